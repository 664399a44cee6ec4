"""Logistic regression on more features than the driver can hold the solver's vectors of.

The method and the steps are those of Spark ML's binary fit: standardized and centred features, L2
penalty, L-BFGS with ten pairs of history and a strong Wolfe line search.  What differs is where vectors live.
The levels of the largest categorical column are dealt to blocks, each with the rows that hold
them; a block keeps its part of every iterate ``x`` and of its gradient.  All vectors of
the solver are sums of those and of the scaled feature means, so the driver only
needs their dot products.  It holds vectors of the shared features alone: the numeric columns, the other
categorical columns' levels, and levels so frequent that their rows are spread over all blocks.

One evaluation is one pass over the packed blocks, which stay where they are; per block the driver
gets the loss, the dot products and the gradient of the shared features.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurewright.session import materialize

MEMORY = 10
#: Rows of a block.
BLOCK_ROWS = 200_000


class _Failed(Exception):
    """The line search found no step."""


def pack(rows: DataFrame, numeric: int, cats: int, blocks: int) -> DataFrame:
    """One row per block from ``block, main, n0.., c0.., label, weight``: its arrays, and the weight of each of its levels.

    ``main`` counts from the block's first level, ``c`` from the first shared feature; -1 is none.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        num = np.column_stack([pdf[f"n{i}"].to_numpy(np.float64) for i in range(numeric)]) if numeric else np.zeros((len(pdf), 0))
        cat = np.column_stack([pdf[f"c{j}"].to_numpy(np.int32) for j in range(cats)]) if cats else np.zeros((len(pdf), 0), np.int32)
        main, weight = pdf["main"].to_numpy(np.int32), pdf["weight"].to_numpy(np.float64)
        held = np.bincount(main[main >= 0], weight[main >= 0])
        order = np.argsort(main, kind="stable")
        data = {"num": num[order], "cat": cat[order], "main": main[order], "y": pdf["label"].to_numpy(np.float64)[order], "w": weight[order], "held": held}
        return pd.DataFrame({"block": [pdf["block"].iat[0]], "data": [pickle.dumps(data)]})

    packed = rows.repartition(blocks, "block").groupBy("block").applyInPandas(run, "block int, data binary")
    return materialize(packed.repartition(blocks, "block").sortWithinPartitions("block"))


def _per_block(packed: DataFrame, fn) -> list:
    def run(batches):
        for batch in batches:
            for blob in batch["data"]:
                yield pd.DataFrame({"out": [pickle.dumps(fn(pickle.loads(blob)))]})

    return [pickle.loads(r["out"]) for r in packed.select("data").mapInPandas(run, "out binary").collect()]


def _moments(shared: int, numeric: int):
    def fn(d):
        w, sums, squares = d["w"], np.zeros(shared), np.zeros(shared)
        sums[:numeric], squares[:numeric] = w @ d["num"], w @ d["num"] ** 2
        for c in d["cat"].T:
            sums += np.bincount(c[c >= 0], w[c >= 0], shared)
        squares[numeric:] = sums[numeric:]
        return w.sum(), (w * w).sum(), w[d["y"] > 0].sum(), len(w), sums, squares

    return fn


class _Problem:
    """The evaluations: x is known by its coefficients over the basis x0, h0, x1, h1, .., mu.

    ``h`` is the gradient before the centring is taken off: g = h - slope * mu, with the sum of the multipliers
    ``slope`` only known when all blocks are through.
    """

    def __init__(self, packed: DataFrame, shared: int, numeric: int):
        self.packed, self.shared, self.numeric = packed, shared, numeric
        parts = _per_block(packed, _moments(shared, numeric))
        self.weight, square, self.positive, n = (sum(p[i] for p in parts) for i in range(4))
        self.penalty = 1.0 / n
        self.spread = self.weight - square / self.weight
        sums, squares = sum(p[4] for p in parts), sum(p[5] for p in parts)
        mean = sums / self.weight
        self.std = np.sqrt(np.maximum((squares - self.weight * mean ** 2) / self.spread, 0.0))
        inv = np.divide(1.0, self.std, out=np.zeros(shared), where=self.std > 0)
        self.inv = inv
        self.mu = np.append(mean * inv, 0.0)  # the intercept last
        self.points: list[dict] = []  # those in memory, oldest first
        self.gram: dict[tuple, float] = {}
        self.next = 0

    def basis(self) -> list[tuple]:
        return [v for p in self.points for v in (("x", p["id"]), ("h", p["id"]))] + [("mu", 0)]

    def dot(self, a: dict, b: dict) -> float:
        return sum(p * q * self.gram[u, v] for u, p in a.items() if p for v, q in b.items() if q)

    def value(self, x: dict, own: np.ndarray) -> dict:
        """Evaluates at the vector with coefficients ``x``; ``own``: its shared part and intercept."""
        inv, weight, spread, penalty, shared, numeric = self.inv, self.weight, self.spread, self.penalty, self.shared, self.numeric
        ids, made = [p["id"] for p in self.points], dict(x)
        offset = own[-1] - (sum(q * self.gram[u, ("mu", 0)] for u, q in x.items() if q) if x else 0.0)
        scaled = own[:-1] * inv

        def at(d, held):
            """The block's part: x, h and what the driver adds up."""
            ws = d["held"]
            std = np.sqrt(np.maximum(ws * (weight - ws) / weight / spread, 0.0))
            back = np.divide(1.0, std, out=np.zeros(len(ws)), where=std > 0)
            mu = ws / weight * back
            known = [(v, held[v]) for v in (u for i in ids for u in (("x", i), ("h", i)))] + [(("mu", 0), mu)]
            point = np.zeros(len(ws))
            for v, vector in known:
                if made.get(v):
                    point += made[v] * vector
            coef = point * back
            margin = offset + d["num"] @ scaled[:numeric]
            for c in d["cat"].T:
                margin += np.where(c >= 0, scaled[c], 0.0) if shared else 0.0
            main, y, w = d["main"], d["y"], d["w"]
            inside = main >= 0
            margin[inside] += coef[main[inside]]
            loss = float(w @ (np.logaddexp(0.0, margin) - y * margin))
            many = w * (1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700))) - y)
            h = np.bincount(main[inside], many[inside], len(ws)) * back / weight + penalty * coef * back
            raw = np.zeros(shared)
            raw[:numeric] = many @ d["num"]
            for c in d["cat"].T:
                raw += np.bincount(c[c >= 0], many[c >= 0], shared)
            dots = {("x", v): float(point @ vector) for v, vector in known} | {("h", v): float(h @ vector) for v, vector in known}
            dots |= {("x", "x"): float(point @ point), ("x", "h"): float(point @ h), ("h", "h"): float(h @ h), ("mu", "mu"): float(mu @ mu)}
            return point, h, (loss, float(many.sum()), 0.5 * penalty * float(coef @ coef), raw, dots)

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            d = pickle.loads(left["data"].iat[0])
            held = {}
            for i, x_blob, h_blob in zip(right["id"], right["x"], right["h"]):
                held["x", i], held["h", i] = (np.frombuffer(b) if b else np.zeros(0) for b in (x_blob, h_blob))
            point, h, said = at(d, held)
            return pd.DataFrame({"block": [left["block"].iat[0]], "x": [point.tobytes()], "h": [h.tobytes()], "said": [pickle.dumps(said)]})

        schema = "block int, x binary, h binary, said binary"
        if ids:
            vectors = None
            for p in self.points:
                one = p["vectors"].select("block", F.lit(p["id"]).alias("id"), "x", "h")
                vectors = one if vectors is None else vectors.unionByName(one)
            found = self.packed.groupBy("block").cogroup(vectors.groupBy("block")).applyInPandas(run, schema)
        else:
            none = pd.DataFrame({"id": [], "x": [], "h": []})
            found = self.packed.groupBy("block").applyInPandas(lambda left: run(left, none), schema)
        found = materialize(found)
        said = [pickle.loads(r["said"]) for r in found.select("said").collect()]
        loss, slope, fine = (sum(s[i] for s in said) for i in range(3))
        raw = sum(s[3] for s in said)
        me = self.next
        self.next += 1
        h = np.append(raw * inv / weight + penalty * own[:-1] * inv ** 2, slope / weight)
        point = {"id": me, "vectors": found, "x": own, "h": h, "slope": slope / weight,
                 "f": loss / weight + fine + 0.5 * penalty * float(scaled @ scaled)}
        names, mine = self.basis(), {"x": own, "h": h}
        shares = {("x", p["id"]): p["x"] for p in self.points} | {("h", p["id"]): p["h"] for p in self.points} | {("mu", 0): self.mu}
        for k in ("x", "h"):
            for v in names:
                total = sum(s[4][k, v] for s in said) + float(mine[k] @ shares[v])
                self.gram[(k, me), v] = self.gram[v, (k, me)] = total
        for a, b in (("x", "x"), ("x", "h"), ("h", "h")):
            total = sum(s[4][a, b] for s in said) + float(mine[a] @ mine[b])
            self.gram[(a, me), (b, me)] = self.gram[(b, me), (a, me)] = total
        self.gram[("mu", 0), ("mu", 0)] = sum(s[4]["mu", "mu"] for s in said) + float(self.mu @ self.mu)
        return point

    def share(self, a: dict) -> np.ndarray:
        """The shared part and intercept of the vector with coefficients ``a``."""
        out = np.zeros(self.shared + 1)
        for p in self.points:
            out += a.get(("x", p["id"]), 0.0) * p["x"] + a.get(("h", p["id"]), 0.0) * p["h"]
        return out + a.get(("mu", 0), 0.0) * self.mu


def _plus(a: dict, b: dict, by: float = 1.0) -> dict:
    return {k: a.get(k, 0.0) + by * b.get(k, 0.0) for k in {**a, **b}}


def _gradient(p: dict) -> dict:
    return {("h", p["id"]): 1.0, ("mu", 0): -p["slope"]}


def _direction(problem: _Problem, points: list[dict]) -> dict:
    """The two-loop recursion, on coefficients."""
    pairs = [(_plus({("x", b["id"]): 1.0}, {("x", a["id"]): 1.0}, -1.0), _plus(_gradient(b), _gradient(a), -1.0)) for a, b in zip(points, points[1:])][::-1]
    out, steps = _gradient(points[-1]), []
    for s, y in pairs:
        rho = problem.dot(s, y)
        alpha = problem.dot(s, out) / rho if rho else math.nan
        if math.isnan(alpha):
            raise _Failed
        steps.append((alpha, rho))
        out = _plus(out, y, -alpha)
    if pairs:
        s, y = pairs[0]
        if problem.dot(s, y) < 0:
            raise _Failed
        by = problem.dot(s, y) / problem.dot(y, y)
        out = {k: v * by for k, v in out.items()}
    for (s, y), (alpha, rho) in zip(pairs[::-1], steps[::-1]):
        out = _plus(out, s, alpha - problem.dot(y, out) / rho)
    return {k: -v for k, v in out.items()}


def _between(a: tuple, b: tuple) -> float:
    """Minimum of the cubic through two points (t, slope, value), kept off their ends."""
    (lt, ld, lf), (rt, rd, rf) = a, b
    d1 = ld + rd - 3 * (lf - rf) / (lt - rt)
    root = d1 * d1 - ld * rd
    if root < 0:
        return lt + 0.5 * (rt - lt)
    d2 = math.sqrt(root)
    t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2 * d2)
    return min(max(t, lt + 0.1 * (rt - lt)), lt + 0.9 * (rt - lt))


def _search(phi, start: tuple, t: float):
    """Strong Wolfe line search; phi(t) is ((t, slope, value), point)."""
    _, slope, value = start
    if slope > 0:
        raise _Failed

    def enough(c, t):
        return c[2] <= value + 1e-4 * t * slope

    def zoom(low, high):
        for _ in range(10):
            c, point = phi(_between(high, low) if low[0] > high[0] else _between(low, high))
            if not enough(c, c[0]) or c[2] >= low[2]:
                high = c
                continue
            if abs(c[1]) <= 0.9 * abs(slope):
                return point, c[0]
            if c[1] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _Failed

    low = start
    for i in range(10):
        c, point = phi(t)
        if not math.isfinite(c[2]):
            t /= 2.0
            continue
        if not enough(c, t) or (c[2] >= low[2] and i > 0):
            return zoom(low, c)
        if abs(c[1]) <= 0.9 * abs(slope):
            return point, t
        if c[1] >= 0:
            return zoom(c, low)
        low = c
        t *= 1.5
    raise _Failed


def fit(packed: DataFrame, shared: int, numeric: int, max_iter: int, tol: float = 1e-6) -> tuple[np.ndarray, float, DataFrame]:
    """Coefficients of the shared features, the intercept, and (block, coefs: bytes of doubles) of the blocks' levels."""
    problem = _Problem(packed, shared, numeric)
    own = np.zeros(shared + 1)
    own[-1] = math.log(problem.positive / (problem.weight - problem.positive))
    now = problem.value({}, own)
    problem.points = [now]
    history, values, first, failed, i = [now], [math.inf], now["f"], False, 0
    while i < max_iter:
        g = _gradient(now)
        if math.sqrt(max(problem.dot(g, g), 0.0)) <= max(tol * now["f"], 1e-8):
            break
        if abs(now["f"] - max(values)) <= tol * first:
            break
        try:
            d = _direction(problem, history)
            size = math.sqrt(problem.dot(d, d))

            def phi(t, base=now, d=d):
                x = _plus({("x", base["id"]): 1.0}, d, t)
                point = problem.value(x, problem.share(x))
                return (t, problem.dot(_gradient(point), d), point["f"]), point

            new, t = _search(phi, (0.0, problem.dot(g, d), now["f"]), 1.0 / size if i == 0 else 1.0)
            if t * math.sqrt(problem.dot(g, g)) < 1e-10:
                raise _Failed
        except _Failed:
            if failed:
                break
            failed, history, problem.points = True, [now], [now]
            continue
        now, failed, i = new, False, i + 1
        history = [*history, now][-(MEMORY + 1):]
        problem.points = history
        values = [*values, now["f"]][-20:]
    weight, spread = problem.weight, problem.spread

    def unscaled(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        held = pickle.loads(left["data"].iat[0])["held"]
        std = np.sqrt(np.maximum(held * (weight - held) / weight / spread, 0.0))
        blob = right["x"].iat[0]
        coef = np.divide(np.frombuffer(blob) if blob else np.zeros(0), std, out=np.zeros(len(held)), where=std > 0)
        return pd.DataFrame({"block": [left["block"].iat[0]], "coefs": [coef.tobytes()]})

    levels = packed.groupBy("block").cogroup(now["vectors"].select("block", "x").groupBy("block")).applyInPandas(unscaled, "block int, coefs binary")
    intercept = now["x"][-1] - problem.gram[("x", now["id"]), ("mu", 0)]
    return now["x"][:-1] * problem.inv, float(intercept), materialize(levels)
