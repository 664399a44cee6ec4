"""Histogram boosting against a plain numpy fit that rescans all rows for every split."""

import numpy as np
import pytest

from featurewright.operators import boosting as B


def _plain_tree(bins, n_cuts, missing, g, h, c):
    """One split at a time; returns leaf value per row and the number of leaves."""
    def best(rows):
        top, G, H = None, g[rows].sum(), h[rows].sum()
        for f in range(len(bins)):
            for b in range(n_cuts[f]):
                for side in (False, True):
                    x = bins[f, rows]
                    left = np.where(x == missing, side, x <= b)
                    if min(left.sum(), (~left).sum()) < max(c.min_child_rows, 1):
                        continue
                    gl, hl = g[rows][left].sum(), h[rows][left].sum()
                    if min(hl, H - hl) < c.min_child_weight:
                        continue
                    gain = gl**2 / (hl + c.reg_lambda) + (G - gl)**2 / (H - hl + c.reg_lambda) - G**2 / (H + c.reg_lambda)
                    if gain > 1e-6 and (top is None or gain > top[0] + 1e-9):
                        top = (gain, rows[left], rows[~left])
        return top

    leaves = [(np.arange(len(g)), 0)]
    splits = {0: best(leaves[0][0])}
    while c.max_leaves is None or len(leaves) < c.max_leaves:
        able = [i for i, (_, d) in enumerate(leaves) if splits.get(i) and (c.max_depth is None or d < c.max_depth)]
        if not able:
            break
        i = max(able, key=lambda j: splits[j][0])
        _, left, right = splits.pop(i)
        d = leaves[i][1] + 1
        leaves[i] = (left, d)
        leaves.append((right, d))
        splits[i], splits[len(leaves) - 1] = best(left), best(right)
    out = np.zeros(len(g))
    for rows, _ in leaves:
        out[rows] = -g[rows].sum() / (h[rows].sum() + c.reg_lambda) * c.eta
    return out, len(leaves)


def _plain_fit(x, y, w, cuts, c, classes, base):
    missing = max(map(len, cuts)) + 1
    bins = np.array([B.binned(x[:, f], cuts[f], missing) for f in range(x.shape[1])])
    margins, counts = np.tile(np.array(base, float), (len(y), 1)), []
    for _ in range(c.rounds):
        g, h = B.gradients(c.objective, margins, y, w)
        step = [_plain_tree(bins, [len(q) for q in cuts], missing, g[:, k], h[:, k], c) for k in range(classes)]
        margins = margins + np.array([s[0] for s in step]).T
        counts.append([s[1] for s in step])
    return margins, counts


def _data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 3] = rng.integers(0, 3, n)
    x[rng.random((n, 4)) < 0.07] = np.nan
    z = np.nan_to_num(x)
    y = ((z[:, 0] + z[:, 1] > 0.3).astype(int) + (z[:, 3] > 1)).astype(float)
    target = 3 * z[:, 0] - z[:, 1] ** 2 + z[:, 3] * (z[:, 2] > 0) + rng.normal(size=n) * 0.1
    return x, y, target, rng.uniform(0.5, 2, n).round(3)


CUTS = [[-1.0, -0.3, 0.0, 0.4, 1.2], [-0.8, 0.1, 0.9], [-0.5, 0.5], [1.0, 2.0]]


def _frame(spark, x, y, target, w, parts=7):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(a), float(t), float(b)) for i, (r, a, t, b) in enumerate(zip(x, y, target, w))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y double, target double, w double").repartition(parts)


@pytest.mark.parametrize("depth, weight", [(2, None), (3, "w")])
def test_softmax_equals_a_plain_fit(spark, depth, weight):
    x, y, target, w = _data()
    df = _frame(spark, x, y, target, w)
    c = B.BoostConfig(num_class=3, rounds=2, max_depth=depth)
    model = B.train_softmax(df, ["a", "b", "c", "d"], "y", c, weight, CUTS)
    want, counts = _plain_fit(x, y, w if weight else np.ones(len(y)), CUTS, c, 3, [0, 0, 0])
    got = {r["id"]: r for r in model.score(df, ["id"]).collect()}
    assert [[t.leaves() for t in r] for r in model.rounds] == counts
    for i, m in enumerate(want):
        assert got[i]["raw_scores"] == pytest.approx(list(m), abs=1e-6)
        p = np.exp(m - m.max())
        assert got[i]["probabilities"] == pytest.approx(list(p / p.sum()), abs=1e-6)
        assert got[i]["prediction"] == m.argmax()


def test_leafwise_equals_one_split_at_a_time(spark):
    x, y, target, w = _data(900)
    df = _frame(spark, x, y, target, w)
    cuts = [sorted(np.unique(np.nanquantile(x[:, f], np.linspace(0.05, 0.95, 19)))) for f in range(4)]
    cuts = [[float(v) for v in q] for q in cuts]
    c = B.BoostConfig("squared", rounds=2, eta=0.1, max_depth=None, max_leaves=32, reg_lambda=0.0, min_child_weight=1e-3, min_child_rows=5)
    model = B.train_leafwise(df, ["a", "b", "c", "d"], "target", c, cuts=cuts)
    want, _ = _plain_fit(x, target, np.ones(len(y)), cuts, c, 1, [target.mean()])
    assert [[t.leaves() for t in r] for r in model.rounds] == [[32], [32]]
    assert max(t.depth() for r in model.rounds for t in r) > 5  # not level by level
    got = {r["id"]: r["prediction"] for r in model.score(df, ["id"]).collect()}
    assert np.allclose([got[i] for i in range(len(y))], want[:, 0], atol=1e-6)


def test_same_trees_for_any_partitioning_and_after_refresh(spark, monkeypatch):
    x, y, target, w = _data()
    c = B.BoostConfig(num_class=3, rounds=3, max_depth=2)
    a = B.train_softmax(_frame(spark, x, y, target, w, 1), ["a", "b", "c", "d"], "y", c, cuts=CUTS)
    monkeypatch.setattr(B, "REFRESH", 1)
    monkeypatch.setattr(B, "FAN", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 16)
    b = B.train_softmax(_frame(spark, x, y, target, w, 9), ["a", "b", "c", "d"], "y", c, cuts=CUTS)
    assert a.to_json() == b.to_json()
    assert B.BoostModel.from_json(a.to_json()).to_json() == a.to_json()


def test_boosting_learns_and_reports_log_loss(spark):
    x, y, target, w = _data(1500, 9)
    df = _frame(spark, x, y, target, w)
    model = B.train_softmax(df.where("id < 1000"), ["a", "b", "c", "d"], "y", B.BoostConfig(num_class=3, rounds=12))
    scored = model.score(df.where("id >= 1000"), ["id", "y"])
    loss = B.log_loss(scored, "y").first()["log_loss"]
    p = np.bincount(y[:1000].astype(int), minlength=3) / 1000
    prior = -np.log(p[y[1000:].astype(int)]).mean()
    assert loss < 0.5 * prior
    rows = scored.collect()
    assert loss == pytest.approx(np.mean([-np.log(r["probabilities"][int(r["y"])]) for r in rows]))


def test_rejected_and_degenerate_inputs(spark):
    x, y, target, w = _data(60)
    df = _frame(spark, x, y, target, w)
    with pytest.raises(ValueError, match="not a class"):
        B.train_softmax(df, ["a"], "y", B.BoostConfig(num_class=2, rounds=1))
    with pytest.raises(ValueError, match="no row"):
        B.train_softmax(df.where("id < 0"), ["a"], "y", B.BoostConfig(num_class=3, rounds=1))
    flat = B.train_leafwise(df.selectExpr("id", "CAST(1 AS double) AS a", "CAST(4 AS double) AS t"), ["a"], "t")
    assert all(t.leaves() == 1 for r in flat.rounds for t in r) and flat.base == [4.0]
    nulls = B.train_leafwise(df.selectExpr("id", "CAST(NULL AS double) AS a", "target"), ["a"], "target", B.BoostConfig("squared", rounds=1))
    assert nulls.score(df.selectExpr("id", "CAST(NULL AS double) AS a"), ["id"]).count() == 60
