"""Secret scans: statistics against numpy, positions and overlaps against brute force, many matches in one text."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("featurewright.llm")

from featurewright.llm import secrets  # noqa: E402


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 1000, 16384, 16385, 40000])
def test_starts_are_exclusive_sums(spark, n):
    sizes = [random.Random(n).randrange(9) for _ in range(n)]
    got = spark.createDataFrame([(sizes,)], "x array<int>").select(secrets.starts(F.col("x")).alias("s")).first()["s"]
    assert got == [0, *np.cumsum(sizes).tolist()][:n]


def _base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def _named(text):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in _base(text))


def test_base_spans_of_awkward_texts(spark):
    rng = random.Random(7)
    bits = ['token="', "secret = ", "abcdef0123456789" * 2, "AKIA", "ABCDEFGHIJKLMNOP", " ", "\n", "é", "🙂", "api_key:", "x", "passwd='", "/", "=="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "c"), (None, texts[1], "c"), (900, None, "c"), (901, "", "c")], "doc_id int, text string, spans string")
    rows = secrets.find_secrets(df).collect()
    assert len(rows) == 204
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] < 200:
            own = {s for s in r["spans"].split(",") if s and not s.startswith("random")}
            assert own == {s for s in _named(texts[r["doc_id"]]).split(",") if s}


def test_candidates_under_base_spans_are_left_out(spark):
    rng = random.Random(3)
    cand, base = [], []
    for row in range(30):
        for _ in range(rng.randint(0, 12)):
            a = rng.randrange(100)
            cand.append((row, (a, 3, a + rng.randint(1, 30))))
        for _ in range(rng.randint(0, 6)):
            a = rng.randrange(100)
            base.append((row, (a, 0, a + rng.randint(1, 30))))
    span = "struct<start:int,kind:int,end:int>"
    c = spark.createDataFrame([(r, s, (s, "t")) for r, s in cand], f"row int, of {span}, r struct<span:{span},run:string>")
    got = secrets._uncovered(c, spark.createDataFrame(base, f"row int, b {span}")).collect()
    want = [(r, s) for r, s in cand if not any(q == r and b[0] < s[2] and b[2] > s[0] for q, b in base)]
    assert sorted((x["row"], tuple(x["of"])) for x in got) == sorted(want)


def test_uniformity_statistics(spark):
    """The battery's gate against the three statistics computed with numpy."""
    rng = random.Random(5)
    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789"
    runs = ["".join(rng.choices(alphabet, k=n)) for n in (24, 40, 64, 200) for _ in range(15)]
    runs += ["".join(rng.choices(alphabet[:6] + "09", k=40)) for _ in range(10)] + ["".join(sorted(rng.choices(alphabet, k=60))) for _ in range(10)]
    runs += [("az09" * 20)[:60], "aaaaaaaaaaaaaaaaaaaaaaaa1"]
    got = {r["run"]: r for r in secrets.battery(spark.createDataFrame([(x,) for x in runs], "run string")).collect()}
    for run in runs:
        r = got[run]
        letters = secrets.ENCODINGS[r["code"]][1]
        assert set(run) <= set(letters)
        x, k, n = np.array([letters.index(c) for c in run], float), len(letters), len(run)
        chi = (np.bincount(x.astype(int), minlength=k) ** 2).sum() * k / n - n
        up = x >= k / 2
        n1, n2 = up.sum(), (~up).sum()
        z = [((max(chi, 0) / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / np.sqrt(2 / (9 * (k - 1)))]
        both = 2 * n1 * n2
        if not (n1 and n2 and both > n):
            assert not r["uniform"]
            continue
        z.append((1 + (up[1:] != up[:-1]).sum() - (both / n + 1)) / np.sqrt(both * (both - n) / (n * n * (n - 1))))
        mid = x - (k - 1) / 2
        z.append((mid[1:] * mid[:-1]).sum() / ((k * k - 1) / 12 * np.sqrt(n - 1)))
        w = -max(map(abs, z))
        p = 1 / (1 + np.exp(-(1.5976 * w + 0.070566 * w**3)))
        assert r["uniform"] == bool(6 * p >= secrets.UNIFORM_ALPHA)


def test_many_matches_in_one_text_take_seconds(spark):
    """100,000 assignments and long runs in one text of several megabytes."""
    rng = random.Random(1)
    text = "".join(f"token={rng.getrandbits(64):016x}x " for _ in range(100_000))
    began = time.time()
    r = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert r["n_assign"] == 100_000 and time.time() - began < 120
