"""Near-dedup: words and fingerprints whose hashes are made to collide, blocks of large groups, the stage itself."""

import random

import numpy as np
import pytest

pytest.importorskip("featurewright.llm")

from featurewright.llm import near_dedup  # noqa: E402

SCHEMA = "doc_id bigint, text string, node string, n int, row string"


def _frame(spark, texts, parts=3):
    return spark.createDataFrame([(i, t, "clash", 1, "c") for i, t in enumerate(texts)], SCHEMA).repartition(parts)


def _brute(texts, words, percent=80):
    sets = [near_dedup.shingles(t, words) for t in texts]
    comp = list(range(len(texts)))
    for x in range(len(texts)):
        for y in range(x):
            if sets[x] and sets[y] and near_dedup._alike(sets[x], sets[y], percent):
                a, b = comp[x], comp[y]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    return comp


@pytest.mark.parametrize("size", [16, 512, 4096])
def test_bit_parity_words_are_different(spark, size):
    """A binary bit-parity word and its complement: equal under any polynomial hash modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = near_dedup.near_groups(_frame(spark, [one, other, one.upper()])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 1, 2: 0}


def _real_sizes(real):
    """Shingle hashes that say nothing but the set's size: all sets of a size collide."""
    def sets(buf, offs, k):
        h, at = real(buf, offs, k)
        return np.concatenate([np.arange(b - a, dtype=np.uint64) for a, b in zip(at, at[1:])] or [np.zeros(0, np.uint64)]), at

    return sets


def test_equal_fingerprints_of_different_sets(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(12)]
    texts += [t.upper() for t in texts[:4]] + [t.replace(" ", "\n") for t in texts[2:5]] + ["one", "two", "one", None, ""]
    monkeypatch.setattr(near_dedup, "shingle_sets", _real_sizes(near_dedup.shingle_sets))
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(_frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, 5)


def test_blocks_whose_hashes_collide_are_confirmed(spark, monkeypatch):
    """What passes in a block by its hashes is refuted on the full sets, and then all that pass are looked at."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    base = rng.choices(vocabulary, k=60)
    texts = []
    for i in range(40):
        t = list(base)
        for _ in range(i // 6):
            t[rng.randrange(60)] = rng.choice(vocabulary)
        texts.append(" ".join(t))
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    monkeypatch.setattr(near_dedup, "SEEDS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 2000)
    want = _brute(texts, 2)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(_frame(spark, texts), words=2, rows=1).collect()}
    assert [got[i] for i in range(40)] == want
    monkeypatch.setattr(near_dedup, "shingle_sets", _real_sizes(near_dedup.shingle_sets))
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(_frame(spark, texts), words=2, rows=1).collect()}
    for i, c in enumerate(_brute(texts, 2)):  # sizes differ, so not all pairs are candidates; none is linked wrongly
        assert got[i] >= c


def test_overlaps_count_shared_hashes():
    sets = [np.array([1, 5, 9], np.uint64), np.array([], np.uint64), np.array([5, 6], np.uint64)]
    value, owner = np.concatenate(sets), np.repeat(np.arange(3), [3, 0, 2])
    order = np.argsort(value)
    got = near_dedup._overlaps((value[order], owner[order]), 3, np.array([5, 9, 10], np.uint64))
    assert got.tolist() == [2, 0, 1]


def test_stage_keeps_one_row_of_each_group(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(120_000))  # about a megabyte
    texts = ["a b c d e f g", "A B C D E F G", "h i j", None, "", long, long + " end", "h i k"]
    rows = [(i if i != 7 else None, t, "x", 1, "y") for i, t in enumerate(texts)] + [(2, "h i j", "x", 1, "y")]
    out = near_dedup.near_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 0), (False, 2), (False, 3), (False, 4), (False, 5), (True, 0)]
    assert out[0].asDict().keys() == {"doc_id", "text", "node", "n", "row"}
    assert near_dedup.near_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
