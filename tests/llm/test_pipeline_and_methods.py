"""The corpus pipeline end to end; packing, language ID and mixing against brute force."""

import collections
import random
import re

import numpy as np
import pytest

pytest.importorskip("featurewright.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from featurewright.llm import language_id, mixing, near_dedup, packing, token_counts  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, key string"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_packed_ids_are_the_tokenizers(spark):
    rng = random.Random(1)
    parts = ["the ", "été ", "日本", "🙂", "\n\n", "  ", "x1y2", "<|endoftext|>", "don't ", "Ελλάδα ", " ", "''"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(60)] + [None, "", " " * 6000, "é" * 3000]
    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), with_ids=True).collect()
    for i, text in enumerate(texts):
        ids = [x for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]) for x in r["ids"]]
        assert ids == [*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_placements_minimise_the_sum_of_squares():
    """Every piece goes where the sum of squared counts of partly filled windows gets smallest; uniform sizes included."""
    rng = random.Random(4)
    w = 32
    packer = packing.Packer(w)
    for _ in range(3000):
        before = packer.count.copy()
        size = rng.randint(1, w - 1)
        packer._place((0, 0, np.zeros(size, np.uint32), size))
        sums = {}
        for level in range(w - size + 1):
            if level and not before[level]:
                continue
            after = before.copy()
            after[level] -= level > 0
            after[level + size] += level + size < w
            sums[level] = int((after[1:w].astype(int) ** 2).sum())
        assert int((packer.count[1:w] ** 2).sum()) == min(sums.values())
        assert sum(len(v) for v in packer.open.values()) == packer.count[1:w].sum()


def test_many_open_windows_keep_the_method(spark):
    rng = random.Random(2)
    packer = packing.Packer()
    for i in range(8000):
        packer.add(i, np.zeros(rng.randint(1, 2047), np.uint32))
    assert packer.count.sum() > 0
    packer.finish()
    used = [sum(len(p[2]) for p in pieces) for pieces in packer.done]
    assert sum(used) == sum({(p[0]): p[3] for pieces in packer.done for p in pieces}.values()) and sum(u < 2048 for u in used) <= 1


def test_parse_counts_longest_matches():
    """Phrases against a search of every longest match in the learned text."""
    rng = random.Random(3)
    samples = {"aa": bytes(rng.choices(b"abc ", k=300)), "bb": bytes(rng.choices(b"bcd ", k=200))}
    model = language_id.Model(samples)
    texts = [bytes(rng.choices(b"abcde ", k=rng.randint(0, 1300))) for _ in range(40)]
    offs = np.cumsum([0, *map(len, texts)])
    got = model.phrases(np.frombuffer(b"".join(texts), np.uint8), offs)
    for i, t in enumerate(texts):
        for k, lang in enumerate(model.langs):
            n = 0
            for b in range(0, len(t), language_id.BLOCK):
                n, phrase = n + 1, b""  # a symbol that no learned text has begins a phrase that what follows goes on with
                for c in t[b:b + language_id.BLOCK]:
                    if phrase + bytes([c]) in samples[lang]:
                        phrase += bytes([c])
                    else:
                        n, phrase = n + 1, bytes([c]) if bytes([c]) in samples[lang] else b""
            assert got[i, k] == n


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right > 0.97


def test_many_languages_are_all_learned(spark):
    rows = [(i, f"word{i} word{i} other", f"l{i:05d}") for i in range(600)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert len(model.langs) == 600 and min(model.bits) > 1


def test_counts_beyond_latin_1_merge_unknown_words_only(monkeypatch):
    counter = token_counts.Counter(token_counts.whole_tokens())
    merged = []
    monkeypatch.setattr(counter, "merge", lambda words, f=counter.merge: (merged.extend(words), f(words)))
    texts = ["“the house” of the " + "hello world " * 50 + "qzxqzv", "the house ‘of’ hello"]
    assert counter.count(texts) == [len(counter.t.encode(x, add_special_tokens=False).ids) for x in texts]
    assert not {"the", "house", "of", "hello", "world"} & set(merged) and "qzxqzv" in merged


@pytest.mark.parametrize("copies", [1, 7, 40])
def test_mix_meets_the_plan_with_repeated_rows(spark, copies):
    rng = random.Random(copies)
    rows = [(5, "a b c d e f", "en", "s1", 11, 1, "k")] * copies
    rows += [(i, " ".join(["w"] * rng.randint(0, 9)), "en", ["s1", "s2", None][i % 3], 5, 1, "k") for i in range(20, 60)]
    rows += [(None, "x y z", "en", "s2", 5, 1, "k")] * copies
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    planned = collections.Counter()
    for r in mixing.mixture(docs).collect():
        planned[r["source"]] += r["taken"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r["source"]] += len(_words(r["text"]))
        assert r["n_chars"] in (len(r["text"]), 5, 11)
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in planned.items() if v}


def test_pipeline_of_awkward_rows(spark):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in ("sun", "moon", "tree", "house", "river", "stone", "cloud") for b in ("light", "ful", "ing", "ly", "er", "s", "ed", "est")]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(30, 90))) for _ in range(30)]
    run = "\n".join(" ".join(rng.choices(vocabulary, k=12)) for _ in range(6))  # one passage that many hold
    texts = [b + "\n" + run + "\nend of " + b[:20] for b in base] + base[:5] + [base[7] + " extra"] + [None, "", "12 34 !!", " ".join(rng.choices(vocabulary, k=150_000))]
    rows = [(i if i % 9 else None, t, "en", ["a", "b", None][i % 3], len(t or ""), 1, "clash") for i, t in enumerate(texts)]
    rows += [rows[1]] * 3
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.table(stage(spark, docs, ""), name)
        assert out.columns == docs.columns, name
        if name == "language_id":
            assert out.count() == len(rows) - 3  # no text, or no letter
        if name == "line_dedup":
            lines = collections.Counter(line for r in out.collect() for line in set(r["text"].split("\n")))
            assert all(lines[line] <= 4 for line in run.split("\n"))  # rows given several times count as one document
        if name == "near_dedup":
            sets = [near_dedup.shingles(r["text"], 5) for r in out.collect()]
            assert not any(near_dedup._alike(a, b, 80) for i, a in enumerate(sets) for b in sets[:i] if a and b)
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    by_doc = collections.Counter()
    for r in pieces:
        by_doc[r["doc_id"]] += r["length"]
    encode = packing.encoder()
    want = collections.Counter()
    for r in docs.collect():
        want[r["doc_id"]] += len(encode(r["text"] or "")) + 1
    assert by_doc == want


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [f.split()[0] for f in DOCS.split(", ")]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").collect() == []
