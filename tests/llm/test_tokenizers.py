"""Byte-level BPE and cross-tokenizer alignment against the libraries and brute force."""

import base64
import collections
import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("featurewright.llm")

import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402
import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from featurewright.llm import byte_bpe, token_alignment  # noqa: E402

SCHEMA = "doc_id bigint, text string, ids string, slab int, n_a string, lang string"


def _texts():
    rng = random.Random(3)
    words = ["alpha", "été", "日本語", "don't", "  ", "\n\n", "Straße", "🙂", "1234567", "the", "of", "=====", " ", "Ελλάδα", "x" * 40]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(20)]
    return [None, "", " ", "\x00", "<|endoftext|> and <s> </s>", "▁x ▁", " \u0085\x1c a", "a" * 5000, " " * 6000 + "x", "ab" * 3000 + "\n" * 700,
            *base, *base[:4], "".join(rng.choice("abcdefgh") for _ in range(3000)), "\r\n\t" * 50, "the of the of the"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 7 else None, t, "clash", 1, "clash", "en") for i, t in enumerate(_texts())]
    rows += [(1, "twice the same", "c", 1, "c", "en")] * 2
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _library():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_byte_bpe_equals_the_library(docs):
    enc = _library()
    got = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.encode_documents(docs).collect())
    want = []
    for r in docs.collect():
        text = r["text"] or ""
        if len(text) > 5500:  # the library's matcher overflows on long runs of white space
            ids = [x for m in byte_bpe.ByteBpe(byte_bpe.read_ranks()).pattern.findall(text) for x in enc._encode_single_piece(m.encode())]
        else:
            ids = enc.encode_ordinary(text)
        want.append((len(ids), _sha(" ".join(map(str, ids))), _sha(text)))
    assert got == sorted(want)


def test_byte_bpe_round_trip_by_ids(docs):
    encoded = byte_bpe.encode_documents(docs.where("doc_id IS NOT NULL AND doc_id <> 1"), with_ids=True)
    data = {r["doc_id"]: bytes(r["data"]) for r in byte_bpe.decode_documents(encoded).collect()}
    assert data == {i: (t or "").encode() for i, t in enumerate(_texts()) if i % 7 and i != 1}


def _naive(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_merges_are_leftmost_and_of_smallest_rank():
    """A small made-up vocabulary with many ties, against rescanning all pairs."""
    rng = random.Random(8)
    for _ in range(200):
        entries = [bytes([b]) for b in range(97, 101)]
        for _ in range(rng.randint(0, 25)):
            new = rng.choice(entries) + rng.choice(entries)
            if new not in entries:
                entries.append(new)
        ranks = {b: i for i, b in enumerate(entries)}
        piece = bytes(rng.choices(range(97, 101), k=rng.randint(1, 60)))
        assert byte_bpe.merge_ids(piece, ranks, max(map(len, ranks))) == _naive(piece, ranks)
        pieces = [bytes(rng.choices(range(97, 101), k=rng.randint(1, 33))) for _ in range(6)]
        full = {bytes([b]): len(ranks) + b for b in range(256) if bytes([b]) not in ranks} | ranks
        assert byte_bpe.merge_together(pieces, byte_bpe.Pairs(full)) == [tuple(_naive(p, ranks)) for p in pieces]


def test_long_match_and_small_blocks(monkeypatch):
    enc, codec = _library(), byte_bpe.ByteBpe(byte_bpe.read_ranks())
    long = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    assert codec.encode(long) == enc.encode_ordinary(long)
    monkeypatch.setattr(byte_bpe, "BLOCK", 64)
    monkeypatch.setattr(byte_bpe, "MEMO", 5)
    for text in (t for t in _texts() if t and len(t) < 5500):
        assert codec.encode(text) == enc.encode_ordinary(text)


def _expected(texts):
    """Per text the row of the contract, by plain loops."""
    a_tok = Tokenizer.from_file(public_tokenizers.path(token_alignment.SIDE_A))
    a_tok.encode_special_tokens = True
    ranks = byte_bpe.read_ranks()
    bytes_a = {i: b for b, i in ranks.items()}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_alignment.SIDE_B))

    def bytes_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    rows, holders = [], collections.Counter()
    for t in texts:
        spelled = (" " + t).encode() if t else b""
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        if not t or b"".join(bytes_a[i] for i in a) != spelled or b"".join(map(bytes_b, b)) != spelled:
            rows.append(([], [], []))
            continue
        groups, i, j = [], 0, 0
        while i < len(a):
            ga, gb, la, lb = [], [], 0, 0
            while not ga or la != lb:
                if la <= lb:
                    ga.append(a[i])
                    la += len(bytes_a[a[i]])
                    i += 1
                else:
                    gb.append(b[j])
                    lb += len(bytes_b(b[j]))
                    j += 1
            groups.append((ga, gb))
        rows.append((a, b, groups))
        holders.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    top = collections.Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    out = []
    for a, b, groups in rows:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(holders[p] == top[p[0]] for p in links), sum(holders[p] for p in links), _sha(text) if a else ""))
    return out, holders


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("slab, group", [(8 << 20, 32 << 20), (2000, 400)])  # the second: many slabs, salts, slices
def test_alignment_equals_brute_force(docs, monkeypatch, slab, group):
    monkeypatch.setattr(token_alignment, "SLAB", slab)
    monkeypatch.setattr(token_alignment, "GROUP_BYTES", group)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in token_alignment.align_documents(docs).collect())
    want, holders = _expected([r["text"] for r in docs.collect()])
    assert got == sorted(want)
    counted = {(r["a"], r["b"]): r["n"] for r in token_alignment.pair_counts(docs).collect()}
    assert counted == dict(holders)


def test_large_groups_are_weighted():
    """Token ends that never meet: one group of many tokens, whose equal ids count once with a weight."""
    class Sides:
        a_len = np.array([2, 3, 1], np.int64)
        b_len = np.array([4, 1, 3], np.int64)

    rng = np.random.default_rng(2)
    a = np.concatenate([[2], np.zeros(200, np.int64), [1], [0] * 100, [2]])
    total = int(Sides.a_len[a].sum())
    b = np.concatenate([np.zeros(total // 4, np.int64), np.full(total % 4, 1)])
    pairs = [(a, b), (rng.permutation(a), b), (a[:1], np.array([1]))]
    found = token_alignment.Aligned(Sides, pairs)
    keys, links = found.records(5)
    want = collections.Counter()
    for g in range(found.groups):
        for x in found.a[found.group_a == g]:
            for y in found.b[found.group_b == g]:
                want[int(x), int(y), int(found.doc[g]) + 5] += 1
    shift, low = token_alignment.A_BITS - token_alignment._RADIX_BITS, token_alignment._RADIX_BITS
    got = {}
    for k, n in zip(keys.tolist(), links.tolist()):
        turned = k >> (token_alignment.B_BITS + token_alignment.D_BITS)
        x = (turned & (1 << shift) - 1) << low | turned >> shift
        got[x, k >> token_alignment.D_BITS & (1 << token_alignment.B_BITS) - 1, k & (1 << token_alignment.D_BITS) - 1] = n
    assert got == dict(want)
    assert found.n_links.sum() == sum(want.values())


def test_merge_of_many_runs(monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK", 4)
    rng = random.Random(4)
    runs, want = [], collections.Counter()
    for _ in range(30):
        keys = sorted({rng.randrange(40) << token_alignment.D_BITS | rng.randrange(9) for _ in range(rng.randint(0, 60))})
        want.update(k >> token_alignment.D_BITS for k in keys)
        runs.append(token_alignment.write_run(np.array(keys, np.int64), np.ones(len(keys), np.int64)))
    merged = [(int(p), int(n)) for ps, ns in token_alignment.merge_counts(runs) for p, n in zip(ps, ns)]
    assert merged == sorted(want.items())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.encode_documents(empty).collect() == []
    assert token_alignment.align_documents(empty).collect() == []
    nulls = spark.createDataFrame([(None, None, "", 1, "", "")], SCHEMA)
    assert tuple(token_alignment.align_documents(nulls).first()) == (None, 0, 0, 0, 0, 0, 0, "")
    assert byte_bpe.encode_documents(nulls).first()["n_tokens"] == 0
