"""Byte-level BPE, encoding and decoding, with a segment tree over byte positions.

A text is split by the vocabulary's pattern; each match is merged on its own.
A leaf of the tree belongs to the byte at which a live token starts and holds
the rank of that token joined with its right neighbour (one number: rank, then
position); an inner node holds the smallest number below it, so the root names
the leftmost pair of the smallest rank.  A merge changes three leaves (the
token that grew, its left neighbour, the swallowed one) and their paths to the
root, which end early where a node keeps its value: O(log n) a merge, so a
match of a million letters is no special case.

A match that is an entry of the vocabulary as it stands is that entry, as in
the rank library.  Matches are remembered in a memo, at most ``MEMO`` of them and
``MEMO_CHARS`` characters per worker, which changes no result; new matches of up to
``SHORT`` bytes are merged together, one merge of each at a time, in trees that
are the rows of one array.

Null text is empty: no tokens, digests of nothing.  Rows that repeat or share
an id, or have none, are encoded row by row; other columns are not read.  An empty
table gives an empty table.  Nothing is shuffled: one pass over the scan, in
memory the batch read, the memo, and the matches of about ``BLOCK`` characters.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.llm.common import documents, freeing

RANKS = "byte_bpe_50k.tiktoken"
MEMO, MEMO_CHARS, SHORT, BLOCK = 400_000, 32 << 20, 64, 1 << 20
_NONE = 1 << 62  # above every number in a tree: ranks stay below 2^24, matches below 2^31 bytes


def read_ranks(name: str = RANKS) -> dict[bytes, int]:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_ids(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one match after all merges; ``longest`` is the size of the longest vocabulary entry."""
    n = len(piece)
    none = _NONE
    ids = [ranks[piece[i:i + 1]] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n))

    def number(start: int, end: int) -> int:
        rank = ranks.get(piece[start:end]) if end - start <= longest else None
        return none if rank is None else rank * n + start

    tree = [none] * n + [number(i, i + 2) for i in range(n - 1)] + [none]
    for at in range(n - 1, 0, -1):
        a, b = tree[2 * at], tree[2 * at + 1]
        tree[at] = a if a < b else b

    def put(leaf: int, value: int) -> None:
        at = leaf + n
        tree[at] = value
        at >>= 1
        while at:
            a, b = tree[2 * at], tree[2 * at + 1]
            low = a if a < b else b
            if tree[at] == low:
                return
            tree[at] = low
            at >>= 1

    while n > 1 and tree[1] < none:
        rank, i = divmod(tree[1], n)
        gone = after[i]
        end = after[gone]
        ids[i], ids[gone], after[i] = rank, -1, end
        put(gone, none)
        if end < n:
            before[end] = i
            put(i, number(i, after[end]))
        else:
            put(i, none)
        if i:
            put(before[i], number(before[i], end))
    return [x for x in ids if x >= 0]


class Pairs:
    """Rank of two neighbouring tokens' joined bytes, for arrays of ids: a sorted table of all splits of all entries."""

    def __init__(self, ranks: dict[bytes, int]):
        self.span = max(ranks.values()) + 1
        found = [(ranks[left] * self.span + ranks[right], rank) for entry, rank in ranks.items() for cut in range(1, len(entry))
                 if (left := entry[:cut]) in ranks and (right := entry[cut:]) in ranks]
        self.keys, self.rank = np.array(sorted(found), np.int64).reshape(-1, 2).T.copy()
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, whether there is one)"""
        key = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return (self.rank[at], self.keys[at] == key) if len(self.keys) else (key, np.zeros(key.shape, bool))


def merge_together(pieces: list[bytes], pairs: Pairs) -> list[tuple[int, ...]]:
    """Ids of several short matches: ``merge_ids`` for each, with a row of the arrays per match."""
    width = 1 << max(1, (max(map(len, pieces)) - 1).bit_length())
    size = np.array(list(map(len, pieces)))
    place = np.arange(width)
    ids = np.full((len(pieces), width + 1), -1, np.int64)
    ids[:, :width][place < size[:, None]] = pairs.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.tile(np.arange(1, width + 2), (len(pieces), 1))
    before = np.tile(np.arange(-1, width), (len(pieces), 1))
    tree = np.full((len(pieces), 2 * width), _NONE, np.int64)

    def put(row: np.ndarray, leaf: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        rank, known = pairs.ranks(left, right)
        tree[row, width + leaf] = np.where(known, rank * width + leaf, _NONE)

    row, leaf = np.nonzero(place < size[:, None] - 1)
    put(row, leaf, ids[row, leaf], ids[row, leaf + 1])
    level = width
    while level > 1:  # all inner nodes, from the leaves up
        level //= 2
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
    row = np.flatnonzero(tree[:, 1] < _NONE)
    while len(row):
        rank, i = np.divmod(tree[row, 1], width)
        gone = after[row, i]
        end = after[row, gone]
        ids[row, i], ids[row, gone], after[row, i] = rank, -1, end
        before[row, end] = i
        tree[row, width + gone] = tree[row, width + i] = _NONE
        more = end < size[row]
        put(row[more], i[more], rank[more], ids[row[more], end[more]])
        less = i > 0
        left = before[row[less], i[less]]
        put(row[less], left, ids[row[less], left], rank[less])
        for at, r in ((width + gone, row), (width + i, row), (width + left, row[less])):
            for _ in range(width.bit_length() - 1):
                at = at // 2
                tree[r, at] = np.minimum(tree[r, 2 * at], tree[r, 2 * at + 1])
        row = row[tree[row, 1] < _NONE]
    live = ids >= 0
    flat = ids[live].tolist()
    ends = np.cumsum(live.sum(axis=1)).tolist()
    return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]


class ByteBpe:
    """Encoder and decoder of one vocabulary; ``pattern`` None takes the one published with the rank files."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        import public_tokenizers
        import regex

        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.memo_chars = 0

    def _learn(self, matches: list[list[str]]) -> None:
        """Put the ids of all these matches into the memo."""
        memo = self.memo
        new = {m for ms in matches for m in ms if m not in memo}
        if len(memo) + len(new) > MEMO or self.memo_chars > MEMO_CHARS:
            memo.clear()
            self.memo_chars = 0
            new = {m for ms in matches for m in ms}
        short: dict[int, list[tuple[str, bytes]]] = {}
        for m in new:
            piece = m.encode()
            self.memo_chars += len(m)
            whole = self.ranks.get(piece)
            if whole is not None:
                memo[m] = (whole,)
            elif len(piece) <= SHORT:
                short.setdefault((len(piece) - 1).bit_length(), []).append((m, piece))
            else:
                memo[m] = tuple(merge_ids(piece, self.ranks, self.longest))
        for words in short.values():
            memo.update(zip((m for m, _ in words), merge_together([p for _, p in words], self.pairs)))

    def blocks(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(index of the text, some of its ids), texts and ids in order, ids of a bounded number of matches at a time."""
        waiting: list[tuple[int, list[str]]] = []
        chars = 0

        def ready() -> Iterator[tuple[int, list[int]]]:
            self._learn([ms for _, ms in waiting])
            of = self.memo.__getitem__
            for k, ms in waiting:
                yield k, list(itertools.chain.from_iterable(map(of, ms)))
            waiting.clear()

        for k, text in enumerate(texts):
            if len(text) > BLOCK:
                found = (m.group() for m in self.pattern.finditer(text))
                while part := list(itertools.islice(found, BLOCK // 8)):
                    waiting.append((k, part))
                    yield from ready()
                continue
            waiting.append((k, self.pattern.findall(text)))
            chars += len(text)
            if chars > BLOCK:
                yield from ready()
                chars = 0
        yield from ready()

    def encode(self, text: str) -> list[int]:
        return [i for _, ids in self.blocks([text]) for i in ids]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _codec(name: str) -> ByteBpe:
    """One codec per Python worker, so its memo outlives a task."""
    return ByteBpe(read_ranks(name))


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256; ``with_ids`` adds ids array<int>."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = _codec(ranks)
        decimal = {i: str(i) for i in codec.bytes_of}
        for b in batches:
            texts = pc.fill_null(b.column(1), "").to_pylist()
            n_tokens, kept = [0] * len(texts), [[] for _ in texts]
            of_ids, of_text = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
            for k, ids in codec.blocks(texts):
                if n_tokens[k] and ids:
                    of_ids[k].update(b" ")
                n_tokens[k] += len(ids)
                of_ids[k].update(" ".join(map(decimal.__getitem__, ids)).encode())
                of_text[k].update(codec.decode(ids))
                if with_ids:
                    kept[k].extend(ids)
            columns = [b.column(0), pa.array(n_tokens, pa.int64()), *(pa.array([h.hexdigest() for h in hs], pa.string()) for hs in (of_ids, of_text))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return src.mapInArrow(freeing(run), schema)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str = RANKS) -> DataFrame:
    """doc_id, data (the bytes that the ids stand for; null ids: empty).  An id outside the vocabulary raises KeyError."""
    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        codec = _codec(ranks)
        for b in batches:
            data = [codec.decode(ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(freeing(run), f"doc_id {id_type}, data binary")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
