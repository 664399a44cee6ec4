"""Sum-of-squares online packing of documents into fixed token windows.

Each partition is packed on its own in one pass, right where its texts are
read: no shuffle, and an executor's loss repeats its partitions only.  A
document's whole windows go out at once.  What is left of it goes to the fill
level that keeps the sum of squared counts of partly filled windows smallest:
an array holds, for each level, how many open windows are filled that far, and
placing a piece of L tokens at level h changes the sum by
2 * (count[h + L] - count[h] + 1); a new window (h = 0) and one that gets full
change one term only, by 2 * count[L] + 1 and 1 - 2 * count[h].

When the partition ends, the open windows are laid end to end and cut anew at the
window size, so padding is at most one window in a partition.  Memory: the batch
read and the ids in open windows, of whatever number: at most those of the
partition, four bytes a token.

Null text is empty; an empty document is its end token alone.  Rows that share
an id are packed as separate documents.  Sequence ids are (partition, number).
"""

from __future__ import annotations

import base64
import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.llm.common import documents, freeing

WINDOW, END_ID = 2048, 1
TOKENIZER, RANKS, SPECIAL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "<|endoftext|>"
#: Longer runs of white space overflow the rank encoder's pattern matcher.
_LONG_SPACE = re.compile(r"\s{5000}")


@functools.cache
def encoder(json_name: str = TOKENIZER, ranks_name: str = RANKS):
    """text -> ids of the JSON tokenizer.

    Texts in Latin-1 go through the rank file of the same vocabulary, which is
    four times as fast and gives the same ids there; others, whose letter
    classes may differ between the two libraries' Unicode versions, and
    over-long runs of white space go through the tokenizer itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(json_name))
    special = {t.content: i for i, t in exact.get_added_tokens_decoder().items()}
    with open(public_tokenizers.path(ranks_name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return exact.encode(text, add_special_tokens=False).ids
        if len(text) >= 5000 and _LONG_SPACE.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        if any(s in text for s in special):
            return fast.encode(text, allowed_special="all")
        return fast.encode_ordinary(text)

    return encode


class Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens); finished windows come out of ``done`` as lists of pieces."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.done: list[list] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        whole = n - n % w
        for s in range(0, whole, w):
            self.done.append([(doc_id, s, ids[s:s + w], n)])
        if whole < n:
            self._place((doc_id, whole, ids[whole:].copy(), n))

    def _place(self, piece) -> None:
        size = len(piece[2])
        c = self.count
        usable = c[:self.window + 1 - size] > 0
        usable[0] = True
        # less 2: the change of the sum; a new window empties no level and a full one fills none
        change = 2 * (c[size:] - c[:self.window + 1 - size])
        change[0] -= 1
        change[-1] -= 1
        levels = np.flatnonzero(usable)
        best = change[levels]
        level = int(levels[len(best) - 1 - int(np.argmin(best[::-1]))])  # ties: the fullest
        if level:
            pieces = self._take(level)
        else:
            pieces = []
        pieces.append(piece)
        self._put(level + size, pieces)

    def _take(self, level: int) -> list:
        stack = self.open[level]
        pieces = stack.pop()
        if not stack:
            del self.open[level]
        self.count[level] -= 1
        return pieces

    def _put(self, level: int, pieces: list) -> None:
        if level == self.window:
            self.done.append(pieces)
            return
        self.open.setdefault(level, []).append(pieces)
        self.count[level] += 1

    def _join_open(self) -> None:
        """Lay the open windows end to end and cut them anew; one stays open at most."""
        now, level = [], 0
        for pieces in [p for at in sorted(self.open) for p in self.open[at]]:
            for doc_id, start, ids, n in pieces:
                while len(ids):
                    part, ids = ids[:self.window - level], ids[self.window - level:]
                    now.append((doc_id, start, part, n))
                    start += len(part)
                    level += len(part)
                    if level == self.window:
                        self.done.append(now)
                        now, level = [], 0
        self.open = {}
        self.count[:] = 0
        if now:
            self._put(level, now)

    def finish(self) -> None:
        self._join_open()
        for level in list(self.open):
            self.done.extend(self.open.pop(level))


_COLUMNS = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("padded_to", pa.int64()),
            ("ids", pa.list_(pa.uint32()))]


def padded_to(tokens: int, window: int) -> int:
    return tokens if tokens & (tokens - 1) == 0 else window


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's token ids."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    columns = _COLUMNS if with_ids else _COLUMNS[:-1]

    def run(batches):
        encode, packer, first, id_type = encoder(), Packer(window), TaskContext.get().partitionId() << 33, None
        number = 0

        def out():
            nonlocal number
            ids, rows = [], []
            for pieces in packer.done:
                total, at = sum(len(p[2]) for p in pieces), 0
                for doc_id, start, part, n in pieces:
                    ids.append(doc_id)
                    row = (start, len(part), zlib.crc32(part.astype("<u4").tobytes()), n, first + number, at, total, padded_to(total, window))
                    rows.append((*row, part) if with_ids else row)
                    at += len(part)
                number += 1
            packer.done = []
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), *(pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(columns))],
                ["doc_id", *(c for c, _ in columns)],
            )

        for b in batches:
            id_type = b.schema.field(0).type
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    packer.add(doc_id, np.array([*encode(text or ""), END_ID], np.uint32))
                if len(packer.done) >= 256:
                    yield out()
        packer.finish()
        if packer.done:
            yield out()

    id_type = src.schema["doc_id"].dataType.simpleString()
    fields = ", ".join(f"{c} {'array<bigint>' if c == 'ids' else 'bigint'}" for c, _ in columns)
    if with_ids:
        columns = [*_COLUMNS[:-1], ("ids", pa.list_(pa.int64()))]
    return src.mapInArrow(freeing(run), f"doc_id {id_type}, {fields}")


def op1_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
