"""Token counts by the whole-token shortcut.

For each entry of the vocabulary that can end a word the tokenizer itself is
asked, once, whether the string alone becomes that one token.  Pre-tokens that
are among those strings count one token without any merging; only the rest
(remembered per task, in a bounded memo) is merged by the library.

A pre-token's merges do not depend on its neighbours, so the sum over
pre-tokens is the library's count.  Texts in Latin-1 are lower-cased and split
here by the tokenizer's own pattern (its normal form changes nothing else
there); others are normalised and split by the library's own components, and
their words, back from the byte alphabet, take the same two ways.
Special strings are cut out first and count one each.

Null text is empty and counts 0.  Nothing is shuffled: one pass over the scan.
"""

from __future__ import annotations

import contextlib
import functools
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.llm.common import documents, freeing

TOKENIZER, LIMIT, MEMO = "word_bpe_49k.json", 2048, 1_000_000
_LATIN = [chr(i) for i in range(256)]
_LETTERS, _NUMBERS = ("".join(c for c in _LATIN if unicodedata.category(c)[0] == k) for k in "LN")
_SPACE = "\\t-\\r \\x85\\xa0"
#: The tokenizer's pattern with its classes spelled out for Latin-1.
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+")


def _tokenizer(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def whole_tokens(name: str = TOKENIZER) -> frozenset[str]:
    """The strings that the tokenizer, asked for each alone, encodes as one token."""
    t = _tokenizer(name)
    special = {a.content for a in t.get_added_tokens_decoder().values()}
    suffix = t.model.end_of_word_suffix or ""
    table = _byte_alphabet()
    words = set()
    for v in t.get_vocab():
        w = v.removesuffix(suffix)
        if w and v.endswith(suffix) and v not in special and table.keys() >= set(w):
            with contextlib.suppress(UnicodeDecodeError):  # part of a character
                words.add(bytes(table[c] for c in w).decode())
    words = sorted(words)
    return frozenset(w for w, e in zip(words, t.encode_batch(words, add_special_tokens=False)) if len(e.ids) == 1)


class Counter:
    """Counts of texts; ``known`` are words of one token."""

    def __init__(self, known: frozenset[str], name: str = TOKENIZER):
        self.t, self.known, self.memo = _tokenizer(name), known, {}
        special = sorted((a.content for a in self.t.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def words(self, text: str) -> list[str]:
        """The pre-tokens in plain characters."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            split = self.t.pre_tokenizer.pre_tokenize_str(self.t.normalizer.normalize_str(text))
            return [_from_bytes(w) for w, _ in split]
        return _WORDS.findall(text.lower())

    def merge(self, words: set[str]) -> None:
        """Let the library merge what is not known yet."""
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo, new = {}, list(words)
        self.memo.update(zip(new, (len(e.ids) for e in self.t.encode_batch_fast(new, add_special_tokens=False))))

    def count(self, texts: list[str]) -> list[int]:
        out, plain = [0] * len(texts), []
        for k, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                out[k] += len(self.special.findall(text))
                parts = self.special.split(text)
            plain += [(k, self.words(part)) for part in parts]
        rest = [(k, [w for w in words if w not in self.known], len(words)) for k, words in plain]
        self.merge({w for _, r, _ in rest for w in r})
        memo = self.memo
        for k, r, n in rest:
            out[k] += n - len(r) + sum(map(memo.__getitem__, r))
        return out


@functools.cache
def _byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _from_bytes(word: str) -> str:
    return bytes(map(_byte_alphabet().__getitem__, word)).decode()


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(whole_tokens())  # at most the vocabulary

    def run(batches):
        counter = Counter(known.value)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                text = pc.fill_null(part.column(1), "")
                n = counter.count(text.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.binary_length(text.cast(pa.binary())).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(freeing(run), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
