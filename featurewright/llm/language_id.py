"""Language ID by cross-parsing entropy.

Per language a suffix automaton is built from a bounded sample of labelled
text.  A text is parsed greedily: as long as the automaton can follow, the
phrase grows; where it can't, a new phrase begins.  A phrase is charged the bits
that point into the language's learned text, so samples of different sizes
compare; the language of the fewest bits wins (ties: the smaller name).

Symbols are the UTF-8 bytes of the lower-cased text, runs of ASCII
non-letters being one space.  The parse restarts every ``BLOCK`` symbols, for
every language alike, so that all blocks of a batch advance together, one
vectorised table step per symbol; texts of any length are parsed whole.

The sample (the only bounded thing): ``SAMPLE_DOCS`` documents of smallest
hash per language, ``DOC_CHARS`` of each and ``SAMPLE_BYTES`` symbols in all, dealt evenly over the
languages, ``LEAST_BYTES`` at least to each.  The tables are a bounded broadcast: two states per sampled symbol.

Null text, text without a letter, and any text if nothing could be learned
give ``und`` with score 0.  The score is 1 - fewest / second fewest bits
(1 if only one language is known).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurewright.llm.common import documents, freeing, row_slices, utf8

SAMPLE_DOCS, DOC_CHARS, SAMPLE_BYTES, LEAST_BYTES, BLOCK = 64, 4096, 1 << 16, 256, 512
UNDETERMINED = "und"
_SYMBOL = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def symbols(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded symbols of the rows and their offsets; a run of spaces is one, within its row."""
    s = _SYMBOL[buf]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 32) | (s[:-1] != 32)
    keep[offs[:-1][np.diff(offs) > 0]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return s[keep], at[offs]


def suffix_automaton(s: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton's states; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in s:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Model:
    """Automata of all languages as one table: (state, symbol) -> state * width * 2 + (1 if a phrase begins)."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        used = sorted(set(b"".join(samples.values())))
        self.code = np.full(256, len(used), np.int32)  # the last code: in no sample
        self.code[used] = np.arange(len(used))
        width, tables, self.roots, base = len(used) + 1, [], [], 0
        for lang in self.langs:
            step = suffix_automaton(samples[lang])
            t = np.zeros((len(step), width), np.int64)
            for k, d in enumerate(step):
                t[k, self.code[list(d)]] = list(d.values())
            fresh = t == 0
            t = np.where(fresh, t[0], t)  # no way on: the symbol begins a phrase at the root
            tables.append(((t + base) * width * 2 + fresh).astype(np.int32).ravel())
            self.roots.append(base * width)
            base += len(step)
        # a phrase costs the bits that point into the learned text: samples of other sizes become comparable
        self.bits = np.array([np.log2(max(len(samples[lang]), 2)) for lang in self.langs])
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def phrases(self, s: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Phrases per row and language."""
        n = np.diff(offs)
        blocks = -(-n // BLOCK)
        row = np.repeat(np.arange(len(n)), blocks)
        first = np.concatenate([[0], np.cumsum(blocks)])[:-1]
        start = offs[row] + (np.arange(len(row)) - first[row]) * BLOCK
        size = np.minimum(offs[row + 1] - start, BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, row = start[order], size[order], row[order]
        code = np.append(self.code[s], 0).astype(np.int32)
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(row), axis=1)
        count = np.zeros(state.shape, np.int32)
        live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for t, m in enumerate(live):
            nxt = self.table[state[:, :m] + code[start[:m] + t]]
            count[:, :m] += nxt & 1
            state[:, :m] = nxt >> 1
        out = np.zeros((len(n), len(self.langs)), np.int64)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(row, count[k], len(n)) + blocks  # each block begins one
        return out


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> Model:
    """Model from the rows given; null texts and languages take no part."""
    src = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(key_col).cast("string").alias("key"))
    w = Window.partitionBy("lang").orderBy(F.md5(F.coalesce("key", F.lit(""))), F.md5("text"))
    picked = (
        src.filter("text IS NOT NULL AND lang IS NOT NULL")
        .withColumn("n", F.row_number().over(w)).filter(F.col("n") <= SAMPLE_DOCS)
        # what a document can add is bounded, so the sample is
        .select("lang", "n", F.substring("text", 1, DOC_CHARS).alias("text"))
    ).toLocalIterator()
    texts: dict[str, list] = {}
    for r in sorted(((r["lang"], r["n"], r["text"]) for r in picked), key=lambda r: r[:2]):
        s, _ = symbols(*utf8(pc.utf8_lower(pa.array([r[2]], pa.string()))))
        texts.setdefault(r[0], []).append(s.tobytes())
    each = max(SAMPLE_BYTES // max(1, len(texts)), LEAST_BYTES)
    samples = {}
    for lang, parts in texts.items():
        share = max(1, each // len(parts))
        samples[lang] = b" ".join(p[:share] for p in parts)[:each]
    return Model({k: v for k, v in samples.items() if v})


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the prediction and its score at the end; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            text = b.column(at)
            letter = np.array(pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False))
            buf, offs = utf8(pc.utf8_lower(text))
            pred, score = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows)
            for lo, hi in row_slices(offs, 4 << 20) if m.langs else ():
                n = m.phrases(*symbols(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])) * m.bits
                best = n.argmin(axis=1)
                two = np.sort(n, axis=1)[:, :2]
                for r in np.flatnonzero(letter[lo:hi]):
                    pred[lo + r] = m.langs[best[r]]
                    score[lo + r] = 1 - two[r, 0] / max(1.0, two[r, 1]) if len(m.langs) > 1 else 1.0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*b.schema.names, pred_col, score_col])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(freeing(run), ", ".join([*fields, f"`{pred_col}` string", f"`{score_col}` double"]))


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out, said of all."""
    kept = held_out()
    model = train(docs.filter(~F.coalesce(kept, F.lit(False))))
    return predict(docs.select("doc_id", F.coalesce(kept, F.lit(False)).alias("held_out"), "text"), model).drop("text")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language can't be told (no text, or no letter in it)."""
    kept = held_out()
    model = train(docs.filter(~F.coalesce(kept, F.lit(False))))
    pred, score = "lang_pred", "score"
    while {pred, score} & set(docs.columns):
        pred, score = f"_{pred}", f"_{score}"
    known = predict(docs, model, pred_col=pred, score_col=score)
    # without any labelled text nothing can be told, so nothing is rejected for it
    reject = (F.col(pred) == UNDETERMINED) if model.langs else ~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return known.filter(~reject).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
