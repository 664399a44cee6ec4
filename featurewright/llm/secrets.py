"""Secret scan: fixed patterns plus a battery of randomness tests.

Base spans (kept as they are): assignments to password-like names, access
keys, long hex strings.  Positions come from splitting a text at its matches:
the pieces and the matches alternate, so their lengths add up to offsets in
code points.  Only texts that contain a match at all are split.

The battery looks at every unbroken run of ``MIN_RUN`` or more characters of
the usual encodings' alphabets, and in each run also at the parts of that length
between ``/``, ``=``, ``-`` and ``_`` (a key behind a path or a name).  The
smallest encoding that holds such a candidate is inferred, and its symbols are
tested against random ones of that alphabet:

* chi-squared of the symbol counts against uniformity,
* runs above and below the middle of the alphabet,
* serial correlation of neighbouring symbols.

A candidate must pass all three (Bonferroni at ``UNIFORM_ALPHA``), and must be too
unlikely as text.  Text is a chain of symbols whose transitions are counted over all
words of the corpus (runs shorter than ``MIN_RUN``) or, as the second model, over the
corpus' own long runs without digits that fail the three tests (joined words, names
in code, paths), each restricted to the candidate's alphabet and with a share of ``NOISE`` uniform
symbols.  The likelihood ratio of "uniform" to "text" is at least r with a
probability of at most 1 / r in text (Markov), so 1 / r is a p-value for "this is
text"; the larger of both models' counts.  Where words are few, ``PRIOR`` symbols with
the usual shares of letters in prose stand in for them, and words for long runs.
Digits are told from text only as far as the corpus' own numbers are not uniform.

False discoveries among all candidates of the corpus are held at ``FDR`` by
Benjamini-Hochberg per length class (powers of two), on a histogram of p-values:
at most 32 classes x 401 bins whatever the corpus, and 32 thresholds and the
transitions (2 x 68 x 67) on the driver.  Of an accepted run the parts are not added.

Everything is SQL functions.  Null text is empty.  Spans of the battery that
overlap a base span are not added.  Rows that share an id are scanned each.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurewright.llm.common import documents, staged

# The base patterns; a maximal run of the class is as long as its greedy match.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

MIN_RUN, FDR, UNIFORM_ALPHA, BINS, NOISE, PRIOR, SUMS = 20, 0.01, 0.001, 400, 0.1, 100, 128
_CLASS = "A-Za-z0-9+/_=-"
RUN = f"(?<![{_CLASS}])[{_CLASS}]{{{MIN_RUN},}}"
PART = f"[A-Za-z0-9+]{{{MIN_RUN},}}"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = _UPPER + _LOWER + _DIGITS + "+/_=-"
#: Encodings from the smallest alphabet on: pattern and alphabet.
ENCODINGS = (
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + _LOWER[:6]),
    ("^[0-9A-F]+$", _DIGITS + _UPPER[:6]),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Z2-7]+=*$", _UPPER + _DIGITS[2:8]),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Rough shares of the symbols in prose, in tenths of a per cent of the lower-case letters.
_PROSE = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8, 2, 2, 1, 1)))
_PROSE |= {c.upper(): n / 25 for c, n in _PROSE.items()} | dict.fromkeys(_DIGITS, 2.0) | dict.fromkeys("+/_=-", 1.0)
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def spans(text: Column, pattern: str, kind: int, value_group: int | None = None) -> Column:
    """Spans (start, kind, end) of the pattern's leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    sizes = F.transform(F.arrays_zip(found.alias("m"), values.alias("v"), F.split(text, pattern, -1).alias("p")), lambda x: F.struct(
        F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("match"), F.length(x["v"]).alias("value")))
    least = MIN_VALUE if value_group else 0

    def placed(x: Column) -> Column:
        return _let(starts(F.transform(x, lambda y: y["gap"] + y["match"])), lambda at: F.transform(
            F.filter(F.arrays_zip(x.alias("x"), at.alias("at")), lambda z: z["x"]["value"] >= least),
            lambda z: F.struct((z["at"] + z["x"]["gap"]).alias("start"), F.lit(kind).alias("kind"), (z["at"] + z["x"]["gap"] + z["x"]["match"]).alias("end"))))

    # the last piece follows no match
    return _let(F.filter(sizes, lambda x: x["match"].isNotNull()), placed)


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def starts(sizes: Column) -> Column:
    """Sum of all earlier elements at each place of an array<int>, in time close to its length.

    Sums of blocks of ``SUMS``, and of blocks of those, so an element adds up at
    most ``SUMS`` numbers on each of two levels; an array that grew element by
    element would be copied as often.
    """
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda s, v: s + v)

    def blocks(x: Column) -> Column:
        n = F.floor((F.size(x) + SUMS - 1) / SUMS).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda b: total(F.slice(x, b * SUMS + 1, F.lit(SUMS))))).otherwise(F.array().cast("array<int>"))

    def within(x: Column, before: Column) -> Column:
        """The sums over ``x``, given those before each of its blocks."""
        return F.transform(x, lambda _, i: F.get(before, F.floor(i / SUMS).cast("int")) + total(F.slice(x, F.floor(i / SUMS).cast("int") * SUMS + 1, i % SUMS)))

    def top(x: Column) -> Column:
        return F.transform(x, lambda _, i: total(F.slice(x, F.lit(1), i)))

    # every array is bound before a lambda slices it: an expression there would be computed for each element
    return _let(sizes, lambda x: _let(blocks(x), lambda one: _let(blocks(one), lambda two: _let(
        top(two), lambda far: _let(within(one, far), lambda before: within(x, before))))))


def _if_any(text: Column, pattern: str, value: Column) -> Column:
    return F.when(text.rlike(pattern), value).otherwise(F.array().cast(_SPAN))


def _normal_cdf(z: Column) -> Column:
    """Logistic approximation with a cubic term."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.070566 * z * z * z)))


def transitions(words: DataFrame, prior: dict | None = None) -> dict[str, dict[str, float]]:
    """Shares of each symbol after each other one ('': at the start) in strings ``word`` that occur ``n`` times; ``prior`` fills in what is rare."""
    chars = words.select("n", F.split("word", "").alias("b"))
    pairs = chars.select("n", F.explode(F.expr("zip_with(concat(array(''), slice(b, 1, size(b) - 1)), b, (x, y) -> struct(x AS a, y AS b))")).alias("p"))
    seen = {(r["a"], r["b"]): r["n"] for r in pairs.groupBy("p.a", "p.b").agg(F.sum("n").alias("n")).collect()}  # at most 68 x 67
    single, after = Counter(), Counter()
    for (a, b), n in seen.items():
        single[b] += n
        after[a] += n
    total = sum(single.values())
    alone = {b: (single[b] + PRIOR * _PROSE[b] / sum(_PROSE.values())) / (total + PRIOR) for b in _SYMBOLS}
    return {a: {b: (seen.get((a, b), 0) + PRIOR * (prior[a] if prior else alone)[b]) / (after[a] + PRIOR) for b in _SYMBOLS} for a in ["", *_SYMBOLS]}


def battery(runs: DataFrame) -> DataFrame:
    """Adds to rows with a string ``run`` (of two symbols at least besides its padding): its encoding's ``code``, ``body``, length_class, and ``uniform``."""
    def pick(values: list) -> Column:
        last = F.lit(values[-1])
        return reduce(lambda rest, e: F.when(F.col("run").rlike(e[0][0]), F.lit(e[1])).otherwise(rest),
                      reversed(list(zip(ENCODINGS[:-1], values))), last)

    e = (
        runs.withColumn("code", pick(list(range(len(ENCODINGS)))))
        .withColumn("alphabet", F.element_at(F.array(*[F.lit(x[1]) for x in ENCODINGS]), F.col("code") + 1))
        .withColumn("body", F.regexp_replace("run", "=+$", ""))
        .withColumn("k", F.length("alphabet").cast("double"))
        .withColumn("n", F.length("body").cast("double"))
        .filter("n >= 2")  # of a run of padding alone no statistic is defined
        .withColumn("x", F.expr("transform(split(body, ''), c -> CAST(locate(c, alphabet) - 1 AS DOUBLE))"))
    )
    e = e.withColumn("chars", F.expr("split(body, '')"))
    e = e.withColumn("chi", F.expr(
        "try_divide(aggregate(array_distinct(chars), 0D, (s, d) -> s + pow(size(filter(chars, c -> c = d)), 2)) * k, n) - n"
    ))
    e = e.withColumn("up", F.expr("transform(x, v -> IF(v >= k / 2, 1, 0))"))
    e = e.withColumn("n1", F.expr("CAST(aggregate(up, 0, (s, u) -> s + u) AS DOUBLE)")).withColumn("n2", F.expr("n - n1"))
    e = e.withColumn("runs_seen", F.expr(
        "1 + aggregate(zip_with(slice(up, 1, size(up) - 1), slice(up, 2, size(up)), (a, b) -> IF(a <> b, 1, 0)), 0, (s, d) -> s + d)"
    ))
    e = e.withColumn("mid", F.expr("(k - 1) / 2")).withColumn("products", F.expr(
        "aggregate(zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x)), (a, b) -> (a - mid) * (b - mid)), 0D, (s, d) -> s + d)"
    ))
    df, n = F.col("k") - 1, F.col("n")
    z_chi = (F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    both = 2 * F.col("n1") * F.col("n2")
    # a run on one side of the middle has no variance of runs; it isn't uniform anyway
    z_runs = F.try_divide(F.col("runs_seen") - (both / n + 1), F.sqrt(both * (both - n) / (n * n * (n - 1))))
    z_serial = F.col("products") / ((F.pow("k", F.lit(2)) - 1) / 12 * F.sqrt(n - 1))
    worst = F.greatest(F.abs(z_chi), F.abs(z_runs), F.abs(z_serial))
    uniform = (F.col("n1") > 0) & (F.col("n2") > 0) & (both > n) & (3 * 2 * _normal_cdf(-worst) >= UNIFORM_ALPHA)
    return e.select(
        *runs.columns, "code", "body", F.floor(F.log2(F.length("run").cast("double"))).cast("int").alias("length_class"),
        F.coalesce(uniform, F.lit(False)).alias("uniform"),
    )


def with_bins(tested: DataFrame, models: list[dict]) -> DataFrame:
    """Adds p_text's ``bin`` (larger: less like text) to the battery's rows, by the model that takes a row for text most."""
    size, alphabets = len(_SYMBOLS), [*(x[1] for x in ENCODINGS[:-1]), _SYMBOLS]  # the last one takes what is left
    e = tested.withColumn("at", F.expr(f"transform(split(body, ''), c -> locate(c, '{_SYMBOLS}'))"))
    e = e.withColumn("m", F.expr(f"element_at(array({','.join(f'{len(x)}D' for x in alphabets)}), code + 1)"))
    bits = []
    for model in models:
        share, inside = ("array(" + ",".join(f"{x:.12e}D" for x in xs) + ")" for xs in (
            [x for p in model.values() for x in p.values()], [sum(map(p.__getitem__, x)) for x in alphabets for p in model.values()]))
        bits.append(F.expr(
            f"""aggregate(zip_with(concat(array(0), slice(at, 1, size(at) - 1)), at, (a, b) -> -log2({NOISE}D + {1 - NOISE}D * m
                * element_at({share}, a * {size} + b) / element_at({inside}, code * {size + 1} + a + 1))), 0D, (s, v) -> s + v)"""
        ))
    least = F.greatest(F.array_min(F.array(*bits)), F.lit(0.0))
    return e.withColumn("bin", F.least(F.floor(least * math.log10(2) * 20), F.lit(BINS)).cast("int")).drop("at", "m")


def thresholds(tested: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Smallest bin that Benjamini-Hochberg rejects in each length class (at most 32 numbers)."""
    per_bin = tested.groupBy("length_class", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("length_class")
    at_least = F.sum("n").over(w.orderBy(F.desc("bin")))
    hits = per_bin.withColumn("c", at_least).withColumn("m", F.sum("n").over(w)).filter(
        F.pow(F.lit(10.0), -F.col("bin") / 20) <= fdr * F.col("c") / F.col("m")
    )
    return {r["length_class"]: r["bin"] for r in hits.groupBy("length_class").agg(F.min("bin").alias("bin")).collect()}


def _uncovered(cand: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates (row, of, r) that no base span (row, b) overlaps: of the base spans that start before one ends, none ends behind its start.

    One sorted pass over each row's spans, whatever their number.
    """
    none = F.lit(None)
    asks = cand.select("row", "of", "r", F.col("r.span.end").alias("at"), F.lit(0).alias("later"), none.cast("int").alias("upto"))
    spans_ = base.select("row", none.cast(cand.schema["of"].dataType).alias("of"), none.cast(cand.schema["r"].dataType).alias("r"),
                         F.col("b.start").alias("at"), F.lit(1).alias("later"), F.col("b.end").alias("upto"))
    before = Window.partitionBy("row").orderBy("at", "later").rowsBetween(Window.unboundedPreceding, -1)
    reached = asks.unionByName(spans_).withColumn("reached", F.max("upto").over(before))
    return reached.filter("later = 0 AND (reached IS NULL OR reached <= r.span.start)").select("row", "of", "r")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    runs = spans(text, RUN, 3)
    # the strings of the runs go along: they are short, and few
    scanned = src.select(
        "doc_id",
        _if_any(text, ASSIGN, spans(text, ASSIGN, 0, 2)).alias("assign"),
        _if_any(text, ACCESS, spans(text, ACCESS, 1)).alias("access"),
        _if_any(text, HEX, spans(text, HEX, 2)).alias("hex"),
        _if_any(text, RUN, runs).alias("run_spans"),
        F.regexp_extract_all(text, F.lit(RUN), F.lit(0)).alias("run_texts"),
    )
    scanned = staged(
        scanned.select(
            "doc_id", F.monotonically_increasing_id().alias("row"),
            F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"),
            F.sort_array(F.concat("assign", "access", "hex")).alias("base"),
            F.zip_with("run_spans", "run_texts", lambda s, t: F.struct(s.alias("span"), t.alias("run"))).alias("runs"),
        )
    )
    runs = scanned.select("row", F.explode("runs").alias("r")).select("row", "r.span", "r.run")
    part_spans = F.transform(spans(F.col("run"), PART, 3), lambda x: F.struct(
        (F.col("span.start") + x["start"]).alias("start"), x["kind"].alias("kind"), (F.col("span.start") + x["end"]).alias("end")))
    parts = F.zip_with(part_spans, F.regexp_extract_all("run", F.lit(PART), F.lit(0)), lambda s, t: F.struct(s.alias("span"), t.alias("run")))
    whole = F.struct("span", "run")
    cand = runs.select("row", F.col("span").alias("of"), F.explode(F.concat(F.array(whole), F.filter(parts, lambda x: x["run"] != F.col("run")))).alias("r"))
    cand = _uncovered(cand, scanned.filter("size(runs) > 0").select("row", F.explode("base").alias("b")))
    tested = staged(battery(cand.select("row", "of", "r.span", "r.run")))
    words = src.select(F.explode(F.split("text", f"[^{_CLASS}]+")).alias("word")).filter((F.length("word") > 0) & (F.length("word") < MIN_RUN))
    by_words = transitions(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    # longer runs are data; one with digits may hold a key behind a path, and few keys would make up all a model knows of an alphabet
    names = tested.filter("NOT uniform AND of = span AND length_class < 7 AND NOT rlike(run, '[0-9]')").select(F.col("run").alias("word"), F.lit(1).alias("n"))
    tested = staged(with_bins(tested, [by_words, transitions(names, by_words)]).drop("run", "body"))
    cut = thresholds(tested)
    accepted = F.lit(False)
    for length_class, least in sorted(cut.items()):
        accepted = accepted | ((F.col("length_class") == length_class) & (F.col("bin") >= least))
    # of an accepted run the parts are not added
    is_whole = F.col("of") == F.col("span")
    of_run = tested.filter(accepted & F.col("uniform")).groupBy("row", "of").agg(F.max(is_whole).alias("whole"), F.collect_list("span").alias("found"))
    kept = of_run.select("row", F.explode(F.when(F.col("whole"), F.array("of")).otherwise(F.col("found"))).alias("span"))
    extra = kept.groupBy(F.col("row").alias("x_row")).agg(F.collect_list("span").alias("extra"))
    out = scanned.join(extra, F.col("row") == F.col("x_row"), "left").withColumn("extra", F.coalesce("extra", F.array().cast(_SPAN)))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size("extra").cast("long").alias("n_random"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("base", "extra"))).alias("spans"),
    )


def op2_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))
