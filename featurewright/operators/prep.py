"""Distributed preprocessing.

The reference pulled the feature table into pandas and re-fitted encoders on
the scoring data (Q4).  Here ``Preprocessor.fit`` runs Spark aggregates and
brings back only small statistics - categorical levels (the one-hot column
set is schema, so it has to exist on the driver), one row of min/max and one
row of variances.  ``FittedPrep.transform`` is a pure projection, so the same
fitted state scores new data and can be saved as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def _name(col: str) -> Column:
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + col.replace("`", "``") + "`")


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls to 0 in numeric and boolean columns, to "0" in string columns."""
    cols = set(columns or df.columns)
    exprs = []
    for f in df.schema.fields:
        c = _name(f.name)
        if f.name in cols and isinstance(f.dataType, StringType):
            c = F.coalesce(c, F.lit("0")).alias(f.name)
        elif f.name in cols and isinstance(f.dataType, NumericType):
            c = F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name)
        elif f.name in cols and f.dataType.simpleString() == "boolean":
            c = F.coalesce(c, F.lit(False)).alias(f.name)
        exprs.append(c)
    return df.select(*exprs)


def column_ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """One aggregate pass, one row back."""
    row = df.agg(
        *[F.min(_name(c)).cast("double").alias(f"min__{c}") for c in cols],
        *[F.max(_name(c)).cast("double").alias(f"max__{c}") for c in cols],
    ).first()
    return {c: (row[f"min__{c}"], row[f"max__{c}"]) for c in cols}


def column_ranges_df(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A9 as a long table: column_name, min_value, max_value."""
    agg = df.agg(
        *[F.min(_name(c)).cast("double").alias(f"min__{c}") for c in cols],
        *[F.max(_name(c)).cast("double").alias(f"max__{c}") for c in cols],
    )
    return _long(agg, cols, ["min", "max"], ["min_value", "max_value"])


def column_variances_df(df: DataFrame, cols: Sequence[str], threshold: float | None = None) -> DataFrame:
    """A10 as a long table: column_name, variance (population), keep (variance > threshold)."""
    agg = df.agg(*[F.var_pop(_name(c).cast("double")).alias(f"var__{c}") for c in cols])
    out = _long(agg, cols, ["var"], ["variance"])
    if threshold is not None:
        out = out.withColumn("keep", F.col("variance") > F.lit(threshold))
    return out


def _long(agg: DataFrame, cols: Sequence[str], prefixes: Sequence[str], names: Sequence[str]) -> DataFrame:
    parts = ", ".join(
        "'" + c.replace("'", "\\'") + "', " + ", ".join(f"`{p}__{c}`" for p in prefixes) for c in cols
    )
    return agg.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, {', '.join(names)})")


def variance_select(df: DataFrame, cols: Sequence[str], threshold: float) -> list[str]:
    """A10/L3: columns whose population variance is strictly greater than ``threshold``.

    ``pyspark.ml``'s VarianceThresholdSelector uses the sample variance, so the
    population variance is aggregated directly.
    """
    row = df.agg(*[F.var_pop(_name(c).cast("double")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > threshold]


def one_hot_columns(col: str, levels: Sequence[str]) -> list[Column]:
    """L1: one 0/1 column ``<col>_<level>`` per level (levels already without the first)."""
    return [
        F.when(_name(col).cast("string") == F.lit(lv), F.lit(1)).otherwise(F.lit(0)).alias(f"{col}_{lv}")
        for lv in levels
    ]


def _cells(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per categorical cell: ``column_name``, ``level`` and the ``keep`` columns."""
    cell = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _name(c).cast("string").alias("level")) for c in cols
    ])).alias("__cell")
    return df.select(*[_name(k) for k in keep], cell).select(*[_name(k) for k in keep], "__cell.*")


def category_levels(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> dict[str, list[str]]:
    """Distinct levels per categorical column, sorted as strings, first dropped, for the wide one-hot form.

    One pass for all columns; the lists come to the driver because every level
    becomes a column there.  Columns with many levels belong in ``SparsePreprocessor``.
    """
    out: dict[str, list[str]] = {c: [] for c in cols}
    if not cols:
        return out
    for r in _cells(df, cols).where(F.col("level").isNotNull()).distinct().collect():
        out[r["column_name"]].append(r["level"])
    return {c: (sorted(v)[1:] if drop_first else sorted(v)) for c, v in out.items()}


def min_max_column(col: str, lo: float | None, hi: float | None) -> Column:
    """L2: ``(x - min) / (max - min)``; a constant column scales to 0 (range taken as 1)."""
    lo = 0.0 if lo is None else float(lo)
    rng = 0.0 if hi is None else float(hi) - lo
    scale = rng if rng != 0.0 else 1.0
    return ((_name(col).cast("double") - F.lit(lo)) / F.lit(scale)).alias(col)


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """L2 fitted and applied on the same frame."""
    ranges = column_ranges(df, cols)
    return df.withColumns({c: min_max_column(c, *ranges[c]) for c in cols})


@dataclass
class PrepConfig:
    numeric: Sequence[str]
    categorical: Sequence[str]
    min_variance: float | None = 0.0001
    keep_cols: Sequence[str] = ()  # carried through untouched (keys, label)


@dataclass
class FittedPrep:
    numeric: list[str]
    levels: dict[str, list[str]]
    ranges: dict[str, list[float | None]]
    kept: list[str]
    keep_cols: list[str] = field(default_factory=list)

    def encoded(self, df: DataFrame) -> DataFrame:
        """Fill, one-hot and scale with the fitted state (no variance filter)."""
        filled = fill_zero(df, [*self.numeric, *self.levels])
        feats = [_name(c).cast("double").alias(c) for c in self.numeric]
        for c, lv in self.levels.items():
            feats.extend(x.cast("double").alias(f"{c}_{v}") for x, v in zip(one_hot_columns(c, lv), lv))
        wide = filled.select(*[F.col(k) for k in self.keep_cols], *feats)
        return wide.select(
            *[F.col(k) for k in self.keep_cols],
            *[min_max_column(c, *self.ranges[c]) for c in self.ranges],
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Scoring-time transform: same columns, levels and scales as at fit time.

        Unseen levels become all-zero; missing levels become zero columns.
        """
        return self.encoded(df).select(*[F.col(k) for k in self.keep_cols], *[_name(c) for c in self.kept])

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FittedPrep:
        return FittedPrep(**json.loads(text))


class Preprocessor:
    """L4: fill zero -> one-hot (drop first) -> min-max -> variance filter.

    ``fit`` reads the data twice: one grouped count of (column, level) for all
    categorical columns together, and one aggregate row of min / max /
    population variance for the numeric ones.  One-hot statistics follow from
    the level counts (a dummy with share p has variance p(1-p)) and the scaled
    variance is the raw variance over the squared range, so no third pass over
    the encoded data is needed.
    """

    def __init__(self, cfg: PrepConfig):
        self.cfg = cfg

    def fit(self, df: DataFrame) -> FittedPrep:
        cfg = self.cfg
        filled = fill_zero(df, [*cfg.numeric, *cfg.categorical])
        levels: dict[str, list[str]] = {c: [] for c in cfg.categorical}
        counts: dict[tuple[str, str], int] = {}
        if cfg.categorical:
            # every level becomes a column here; for columns with many levels use SparsePreprocessor
            for r in _cells(filled, cfg.categorical).groupBy("column_name", "level").count().collect():
                counts[(r["column_name"], r["level"])] = r["count"]
            for c in cfg.categorical:
                levels[c] = sorted(lv for (cc, lv) in counts if cc == c)[1:]
        stats = filled.agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.min(_name(c).cast("double")).alias(f"min__{c}") for c in cfg.numeric],
            *[F.max(_name(c).cast("double")).alias(f"max__{c}") for c in cfg.numeric],
            *[F.var_pop(_name(c).cast("double")).alias(f"var__{c}") for c in cfg.numeric],
        ).first()
        n = stats["__n"]
        ranges: dict[str, list[float | None]] = {}
        variances: dict[str, float | None] = {}
        for c in cfg.numeric:
            lo, hi, var = stats[f"min__{c}"], stats[f"max__{c}"], stats[f"var__{c}"]
            ranges[c] = [lo, hi]
            rng = (hi - lo) if lo is not None and hi is not None else 0.0
            scale = rng if rng != 0.0 else 1.0
            variances[c] = None if var is None else var / (scale * scale)
        for c in cfg.categorical:
            for lv in levels[c]:
                k = counts.get((c, lv), 0)
                p = k / n if n else 0.0
                name = f"{c}_{lv}"
                ranges[name] = [0.0 if k < n else 1.0, 1.0 if k > 0 else 0.0]
                variances[name] = p * (1.0 - p)
        kept = [c for c in ranges if variances[c] is not None
                and (cfg.min_variance is None or variances[c] > cfg.min_variance)]
        return FittedPrep(list(cfg.numeric), levels, ranges, kept, list(cfg.keep_cols))


@dataclass
class SparseFit:
    """Fitted state of ``SparsePreprocessor``: a level table and one range per configured numeric column."""

    cfg: PrepConfig
    levels: DataFrame  # column_name, level: what is encoded; distributed, any number of rows
    ranges: dict[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Entries (keep columns, ``feature``, ``value``) that are not zero.

        A row without an entry for a feature holds 0 there; an unseen level has no entry.
        """
        keep = list(self.cfg.keep_cols)
        filled = fill_zero(df, [*self.cfg.numeric, *self.cfg.categorical])
        parts = []
        if self.ranges:
            entries = F.explode(F.array(*[
                F.struct(F.lit(c).alias("feature"), min_max_column(c, *r).alias("value"))
                for c, r in self.ranges.items()
            ])).alias("__entry")
            parts.append(filled.select(*[_name(k) for k in keep], entries).select(*[_name(k) for k in keep], "__entry.*")
                         .where(F.col("value") != 0))
        if self.cfg.categorical:
            cells = _cells(filled, self.cfg.categorical, keep)
            parts.append(cells.join(self.levels, ["column_name", "level"]).select(
                *[_name(k) for k in keep], F.concat("column_name", F.lit("_"), "level").alias("feature"),
                F.lit(1.0).alias("value"),
            ))
        if not parts:
            raise ValueError("no feature columns configured")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class SparsePreprocessor:
    """L1/L4 for any number of levels: fill zero -> one-hot (drop first) -> min-max -> variance filter.

    The same steps as ``Preprocessor``, but levels stay a distributed table and
    the result holds only entries that are not zero.  The driver sees one row of
    statistics, as wide as the configured columns.  ``min_variance=None`` keeps every feature.
    """

    def __init__(self, cfg: PrepConfig):
        self.cfg = cfg

    def fit(self, df: DataFrame) -> SparseFit:
        cfg = self.cfg
        filled = fill_zero(df, [*cfg.numeric, *cfg.categorical])
        row = filled.agg(
            F.count(F.lit(1)),
            *[f(_name(c).cast("double")) for c in cfg.numeric for f in (F.min, F.max, F.var_pop)],
            *[F.min(_name(c).cast("string")) for c in cfg.categorical],
        ).first()
        n, stats, firsts = row[0], row[1:1 + 3 * len(cfg.numeric)], row[1 + 3 * len(cfg.numeric):]
        ranges = {}
        for c, lo, hi, var in zip(cfg.numeric, stats[0::3], stats[1::3], stats[2::3]):
            width = (hi - lo or 1.0) if var is not None else 1.0
            if cfg.min_variance is None or (var is not None and var / width ** 2 > cfg.min_variance):
                ranges[c] = (lo, hi)
        later = F.lit(False)
        for c, first in zip(cfg.categorical, firsts):
            later = later | ((F.col("column_name") == c) & (F.col("level") > first))
        if not cfg.categorical:
            levels = df.sparkSession.createDataFrame([], "column_name string, level string")
        else:
            counts = _cells(filled, cfg.categorical).groupBy("column_name", "level").count().where(later)
            share = F.col("count") / F.lit(float(n or 1))
            if cfg.min_variance is not None:
                counts = counts.where(share * (1 - share) > cfg.min_variance)
            levels = counts.select("column_name", "level")
        return SparseFit(cfg, levels, ranges)


def hash_unit(key: Column, salt: str = "") -> Column:
    """Uniform [0, 1) number from the first 8 hex digits of md5(key [+ salt]).

    Reproducible on any engine with md5 (``randomSplit`` is not: it depends
    on partitioning).
    """
    text = key.cast("string") if not salt else F.concat(key.cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def split(df: DataFrame, key: str | Column, test_size: float = 0.3, col: str = "split") -> DataFrame:
    """Keyed train/test split; a key always lands on the same side."""
    k = F.col(key) if isinstance(key, str) else key
    return df.withColumn(col, F.when(hash_unit(k) < F.lit(test_size), F.lit("test")).otherwise(F.lit("train")))


def downsample(df: DataFrame, key: str | Column, fraction: float = 0.25, env: str = "dev") -> DataFrame:
    """Keep ``fraction`` of the keys outside prod (one decision per key, Q3 fixed).

    Features and label stay in one row, so they are sampled together.
    """
    if env == "prod":
        return df
    k = F.col(key) if isinstance(key, str) else key
    return df.where(hash_unit(k, ":sample") < F.lit(fraction))
