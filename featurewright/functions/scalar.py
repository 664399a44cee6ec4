"""Scalar functions.

Each replaces a row-level Python lambda of the reference with a native
expression: null-safe, codegen-friendly, and readable by the optimizer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def squash_blanks(c: Column | str) -> Column:
    """blanks to underscores; null stays null (the reference lambda raised)."""
    return F.translate(_c(c), " ", "_")


def json_map(c: Column | str) -> Column:
    """JSON object text to ``map<string,string>``."""
    return F.from_json(_c(c), "map<string,string>")


def flag(cond: Column) -> Column:
    """0/1 integer flag; a null condition counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def as_int(c: Column | str) -> Column:
    """boolean (or numeric text) to int."""
    return _c(c).cast("int")


def trunc_nullable_int(c: Column | str) -> Column:
    """Truncate toward zero to bigint, keeping nulls.

    The reference filled nulls with -1, cast, and mapped -1 back to null;
    a plain cast is the same for every value it can produce.
    """
    return _c(c).cast("bigint")


@dataclass(frozen=True)
class BucketRange:
    label: int
    lower: float
    upper: float


def bucket(c: Column | str, ranges: Sequence[BucketRange], other: int = 4) -> Column:
    """first range with ``lower <= v <= upper`` wins; else ``other``.

    Edges are inclusive on both sides and ranges may overlap, as in the
    reference's configuration.  Null falls through to ``other``.
    """
    col = _c(c)
    expr = None
    for r in ranges:
        cond = (col >= F.lit(r.lower)) & (col <= F.lit(r.upper))
        expr = F.when(cond, F.lit(r.label)) if expr is None else expr.when(cond, F.lit(r.label))
    if expr is None:
        return F.lit(other)
    return expr.otherwise(F.lit(other))


def bucket_sql(col: str, ranges: Sequence[BucketRange], other: int = 4) -> str:
    """The same rule as an SQL ``CASE`` (used by the oracle side)."""
    parts = " ".join(
        f"WHEN {col} >= {r.lower} AND {col} <= {r.upper} THEN {r.label}" for r in ranges
    )
    return f"CASE {parts} ELSE {other} END"


def match_any(c: Column | str, patterns: Sequence[str]) -> Column:
    """True when the value matches any of the (trimmed) regex patterns; without patterns none does."""
    alternation = "|".join(f"(?:{p.strip()})" for p in patterns if p.strip())
    return _c(c).rlike(alternation) if alternation else F.lit(False)
