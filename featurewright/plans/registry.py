"""Registered queries (one per SURVEY section 2 operator) and their DuckDB oracles.

Every query reads the shared test tables of ``sf_dir`` in full (or data Spark
derives from them) and returns a lazy DataFrame.  Float outputs are rounded to
4 decimals on both sides so the value hash is stable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from featurewright.session import apply_core_conf

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_core_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run

    return deco


def stable_round(c, digits: int = 4):
    """Round to ``digits`` decimals with the tie point moved off exact decimals.

    Two engines summing in different orders can land one ulp on either side of
    an exact ``...5`` tie; ``floor(x * 10^d + 0.4999)`` only flips for values
    whose decimal expansion ends in ``5001`` at that place, which sums and means
    of short decimals do not produce.  ``r_sql`` is the same formula in SQL.
    """
    scale = 10 ** digits
    x = c.cast("double") * scale + 0.4999
    # Spark's floor goes through bigint; from 2^53 on a double is whole, so it stays as it is.
    return F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x) / scale


def r_sql(expr: str, digits: int = 4) -> str:
    scale = 10 ** digits
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + 0.4999) / {scale})"


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every float/double/decimal column to ``digits`` decimals (as double)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (FloatType, DoubleType, DecimalType)):
            cols.append(stable_round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["J6_training_set"](spark, sf_dir)


_LOADED = [False]


def _load() -> None:
    if _LOADED[0]:
        return
    _LOADED[0] = True
    # Importing the modules registers their queries.
    from featurewright.plans import q_trips  # noqa: F401
    from featurewright.plans import q_training  # noqa: F401
    from featurewright.plans import q_customer  # noqa: F401
    from featurewright.plans import q_prep  # noqa: F401
    from featurewright.plans import q_metrics  # noqa: F401
    from featurewright.plans import q_history  # noqa: F401
    from featurewright.plans import q_scoring  # noqa: F401
    from featurewright.plans import q_sinks  # noqa: F401
    from featurewright.plans import q_more  # noqa: F401
    from featurewright.plans import q_models  # noqa: F401
    from featurewright.plans import q_streaming  # noqa: F401
    from featurewright.plans import q_io  # noqa: F401
    from featurewright.plans import q_selection  # noqa: F401
    from featurewright.plans import q_evolution  # noqa: F401
    from featurewright.plans import q_boosting  # noqa: F401
    from featurewright.plans import q_jobs  # noqa: F401
    from featurewright.plans import q_streaming_state  # noqa: F401
