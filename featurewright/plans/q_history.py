"""Registered queries: model history, SCD2, unions, upsert, re-keying, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.operators.history import (
    champion_history,
    filter_names,
    latest_version,
    normalise_columns,
    project_excluding,
    rekey,
    run_snapshot,
    scd2_merge,
    stack,
    stack_by_name,
    stamp,
    upsert,
)
from featurewright.operators.joins import rows_for_keys
from featurewright.operators.scan import row_index, surrogate_id
from featurewright.plans.q_trips import DROPOFF_SQL
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.plans.trips import dropoff_features
from featurewright.sources.standins import model_runs, trips
from featurewright.sources.tables import read_table

RUNS_SQL = """SELECT CAST(event_id AS VARCHAR) AS run_id,
                     'model_' || CAST(user_id % 20 AS VARCHAR) AS model_name,
                     CAST(event_id AS VARCHAR) AS version, ts AS created, value AS metric, props, user_id
              FROM events"""

HISTORY_SQL = f"""
  runs AS ({RUNS_SQL}),
  r AS (SELECT *, max(coalesce(metric, '-infinity')) OVER (PARTITION BY model_name ORDER BY created, run_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max FROM runs),
  c AS (SELECT *, (prev_max IS NULL OR coalesce(metric, '-infinity') > prev_max) AS is_champ FROM r),
  h AS (SELECT c.*, CASE WHEN NOT c.is_champ THEN NULL WHEN c.prev_max IS NULL THEN c.run_id
                         ELSE p.run_id END AS challenger_run_id
        FROM c LEFT JOIN c p ON c.is_champ AND p.is_champ AND p.model_name = c.model_name
                              AND coalesce(p.metric, '-infinity') = c.prev_max)
"""


@query(
    "W4_champion_history",
    f"""WITH {HISTORY_SQL}
    SELECT run_id, model_name, version, created, {r_sql('metric')} AS metric, props, user_id,
           CAST(is_champ AS INTEGER) AS is_champion, challenger_run_id FROM h""",
)
def w4_champion(spark, sf_dir):
    """Replay champion/challenger promotion (strictly greater metric) over every run."""
    return rounded(champion_history(model_runs(spark, sf_dir)))


@query(
    "A19_latest_version",
    f"SELECT model_name, max(CAST(version AS BIGINT)) AS latest_version FROM ({RUNS_SQL}) GROUP BY model_name",
)
def a19_latest(spark, sf_dir):
    """Highest version number per model."""
    return latest_version(model_runs(spark, sf_dir))


_SNAPSHOT_SQL = f"""WITH {HISTORY_SQL},
  latest AS (SELECT model_name, arg_max(run_id, (created, run_id)) AS champ,
                    arg_max(challenger_run_id, (created, run_id)) AS chall
             FROM h WHERE is_champ GROUP BY model_name),
  aliases AS (SELECT model_name, 'Champion' AS alias, champ AS run_id FROM latest
              UNION ALL SELECT model_name, 'Challenger' AS alias, chall AS run_id FROM latest)
  SELECT a.run_id, CAST(r.user_id % 20 AS VARCHAR) AS experiment_id, 'run_' || a.run_id AS run_name,
         a.alias, a.model_name, r.version,
         strftime(date_trunc('millisecond', r.created), '%Y-%m-%d %H:%M:%S.%f') AS created_timestamp,
         strftime(date_trunc('millisecond', r.created) + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S.%f') AS last_updated_timestamp,
         TIMESTAMP '2024-02-01 00:00:00' AS ingestion_time,
         {r_sql('r.metric')} AS metric_value,
         json_extract_string(r.props, '$.k') AS profile_k,
         'events' AS dataset_source, 'Y' AS active_flag, CAST(r.created AS DATE) AS start_date,
         CAST(NULL AS DATE) AS end_date
  FROM aliases a JOIN runs r ON a.run_id = r.run_id
"""


def _aliases(spark, sf_dir):
    runs = model_runs(spark, sf_dir)
    hist = champion_history(runs)
    latest = hist.where(F.col("is_champion") == 1).groupBy("model_name").agg(
        F.max_by("run_id", F.struct("created", "run_id")).alias("champ"),
        F.max_by("challenger_run_id", F.struct("created", "run_id")).alias("chall"),
    )
    champions = latest.select("model_name", F.lit("Champion").alias("alias"), F.col("champ").alias("run_id"))
    challengers = latest.select("model_name", F.lit("Challenger").alias("alias"), F.col("chall").alias("run_id"))
    return runs, stack([champions, challengers])


@query("C6_U1_run_snapshot", _SNAPSHOT_SQL)
def c6_snapshot(spark, sf_dir):
    """C6 + U1: Champion and Challenger rows stacked, then the model-run extract."""
    runs, aliases = _aliases(spark, sf_dir)
    created_ms = F.unix_millis(F.col("created").cast("timestamp"))
    detail = runs.select(
        "run_id",
        (F.col("user_id") % 20).cast("string").alias("experiment_id"),
        F.concat(F.lit("run_"), F.col("run_id")).alias("run_name"),
        "version", created_ms.alias("created_ms"), (created_ms + 1000).alias("updated_ms"),
        F.create_map(F.lit("metric"), F.col("metric")).alias("metrics"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        F.col("props").alias("dataset_profile"), F.lit("events").alias("dataset_source"),
    )
    src = aliases.join(detail, "run_id")
    snap = run_snapshot(src, "2024-02-01 00:00:00")
    out = snap.select(
        *[c for c in snap.columns if c not in ("metrics", "params", "dataset_profile")],
        F.col("metrics")["metric"].alias("metric_value"),
        F.col("dataset_profile")["k"].alias("profile_k"),
    )
    return rounded(out)


_STORED_SQL = """SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS id, c_custkey AS key, c_acctbal AS value,
                        'Y' AS active_flag, DATE '1999-01-01' AS start_date, CAST(NULL AS DATE) AS end_date
                 FROM customer"""
_INCOMING_SQL = "SELECT o_custkey AS key, max(o_totalprice) AS value FROM orders GROUP BY o_custkey"


def _stored(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    base = c.select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"), F.lit("Y").alias("active_flag"),
        F.to_date(F.lit("1999-01-01")).alias("start_date"), F.lit(None).cast("date").alias("end_date"),
    )
    return surrogate_id(base, ["key"]).select("id", "key", "value", "active_flag", "start_date", "end_date")


def _incoming(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.max("o_totalprice").alias("value")
    )


@query(
    "C5_W1_scd2_merge",
    f"""
  WITH stored AS ({_STORED_SQL}), incoming AS ({_INCOMING_SQL}),
  merged AS (
    SELECT s.id, s.key, s.value,
           CASE WHEN i.key IS NOT NULL THEN 'N' ELSE s.active_flag END AS active_flag, s.start_date,
           CASE WHEN i.key IS NOT NULL THEN DATE '2000-01-01' ELSE s.end_date END AS end_date
    FROM stored s LEFT JOIN (SELECT DISTINCT key FROM incoming) i ON s.key = i.key
    UNION ALL
    SELECT NULL, key, value, 'Y', DATE '2000-01-01', NULL FROM incoming)
  SELECT row_number() OVER (ORDER BY id NULLS LAST, key) - 1 AS id, key, {r_sql('value')} AS value,
         active_flag, start_date, end_date
  FROM merged
""",
)
def c5_scd2(spark, sf_dir):
    """C5 + W1: SCD2 merge (parity mode) of per-customer order maxima into a customer dimension."""
    return rounded(scd2_merge(_stored(spark, sf_dir), _incoming(spark, sf_dir), "key", "2000-01-01"))


@query(
    "U2_stack_by_name",
    f"""SELECT id, key, {r_sql('value')} AS value, active_flag, start_date, end_date FROM ({_STORED_SQL})
        UNION ALL
        SELECT NULL AS id, key, {r_sql('value')} AS value, NULL AS active_flag, NULL AS start_date,
               NULL AS end_date FROM ({_INCOMING_SQL})""",
)
def u2_stack_by_name(spark, sf_dir):
    """Union by name, columns missing on one side become null."""
    return rounded(stack_by_name(_stored(spark, sf_dir), _incoming(spark, sf_dir)))


@query(
    "P6_J7_rows_for_keys",
    f"""SELECT id, key, {r_sql('value')} AS value, active_flag, start_date, end_date FROM ({_STORED_SQL})
        WHERE key IN (SELECT key FROM ({_INCOMING_SQL}))""",
)
def p6_rows_for_keys(spark, sf_dir):
    """Stored rows whose key is in the incoming set (left-semi join, no collect)."""
    return rounded(rows_for_keys(_stored(spark, sf_dir), _incoming(spark, sf_dir), ["key"]))


@query(
    "IO7_J8_upsert",
    f"""
  WITH d AS ({DROPOFF_SQL}),
  target AS (SELECT * FROM d WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'),
  updates AS (SELECT * FROM d WHERE ts > TIMESTAMP '2024-01-15 00:00:00')
  SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.zip = t.zip AND u.ts = t.ts)
  UNION ALL SELECT * FROM updates
""",
)
def io7_upsert(spark, sf_dir):
    """IO7/J8: key-based upsert of overlapping feature-table ranges (anti join + union)."""
    ev = trips(spark, sf_dir)
    target = dropoff_features(ev, "ts", end="2024-01-19 23:30:00", zip_col="user_id")
    updates = dropoff_features(ev, "ts", start="2024-01-14 23:30:00", zip_col="user_id")
    return upsert(target, updates, ["zip", "ts"])


@query(
    "W1_row_index_orders",
    f"""SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS id, o_orderkey, o_orderdate,
               {r_sql('o_totalprice')} AS o_totalprice FROM orders""",
)
def w1_row_index(spark, sf_dir):
    """Dense global row index in (date, key) order, range-partitioned (no one-task window)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return rounded(row_index(o, ["o_orderdate", "o_orderkey"], "id"))


@query(
    "W1_rekey_nulls_last",
    f"""SELECT row_number() OVER (ORDER BY id NULLS LAST, key) - 1 AS id, key, {r_sql('value')} AS value
        FROM (SELECT id, key, value FROM ({_STORED_SQL})
              UNION ALL SELECT NULL, key, value FROM ({_INCOMING_SQL}))""",
)
def w1_rekey(spark, sf_dir):
    """ROW_NUMBER() OVER (ORDER BY id NULLS LAST) - 1 re-keying of stored + new rows."""
    s = _stored(spark, sf_dir).select("id", "key", "value")
    i = _incoming(spark, sf_dir).select(F.lit(None).cast("long").alias("id"), "key", "value")
    return rounded(rekey(s.unionByName(i), "id", tie=["key"]))


@query(
    "P8_match_any",
    "SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '(?:#00000001)|(?:#0000012)')",
)
def p8_match_any(spark, sf_dir):
    """Names matching any of several (trimmed) patterns, one rlike alternation."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return filter_names(c, "c_name", [" #00000001 ", "#0000012"])


@query(
    "P10_P11_P13_projection",
    f"""SELECT 'v3' AS model_version, TIMESTAMP '2024-02-01 00:00:00' AS inference_timestamp,
               c_custkey AS customer_key, c_name AS customer_name, {r_sql('c_acctbal')} AS account_balance
        FROM customer""",
)
def p10_projection(spark, sf_dir):
    """P11 blanks in names -> underscores, P10 reorder / exclude, P13 lineage stamp."""
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer key"), F.col("c_name").alias("customer name"),
        F.col("c_acctbal").alias("account balance"), F.col("c_mktsegment").alias("segment"),
    )
    out = stamp(normalise_columns(c), "v3", "2024-02-01 00:00:00")
    return rounded(project_excluding(out, exclude=["segment"], first=["model_version", "inference_timestamp"]))
