"""Registered queries: joint multiclass and best-first boosting (L8, L9) and their evaluation.

Fitted values have no SQL form.  The histogram that the first split is chosen
from has one, and so has what a model must beat on the test side: the
log loss of the training shares, the error of the training mean.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featurewright.operators.boosting import LEAFWISE, SOFTMAX, log_loss, root_histogram, train_leafwise, train_softmax
from featurewright.operators.metrics import regression_metrics, roc_auc
from featurewright.operators.models import score, train_forest_regressor, train_logistic
from featurewright.operators.prep import min_max, split
from featurewright.operators.selection import key_text
from featurewright.plans.q_prep import _hash_sql
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources.tables import read_table

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: What a line brings, and its classes: a product of three features, no sum of steps.
_NET = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
PRICE_CUTS = [10_000.0, 25_000.0, 40_000.0, 60_000.0]
#: Cut points of the histogram query.
FIXED_CUTS = {"l_quantity": [5.5, 12.5, 25.5, 40.5], "l_discount": [0.025, 0.055], "l_tax": [0.015, 0.045, 0.065]}


def _class_sql() -> str:
    return "CASE " + " ".join(f"WHEN {_NET} < {c} THEN {k}" for k, c in enumerate(PRICE_CUTS)) + f" ELSE {len(PRICE_CUTS)} END"


_KEY = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
_LINES_SQL = f"""lines AS (
  SELECT {_NET} AS net, {_class_sql()} AS class, {_hash_sql(_KEY)} < 0.3 AS test
  FROM lineitem WHERE {_NET} IS NOT NULL)"""


def _lines(spark, sf_dir):
    """Lines with what they bring, their class and their side, as Spark's side of ``_LINES_SQL``."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_FEATURES, F.expr(_NET).alias("net"))
    net = F.col("net")
    label = F.lit(len(PRICE_CUTS))
    for k, c in reversed(list(enumerate(PRICE_CUTS))):
        label = F.when(net < c, k).otherwise(label)
    key = F.concat(key_text("l_orderkey"), F.lit("-"), key_text("l_linenumber"))
    return split(li.where(net.isNotNull()).withColumn("class", label), key, 0.3)


@query(
    "L8_root_histogram",
    "WITH y AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label FROM lineitem), binned AS (" + " UNION ALL ".join(
        f"SELECT label, '{f}' AS feature, CASE WHEN {f} IS NULL THEN {max(map(len, FIXED_CUTS.values())) + 1} "
        + " ".join(f"WHEN {f} < {c} THEN {b}" for b, c in enumerate(cuts)) + f" ELSE {len(cuts)} END AS bin FROM y" for f, cuts in FIXED_CUTS.items())
    + f""") SELECT CAST(k AS INTEGER) AS class, feature, CAST(bin AS INTEGER) AS bin,
                   {r_sql('sum(1.0 / 3 - CASE WHEN label = k THEN 1 ELSE 0 END)')} AS gradient, {r_sql('count(*) * 4.0 / 9')} AS hessian, count(*) AS n
            FROM binned, range(3) AS classes(k) GROUP BY ALL""",
)
def l8_root_histogram(spark, sf_dir):
    """Gradient and hessian sums per class, feature and bin before the first split."""
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    li = read_table(spark, sf_dir, "lineitem").select(*FIXED_CUTS, y.alias("label"))
    return rounded(root_histogram(li, list(FIXED_CUTS), "label", replace(SOFTMAX, num_class=3), list(FIXED_CUTS.values())))


def _softmax(spark, sf_dir):
    data = _lines(spark, sf_dir)
    model = train_softmax(data.where("split = 'train'"), LINE_FEATURES, "class", replace(SOFTMAX, num_class=len(PRICE_CUTS) + 1, rounds=12))
    return model.score(data.where("split = 'test'"), ["l_orderkey", "l_linenumber", "class"])


@query("L8_softmax_boosting")
def l8_softmax_boosting(spark, sf_dir):
    """Joint softmax boosting of a line's class; test-side probabilities."""
    return _softmax(spark, sf_dir)


@query(
    "L8_softmax_evaluation",
    f"""WITH {_LINES_SQL}, shares AS (SELECT class, count(*) / sum(count(*)) OVER () AS share FROM lines WHERE NOT test GROUP BY class)
        SELECT count(*) AS n_test, {r_sql('avg(-ln(greatest(coalesce(share, 0), 1e-15)))')} AS prior_log_loss, true AS below_half_of_prior
        FROM (SELECT * FROM lines WHERE test) LEFT JOIN shares USING (class)""",
)
def l8_softmax_evaluation(spark, sf_dir):
    """Test rows, the log loss of the training shares, and whether the model's is less than half of it."""
    data = _lines(spark, sf_dir)
    scored = _softmax(spark, sf_dir)
    shares = data.where("split = 'train'").groupBy("class").count()
    share = F.coalesce(F.col("count") / F.col("total"), F.lit(0.0))
    prior = data.where("split = 'test'").join(shares.crossJoin(shares.agg(F.sum("count").alias("total"))), "class", "left").agg(
        F.count("*").alias("n_test"), F.avg(-F.log(F.greatest(share, F.lit(1e-15)))).alias("prior_log_loss"))
    out = prior.crossJoin(log_loss(scored, "class"))  # one row and one row
    return rounded(out.select("n_test", "prior_log_loss", (F.col("log_loss") < 0.5 * F.col("prior_log_loss")).alias("below_half_of_prior")))


def _leafwise(spark, sf_dir):
    data = _lines(spark, sf_dir)
    model = train_leafwise(data.where("split = 'train'"), LINE_FEATURES, "net", replace(LEAFWISE, rounds=10))
    return model.score(data.where("split = 'test'"), ["l_orderkey", "l_linenumber", "net"])


@query("L9_leafwise_regressor")
def l9_leafwise_regressor(spark, sf_dir):
    """Best-first trees of 32 leaves on what the line brings; test-side predictions."""
    return _leafwise(spark, sf_dir)


_MEAN_SQL = f"""WITH {_LINES_SQL}, mean AS (SELECT avg(net) AS m FROM lines WHERE NOT test)
        SELECT count(*) AS n_test, {r_sql('avg((net - m) * (net - m)) / 1e6')} AS mse_of_mean_in_millions, true AS below_half_of_mean
        FROM lines, mean WHERE test"""


def _beside_the_mean(spark, sf_dir, scored):
    """Test rows, the error of the training mean, and whether the scored rows' error is less than half of it."""
    data = _lines(spark, sf_dir)
    mean = data.where("split = 'train'").agg(F.avg("net").alias("m"))
    error = F.col("net") - F.col("m")
    base = data.where("split = 'test'").crossJoin(F.broadcast(mean)).agg(F.count("*").alias("n_test"), F.avg(error * error).alias("mse"))
    got = regression_metrics(scored, "prediction", "net").select("mean_squared_error")
    return rounded(base.crossJoin(got).select("n_test", (F.col("mse") / 1e6).alias("mse_of_mean_in_millions"),
                                              (F.col("mean_squared_error") < 0.5 * F.col("mse")).alias("below_half_of_mean")))


@query("L9_leafwise_evaluation", _MEAN_SQL)
def l9_leafwise_evaluation(spark, sf_dir):
    """The best-first trees beside the training mean."""
    return _beside_the_mean(spark, sf_dir, _leafwise(spark, sf_dir))


@query("L10_forest_evaluation", _MEAN_SQL)
def l10_forest_evaluation(spark, sf_dir):
    """A random forest beside the training mean."""
    data = _lines(spark, sf_dir)
    model = train_forest_regressor(data.where("split = 'train'"), LINE_FEATURES, "net", trees=20)
    return _beside_the_mean(spark, sf_dir, score(data.where("split = 'test'"), model, ["l_orderkey", "l_linenumber", "net"]))


@query(
    "L7_logistic_evaluation",
    f"""WITH {_LINES_SQL} SELECT count(*) AS n_test, {r_sql('avg(CASE WHEN class >= 2 THEN 1.0 ELSE 0.0 END)')} AS share, true AS auc_above_nine_tenths
        FROM lines WHERE test""",
)
def l7_logistic_evaluation(spark, sf_dir):
    """Balanced logistic regression on scaled features; test rows, the label's share, and whether the AUC exceeds 0.9."""
    data = min_max(_lines(spark, sf_dir).withColumn("high", (F.col("class") >= 2).cast("int")), LINE_FEATURES)
    model = train_logistic(data.where("split = 'train'"), LINE_FEATURES, "high", max_iter=100)
    scored = model.transform(data.where("split = 'test'")).select("high", vector_to_array("probability")[1].alias("p"))
    auc = roc_auc(scored, "high", "p")
    both = scored.agg(F.count("*").alias("n_test"), F.avg("high").alias("share")).crossJoin(auc)  # one row and one row
    return rounded(both.select("n_test", "share", (F.col("auc") > 0.9).alias("auc_above_nine_tenths")))
