"""Detectors against labels."""

from pyspark.sql import functions as F

from ..jobs import evaluate_sigma
from ..operators import evaluate
from ..operators.sigma import sigma_distance
from .registry import events, query, table

_PRED = """SELECT event_id, user_id, CAST(event_type = 'error' AS INTEGER) AS actual,
                  CAST(abs((value - avg(value) OVER ()) / stddev_samp(value) OVER ()) > 2 AS INTEGER) AS sigma2,
                  CAST(abs((value - avg(value) OVER ()) / stddev_samp(value) OVER ()) > 3 AS INTEGER) AS sigma3,
                  CAST(value > 100 AS INTEGER) AS fixed100 FROM events"""
_CELLS = """count(*) FILTER (a = 0 AND p = 0) AS tn, count(*) FILTER (a = 0 AND p = 1) AS fp,
            count(*) FILTER (a = 1 AND p = 0) AS fn, count(*) FILTER (a = 1 AND p = 1) AS tp"""
_QUALITY = """round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
              round(2 * tp / (2 * tp + fp + fn), 6) AS f1"""


def predictions(spark, d):
    z = F.abs("distance")
    return sigma_distance(events(spark, d), "value").select(
        "event_id",
        "user_id",
        (F.col("event_type") == "error").cast("int").alias("actual"),
        (z > 2).cast("int").alias("sigma2"),
        (z > 3).cast("int").alias("sigma3"),
        (F.col("value") > 100).cast("int").alias("fixed100"),
    )


@query("confusion", f"SELECT {_CELLS} FROM (SELECT quality AS a, 1 - toxic AS p FROM labels)")
def confusion(spark, d):
    df = table(spark, d, "labels").withColumn("p", 1 - F.col("toxic"))
    return evaluate.confusion(df, "quality", "p")


@query(
    "confusion_by_device",
    f"SELECT user_id, {_CELLS} FROM (SELECT user_id, actual AS a, fixed100 AS p FROM ({_PRED})) GROUP BY user_id",
)
def confusion_by_device(spark, d):
    return evaluate.confusion(predictions(spark, d), "actual", "fixed100", ["user_id"])


@query(
    "f1",
    f"""SELECT *, {_QUALITY} FROM (SELECT {_CELLS} FROM (SELECT actual AS a, sigma2 AS p FROM ({_PRED})))""",
)
def f1(spark, d):
    pred = predictions(spark, d)
    both = evaluate.align(pred.select("event_id", "sigma2"), pred.select("event_id", "actual"), ["event_id"], "sigma2", "actual")
    out = evaluate.quality(evaluate.confusion(both, "actual", "sigma2"))
    return out.select("tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "compare_detectors",
    f"""SELECT *, {_QUALITY} FROM (SELECT detector, {_CELLS} FROM (
          SELECT 'sigma2' AS detector, actual AS a, sigma2 AS p FROM ({_PRED})
          UNION ALL SELECT 'sigma3', actual, sigma3 FROM ({_PRED})
          UNION ALL SELECT 'fixed100', actual, fixed100 FROM ({_PRED})) GROUP BY detector)""",
)
def compare_detectors(spark, d):
    out = evaluate.compare_detectors(predictions(spark, d), "actual", ["sigma2", "sigma3", "fixed100"])
    return out.select("detector", "tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "unmatched_labels",
    """SELECT count(*) FILTER (l.doc_id IS NULL) AS only_predicted, count(*) FILTER (d.doc_id IS NULL) AS only_truth,
              count(*) FILTER (l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL) AS matched
       FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
)
def unmatched_labels(spark, d):
    return evaluate.unmatched(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query(
    "sigma_evaluation",
    f"""WITH z AS (SELECT event_id, user_id, date_trunc('second', ts) AS s, CAST(event_type = 'error' AS INTEGER) AS a,
                   round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) AS z FROM events
                   WINDOW w AS (PARTITION BY user_id)),
        o AS (SELECT *, (z - avg(z) OVER w) / stddev_samp(z) OVER w AS dist FROM z WINDOW w AS (PARTITION BY user_id)),
        e AS (SELECT DISTINCT user_id, s FROM o WHERE dist > 2 OR dist < -2)
        SELECT *, {_QUALITY} FROM (SELECT {_CELLS} FROM (
          SELECT a, CAST(e.s IS NOT NULL AS INTEGER) AS p FROM o LEFT JOIN e ON e.user_id = o.user_id AND e.s = o.s))""",
)
def sigma_evaluation(spark, d):
    """The whole evaluation run: normalise, outliers, episodes per second, labels, F1."""
    df = events(spark, d).select("event_id", F.col("user_id").alias("device_id"), "ts", "value", "event_type")
    truth = df.select("event_id", (F.col("event_type") == "error").cast("int").alias("anomaly"))
    out = evaluate_sigma(df.drop("event_type"), truth, ["event_id"], k=2.0, min_count=0)
    return out.select("tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])
