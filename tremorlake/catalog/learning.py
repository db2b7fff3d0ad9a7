"""Detectors that learn, with SQL that grows the same trees, moves the same centres and finds the same components."""

from pyspark.sql import functions as F

from ..operators import evaluate
from ..operators.iforest import fit_forest, fit_predict_forest, load_forest, predict_forest, save_forest
from ..operators.kmeans import assign_clusters, centres, cluster_rarity, first_rows, fit_lloyd, quantile_rows, silhouette
from ..operators.normalize import apply_scaler, fit_scaler, znorm
from ..operators.reconstruct import fit_linear, label_losses, linear_loss, load_linear, reconstruction_loss, save_linear
from ..operators.smooth import moving_average, smoothed_windows
from ..operators.stats import percentile_threshold
from ..plans import attach_scalar, with_position, write_scratch
from ..plans.scratch import scratch_path
from ..streaming.ingest import start
from ..streaming.scoring import Scorer, incremental_scorer, read_scored, score_batch
from .registry import event_block, events, query, table, with_day
from .streams import event_stream
from .windows import positioned


def smoothed(spark, d):
    """Standardised signal and its rounded moving average, as the clustering sees it."""
    df = znorm(with_day(positioned(spark, d, "ts", "value")), "value")
    df = moving_average(df, "zscale", ["user_id"], "day", 3)
    return df.select("event_id", "user_id", "zscale", F.round("moving_average", 0).alias("zround"))


#: The same in SQL.
_SMOOTHED = """
    SELECT event_id, user_id, zscale, round(avg(zscale) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id
                                             ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 0) AS zround
    FROM (SELECT event_id, user_id, ts, round((value - avg(value) OVER ()) / stddev_samp(value) OVER (), 6) AS zscale FROM events)"""


_COLUMNS = ["zscale", "zround"]
_STEPS = 10


def _lloyd_sql(k, steps=_STEPS):
    """Lloyd's steps over x (zscale, zround) from the column quantiles: centres c0, c1, ... as lists, clusters in ``near``."""
    at = [(i + 0.5) / k for i in range(k)]
    first = ", ".join(f"[{', '.join(f'quantile_disc({c}, {q!r})' for q in at)}] AS {n}" for c, n in zip(_COLUMNS, "ab"))
    near = """SELECT x.*, list_position(d, list_min(d)) - 1 AS c FROM (
                SELECT *, list_transform(a, lambda v, i: (zscale - v) * (zscale - v) + (zround - b[i]) * (zround - b[i])) AS d
                FROM x, c{step}) x"""
    parts = [f"x AS MATERIALIZED ({_SMOOTHED}), c0 AS MATERIALIZED (SELECT {first} FROM x)"]
    for s in range(steps):
        parts.append(
            f"""c{s + 1} AS MATERIALIZED (
                  SELECT list(coalesce(m.a, c{s}.a[t.i + 1]) ORDER BY t.i) AS a, list(coalesce(m.b, c{s}.b[t.i + 1]) ORDER BY t.i) AS b
                  FROM range(0, {k}) t(i) CROSS JOIN c{s}
                  LEFT JOIN (SELECT c, avg(zscale) AS a, avg(zround) AS b FROM ({near.format(step=s)}) GROUP BY c) m ON m.c = t.i)"""
        )
    return ", ".join([*parts, f"near AS MATERIALIZED ({near.format(step=steps)})"])


_RARITY = """n AS (SELECT c, count(*) AS n FROM near GROUP BY c), e AS (SELECT min(n) AS lo, max(n) AS hi FROM n),
             rare AS (SELECT c, (hi - n) / (hi - lo) AS score FROM n, e)"""


def quantile_start(spark, d, k):
    df = write_scratch(smoothed(spark, d), "smoothed")
    return df, quantile_rows(df, _COLUMNS, k)


@query(
    "kmeans_anomalies",
    f"""WITH {_lloyd_sql(5)}, {_RARITY}
        SELECT event_id, user_id, zscale, zround, CAST(near.c AS INTEGER) AS prediction, round(score, 6) AS score, 1 AS anomaly
        FROM near JOIN rare USING (c) WHERE score > 0.9999""",
)
def kmeans_events(spark, d):
    df, start = quantile_start(spark, d, 5)
    out = cluster_rarity(assign_clusters(df, fit_lloyd(df, _COLUMNS, start, _STEPS), _COLUMNS)).filter("anomaly = 1")
    return out.withColumn("score", F.round("score", 6))


@query(
    "kmeans_centres",
    f"""WITH {_lloyd_sql(6)}
        SELECT CAST(i AS INTEGER) AS cluster, CAST(j AS INTEGER) AS dimension,
               round(CASE WHEN j = 0 THEN a[i + 1] ELSE b[i + 1] END, 6) + 0.0 AS coordinate
        FROM c{_STEPS}, range(0, 6) t(i), range(0, 2) u(j)""",
)
def kmeans_centres(spark, d):
    df, start = quantile_start(spark, d, 6)
    out = centres(df, fit_lloyd(df, _COLUMNS, start, _STEPS))
    return out.withColumn("coordinate", F.round("coordinate", 6) + 0.0)


@query(
    "kmeans_silhouette",
    f"""WITH {_lloyd_sql(5)},
        g AS (SELECT c, count(*) AS n, avg(zscale) AS ma, avg(zround) AS mb, avg(zscale * zscale + zround * zround) AS mq
              FROM near GROUP BY c),
        far AS (SELECT event_id, near.c AS own, g.c, g.n,
                       zscale * zscale + zround * zround - 2 * (zscale * ma + zround * mb) + mq AS d FROM near, g),
        s AS (SELECT event_id, any_value(n) FILTER (c = own) AS n, any_value(d * n / (n - 1)) FILTER (c = own AND n > 1) AS a,
                     min(d) FILTER (c <> own) AS b FROM far GROUP BY event_id)
        SELECT count(*) AS n_rows, round(avg(CASE WHEN n = 1 OR a = b THEN 0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END), 6) AS silhouette
        FROM s""",
)
def kmeans_silhouette(spark, d):
    df, start = quantile_start(spark, d, 5)
    value = silhouette(df, fit_lloyd(df, _COLUMNS, start, _STEPS), _COLUMNS)
    return df.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).withColumn("silhouette", F.round(F.lit(value), 6))


def _vector_lloyd_sql(k, steps):
    near = """SELECT x.*, list_position(d, list_min(d)) - 1 AS c FROM (
                SELECT *, list_transform(m, lambda q: list_sum(list_transform(e, lambda v, j: (v - q[j]) * (v - q[j])))) AS d
                FROM x, c{step}) x"""
    parts = [
        f"""x AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
            c0 AS MATERIALIZED (SELECT list(e ORDER BY vec_id) AS m FROM (SELECT * FROM x ORDER BY vec_id LIMIT {k}))"""
    ]
    for s in range(steps):
        parts.append(
            f"""c{s + 1} AS MATERIALIZED (
                  SELECT list(coalesce(g.m, c{s}.m[t.i + 1]) ORDER BY t.i) AS m FROM range(0, {k}) t(i) CROSS JOIN c{s}
                  LEFT JOIN (SELECT c, list(v ORDER BY j) AS m FROM (
                               SELECT c, j, avg(e[j]) AS v FROM ({near.format(step=s)}), range(1, 65) u(j) GROUP BY c, j)
                             GROUP BY c) g ON g.c = t.i)"""
        )
    return ", ".join([*parts, f"near AS MATERIALIZED ({near.format(step=steps)})"])


@query(
    "kmeans_embeddings",
    f"""WITH {_vector_lloyd_sql(5, 5)}, {_RARITY}
        SELECT vec_id, CAST(near.c AS INTEGER) AS prediction, round(score, 6) AS score, CAST(coalesce(score > 0.9999, false) AS INTEGER) AS anomaly
        FROM near JOIN rare USING (c)""",
)
def kmeans_embeddings(spark, d):
    size = 64
    df = table(spark, d, "embeddings").select(
        "vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(size)]
    )
    cols = [f"x{i}" for i in range(size)]
    model = fit_lloyd(df, cols, first_rows(df, cols, ["vec_id"], 5), steps=5)
    out = cluster_rarity(assign_clusters(df, model, cols))
    return out.select("vec_id", "prediction", F.round("score", 6).alias("score"), "anomaly")


_C = "CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"


def _unit_sql(text):
    return f"CAST('0x' || md5({text})[1:12] AS BIGINT) / 281474976710656.0"


def _forest_sql(x, key, trees=100, rows=256, seed=43):
    """A forest of depth 2 over one feature ``x`` (event_id, x), grown and walked in SQL: sample, root, children, leaves."""
    return f"""
    x AS MATERIALIZED ({x}), n AS (SELECT count(*) AS n FROM x),
    few AS (SELECT tree, x, row_number() OVER (PARTITION BY tree ORDER BY t, {key}) AS r FROM (
              SELECT *, {_unit_sql(f"concat_ws(':', {seed}, tree, {key})")} AS t FROM x, range(0, {trees}) k(tree)
              WHERE (SELECT n FROM n) <= {trees * rows})),
    many AS (SELECT (row_number() OVER (ORDER BY t, {key}) - 1) AS turn, x FROM (
               SELECT *, {_unit_sql(f"concat_ws(':', {seed}, {key})")} AS t FROM x WHERE (SELECT n FROM n) > {trees * rows})),
    drawn AS (SELECT tree, x FROM few WHERE r <= {rows}
              UNION ALL SELECT turn % {trees}, x FROM many WHERE turn < {trees * rows}),
    d0 AS (SELECT tree, 1 AS node, x FROM drawn),
    n0 AS (SELECT tree, node, count(*) AS size, min(x) + {_unit_sql(f"concat_ws(':', {seed}, tree, node, 'cut')")} * (max(x) - min(x)) AS cut,
                  max(x) > min(x) AS splits FROM d0 GROUP BY tree, node),
    d1 AS (SELECT tree, CASE WHEN x < cut THEN 2 * node ELSE 2 * node + 1 END AS node, x FROM d0 JOIN n0 USING (tree, node) WHERE splits),
    n1 AS (SELECT tree, node, count(*) AS size, min(x) + {_unit_sql(f"concat_ws(':', {seed}, tree, node, 'cut')")} * (max(x) - min(x)) AS cut,
                  max(x) > min(x) AS splits FROM d1 GROUP BY tree, node),
    d2 AS (SELECT tree, CASE WHEN x < cut THEN 2 * node ELSE 2 * node + 1 END AS node, x FROM d1 JOIN n1 USING (tree, node) WHERE splits),
    n2 AS (SELECT tree, node, count(*) AS size FROM d2 GROUP BY tree, node),
    v AS (SELECT DISTINCT x FROM x),
    p AS (SELECT v.x, n0.tree,
                 CASE WHEN NOT n0.splits THEN {_C.format(n="n0.size")}
                      WHEN NOT n1.splits THEN 1 + {_C.format(n="n1.size")}
                      ELSE 2 + {_C.format(n="n2.size")} END AS h
          FROM v CROSS JOIN n0
          LEFT JOIN n1 ON n1.tree = n0.tree AND n1.node = CASE WHEN v.x < n0.cut THEN 2 ELSE 3 END
          LEFT JOIN n2 ON n2.tree = n0.tree AND n2.node = 2 * n1.node + CASE WHEN v.x < n1.cut THEN 0 ELSE 1 END),
    psi AS (SELECT max(size) AS psi FROM n0),
    s AS (SELECT x, pow(2.0, -avg(h) / any_value({_C.format(n="psi")})) AS score FROM p, psi GROUP BY x),
    scored AS (SELECT x.*, score FROM x JOIN s USING (x)),
    q AS (SELECT quantile_disc(round(score, 9), 0.985) AS q FROM scored)"""


@query(
    "iforest_anomalies",
    f"""WITH {_forest_sql(f"SELECT event_id, zround AS x FROM ({_SMOOTHED})", "event_id")}
        SELECT event_id, round(score, 6) AS score, CAST(round(score, 9) > q AS DOUBLE) AS prediction FROM scored, q""",
)
def iforest_events(spark, d):
    df = write_scratch(smoothed(spark, d).select("event_id", F.array("zround").alias("x")), "smoothed")
    out, _ = fit_predict_forest(df, "x", ["event_id"])
    return out.select("event_id", F.round("score", 6).alias("score"), "prediction")


@query(
    "iforest_stored",
    f"""WITH {_forest_sql("SELECT event_id, value AS x FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'", "event_id", trees=20)},
        walked AS (SELECT event_id, value, tree,
                     CASE WHEN NOT n0.splits THEN {_C.format(n="n0.size")}
                          WHEN NOT n1.splits THEN 1 + {_C.format(n="n1.size")}
                          ELSE 2 + {_C.format(n="n2.size")} END AS h
                   FROM (SELECT event_id, value, n0.* FROM events CROSS JOIN n0) n0
                   LEFT JOIN n1 USING (tree) LEFT JOIN n2 USING (tree)
                   WHERE (n1.node IS NULL OR n1.node = CASE WHEN value < n0.cut THEN 2 ELSE 3 END)
                     AND (n2.node IS NULL OR NOT n1.splits OR n2.node = 2 * n1.node + CASE WHEN value < n1.cut THEN 0 ELSE 1 END)),
        final AS (SELECT event_id, pow(2.0, -avg(h) / any_value({_C.format(n="psi")})) AS score
                  FROM (SELECT DISTINCT event_id, tree, h FROM walked), psi GROUP BY event_id)
        SELECT event_id, round(score, 6) AS score, CAST(round(score, 9) > q AS DOUBLE) AS prediction FROM final, q""",
)
def iforest_stored(spark, d):
    """A forest of the first half, stored, loaded, and applied to all readings by its stored threshold."""
    df = events(spark, d).select("event_id", "ts", F.array("value").alias("x"))
    path = scratch_path(spark, "forest")
    first = df.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    save_forest(fit_forest(first, "x", ["event_id"], trees=20), path)
    out = predict_forest(df, load_forest(spark, path), "x")
    return out.select("event_id", F.round("score", 6).alias("score"), "prediction")


def _vector_forest_sql(depth, size=64, trees=100, rows=256, seed=43):
    """A forest over ``embeddings``, grown and walked level by level; for tables of up to trees * rows rows, and above."""
    key, cut = (_unit_sql(f"concat_ws(':', {seed}, tree, node, '{of}')") for of in ("feature", "cut"))
    parts = [
        f"""x AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
            few AS (SELECT tree, e, row_number() OVER (PARTITION BY tree ORDER BY t, vec_id) AS r FROM (
                      SELECT *, {_unit_sql(f"concat_ws(':', {seed}, tree, vec_id)")} AS t FROM x, range(0, {trees}) k(tree)
                      WHERE (SELECT count(*) FROM x) <= {trees * rows})),
            many AS (SELECT (row_number() OVER (ORDER BY t, vec_id) - 1) AS turn, e FROM (
                       SELECT *, {_unit_sql(f"concat_ws(':', {seed}, vec_id)")} AS t FROM x WHERE (SELECT count(*) FROM x) > {trees * rows})),
            d0 AS MATERIALIZED (SELECT tree, 1 AS node, e FROM few WHERE r <= {rows}
                   UNION ALL SELECT turn % {trees}, 1, e FROM many WHERE turn < {trees * rows}),
            w0 AS MATERIALIZED (SELECT vec_id, tree, 1 AS node, CAST(NULL AS DOUBLE) AS h FROM x, range(0, {trees}) k(tree))"""
    ]
    for level in range(depth + 1):
        ends = f"{level} + {_C.format(n='size')}"
        parts.append(
            f"""n{level} AS MATERIALIZED (
                  SELECT tree, node, size, f, c, size > 1 AND f IS NOT NULL AND c > lo[f] AND {level} < {depth} AS splits FROM (
                    SELECT *, lo[f] + {cut} * (hi[f] - lo[f]) AS c FROM (
                      SELECT *, usable[1 + CAST(floor({key} * len(usable)) AS BIGINT)] AS f FROM (
                        SELECT *, list_filter(range(1, {size + 1}), lambda j: hi[j] > lo[j]) AS usable FROM (
                          SELECT tree, node, max(n) AS size, list(lo ORDER BY j) AS lo, list(hi ORDER BY j) AS hi FROM (
                            SELECT tree, node, j, count(*) AS n, min(e[j]) AS lo, max(e[j]) AS hi FROM d{level}, range(1, {size + 1}) t(j)
                            GROUP BY tree, node, j) GROUP BY tree, node)))))"""
        )
        step = "CASE WHEN e[f] < c THEN 2 * node ELSE 2 * node + 1 END"
        parts.append(f"d{level + 1} AS MATERIALIZED (SELECT tree, {step} AS node, e FROM d{level} JOIN n{level} USING (tree, node) WHERE splits)")
        parts.append(
            f"""w{level + 1} AS MATERIALIZED (
                  SELECT w.vec_id, tree, CASE WHEN splits THEN {step} ELSE node END AS node,
                         CASE WHEN h IS NULL AND NOT splits THEN {ends} ELSE h END AS h
                  FROM w{level} w JOIN x USING (vec_id) LEFT JOIN n{level} USING (tree, node))"""
        )
    return f"""WITH {", ".join(parts)}, psi AS (SELECT max(size) AS psi FROM n0),
               s AS (SELECT vec_id, pow(2.0, -avg(h) / any_value({_C.format(n="psi")})) AS score FROM w{depth + 1}, psi GROUP BY vec_id),
               q AS (SELECT quantile_disc(round(score, 9), 0.985) AS q FROM s)
               SELECT vec_id, round(score, 6) AS score, CAST(round(score, 9) > q AS DOUBLE) AS prediction FROM s, q"""


@query("iforest_embeddings", _vector_forest_sql(8))
def iforest_embeddings(spark, d):
    df = table(spark, d, "embeddings").select("vec_id", "embedding")
    out, _ = fit_predict_forest(df, "embedding", ["vec_id"], max_depth=8)
    return out.select("vec_id", F.round("score", 6).alias("score"), "prediction")


def event_windows(spark, d):
    df = znorm(positioned(spark, d, "value"), "value", ddof=0, digits=None)
    df = smoothed_windows(df, "zscale", ["user_id"], 3, 5)
    return write_scratch(df.select("event_id", "user_id", "window"), "windows")


def labelled(windows, model):
    """Losses with the 95th percentile as the threshold."""
    scored = write_scratch(reconstruction_loss(windows, model, "window").drop("window"), "losses")
    limit = percentile_threshold(scored, "loss", 0.95, out="_limit")
    return label_losses(attach_scalar(scored, limit), F.col("_limit")).drop("_limit")


def _pair_windows_sql(rows="events"):
    """Two-wide windows (a, b) of the smoothed signal before each reading, standardised by all of ``events``."""
    return f"""SELECT event_id, user_id, ts, lag(m, 2) OVER v AS a, lag(m, 1) OVER v AS b FROM (
                 SELECT event_id, user_id, ts, CASE WHEN count(*) OVER w >= 3 THEN avg(z) OVER w END AS m FROM (
                   SELECT event_id, user_id, ts, (value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events) AS z
                   FROM {rows})
                 WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
               WINDOW v AS (PARTITION BY user_id ORDER BY event_id)"""


def _pair_loss_sql(fit):
    """Loss (event_id, user_id, loss) of all windows w by the leading eigenvector of the windows in ``fit``, in closed form."""
    return f"""t AS (SELECT avg(a) AS ma, avg(b) AS mb, 0.5 * atan2(2 * covar_pop(a, b), var_pop(a) - var_pop(b)) AS angle FROM {fit}),
               l AS (SELECT event_id, user_id, (abs((a - ma) - cos(angle) * p) + abs((b - mb) - sin(angle) * p)) / 2 AS loss
                     FROM (SELECT *, cos(angle) * (a - ma) + sin(angle) * (b - mb) AS p FROM w, t))"""


@query(
    "pca_pairs",
    f"""WITH w AS (SELECT * FROM ({_pair_windows_sql()}) WHERE a IS NOT NULL), {_pair_loss_sql("w")}
        SELECT event_id, user_id, round(loss, 6) AS loss, round(q, 6) AS threshold, CAST(loss > q AS INTEGER) AS anomaly
        FROM l, (SELECT quantile_cont(loss, 0.95) AS q FROM l)""",
)
def pca_pairs(spark, d):
    """Windows of two smoothed values, where the component has a closed form."""
    df = znorm(positioned(spark, d, "value"), "value", ddof=0, digits=None)
    df = smoothed_windows(df, "zscale", ["user_id"], 3, 2).select("event_id", "user_id", "window")
    df = write_scratch(df, "pairs")
    out = labelled(df, fit_linear(df, "window", 1))
    return out.select("event_id", "user_id", F.round("loss", 6).alias("loss"), F.round("threshold", 6).alias("threshold"), "anomaly")


_STORED_SQL = f"""WITH w AS (SELECT * FROM ({_pair_windows_sql()}) WHERE a IS NOT NULL),
                  h AS (SELECT * FROM ({_pair_windows_sql("(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')")})
                        WHERE a IS NOT NULL), {_pair_loss_sql("h")}
                  SELECT event_id, user_id, round(loss, 6) AS loss, CAST(loss > 0.25 AS INTEGER) AS label FROM l"""


def stored_scorer(spark, d):
    """A scorer from a model of the first half of the period, stored and loaded, with a fixed threshold."""
    scaler = fit_scaler(events(spark, d), "value", ddof=0)
    df = positioned(spark, d, "ts", "value").filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    df = with_position(df.drop("pos"), ["user_id"], ["event_id"], "pos", event_block())
    df = apply_scaler(df, scaler, "value", out="zscale", digits=None)
    windows = write_scratch(smoothed_windows(df, "zscale", ["user_id"], 3, 2).select("window"), "first-half")
    path = scratch_path(spark, "linear")
    save_linear(spark, fit_linear(windows, "window", 1), path)
    return Scorer(
        scaler=scaler, loss=linear_loss(load_linear(spark, path)), threshold=0.25, steps=2,
        device="user_id", index="event_id", by_device=False,
    )


@query("stored_model_scores", _STORED_SQL)
def stored_model_scores(spark, d):
    out = score_batch(events(spark, d).select("event_id", "user_id", "value"), stored_scorer(spark, d), block=event_block())
    return out.select("event_id", "user_id", F.round("loss", 6).alias("loss"), "label")


@query("stream_stored_model", _STORED_SQL)
def stream_stored_model(spark, d):
    """The same over the stream: nothing is fitted on what it brings."""
    state, out, ck = (scratch_path(spark, n) for n in ("state", "scores", "scores-checkpoint"))
    rows = event_stream(spark, d).select("event_id", "user_id", "value")
    start(rows, incremental_scorer(stored_scorer(spark, d), state, out), ck).awaitTermination()
    return read_scored(spark, out).select("event_id", "user_id", F.round("loss", 6).alias("loss"), "label")


@query("pca_reconstruction")
def pca_reconstruction(spark, d):
    windows = event_windows(spark, d)
    return labelled(windows, fit_linear(windows, "window", 2))


@query("pca_embeddings")
def pca_embeddings(spark, d):
    df = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("window"))
    return labelled(df, fit_linear(df, "window", 8))


_DETECTORS = ["sigma", "kmeans", "forest", "pca"]


@query(
    "best_thresholds",
    f"""WITH {_lloyd_sql(5)}, {_RARITY},
        f AS (WITH {_forest_sql(f"SELECT event_id, zround AS x FROM ({_SMOOTHED})", "event_id")} SELECT event_id, score FROM scored),
        p AS (WITH w AS (SELECT * FROM ({_pair_windows_sql()}) WHERE a IS NOT NULL), {_pair_loss_sql("w")} SELECT event_id, loss FROM l),
        g AS (SELECT near.event_id, abs(zscale) AS sigma, rare.score AS kmeans, f.score AS forest, p.loss AS pca,
                     CAST(event_type = 'error' AS INTEGER) AS actual
              FROM near JOIN rare USING (c) JOIN f USING (event_id) LEFT JOIN p USING (event_id) JOIN events e ON e.event_id = near.event_id),
        long AS ({" UNION ALL ".join(f"SELECT '{x}' AS detector, round({x}, 6) AS score, actual FROM g" for x in _DETECTORS)}),
        t AS (SELECT detector, count(*) AS n, sum(actual) AS p FROM long GROUP BY detector),
        c AS (SELECT detector, score, sum(count(*)) OVER o AS flagged, sum(sum(actual)) OVER o AS tp FROM long WHERE score IS NOT NULL
              GROUP BY detector, score WINDOW o AS (PARTITION BY detector ORDER BY score DESC)),
        q AS (SELECT detector, score AS threshold, n - p - flagged + tp AS tn, flagged - tp AS fp, p - tp AS fn, tp,
                     CASE WHEN 2 * tp + (flagged - tp) + (p - tp) > 0 THEN 2 * tp / (2 * tp + (flagged - tp) + (p - tp)) END AS f1
              FROM c JOIN t USING (detector))
        SELECT detector, threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
               round(tp / (tp + fp), 6) AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall, round(f1, 6) AS f1
        FROM (SELECT *, row_number() OVER (PARTITION BY detector ORDER BY coalesce(f1, -1) DESC, threshold DESC) AS r FROM q) WHERE r = 1""",
)
def best_thresholds_of_detectors(spark, d):
    """Four detectors against the error events, met by key: the threshold with the best F1 of each."""
    df, start = quantile_start(spark, d, 5)
    scored = cluster_rarity(assign_clusters(df, fit_lloyd(df, _COLUMNS, start, _STEPS), _COLUMNS))
    scored = scored.select("event_id", F.abs("zscale").alias("sigma"), F.col("score").alias("kmeans"), F.array("zround").alias("x"))
    scored, _ = fit_predict_forest(scored, "x", ["event_id"], score="forest")
    pairs = znorm(positioned(spark, d, "value"), "value", ddof=0, digits=None)
    pairs = write_scratch(smoothed_windows(pairs, "zscale", ["user_id"], 3, 2).select("event_id", "window"), "pairs")
    losses = reconstruction_loss(pairs, fit_linear(pairs, "window", 1), "window", "pca").drop("window")
    truth = events(spark, d).select("event_id", (F.col("event_type") == "error").cast("int").alias("actual"))
    met = scored.drop("x", "prediction").join(losses, "event_id", "left").join(truth, "event_id")
    rounded = met.select("actual", *[F.round(c, 6).alias(c) for c in _DETECTORS])
    best = evaluate.best_thresholds(evaluate.long_scores(rounded, ["actual"], _DETECTORS), "actual", "score", ["detector"])
    return best.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})
