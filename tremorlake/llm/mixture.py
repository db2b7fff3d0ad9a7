"""Mixing sources to target weights by weighted fair queueing.

A source's documents are shuffled by a hash and served in that order, as often as its target needs. The
virtual finish time of a served document is the source's words up to its end, divided by the source's
target. All sources are served in one order, by finish time, and the mix is the prefix of that order
which fills the budget; the document on the border is taken in part.

Running totals come from ``plans.positions``: range-sorted blocks, each started from the total of the
blocks before it, so a source with a third of all rows is not gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import attach_scalar, running_total, with_position, write_scratch
from ..plans.joins import BROADCAST_BYTES, measured_bytes
from .common import WORD, count_words, query, table, text_of

WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
_SPREAD = 64


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Targets from one row per source (_source, _words): _source, _words, _target, _total.

    Sources in code point order, null last, take the weights in turn and share the total by weight. No
    target exceeds ``most_times`` times its source's words; the excess goes to the others by weight. That
    is filling to a level: sorted by words per weight, sources up to some point are full, and the others
    get the rest in proportion to their weights.
    """
    ordered = sizes.withColumn("_last", F.col("_source").isNull())
    ranked = with_position(ordered, [], ["_last", "_source"], "_pos").drop("_last")
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("_weight", F.get(turn, F.pmod("_pos", F.lit(len(weights))).cast("int")).cast("bigint"))
    ranked = ranked.withColumn("_full", F.col("_words") * most_times)
    ranked = write_scratch(ranked.withColumn("_ratio", F.col("_full") / F.col("_weight")), "sources")
    total = ranked.agg(
        F.coalesce(F.sum("_words"), F.lit(0)).alias("_total"), F.coalesce(F.sum("_weight"), F.lit(0)).alias("_weights")
    )
    by = ["_ratio", "_pos"]
    filled = running_total(ranked, [], by, F.col("_full"), "_full_before")
    filled = running_total(filled, [], by, F.col("_weight"), "_weight_before")
    filled = write_scratch(attach_scalar(filled, total), "filled")
    # The level at which this source would be the first that is not full.
    level = (F.col("_total") - F.col("_full_before")) / (F.col("_weights") - F.col("_weight_before"))
    filled = filled.withColumn("_level", level)
    top = filled.filter(F.col("_level") < F.col("_ratio")).agg(F.min(F.struct("_ratio", "_pos", "_level")).alias("_m"))
    top = top.select(F.col("_m._ratio").alias("_from"), F.col("_m._pos").alias("_from_pos"), F.col("_m._level").alias("_at"))
    after = F.struct("_ratio", "_pos") >= F.struct("_from", "_from_pos")
    share = F.when(F.col("_from").isNotNull() & after, F.col("_weight") * F.col("_at"))
    return attach_scalar(filled, top).select(
        "_source", "_words", F.coalesce(share, F.col("_full").cast("double")).alias("_target"), "_total"
    )


def fair_mixture(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``docs``: ``key``, size, source_size, target and taken words.

    Null text has size 0 and is never taken. A null source is one source, the last in order. Documents of
    one source with equal keys or null keys are served by text hash, and rows equal in all of these share
    what is taken evenly by their order in the sort. An empty table gives an empty result, and reruns agree.
    """
    rows = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        count_words(text_of(text)).alias("_size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary")).alias("_turn"),
        F.xxhash64(text).alias("_hash"),
    )
    rows = write_scratch(rows, "sizes")
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("_words"))
    targets = write_scratch(source_targets(sizes, weights, most_times), "targets")
    # One line per source; beyond the limit the join is a shuffle in which the sources are spread.
    spread = F.pmod(F.xxhash64("_turn"), F.lit(_SPREAD))
    if measured_bytes(targets) <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(targets.withColumnRenamed("_source", "_s")), F.col("_source").eqNullSafe(F.col("_s")))
    else:
        many = targets.withColumnRenamed("_source", "_s").withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))))
        met = rows.withColumn("_at", spread).join(
            many, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_at") == F.col("_k"))
        ).drop("_at", "_k")
    met = met.drop("_s")

    order = ["_turn", "_hash", "_size"]
    served = running_total(met, ["_source"], order, F.col("_size"), "_before")
    rounds = F.when(F.col("_words") > 0, F.ceil(F.col("_target") / F.col("_words"))).otherwise(F.lit(0)).cast("int")
    served = served.withColumn("_id", F.struct("_turn", "_hash", "_before"))
    turns = served.filter("_size > 0").withColumn("_round", F.explode(F.sequence(F.lit(0), rounds - 1)))
    ends = F.col("_before") + F.col("_size") + F.col("_round") * F.col("_words")
    turns = turns.withColumns({"_finish": ends / F.col("_target"), "_end": ends})
    turns = turns.withColumn("_last", F.col("_source").isNull())
    line = ["_finish", "_last", "_source", "_end"]
    queue = running_total(turns, [], line, F.col("_size"), "_served")
    part = F.greatest(F.least(F.col("_total") - F.col("_served"), F.col("_size")), F.lit(0)).cast("bigint")
    # Back to documents: the rows of one document carry its columns, and rows of size 0 join in.
    back = ["_key", "_size", "_source", "_words", "_target", "_turn", "_hash", "_before"]
    none = served.filter("_size = 0").select(*back, F.lit(0).cast("bigint").alias("_part"), F.lit(0).alias("_round"))
    lines = queue.select(*back, part.alias("_part"), "_round")
    whole = lines.groupBy(*back).agg(F.sum("_part").alias("_taken"))
    result = whole.unionByName(none.withColumnRenamed("_part", "_taken").drop("_round"))
    return result.select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **names) -> DataFrame:
    """Documents of the mix, each as often as it is taken (a part counts as one), with all columns."""
    key = names.get("key", "doc_id")
    taken = fair_mixture(docs, **names).filter("taken > 0")
    times = F.ceil(F.col("taken") / F.col("size")).cast("int").alias("_times")
    picked = taken.groupBy(key).agg(F.max(times).alias("_times")).withColumnRenamed(key, "_k")
    met = docs.join(picked, F.col(key).eqNullSafe(F.col("_k")))
    copies = met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5(concat_ws(':', 'mix', doc_id)) AS turn,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM d GROUP BY source
), w AS (
  SELECT *, [1, 2, 3][(pos % 3 + 1)::BIGINT] AS weight, words * 3 AS full_words FROM s
), r AS (
  SELECT *, full_words / weight AS ratio, sum(words) OVER () AS total FROM w
), l AS (
  SELECT *, (total - coalesce(sum(full_words) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM r WINDOW before AS (ORDER BY ratio, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT min((ratio, pos)) AS first_free, arg_min(level, (ratio, pos)) AS lvl FROM l WHERE level < ratio
), t AS (
  SELECT source, words, total,
         CASE WHEN first_free IS NOT NULL AND (ratio, pos) >= first_free THEN weight * lvl ELSE full_words::DOUBLE END AS target
  FROM l, f
), m AS (
  SELECT d.*, words, target, total,
         sum(size) OVER (PARTITION BY d.source ORDER BY turn) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, before + size + k.round * words AS ends FROM m,
         (SELECT unnest(range(0, 4)) AS round) k
  WHERE size > 0 AND k.round < ceil(target / words)
), v AS (
  SELECT doc_id, source, size, total,
         sum(size) OVER (ORDER BY ends / target, source NULLS LAST, ends
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS served
  FROM q
), p AS (
  SELECT doc_id, sum(greatest(least(total - served, size), 0))::BIGINT AS taken FROM v GROUP BY doc_id
)
SELECT m.doc_id, m.size::BIGINT AS size, m.words AS source_size, m.target, coalesce(p.taken, 0) AS taken
FROM m LEFT JOIN p ON m.doc_id = p.doc_id
"""


@query("op8_fair_mixture", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mixture(table(spark, sf_dir, "documents"))
