"""Benchmark decontamination by winnowing.

The words of a text give hashes of ``K`` neighbouring words; of every ``W`` neighbouring hashes the
smallest is kept as a fingerprint. Two texts that share ``W + K - 1`` words in a row share such a window of
hashes, and so its minimum: no shared span of ``WINDOW`` = ``W + K - 1`` words is missed. Items shorter than
that have no full window; each length among them is matched by the hashes of that many words.

Fingerprints of documents meet those of the benchmark by value. Only documents with a hit are extended: their
windows meet the distinct windows of the items, word by word, and every word of an equal window is hit. A document
gives one row per place and an item one per distinct window, so a passage that repeats in both, down to one
word over and over, costs its length and not the product of the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import write_scratch
from ..plans.joins import BROADCAST_BYTES, measured_bytes
from .common import ascii_words, query, table, text_of

WINDOW = 10
K = 5


def _empty() -> Column:
    return F.array().cast("array<bigint>")


def gram_hashes(hashes: Column, k: int) -> Column:
    """Hash of every run of ``k`` words, by the position of its first word; ``hashes`` are those of the words."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
    )
    return F.when(F.size(hashes) >= k, grams).otherwise(_empty())


def minima(hashes: Column, w: int) -> Column:
    """Distinct minima of every ``w`` neighbouring hashes (of all, if there are fewer)."""
    lowest = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(hashes) - w, F.lit(0))),
        lambda i: F.least(*[F.get(hashes, i + j) for j in range(w)]),
    )
    return F.when(F.size(hashes) > 0, F.array_distinct(lowest)).otherwise(_empty())


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("_w", F.transform("_words", lambda w: F.xxhash64(w)))


def _benchmark(items: DataFrame, item_text: str, item_key: str) -> DataFrame:
    """Items with their words and the hashes that mark them, one row per distinct item and text."""
    rows = items.select(F.col(item_key).cast("string").alias("_item"), text_of(item_text).alias("_t")).distinct()
    rows = _hashed(rows.select("_item", ascii_words(F.col("_t")).alias("_words")).filter(F.size("_words") > 0))
    n = F.size("_words")
    # A column of its own: written into ``minima``, all grams would be computed again for every element.
    rows = rows.withColumn("_grams", gram_hashes(F.col("_w"), K))
    kept = minima(F.col("_grams"), WINDOW - K + 1)
    short = F.lit(None).cast("bigint")
    for length in range(1, WINDOW):
        whole = F.xxhash64(*[F.get("_w", F.lit(j)) for j in range(length)])
        short = F.when(n == length, whole).otherwise(short)
    return rows.select("_item", "_words", F.when(n >= WINDOW, kept).otherwise(F.array(short)).alias("_marks"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_words, n_hit, n_items, items_sha256 and contaminated.

    Null or empty texts have no words and are never hit; items without words hit nothing, and items with
    a null key are left out. Rows of ``docs`` with equal key and text give equal rows. Empty tables on
    either side are allowed; other columns change nothing.
    """
    named = benchmark.filter(F.col(item_key).isNotNull())
    items = write_scratch(_benchmark(named, item_text, item_key), "items")
    # At most WINDOW - 1 values.
    lengths = [r[0] for r in items.select(F.size("_words").alias("n")).filter(F.col("n") < WINDOW).distinct().collect()]
    values = write_scratch(items.select(F.explode("_marks").alias("g")).distinct(), "values")

    def sized(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if measured_bytes(table) <= limit else table

    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_t"), F.xxhash64(text_of(text)).alias("_h"))
    words = rows.select("_key", "_h", ascii_words(F.col("_t")).alias("_words"))
    hashes = _hashed(words).select("_key", "_h", "_w").withColumn("_grams", gram_hashes(F.col("_w"), K))
    kept = [minima(F.col("_grams"), WINDOW - K + 1), *[gram_hashes(F.col("_w"), n) for n in lengths]]
    prints = hashes.select("_key", "_h", F.size("_w").alias("_n"), F.explode_outer(F.concat(*kept)).alias("g"))
    met = prints.join(sized(values.withColumn("_met", F.lit(True))), "g", "left")
    # One line per key and text: its words, whether a fingerprint meets the benchmark, and how many rows it has.
    seen = met.groupBy("_key", "_h").agg(F.max("_n").alias("_n"), F.max(F.coalesce("_met", F.lit(False))).alias("_met"))
    seen = write_scratch(seen, "seen")

    same = ["_key", "_h"]
    hits = _extended(words, seen.filter("_met").select(*same), items, sorted({WINDOW, *lengths}), sized)
    spans = hits.select(*same, "_start", "_span").distinct()
    covered = F.sequence(F.col("_start"), F.col("_start") + F.col("_span") - 1)
    n_hit = spans.select(*same, F.explode(covered).alias("_p")).distinct().groupBy(*same).agg(F.count(F.lit(1)).alias("_hit"))
    which = hits.select(*same, "_item").distinct().groupBy(*same).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    found = n_hit.join(which, same_row(n_hit, which)).select(n_hit["_key"], n_hit["_h"], "_hit", "_items")
    found = write_scratch(found, "found")
    whole = seen.join(found, same_row(seen, found), "left").select(seen["_key"], seen["_h"], "_n", "_hit", "_items")
    plain = rows.select("_key", "_h")
    out = plain.join(whole, same_row(plain, whole), "left")
    names = F.coalesce("_items", F.array().cast("array<string>"))
    return out.select(
        plain["_key"].alias(key),
        F.col("_n").cast("bigint").alias("n_words"),
        F.coalesce("_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("_hit").isNotNull().alias("contaminated"),
    )


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Equal text and equal or both null key."""
    return a["_key"].eqNullSafe(b["_key"]) & (a["_h"] == b["_h"])


def _windows(words: Column, span: Column) -> Column:
    """The texts of all runs of ``span`` words (which hold no space), by the position of the first word."""
    texts = F.transform(F.sequence(F.lit(1), F.size(words) - span + 1), lambda i: F.array_join(F.slice(words, i, span), " "))
    return F.when(F.size(words) >= span, texts).otherwise(F.array().cast("array<string>"))


def _extended(words: DataFrame, met: DataFrame, items: DataFrame, spans: list[int], sized) -> DataFrame:
    """Rows (_key, _h, _item, _start, _span): windows of documents with a fingerprint hit that equal one of an item."""
    met = met.withColumnsRenamed({"_key": "_mk", "_h": "_mh"})
    here = words.join(sized(met), words["_key"].eqNullSafe(met["_mk"]) & (words["_h"] == met["_mh"]), "left_semi")
    # Written: inside lambdas the words must be a stored column, or their computation is folded into every element.
    here = write_scratch(here.dropDuplicates(["_key", "_h"]), "candidates")
    own = F.least(F.size("_words"), F.lit(WINDOW))
    theirs = items.select("_item", own.alias("_n"), F.explode(_windows(F.col("_words"), own)).alias("_text")).distinct()
    theirs = write_scratch(theirs, "item-windows")
    mine = None
    for span in spans:
        part = here.select(
            "_key", "_h", F.lit(span).alias("_span"), F.posexplode(_windows(F.col("_words"), F.lit(span))).alias("_start", "_t")
        )
        mine = part if mine is None else mine.unionByName(part)
    theirs = sized(theirs)
    found = mine.join(theirs, (F.col("_t") == F.col("_text")) & (F.col("_span") == F.col("_n")))
    return write_scratch(found.select("_key", "_h", "_item", "_start", "_span"), "hits")


# Every window of an item is compared as a text; windows are joined to document windows of as many words.
_CHARS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_CHARS}') AS w FROM documents
), b AS (
  SELECT item_id, w, least(len(w), 10) AS n
  FROM (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_CHARS}') AS w FROM benchmark)
  WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM b)
), lens AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)
), h AS (
  SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t
), p AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id
), i AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""


@query("op10_winnowing", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
