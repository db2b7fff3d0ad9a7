"""Near-duplicate components by HyperMinHash.

A document is the set of its 5-word shingles. The hash of a shingle picks one of ``BUCKETS`` buckets, and a
second hash is minimised there; a register keeps the leading zeros (6 bits) and the next 10 bits of that
minimum. Empty registers borrow from others by a fixed probe sequence. ``ROWS`` neighbouring registers form
a band, and documents that agree in a band are candidates; at the similarity 0.75 a pair agrees in none of
the 48 bands with a probability of about 1e-8. Sets of up to ``SMALL`` shingles have too few minima for
such odds, so they, and all sets that can reach 0.75 with them, also meet by prefix filtering, which is exact.

Links are then confirmed on the full sets, in an order that avoids pairs within large groups:

* Copies are one node from the start.
* A shingle that no other candidate has can be in no intersection. Candidates of which more than a quarter
  is of that kind have no link and go; this is what parts documents that merely share a passage.
* Each candidate is compared with a few centres of its bands, after the estimated similarity (corrected
  for colliding registers) has ruled out the hopeless pairs, and components are formed.
* Whatever still shares a band across two components is compared in full, unless the sizes, the shingles
  that can be shared, a parity sketch, or a one-bit sketch of the registers (a bound of six deviations) rule it out.
  The parity sketch holds for each of ``PARITIES`` groups of hashes whether the set has an odd number of them. Groups
  in which two sets differ hold at least one shingle that only one of them has, so their number is a lower bound for
  the symmetric difference, which for linked sets is at most a seventh of both sizes. In a dense group of near copies
  it leaves only pairs close to the threshold, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import write_scratch
from .common import query, table

WORDS = 5
BUCKETS, ROWS = 192, 4
BANDS = BUCKETS // ROWS
SMALL = 32
CENTRES = 3
MANTISSA = 10
PARITIES = 1024
_REACH = SMALL * 4 // 3 + 1
_PROBES = 400


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = _mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PROBE = (_mix(np.arange(_PROBES * BUCKETS, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64).reshape(_PROBES, BUCKETS)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, WORDS)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h += w[j : n - k + 1 + j] * _FACTORS[j]
    return np.unique(_mix(h + np.uint64(k)))


def registers(shingles: np.ndarray) -> np.ndarray:
    """``BUCKETS`` registers of 16 bits; ``shingles`` is sorted, so buckets are runs."""
    bucket = ((shingles >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    least = np.minimum.reduceat(_mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)), first)
    zeros = np.uint64(63) - np.floor(np.log2(least.astype(np.longdouble) + 0.5)).astype(np.uint64).clip(0, 63)
    after = (least << zeros) << np.uint64(1)
    found = (zeros << np.uint64(MANTISSA)) | (after >> np.uint64(64 - MANTISSA))
    out = np.full(BUCKETS, -1, np.int64)
    out[bucket[first].astype(np.int64)] = found.astype(np.int64)
    if len(first) < BUCKETS:
        empty = np.flatnonzero(out < 0)
        filled = out.copy()
        for probe in _PROBE:
            if not len(empty):
                break
            got = out[probe[empty]]
            filled[empty] = got
            empty = empty[got < 0]
        filled[empty] = found[0]
        out = filled
    return out.astype(np.uint16)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each group of hashes whether their number is odd, as 64-bit words."""
    group = (_mix(shingles ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(PARITIES)).astype(np.int64)
    return np.packbits((np.bincount(group, minlength=PARITIES) & 1).astype(np.uint8)).view(np.int64)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.iloc[at : at + 2000]
            rows = []
            for key, text in zip(part["_id"], part["_text"]):
                s = shingle_set(text)
                n = len(s)
                if not n:
                    rows.append((key, 0, None, None, None, None, 0, 0, 0))
                    continue
                r = registers(s)
                bits = np.packbits((_mix(r.astype(np.uint64) + np.uint64(1)) & np.uint64(1)).astype(np.uint8))
                sketch = bits.view(np.int64)
                small = s[: n - -(-3 * n // 4) + 1].view(np.int64) if n <= _REACH else None
                rows.append((key, n, xxhash.xxh3_128_digest(s.tobytes()), r.tobytes(), small, parities(s), *map(int, sketch)))
            out = pd.DataFrame(rows, columns=["_id", "n", "fp", "regs", "small", "odd", "s0", "s1", "s2"])
            out["_id"] = part["_id"].to_numpy()
            yield out


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.iloc[at : at + 2000]
            yield pd.DataFrame({"_id": part["_id"], "set": [shingle_set(t).view(np.int64) for t in part["_text"]]})


def _band(regs: Column, i: Column) -> Column:
    return F.substring(regs, i * (2 * ROWS) + 1, F.lit(2 * ROWS))


def _slack(n: Column) -> Column:
    """Most bits in which sketches of linked sets differ: expectation and six deviations."""
    minima = BUCKETS * (1 - F.exp(-n / F.lit(float(BUCKETS))))
    return F.lit(BUCKETS) * (0.125 + 6 * F.sqrt(0.125 * 0.875 / minima))


@F.pandas_udf(T.DoubleType())
def estimate(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    """Estimated Jaccard similarity: the share of equal registers, corrected for collisions."""
    if not len(a):
        return pd.Series([], dtype=float)
    x = np.frombuffer(b"".join(a), np.uint16).reshape(-1, BUCKETS)
    y = np.frombuffer(b"".join(b), np.uint16).reshape(-1, BUCKETS)
    share = (x == y).mean(axis=1)
    z = 2.0 ** -np.arange(64)

    def of_zeros(n: pd.Series) -> np.ndarray:
        load = np.maximum(n.to_numpy(float) / BUCKETS, 1.0)[:, None]
        return (1 - z / 2) ** load - (1 - z) ** load

    by_chance = (of_zeros(na) * of_zeros(nb)).sum(axis=1) / (1 << MANTISSA)
    return pd.Series((share - by_chance) / (1 - by_chance))


def _hopeful(n: Column) -> Column:
    """Least estimate of a linked pair: six deviations below 0.75."""
    minima = BUCKETS * (1 - F.exp(-n / F.lit(float(BUCKETS))))
    return F.lit(0.75) - 6 * F.sqrt(0.75 * 0.25 / minima)


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that are linked, by their full sets."""

    def side(frame: DataFrame, name: str, *columns: str) -> DataFrame:
        return frame.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    met = pairs.join(side(nodes, "a", "n", "regs"), "a").join(side(nodes, "b", "n", "regs"), "b")
    fit = 4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")
    met = met.filter(fit).withColumn("_est", estimate("regs_a", "regs_b", "n_a", "n_b"))
    met = met.filter(F.col("_est") >= _hopeful(F.least("n_a", "n_b"))).select("a", "b")
    full = met.join(side(sets, "a", "set"), "a").join(side(sets, "b", "set"), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    full = full.withColumn("_both", both)
    union = F.size("set_a") + F.size("set_b") - F.col("_both")
    return full.filter(100 * F.col("_both") >= 75 * union).select("a", "b")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows (id, comp): the smallest id reachable over ``edges`` (a, b), for every id in them.

    Large-star and small-star rounds: each round links neighbours to the smallest of them, until nothing
    changes. Minima are aggregates, so a hub's neighbours are never gathered.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now, before = write_scratch(now, name), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("_m").alias("v")), F.struct("u", F.col("_m").alias("v")))).alias("_e"))
        small = small.select("_e.u", "_e.v").filter("u <> v").distinct()
        now = write_scratch(small, name)
    return now.select(F.col("u").alias("id"), F.col("v").alias("comp"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``key``, n_shingles, component_id and kept.

    Null and empty texts have no shingles and are linked with nothing. Rows of equal key count as one
    document. A null key takes no part in links other than with copies, gets the component of those, or null,
    and is not kept. An empty table gives an empty result; other columns of ``docs`` change nothing.
    """
    slim = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    kind = dict(slim.dtypes)["_id"]
    signed = slim.mapInPandas(
        _signatures,
        f"_id {kind}, n bigint, fp binary, regs binary, small array<bigint>, odd array<bigint>, s0 bigint, s1 bigint, s2 bigint",
    )
    signed = write_scratch(signed, "signatures")
    filled = signed.filter("n > 0")
    marks = ["n", "regs", "small", "odd", "s0", "s1", "s2"]
    nodes = filled.groupBy("fp").agg(F.min("_id").alias("id"), F.first(F.struct(*marks)).alias("_s"))
    nodes = write_scratch(nodes.select("fp", "id", "_s.*"), "nodes")

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, _band(F.col("regs"), i)))
    small = F.coalesce("small", F.array().cast("array<bigint>"))
    keyed = nodes.filter(F.col("id").isNotNull()).select("id", F.explode(F.concat(bands, small)).alias("band"))
    shared = _shared(keyed)
    shared = write_scratch(shared, "shared")

    wanted = shared.select("id").distinct()
    sets = slim.join(wanted, slim["_id"] == wanted["id"], "left_semi").mapInPandas(
        _sets, f"_id {kind}, set array<bigint>"
    )
    sets = write_scratch(sets.withColumnRenamed("_id", "id").filter(F.size("set") > 0), "sets")
    # Shingles that only one candidate has.
    own = sets.select("id", F.explode("set").alias("h")).groupBy("h").agg(
        F.count(F.lit(1)).alias("_c"), F.min("id").alias("id")
    )
    own = own.filter("_c = 1").groupBy("id").agg(F.count(F.lit(1)).alias("_own"))
    live = nodes.select("id", "n", "regs", "odd", "s0", "s1", "s2").join(wanted, "id").join(own, "id", "left")
    live = live.withColumn("m", F.col("n") - F.coalesce("_own", F.lit(0))).filter("4 * m >= 3 * n").drop("_own")
    live = write_scratch(live, "live")
    # Centres: the candidate of a band with the smallest share of shingles of its own, which lies in the middle of its
    # copies, so that most of them are linked with it; of several, those that share the most bands.
    close = write_scratch(_shared(shared.join(live.select("id").distinct(), "id", "left_semi")), "close")
    own_share = (F.col("n") - F.col("m")) / F.col("n")
    middle = live.select("id", own_share.alias("_own"))
    centre = close.join(middle, "id").groupBy("band").agg(F.min(F.struct("_own", "id")).alias("_c")).select("band", F.col("_c.id").alias("b"))
    met = close.join(centre, "band").filter("id <> b").groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("_c"))
    best = Window.partitionBy("a").orderBy(F.desc("_c"), "b")
    stars = met.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= CENTRES).select("a", "b")
    links = write_scratch(_confirmed(stars, nodes, sets), "links")
    first = connected_components(links, "first")

    # Bands that still hold two components.
    named = live.join(first, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    sizes = named.groupBy("comp").agg(F.count(F.lit(1)).alias("_size"))
    named = write_scratch(named.join(sizes, "comp"), "named")
    spread = close.join(named, "id")
    apart = spread.groupBy("band").agg((F.min("comp") != F.max("comp")).alias("_apart")).filter("_apart").select("band")
    # The number of the band; keys of small sets come after all bands.
    number = F.array_position(bands, F.col("band")).cast("int") - 1
    number = F.when(number < 0, F.lit(BANDS)).otherwise(number)
    spread = write_scratch(spread.join(apart, "band").withColumn("i", number), "spread")
    left, right = (spread.select("band", *[F.col(c).alias(f"{c}_{x}") for c in spread.columns if c != "band"]) for x in "ab")
    differ = sum((F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(1, 3)), start=F.bit_count(F.col("s0_a").bitwiseXOR(F.col("s0_b"))))
    apart_by = sum(
        (F.bit_count(F.get("odd_a", F.lit(i)).bitwiseXOR(F.get("odd_b", F.lit(i)))) for i in range(1, PARITIES // 64)),
        start=F.bit_count(F.get("odd_a", F.lit(0)).bitwiseXOR(F.get("odd_b", F.lit(0)))),
    )
    possible = (
        (F.struct("_size_a", "comp_a") < F.struct("_size_b", "comp_b"))
        & (4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b"))
        & (7 * F.least("m_a", "m_b") >= 3 * (F.col("n_a") + F.col("n_b")))
        & (7 * apart_by <= F.col("n_a") + F.col("n_b"))
        & (differ <= _slack(F.least("n_a", "n_b")))
        # A pair comes from the first band that it shares.
        & ((F.col("i_a") == 0) | ~F.exists(F.sequence(F.lit(0), F.col("i_a") - 1), lambda j: _band(F.col("regs_a"), j) == _band(F.col("regs_b"), j)))
    )
    rest = left.join(right, (left["band"] == right["band"]) & possible)
    rest = rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    more = _confirmed(rest, nodes, sets)
    joined = first.select(F.col("id").alias("a"), F.col("comp").alias("b")).unionByName(more)
    final = connected_components(joined, "final")

    named = nodes.select(F.col("fp"), "id").join(final, "id", "left").select("fp", F.coalesce("comp", "id").alias("_comp"))
    full = filled.select("_id", "n", "fp").join(named, "fp").select("_id", "n", "_comp")
    none = signed.filter("n = 0").select("_id", "n", F.col("_id").alias("_comp"))
    return full.unionByName(none).select(
        F.col("_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("_comp").alias("component_id"),
        F.coalesce(F.col("_id") == F.col("_comp"), F.lit(False)).alias("kept"),
    )


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows (id, band) of bands that hold several ids."""
    several = keyed.groupBy("band").agg((F.min("id") != F.max("id")).alias("_s")).filter("_s").select("band")
    return keyed.join(several, "band").select("id", "band")


@query("op7_hyperminhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
