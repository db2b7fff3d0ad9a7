"""Vector codes: parts of vectors, each replaced by its nearest codebook entry, found by LAESA.

Components become integers, and a vector is cut into equal consecutive parts; each part position has a codebook
of its own. LAESA keeps, for every part, its distances to a few fixed pivots; they are computed once and written
beside the vector. In each round the distances from the pivots to the codebook's entries are computed anew, and by
the triangle inequality |d(part, pivot) - d(pivot, entry)| is a lower bound for d(part, entry). Entries are tried in
the order of the largest such bound, with exact integer arithmetic, until the next bound exceeds the best distance.

Each partition sums its parts by entry, Spark adds the partitions' sums up, and the driver holds arrays of the
codebooks' size only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import attach, write_scratch
from .common import query, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
PIVOTS = 4

#: Largest size of an integer component; squared distances of parts of up to 500 of them stay within 63 bits.
MOST = 1 << 26
#: Rows assigned at once, so that a batch's bounds take a few MB.
_ROWS = 2048
# Bounds are 32-bit floats: each distance is off by at most a relative 2**-23, so a bound gives way by more.
_SLACK = np.float32(1e-6)


def _lengths(difference: np.ndarray) -> np.ndarray:
    return np.sqrt((difference.astype(np.float64) ** 2).sum(-1)).astype(np.float32)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Of each part's entries (parts, entries, width) some far from each other: (parts, pivots, width)."""
    chosen = np.zeros((len(entries), min(count, entries.shape[1])), np.int64)
    nearest = np.full(entries.shape[:2], np.inf, np.float32)
    every = np.arange(len(entries))
    for i in range(1, chosen.shape[1]):
        last = entries[every, chosen[:, i - 1]]
        nearest = np.minimum(nearest, _lengths(entries - last[:, None]))
        chosen[:, i] = nearest.argmax(1)
    return entries[every[:, None], chosen]


@dataclass
class Assigner:
    """Nearest entries by pivots; ``entries`` is (parts, entries, width), ``pivots`` (parts, pivots, width)."""

    entries: np.ndarray
    pivots: np.ndarray

    def __post_init__(self):
        self.apart = _lengths(self.pivots[:, :, None] - self.entries[:, None])

    def nearest(self, vectors: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties to the lower) and squared distance, by row and part.

        ``vectors`` is (rows, parts, width), ``distances`` holds the parts' distances to their pivots.
        """
        index = np.zeros(vectors.shape[:2], np.int64)
        error = np.zeros(vectors.shape[:2], np.int64)
        for p in range(vectors.shape[1]):
            index[:, p], error[:, p] = self._part(p, vectors[:, p], distances[:, p])
        return index, error

    def _part(self, p: int, parts: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bound = np.zeros((len(parts), self.entries.shape[1]), np.float32)
        for v in range(self.apart.shape[1]):
            mine, theirs = distances[:, v, None], self.apart[p, v][None]
            np.maximum(bound, np.abs(mine - theirs) - _SLACK * (mine + theirs), out=bound)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.zeros(len(parts), np.int64)
        rows = np.arange(len(parts))
        while len(rows):
            at = bound.argmin(1)
            low = bound[np.arange(len(rows)), at].astype(np.float64)
            # A bound above the best distance rules out all entries that are left, ties included.
            alive = (low**2 <= best[rows].astype(np.float64) * (1 + 1e-9)) & np.isfinite(low)
            rows, at, bound = rows[alive], at[alive], bound[alive]
            exact = ((parts[rows] - self.entries[p, at]) ** 2).sum(-1)
            better = (exact < best[rows]) | ((exact == best[rows]) & (at < index[rows]))
            best[rows[better]], index[rows[better]] = exact[better], at[better]
            bound[np.arange(len(rows)), at] = np.inf
        return index, best


def _arrays(batch: pa.RecordBatch, like: Assigner) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a batch in slices: the slice, its parts and their distances to the pivots."""
    parts, pivots, width = like.pivots.shape
    for start in range(0, batch.num_rows, _ROWS):
        some = batch.slice(start, _ROWS)
        flat = some.column("_v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        near = some.column("_near").flatten().to_numpy(zero_copy_only=False)
        yield some, flat.reshape(some.num_rows, parts, width), near.reshape(some.num_rows, parts, pivots)


def _with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Distances of every part to its pivots, written once."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                some = batch.slice(start, _ROWS)
                flat = some.column("_v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                parts = flat.reshape(some.num_rows, len(pivots), 1, pivots.shape[2])
                near = _lengths(parts - pivots[None]).reshape(-1)
                each = len(near) // some.num_rows
                lists = pa.ListArray.from_arrays(pa.array(np.arange(some.num_rows + 1, dtype=np.int32) * each), pa.array(near))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], [*some.schema.names, "_near"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return write_scratch(vectors.mapInArrow(add, f"{fields}, _near array<float>"), "pivots")


def _new_entries(vectors: DataFrame, assigner: Assigner) -> np.ndarray:
    """One round: each entry becomes the componentwise floor of the mean of its parts."""
    parts, entries, width = assigner.entries.shape

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        count = np.zeros(parts * entries, np.int64)
        for batch in batches:
            for _, rows, near in _arrays(batch, assigner):
                index, _ = assigner.nearest(rows, near)
                slot = (index + np.arange(parts) * entries).reshape(-1)
                np.add.at(sums, slot, rows.reshape(len(slot), width))
                count += np.bincount(slot, minlength=parts * entries)
        used = np.flatnonzero(count)
        offsets = pa.array(np.arange(len(used) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.ListArray.from_arrays(offsets, pa.array(sums[used].reshape(-1)))],
            ["slot", "n", "sums"],
        )

    found = vectors.select("_v", "_near").mapInArrow(add_up, "slot bigint, n bigint, sums array<bigint>")
    # Sums over all rows may leave 63 bits.
    total = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    renewed = assigner.entries.copy()
    for row in found.groupBy("slot").agg(F.sum("n").alias("n"), *total).collect():  # one row per entry
        renewed[row.slot // entries, row.slot % entries] = [int(s) // row.n for s in row[2:]]
    return renewed


def integer_vectors(vectors: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """_key, _label and integers _v = floor(scale * x); without rows whose vector is null or holds a null, NaN or
    infinite component."""
    wide = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).alias("_key"), F.col(label).alias("_label"), wide.alias("_x"))
    finite = F.forall("_x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("_x").isNotNull() & finite)
    return rows.select("_key", "_label", F.transform("_x", lambda x: F.floor(x * scale).cast("bigint")).alias("_v"))


def vector_codes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all finite vectors, and the codebooks (parts, entries, width).

    The frame has ``key``, ``code`` (two hex digits per part), ``error`` (squared distances summed over parts) and
    ``label_error`` (errors summed over equal labels, null being one). Vectors that are null or hold a null, NaN or
    infinite component have no row. A codebook starts with the parts of the smallest keys (null keys last, equal
    keys by vector), fewer where there are fewer vectors, and an entry that no part uses stays. Repeated rows each
    count and each have a row. All vectors must have the length of the first one, a multiple of ``parts``; a
    vector of another length, or with an integer beyond ``MOST``, has a null code and a null error and takes no part in
    the codebooks. Without vectors the result is empty. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits, so 1 to 256 entries")
    rows = write_scratch(integer_vectors(vectors, key, vector, label, scale), "integers")
    order = [F.col("_key").asc_nulls_last(), "_v"]
    fits = F.forall("_v", lambda x: F.abs(x) <= MOST)
    first = rows.filter(fits).orderBy(*order).select(F.size("_v")).head()
    length = first[0] if first else 0
    if length % parts:
        raise ValueError(f"vectors of length {length} have no {parts} equal parts")
    coded = rows.filter(fits & (F.size("_v") == length))
    start = coded.orderBy(*order).limit(entries).select("_v").collect()
    book = np.array([r[0] for r in start], np.int64).reshape(len(start), parts, length // parts).swapaxes(0, 1)
    schema = f"_key {rows.schema['_key'].dataType.simpleString()}, _label {rows.schema['_label'].dataType.simpleString()}"
    if not start:
        codes = rows.select("_key", "_label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    else:
        fixed = choose_pivots(book, pivots)
        near = _with_pivots(coded, fixed)
        for _ in range(rounds):
            book = _new_entries(near, Assigner(book, fixed))
        assigner = Assigner(book, fixed)

        def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some, ints, distances in _arrays(batch, assigner):
                    index, error = assigner.nearest(ints, distances)
                    hexes = pa.array([r.tobytes().hex() for r in index.astype(np.uint8)], pa.string())
                    columns = [some.column("_key"), some.column("_label"), hexes, pa.array(error.sum(1))]
                    yield pa.RecordBatch.from_arrays(columns, ["_key", "_label", "code", "error"])

        codes = near.mapInArrow(encode, f"{schema}, code string, error bigint")
        others = rows.filter(~(fits & (F.size("_v") == length)))
        codes = codes.unionByName(others.select("_key", "_label"), allowMissingColumns=True)
    codes = write_scratch(codes, "codes")
    sums = codes.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows"))
    met = attach(codes, sums, ["_label"], rows="_rows")
    return met.select(F.col("_key").alias(key), "code", "error", "label_error"), book


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    steps = []
    for r in range(rounds + 1):
        # Squared distance of every part to every entry of its codebook.
        steps.append(f"""
, d{r} AS (
  SELECT x.vec_id, x.p, x.part, c.e,
         list_sum(list_transform(range(1, len(x.part) + 1), lambda i: (x.part[i] - c.entry[i]) * (x.part[i] - c.entry[i])))::BIGINT AS d
  FROM x JOIN c{r} c ON x.p = c.p
), a{r} AS (
  SELECT vec_id, p, any_value(part) AS part, arg_min(e, (d, e)) AS e, min(d) AS d FROM d{r} GROUP BY vec_id, p
)""")
        if r < rounds:
            steps.append(f"""
, s{r} AS (
  SELECT p, e, i, floor(sum(part[i])::HUGEINT / count(*))::BIGINT AS v FROM a{r}, range(1, len(part) + 1) t(i) GROUP BY p, e, i
), n{r} AS (
  SELECT p, e, list(v ORDER BY i) AS entry FROM s{r} GROUP BY p, e
), c{r + 1} AS (
  SELECT c.p, c.e, coalesce(n.entry, c.entry) AS entry FROM c{r} c LEFT JOIN n{r} n ON c.p = n.p AND c.e = n.e
)""")
    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS (
  SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS part FROM k, range(0, {parts}) t(p)
), f AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {entries}
), c0 AS (
  SELECT x.p, f.e, x.part AS entry FROM x JOIN f ON x.vec_id = f.vec_id
){"".join(steps)}
, h AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
), r AS (
  SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
), g AS (
  SELECT r.*, sum(error) OVER (PARTITION BY k.label)::BIGINT AS label_error FROM r JOIN k ON r.vec_id = k.vec_id
)
SELECT g.vec_id, g.code, g.error, g.label_error, h.codebooks_sha256 FROM g, h
"""


@query("op13_laesa_codes", _sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = vector_codes(table(spark, sf_dir, "embeddings"))
    return codes.withColumn("codebooks_sha256", F.lit(book_digest(book)))
