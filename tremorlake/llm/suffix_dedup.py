"""Removal of repeated passages: suffixes in order of their first ``threshold`` bytes, by most significant digits.

A window is the first ``threshold`` bytes of a suffix. A radix sort by most significant digits puts suffixes into
groups that agree on more and more bytes; a group of one leaves, since it cannot be repeated any more, and a group
that has agreed on all bytes of the window is a repeated window. No suffix is ever compared beyond that depth.

The digits are chosen so that few bytes move. Every window has an *anchor*: the gram (a run of bytes) with the
smallest hash that lies in it, the leftmost of equals. Equal windows have equal anchors at equal places, and neighbouring
windows share one, so a row stands for a run of suffixes, about 70 at the threshold of 200 bytes:

1. the first digit is the anchor's gram, counted by Spark; rows whose gram is unique leave;
2. the second is the rest of the run's bytes, as a digest: runs that are repeated as a whole are done;
3. what is left, the borders of repeated passages, is fetched as bytes and dealt out by gram. A task sorts the
   suffixes of its groups by digits of eight bytes through the threshold, comparing the bytes themselves. A group too large
   for that is first split by wider digits, which Spark counts: the bytes that 32, then 8, then 1 neighbouring suffixes share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import attach, scratch_scope, write_scratch
from ..plans.scratch import scratch_path
from .common import query, table, text_of

THRESHOLD = 200
#: Rows of one group that a task sorts; larger groups are split by Spark first.
GROUP_ROWS = 4096
#: Windows of a text that are hashed at once.
_STRETCH = 1 << 20
#: Anchors in one Arrow batch.
_BATCH = 1 << 16
#: Statistics up to this size are broadcast, and so are the hottest groups beyond it.
_BROADCAST = 4 << 20
_WIDTHS = (32, 8, 1)

_M1, _M2, _M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_HALF = np.uint64(32)


def gram_bytes(threshold: int) -> int:
    """Length of an anchor: the largest power of two that is at most a third of the threshold."""
    if not 8 <= threshold < 1 << 15:
        raise ValueError("the threshold is 8 to 32767 bytes")
    return 1 << max((threshold // 3).bit_length() - 1, 0)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each position on, by joining neighbouring halves."""
    if size >= 8:
        width, h = 8, np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)) * _M3
    else:
        width, h = 1, (data.astype(np.uint64) + np.uint64(1)) * _M3
    h ^= h >> _HALF
    while width < size:
        joined = h[:-width] * _M1
        joined += h[width:]
        joined ^= joined >> _HALF
        joined *= _M2
        joined ^= joined >> np.uint64(29)
        h, width = joined, 2 * width
    h *= _M1
    return h


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of ``size`` neighbours, by joining windows of doubled width."""
    width, low = 1, values
    while 2 * width <= size:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    rest = size - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def anchors_of(data: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first and last window, the anchor's place, and its gram's hash."""
    size, found = gram_bytes(threshold), []
    windows = len(data) - threshold + 1
    for start in range(0, max(windows, 0), _STRETCH):
        end = min(start + _STRETCH, windows)
        h = gram_hashes(data[start : end - 1 + threshold], size)
        # The upper half of the hash, then the place: the leftmost of the smallest.
        place = (h >> _HALF << _HALF) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_min(place, threshold - size + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
        last = np.append(first[1:] - 1, end - start - 1)
        anchor = at[first]
        found.append((first + start, last + start, anchor + start, h[anchor].view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive windows, from runs in any order that do not overlap."""
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    new = np.append(True, lo[1:] > hi[:-1] + 1)
    return lo[new], hi[np.append(new[1:], True)]


_SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
_ANCHORS = pa.schema(
    [("_row", pa.int64()), ("gram", pa.int64()), ("rest", pa.int64()), ("n", pa.int64()), ("at", pa.int64()), ("more", _SPANS)]
)
_ANCHOR_SCHEMA = "_row bigint, gram bigint, rest bigint, n bigint, at bigint, more array<struct<lo: bigint, hi: bigint>>"


def _packed(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (first << 32) | ((anchor - first) << 16) | (last - first)


def _anchor_rows(row: int, text: memoryview, threshold: int) -> list[np.ndarray | list]:
    """Rows of one text: one per distinct run, with the places of all equal runs where there are several."""
    first, last, anchor, gram = anchors_of(np.frombuffer(text, np.uint8), threshold)
    ends = (last + threshold).tolist()
    digests = [hashlib.blake2b(text[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), ends)]
    rest = np.frombuffer(b"".join(digests), np.int64)
    at, n, more = _packed(first, last, anchor), np.ones(len(rest), np.int64), [None] * len(rest)
    if len(set(digests)) < len(digests):
        _, head, back, n = np.unique(np.stack([gram, rest]), axis=1, return_index=True, return_inverse=True, return_counts=True)
        order, back = np.argsort(back.reshape(-1), kind="stable"), None
        more, begin = [], 0
        for count in n.tolist():
            same = order[begin : begin + count]
            begin += count
            spans = merged(first[same], last[same]) if count > 1 else None
            more.append(spans and [{"lo": a, "hi": b} for a, b in zip(*map(np.ndarray.tolist, spans))])
        gram, rest, at = gram[head], rest[head], at[head]
    return [np.full(len(rest), row), gram, rest, n, at, more]


def _find_anchors(threshold: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in list(zip(*parts))[:5]]
            more = [m for p in parts for m in p[5]]
            arrays = [*map(pa.array, columns), pa.array(more, _SPANS)]
            return pa.RecordBatch.from_arrays(arrays, schema=_ANCHORS)

        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = memoryview(text.as_buffer())
                if len(text) < threshold:
                    continue
                parts.append(_anchor_rows(row, text, threshold))
                size += len(parts[-1][0])
                if size >= _BATCH:
                    yield flush()
                    parts, size = [], 0
        if parts:
            yield flush()

    return find


_RUNS = pa.schema(
    [(x, pa.int64()) for x in ("g", "n", "_row", "lo", "place", "least", "most")] + [("bytes", pa.binary())]
)
_RUN_SCHEMA = "g bigint, n bigint, _row bigint, lo bigint, place bigint, least bigint, most bigint, k bigint, bytes binary"


def _cut_runs(threshold: int):
    """Runs that are still open, as bytes: the anchor lies at ``place``, and a window may begin ``least`` to ``most``
    bytes before it."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = memoryview(batch.column(1)[i].as_buffer())
                runs = batch.column(2).slice(i, 1).flatten()
                at = runs.field("at").to_numpy()
                lo, place, extra = at >> 32, (at >> 16) & 0xFFFF, at & 0xFFFF
                for start in range(0, len(at), _BATCH):
                    part = slice(start, start + _BATCH)
                    cuts = [bytes(text[a:b]) for a, b in zip(lo[part].tolist(), (lo + extra + threshold)[part].tolist())]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "g": runs.field("gram").slice(start, _BATCH),
                            "n": runs.field("n").slice(start, _BATCH),
                            "_row": pa.array(np.full(len(cuts), batch.column(0)[i].as_py())),
                            "lo": pa.array(lo[part]),
                            "place": pa.array(place[part]),
                            "least": pa.array((place - extra)[part]),
                            "most": pa.array(place[part]),
                            "k": runs.field("k").slice(start, _BATCH),
                            "bytes": pa.array(cuts, pa.binary()),
                        }
                    )

    return cut


def equal_suffixes(data: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Indexes of the suffixes that share their first ``depth`` bytes with another of their group.

    ``data`` ends with at least seven bytes beyond the last window. Each pass sorts by the next eight bytes
    what has agreed so far, and suffixes that are alone leave.
    """
    words = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
    left = np.arange(len(at))
    for digit in [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]:
        key = words[at[left] + digit].astype(np.uint64)
        order = np.lexsort((key, group))
        key, group, left = key[order], group[order], left[order]
        new = np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))[: len(left)]
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1 if len(left) else np.zeros(0, bool)
        left, group = left[shared], number[shared]
        if not len(left):
            break
    return left


def _spans_of(runs: pa.Table, threshold: int) -> pa.RecordBatch:
    """Repeated windows of whole groups: _row, lo and hi, for runs that occur once."""
    g, n, row, lo, place, least, most = (runs.column(c).to_numpy() for c in _RUNS.names[:7])
    cuts = runs.column("bytes").combine_chunks()
    offsets = np.frombuffer(cuts.buffers()[1], np.int32, len(cuts) + 1, 4 * cuts.offset).astype(np.int64)
    data = np.frombuffer(cuts.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0])
    data = np.append(data, np.zeros(8, np.uint8))
    count = most - least + 1
    run = np.repeat(np.arange(len(g)), count)
    before = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + least[run]
    start = (place[run] - before).astype(np.int64)
    # Windows with their anchor at different places are different.
    _, group = np.unique(g, return_inverse=True)
    group = group[run] * (1 << 16) + before
    found = equal_suffixes(data, (offsets[:-1] - offsets[0])[run] + start, group, threshold)
    found = found[n[run[found]] == 1]
    one = row[run[found]]
    window = lo[run[found]] + start[found]
    order = np.lexsort((window, one))
    one, window = one[order], window[order]
    new = np.append(True, (one[1:] != one[:-1]) | (window[1:] != window[:-1] + 1))[: len(one)]
    last = np.append(new[1:], True)[: len(one)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (one[new], window[new], window[last])], ["_row", "lo", "hi"])


def _sort_groups(threshold: int, rows: int):
    """Over rows in the order of their groups: as many whole groups as have about ``rows`` rows at a time."""

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) < rows:
                continue
            whole = pa.concat_tables(held)
            g = whole.column("g").to_numpy()
            borders = np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, len(g))
            begin = 0
            while True:  # whole groups, but for the last one, which may go on
                far = borders[borders < len(g)]
                some = far[(far > begin) & (far - begin <= rows)]
                end = some[-1] if len(some) else next((b for b in far if b > begin), None)
                if end is None or (len(g) - begin < rows):
                    break
                yield _spans_of(whole.slice(begin, end - begin), threshold)
                begin = end
            held = [whole.slice(begin)]
        if held and sum(t.num_rows for t in held):
            yield _spans_of(pa.concat_tables(held), threshold)

    return sort


def _split(runs: DataFrame, width: int, threshold: int) -> DataFrame:
    """A pass by a wider digit: the bytes that ``width`` neighbouring windows share. Groups of one leave."""
    bins = F.sequence(F.expr(f"least div {width}"), F.expr(f"most div {width}"))
    rows = runs.withColumn("_bin", F.explode(bins))
    begin = F.col("place") - F.col("_bin") * width
    core = F.substring("bytes", (begin + 1).cast("int"), F.lit(threshold - width + 1))
    rows = rows.withColumns(
        {
            "g": F.xxhash64("g", "_bin", core),
            "least": F.greatest("least", F.col("_bin") * width),
            "most": F.least("most", F.col("_bin") * width + (width - 1)),
        }
    ).drop("k", "_bin")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    return write_scratch(attach(rows, sizes, ["g"], rows="k", how="inner", limit=_BROADCAST), "split")


def _whole_windows(runs: DataFrame, threshold: int) -> DataFrame:
    """Runs of a single window each, where the windows themselves are the groups."""
    window = F.substring("bytes", (F.col("place") - F.col("least") + 1).cast("int"), F.lit(threshold))
    rows = runs.withColumn("_window", window)
    sizes = rows.groupBy("_window").agg(F.count(F.lit(1)).alias("_same")).filter("_same > 1")
    start = F.col("lo") + F.col("place") - F.col("least")
    met = attach(rows.filter("n = 1"), sizes, ["_window"], rows="_same", how="inner", limit=_BROADCAST)
    return met.select("_row", start.alias("lo"), start.alias("hi"))


def _open_spans(runs: DataFrame, threshold: int, group_rows: int) -> DataFrame:
    """Repeated windows of runs that are not repeated as a whole: _row, lo, hi."""
    found = None
    for width in (None, *_WIDTHS):
        if width:
            runs = _split(runs, width, threshold)
        small = runs.filter(F.col("k") <= group_rows).drop("k")
        dealt = small.repartition("g").sortWithinPartitions("g")
        spans = dealt.mapInArrow(_sort_groups(threshold, group_rows), "_row bigint, lo bigint, hi bigint")
        spans = write_scratch(spans, "spans")
        found = spans if found is None else found.unionByName(spans)
        runs = runs.filter(F.col("k") > group_rows)
        if runs.isEmpty():
            return found
    return found.unionByName(_whole_windows(runs, threshold))


def repeated_windows(texts: DataFrame, threshold: int = THRESHOLD, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Windows that occur more than once, as runs of starts: _row, lo, hi (written).

    ``texts`` is a written table of ``_row`` (unique) and ``_bytes``.
    """
    spark = texts.sparkSession
    live_path, spans_path = scratch_path(spark, "live"), scratch_path(spark, "repeated")
    with scratch_scope(spark):
        rows = texts.select("_row", "_bytes").mapInArrow(_find_anchors(threshold), _ANCHOR_SCHEMA)
        rows = write_scratch(rows, "anchors")
        grams = rows.groupBy("gram").agg(F.sum("n").alias("_total")).filter("_total > 1")
        live = attach(rows, grams, ["gram"], rows="_total", how="inner", limit=_BROADCAST)
        live.drop("_total").write.parquet(live_path)
    live = spark.read.parquet(live_path)
    with scratch_scope(spark):
        runs = live.groupBy("gram", "rest").agg(
            F.sum("n").alias("n"), F.min_by("at", "_row").alias("at"), F.min("_row").alias("_row")
        )
        runs = write_scratch(runs, "runs")
        done = runs.filter("n > 1").select("gram", "rest", F.col("n").alias("_total"))
        done = attach(live, done, ["gram", "rest"], rows="_total", how="inner", limit=_BROADCAST)
        one = F.array(F.struct(F.shiftright("at", 32).alias("lo"), (F.shiftright("at", 32) + F.col("at").bitwiseAND(0xFFFF)).alias("hi")))
        whole = done.select("_row", F.inline(F.coalesce("more", one)))
        # Runs with a common anchor that differ elsewhere.
        grams = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("_least"))
        grams = grams.filter("k > 1 and _least = 1").drop("_least")
        left = attach(runs, grams, ["gram"], rows="k", how="inner", limit=_BROADCAST)
        lists = left.groupBy("_row").agg(F.collect_list(F.struct("gram", "n", "at", "k")).alias("_runs"))
        cut = texts.select("_row", "_bytes").join(lists, "_row").mapInArrow(_cut_runs(threshold), _RUN_SCHEMA)
        parts = _open_spans(write_scratch(cut, "cut"), threshold, group_rows)
        whole.unionByName(parts).write.parquet(spans_path)
    return spark.read.parquet(spans_path)


KEPT = T.StructType(
    [T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]
)


def _remover(threshold: int):
    def keep(texts: pa.Array, spans: pa.Array) -> pa.Array:
        offsets, runs = spans.offsets.to_numpy(), spans.values
        lo, hi = runs.field("lo").to_numpy(), runs.field("hi").to_numpy()
        out: list[tuple[int, int, bytes]] = []
        for i, text in enumerate(texts):
            part = slice(offsets[i], offsets[i + 1])
            whole = memoryview(text.as_buffer())
            kept, begin, covered, count = [], 0, 0, 0
            for a, b in sorted(zip(lo[part].tolist(), (hi[part] + threshold).tolist())):
                if count == 0 or a > begin:  # ``begin`` is the end of the removed bytes so far
                    kept.append(whole[begin:a])
                    count += 1
                    covered += b - a
                else:
                    covered += max(b - begin, 0)
                begin = max(begin, b)
            kept.append(whole[begin:])
            out.append((covered, count, b"".join(kept)))
        removed, runs_of, left = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(removed, pa.int64()), pa.array(runs_of, pa.int64()), pa.array(left, pa.binary())],
            ["n_removed", "n_spans", "kept"],
        )

    return F.arrow_udf(keep, KEPT)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: int = THRESHOLD,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_bytes, n_removed, n_spans and the bytes ``kept`` (binary).

    Every byte goes that is covered by a string of ``threshold`` bytes that also starts anywhere else, in the same
    text or another; strings are judged on the input and overlaps count. Rows are told apart by a number of their
    own, so keys may be null or repeat, and repeated rows are copies of each other like any. A null text counts
    as empty. A text shorter than the threshold has no window and stays whole. A text of any length is read whole, by
    stretches. Removed bytes may cut a character, so ``kept`` is binary. Other columns are not read, and an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "texts")
    rows = docs.select(F.col(key).alias("_key"), text_of(text).cast("binary").alias("_bytes"))
    # A number that is written stays the same whatever is computed again later.
    rows.withColumn("_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    texts = spark.read.parquet(path)
    spans = repeated_windows(texts, threshold, group_rows)
    lists = spans.groupBy("_row").agg(F.collect_list(F.struct("lo", "hi")).alias("_spans"))
    none = F.array().cast("array<struct<lo: bigint, hi: bigint>>")
    met = texts.join(lists, "_row", "left").withColumn("_spans", F.coalesce("_spans", none))
    done = met.withColumn("_kept", _remover(threshold)("_bytes", "_spans"))
    return done.select(
        F.col("_key").alias(key),
        F.octet_length("_bytes").cast("bigint").alias("n_bytes"),
        F.col("_kept.n_removed").alias("n_removed"),
        F.col("_kept.n_spans").alias("n_spans"),
        F.col("_kept.kept").alias("kept"),
    )


def kept_text(kept: Column) -> Column:
    """What is left as text; a character that was cut is replaced."""
    return F.decode(kept, "UTF-8")


@query("op12_radix_suffixes")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
