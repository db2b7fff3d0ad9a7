"""Fill-in-the-middle: a text is cut into prefix, middle and suffix at unit borders and put in another order.

A unit is a word with the white space before it, or the white space at the end of a text. Borders are found
without splitting the text: its UTF-8 bytes are viewed as 64-bit words, and a few arithmetic operations mark
the last byte of every unit in eight bytes at once. ``bitwise_count`` of the marks gives the units of each
word, their cumulative sum finds the word that holds the k-th border, and a multiplication that sums the
marks of its bytes selects the border inside the word. All texts of an Arrow batch are one such array, and
neither the number nor the length of the texts shows in a Python loop.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import query, table, text_of

#: Bytes of text viewed at once; a longer text is viewed alone.
VIEW_BYTES = 16 << 20

_ONES = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def _each(byte: int) -> np.uint64:
    return np.uint64(byte) * _ONES


def white_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is a space or 0x09 to 0x0D. No sum leaves its byte."""
    low = words & _LOW
    from_tab = low + _each(0x80 - 0x09)
    past_return = low + _each(0x80 - 0x0E)
    other = (low ^ _each(0x20)) + _LOW  # top bit unless the byte is a space
    return ((from_tab & ~past_return) | ~other) & ~words & _TOP


def unit_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is not white while the next one is; after the last word all is white."""
    white = white_marks(words)
    following = np.append(white[1:], _TOP)
    following = (white >> np.uint64(8)) | (following << np.uint64(56))
    return ~white & following & _TOP


def select_in_word(marks: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Number of the byte that holds the mark of that rank (1 to 8) in its word."""
    running = (marks >> np.uint64(7)) * _ONES  # byte i holds the marks in bytes 0 to i
    reached = ((running | _TOP) - rank.astype(np.uint64) * _ONES) & _TOP
    return 8 - np.bitwise_count(reached).astype(np.int64)


@dataclass
class UnitIndex:
    """Units of many texts that lie one behind the other in ``data``, from ``starts`` to ``ends`` (bytes)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __post_init__(self):
        size = len(self.data)
        padded = np.full(-(-max(size, 1) // 8) * 8, 0x20, np.uint8)
        padded[:size] = self.data
        self.marks = unit_marks(padded.view("<u8"))
        # The last byte of a text ends its last unit, whatever the next text begins with.
        last = self.ends[self.ends > self.starts] - 1
        bits = np.uint64(0x80) << (8 * (last % 8)).astype(np.uint64)
        np.bitwise_or.at(self.marks, last // 8, bits)
        self.total = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)
        self.before = self._rank(self.starts)
        self.count = self._rank(self.ends) - self.before

    def _rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before the byte ``at``."""
        if not len(at):
            return np.zeros(0, np.int64)
        word = np.minimum(at // 8, len(self.marks) - 1)
        inside = (8 * (at - 8 * word)).astype(np.uint64)
        # A shift by 64 is undefined, so the lowest bits below ``at`` are kept in two steps.
        upper = np.where(inside == 0, np.uint64(0), ~np.uint64(0) >> (np.uint64(64) - np.maximum(inside, np.uint64(1))))
        whole = self.total[word] - np.bitwise_count(self.marks[word])
        return whole + np.bitwise_count(self.marks[word] & upper)

    def end_of(self, unit: np.ndarray) -> np.ndarray:
        """Bytes up to the end of the ``unit``-th unit (from 1) of each text; 0 for unit 0."""
        if not len(unit):
            return np.zeros(0, np.int64)
        wanted = np.maximum(self.before + unit, 1)
        word = np.minimum(np.searchsorted(self.total, wanted), len(self.total) - 1)
        rank = wanted - (self.total[word] - np.bitwise_count(self.marks[word]))
        border = 8 * word + select_in_word(self.marks[word], rank) + 1
        return np.where(unit > 0, border - self.starts, 0)


def _offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary array, also where it is a slice of another."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def _views(offsets: np.ndarray, size: int):
    """Runs of texts of about ``size`` bytes; a text is never cut."""
    at = 0
    while at < len(offsets) - 1:
        end = max(int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1, at + 1)
        yield at, end
        at = end


CUT = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("first", T.LongType()), T.StructField("second", T.LongType())]
)


def cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """Units of each text, and the bytes up to the ends of the smaller and the larger of h1 and h2 mod (n + 1)."""
    data, offsets = _offsets(texts)
    h1, h2 = (h.to_numpy(zero_copy_only=False).astype(np.int64) for h in (h1, h2))
    n, first, second = (np.zeros(len(texts), np.int64) for _ in range(3))
    for a, b in _views(offsets, VIEW_BYTES):
        own = offsets[a : b + 1] - offsets[a]
        index = UnitIndex(data[offsets[a] : offsets[b]], own[:-1], own[1:])
        one, two = h1[a:b] % (index.count + 1), h2[a:b] % (index.count + 1)
        n[a:b] = index.count
        first[a:b], second[a:b] = index.end_of(np.minimum(one, two)), index.end_of(np.maximum(one, two))
    return pa.StructArray.from_arrays([pa.array(n), pa.array(first), pa.array(second)], ["n", "first", "second"])


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: str = "42",
    share: int = 50,
    spm_share: int = 80,
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
) -> DataFrame:
    """One row per row of ``docs``: ``key``, n (units), form, output, prefix_chars and middle_chars.

    ``share`` percent of the texts are cut, ``spm_share`` percent of those in the order suffix, prefix,
    middle. Draws come from the SHA-256 of seed and key, so reruns agree and rows with one key draw alike;
    a null key draws as an empty one. A null text counts as empty. An empty text and one that contains a
    sentinel stay plain, with null lengths. White space alone is one unit. Texts of any length are cut
    as a whole, other columns of ``docs`` are not read, and an empty table gives an empty result.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    draw = [F.conv(F.substring("_draw", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"), digest.alias("_draw"))
    body = F.col("_text").cast("binary")
    cut = F.arrow_udf(cuts, CUT)
    rows = rows.withColumn("_cut", cut(body, draw[0], draw[1]))
    marked = F.col("_text") == ""
    for s in sentinels:
        marked |= F.contains(F.col("_text"), F.lit(s))
    form = F.when(marked | (draw[2] % 100 >= share), "plain").when(draw[3] % 100 < spm_share, "spm").otherwise("psm")
    first, second = F.col("_cut.first"), F.col("_cut.second")
    one = F.lit(1).cast("bigint")

    def part(start: Column, size: Column) -> Column:
        return F.substring(body, start.cast("int"), size.cast("int")).cast("string")

    rows = rows.select(
        "_key",
        "_text",
        F.col("_cut.n").alias("n"),
        form.alias("form"),
        part(one, first).alias("_prefix"),
        part(first + 1, second - first).alias("_middle"),
        part(second + 1, F.octet_length("_text") - second).alias("_suffix"),
    )
    p, s, m = (F.lit(x) for x in sentinels)
    psm = F.concat(p, "_prefix", s, "_suffix", m, "_middle")
    spm = F.concat(s, "_suffix", p, "_prefix", m, "_middle")
    is_cut = F.col("form") != "plain"
    return rows.select(
        F.col("_key").alias(key),
        "n",
        "form",
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("_text")).alias("output"),
        F.when(is_cut, F.char_length("_prefix")).cast("bigint").alias("prefix_chars"),
        F.when(is_cut, F.char_length("_middle")).cast("bigint").alias("middle_chars"),
    )


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that an output was made from. Cut texts hold no sentinel, so each occurs once."""
    p, s, m = sentinels

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    middle = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '{UNITS}') AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query("op11_swar_fim", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        _digest(F.col("output")).alias("output_sha256"),
        _digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
