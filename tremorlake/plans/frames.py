"""Bounded ROWS frames over series of any length.

Given dense positions, a series is cut into chunks of ``chunk_rows`` rows. A frame that
reaches ``before`` rows back and ``after`` rows ahead only needs the edge rows of the
neighbouring chunks, and dense positions say which rows those are without looking at any
other row. So each row is emitted once for its own chunk and, if it lies on an edge, once
more as a *halo* row for the neighbour: a narrow step, followed by one shuffle on
(keys, chunk), whose groups hold at most ``chunk_rows + before + after`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

CHUNK_ROWS = 131_072
_CHUNK, _HALO = "_chunk", "_halo"


def chunk_of(pos: str, chunk_rows: int) -> Column:
    """Number of the chunk of a position, by integer division."""
    return F.expr(f"`{pos}` div {chunk_rows}")


def with_halo(
    df: DataFrame, pos: str, before: int, after: int = 0, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add ``_chunk`` and ``_halo``; edge rows appear again for the chunk that reaches them."""
    chunk = chunk_of(pos, chunk_rows)
    local = F.pmod(F.col(pos), F.lit(chunk_rows))

    def seat(number: Column, halo: bool) -> Column:
        return F.struct(number.alias(_CHUNK), F.lit(halo).alias(_HALO))

    if max(before, after) > chunk_rows:
        # A frame over several chunks: the row goes to every chunk that reaches it.
        first = F.greatest(F.expr(f"(`{pos}` - {after}) div {chunk_rows}"), F.lit(0).cast("bigint"))
        last = F.expr(f"(`{pos}` + {before}) div {chunk_rows}")
        seats = F.transform(F.sequence(first, last), lambda c: seat(c, c != chunk))
        return df.select("*", F.inline(seats))
    own = seat(chunk, False)
    if not before and not after:
        return df.withColumns({_CHUNK: chunk, _HALO: F.lit(False)})
    late, early = local >= chunk_rows - before, (local < after) & (chunk > 0)
    following, previous = seat(chunk + 1, True), seat(chunk - 1, True)
    # A choice between literal arrays compiles; filtering one array would be interpreted per row.
    seats = F.when(late & early, F.array(own, following, previous)).when(late, F.array(own, following))
    seats = seats.when(early, F.array(own, previous)).otherwise(F.array(own))
    return df.select("*", F.inline(seats))


def framed(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    before: int,
    after: int,
    *stages: Mapping[str, Callable[[WindowSpec], Column]],
    within: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``before``/``after`` rows away.

    Each function in a stage takes the ordered window and returns the column. A later stage may
    frame columns of an earlier one; ``before`` and ``after`` are then the sums of the reaches, and
    all stages share one shuffle and one sort. ``within`` names columns at whose change a frame
    ends, such as the second of the reading; a hot second is still spread over chunks.
    """
    w = Window.partitionBy(*keys, _CHUNK, *within).orderBy(pos)
    rows = with_halo(df, pos, before, after, chunk_rows)
    for stage in stages:
        rows = rows.withColumns({name: make(w) for name, make in stage.items()})
    return rows.filter(~F.col(_HALO)).drop(_CHUNK, _HALO)
