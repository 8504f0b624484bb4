"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only after it is shown to hold at most this many rows
# and this many bytes of column data; above either bound the join stays a
# shuffle join (sort-merge, with AQE's skew splitting).
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 8 << 20


def at_most(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and ``max_bytes`` of data.

    One job over at most ``max_rows + 1`` rows: strings count their UTF-8
    length, every other column 8 bytes.
    """
    sizes = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if f.dataType.simpleString() == "string" else F.lit(8)
        for f in df.schema.fields
    ]
    row_bytes = sum(sizes[1:], sizes[0]) if sizes else F.lit(0)
    n, total = df.limit(int(max_rows) + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0))
    ).first()
    return n <= max_rows and total <= max_bytes


def side(df: DataFrame, small: bool) -> DataFrame:
    """``broadcast(df)`` for a side checked small (or a subset of one), else a
    sort-merge hint so the planner cannot pick the other side for broadcast."""
    return F.broadcast(df) if small else df.hint("shuffle_merge")
