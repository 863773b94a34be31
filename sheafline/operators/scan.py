"""Running aggregates over an ordered key that survive a key holding a large share of all rows.

A plain window sends every row of a key to one task. Here a key's ordered rows are cut into
blocks; the window runs inside a block, the block totals (a few rows per key) are accumulated
separately, and the two are added. ``block`` must not decrease along ``order``; that makes the
result equal to the plain window. Rows with a null key are a group of their own, as in a window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "__block"

#: Rows of one key handled by one task when the order column is a dense ordinal.
BLOCK_ROWS = 100_000


#: Bits of an ordinal that hold the position within a body.
_POSITION_BITS = 32


def arrival_ordinal(batch: Column, pos: Column) -> Column:
    """One number that orders entries by body, then by place in the body.

    A place is an array index and so below 2^31; a body number outside 0 to 2^31 - 1 is an error, not a collision.
    """
    wrong = F.raise_error(F.concat(F.lit("Body number out of range: "), batch.cast("string"))).cast("bigint")
    number = F.when((batch >= 0) & (batch < 2**31), batch.cast("bigint")).when(batch.isNotNull(), wrong)
    return F.shiftleft(number, _POSITION_BITS) + pos


def ordinal_parts(ordinal: Column) -> tuple[Column, Column]:
    """Body number and place of an :func:`arrival_ordinal`."""
    return F.shiftright(ordinal, _POSITION_BITS), ordinal.bitwiseAND(F.lit(2**_POSITION_BITS - 1)).cast("int")


def ordinal_block(col: Column, width: int = BLOCK_ROWS) -> Column:
    """Block number of a whole-number ordinal."""
    return F.floor(col / F.lit(width)).cast("bigint")


def ordinal_width(df: DataFrame, name: str, rows: int = BLOCK_ROWS) -> int:
    """Block width that puts about ``rows`` rows in a block when the ordinal is sparse, such as hashed ids.

    One aggregate over that column alone; three numbers come back.
    """
    low, high, n = df.agg(F.min(name), F.max(name), F.count(name)).first()
    if not n:
        return rows
    return max(rows, -(-(high - low + 1) * rows // n))


def blocked_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block: Column,
    running: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add inclusive running aggregates; ``running`` maps a new column to (``sum``|``max``|``count``, value)."""
    agg = {"sum": F.sum, "max": F.max, "count": F.count}
    blocked = df.withColumn(_BLOCK, block)
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    totals = blocked.groupBy(*keys, _BLOCK).agg(*[agg[op](v).alias(f"__t_{n}") for n, (op, v) in running.items()])
    offsets = totals.select(
        *keys,
        _BLOCK,
        *[
            (F.max if op == "max" else F.sum)(f"__t_{n}").over(earlier).alias(f"__o_{n}")
            for n, (op, _) in running.items()
        ],
    )
    scanned = blocked.select("*", *[agg[op](v).over(inside).alias(n) for n, (op, v) in running.items()])
    named = offsets.select(*[F.col(k).alias(f"__k_{k}") for k in (*keys, _BLOCK)], *[f"__o_{n}" for n in running])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in (*keys, _BLOCK)])
    joined = scanned.join(named, same, "left")
    combined = {}
    for name, (op, _) in running.items():
        offset = F.col(f"__o_{name}")
        if op == "max":
            combined[name] = F.greatest(F.col(name), offset)
        elif op == "count":
            combined[name] = F.col(name) + F.coalesce(offset, F.lit(0))
        else:
            combined[name] = F.when(F.col(name).isNull(), offset).otherwise(
                F.when(offset.isNull(), F.col(name)).otherwise(F.col(name) + offset)
            )
    return joined.select(*df.columns, *[c.alias(n) for n, c in combined.items()])


def blocked_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], block: Column, name: str = "rn"
) -> DataFrame:
    """1-based position within the key."""
    return blocked_scan(df, keys, order, block, {name: ("count", F.lit(1))})
