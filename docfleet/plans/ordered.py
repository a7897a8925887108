"""Order-dependent results (row numbers, running sums, last value so far) without putting a
whole group into one task.

Two ways of cutting a group into ordered pieces are used:

* *positions*: when the order is a non-negative integer that is unique within its group, a piece
  is a fixed stretch of positions. That needs no sampling and bounds every piece by its width.
* *range split*: for any other order the table is range-partitioned on (group, order) and stored,
  so a group of any size is spread over as many pieces as its share of the rows asks for.

Either way a piece is finished locally and a small per-piece summary carries the state over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from docfleet.plans.runtime import stored

POSITIONS_PER_PIECE = 65_536
ROWS_PER_PART = 10_000


# ---------------------------------------------------------------- pieces by position


def piece_of(pos: str, width: int) -> Column:
    return F.expr(f"`{pos}` div {width}")


def running_sum_by_position(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: Column,
    out: str,
    width: int | None = None,
) -> DataFrame:
    """Sum of ``value`` over all rows of the group up to and including this position."""
    keys, width = list(keys), width or POSITIONS_PER_PIECE
    pieces = df.withColumn("_piece", piece_of(pos, width)).withColumn("_value", value)
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        pieces.groupBy(*keys, "_piece")
        .agg(F.sum("_value").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(earlier))
        .filter(F.coalesce(F.col("_carry"), F.lit(0)) != 0)
        .select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_piece").alias("_at"), "_carry")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)], F.col("_piece") == F.col("_at"))
    local = Window.partitionBy(*keys, "_piece").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return (
        pieces.join(carry, same, "left")
        .withColumn(out, F.sum("_value").over(local) + F.coalesce(F.col("_carry"), F.lit(0)))
        .drop("_piece", "_value", "_carry", "_at", *[f"_key{i}" for i in range(len(keys))])
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: dict[str, tuple[str, int]],
    width: int | None = None,
) -> DataFrame:
    """Add values of the row just before (offset -1) or after (+1) in position order.

    Positions must be gapless. The rows at the edge of a piece are copied into the neighbouring
    piece, so one shuffle is enough.
    """
    keys, width = list(keys), width or POSITIONS_PER_PIECE
    piece = piece_of(pos, width)
    at_end = F.expr(f"`{pos}` % {width}") == width - 1
    at_start = (F.expr(f"`{pos}` % {width}") == 0) & (piece > 0)
    homes = F.array_compact(F.array(piece, F.when(at_end, piece + 1), F.when(at_start, piece - 1)))
    local = Window.partitionBy(*keys, "_piece").orderBy(pos)
    spread = df.withColumn("_home", piece).withColumn("_piece", F.explode(homes))
    for out, (source, offset) in columns.items():
        spread = spread.withColumn(out, F.lag(source, -offset).over(local))
    return spread.filter(F.col("_piece") == F.col("_home")).drop("_piece", "_home")


def ordered_parts(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    text: Column,
    sep: str,
    out: str = "text",
    rows_per_part: int | None = None,
) -> DataFrame:
    """Join ``text`` in position order, in numbered parts of at most ``rows_per_part`` positions.

    A document that fits in one part comes back as one row (part 0). The parts of a longer one,
    joined by ``sep`` in part order, are the whole text.
    """
    rows_per_part = rows_per_part or ROWS_PER_PART
    piece = df.select(
        *keys,
        F.expr(f"cast(`{pos}` div {rows_per_part} as bigint)").alias("part"),
        F.struct(F.col(pos).alias("p"), F.coalesce(text, F.lit("")).alias("t")).alias("_item"),
    )
    ordered = F.sort_array(F.collect_list("_item"))
    return piece.groupBy(*keys, "part").agg(
        F.array_join(F.transform(ordered, lambda item: item["t"]), sep).alias(out)
    )


def explode_range(df: DataFrame, keys: Sequence[str], low: str, high: str, out: str, width: int | None = None) -> DataFrame:
    """One row per integer in low..high (inclusive), none where low > high.

    Long ranges are first cut into stretches and shuffled, so no task or array holds a long one.
    """
    width = width or POSITIONS_PER_PIECE
    stretches = (
        df.filter(F.col(low) <= F.col(high))
        .withColumn("_stretch", F.explode(F.expr(f"sequence(cast(0 as bigint), (`{high}` - `{low}`) div {width})")))
        .repartition(*keys, "_stretch")
    )
    first = F.col(low) + F.col("_stretch") * width
    return stretches.withColumn(
        out, F.explode(F.sequence(first, F.least(F.col(high), first + (width - 1))))
    ).drop("_stretch")


# ---------------------------------------------------------------- pieces by range split


def range_split(df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Store ``df`` range-partitioned on (keys, order), with the piece number in ``_piece``."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    return stored(ranged.withColumn("_piece", F.spark_partition_id()), "ordered")


def _earlier_pieces(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)


def _add_carry(split: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    # A group that covers k pieces adds k-1 rows to the carry table, so the table has fewer
    # rows than there are pieces: safe to broadcast however large the data is.
    left, right = split.alias("l"), F.broadcast(carry).alias("r")
    same = F.col("l._piece") == F.col("r._piece")
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, same, "left").select("l.*", "r._carry")


def split_running_sum(split: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Running sum over a table made by :func:`range_split`."""
    valued = split.withColumn("_value", value)
    carry = (
        valued.groupBy(*keys, "_piece")
        .agg(F.sum("_value").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(_earlier_pieces(keys)))
        .filter(F.col("_carry").isNotNull())
        .drop("_total")
    )
    local = Window.partitionBy("_piece", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _add_carry(valued, carry, keys)
        .withColumn(out, F.sum("_value").over(local) + F.coalesce(F.col("_carry"), F.lit(0)))
        .drop("_value", "_carry")
    )


def split_last(
    split: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: Column,
    value: str,
    out: str,
    before_only: bool = False,
) -> DataFrame:
    """Last non-null ``value`` so far over a table made by :func:`range_split`.

    ``rank`` is ``order`` as one comparable column (ascending); it finds the last value of a
    piece with a map-side combined ``max_by``. ``before_only`` leaves the row itself out.
    """
    carry = (
        split.groupBy(*keys, "_piece")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), rank)).alias("_last"))
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(_earlier_pieces(keys)))
        .filter(F.col("_carry").isNotNull())
        .drop("_last")
    )
    end = -1 if before_only else 0
    local = Window.partitionBy("_piece", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    return (
        _add_carry(split, carry, keys)
        .withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(local), F.col("_carry")))
        .drop("_carry")
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn", parts: int | None = None
) -> DataFrame:
    """1-based row number within each group; ``order`` must be total for a repeatable result."""
    split = range_split(df, keys, order, parts)
    return split_running_sum(split, keys, order, F.lit(1).cast("bigint"), out).drop("_piece")
