"""Mixing sources to target weights by a curriculum that varies over training time.

Native: DataFrame expressions only.

* Targets. All sources together give ``share`` of their size. It is dealt by weight; a source stops at
  ``most`` times its size and the excess is dealt again among the others, until none is above.
* Schedule. A source's rate over training time 0..1 is piecewise linear (``SCHEDULES``, one per place
  in the cycle of weights). Integrated and scaled to the target it is the source's cumulative demand.
* Positions. A source's documents stand on its demand axis one after the other, in the order of a
  hash; a second turn of all of them follows the first. A turn of a document is taken when its middle
  lies below the target, and the inverse of the cumulative demand at its middle is its training
  position. The mix is range-sorted by position.

Running sums are cut into pieces by hash range, so a source that holds a third of all rows is spread
over as many pieces as its rows need. Sums per source and per piece are made before each shuffle.

Defined results: a null or empty text has size 0 and is taken (it costs nothing) where its source has
a target; a null source is one source, last in order; a source of size 0 has target 0. Rows that
repeat a doc_id are mixed each on its own. Other columns pass through and may have any name that does
not start with an underscore. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docfleet.llm.work import Work
from docfleet.plans.ordered import number_rows

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Knots (time, rate): the heaviest sources come early, the lightest late.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.4), (0.5, 0.8), (1.0, 2.0)),
)
ROWS_PER_PIECE = 1024
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, work: Work, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """From _source and source_size: target and the source's place in the cycle of weights (_turn)."""
    ranked = number_rows(sizes, [], [F.col("_source")], out="_rank")
    turn = ((F.col("_rank") - 1) % len(weights)).cast("int")
    weighted = work.save(
        ranked.withColumn("_turn", turn).withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), F.col("_turn") + 1))
        .withColumn("_cap", (F.col("source_size") * most).cast("bigint")).drop("_rank"),
        "sources",
    )
    # the level that each unit of weight gets: only one row of sums comes to the driver in each turn
    total = weighted.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level = 0.0
    while True:
        full = F.col("_cap") <= F.col("_weight") * F.lit(level)
        s = weighted.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0)).alias("capped"), F.sum(F.when(full, 0).otherwise(F.col("_weight"))).alias("open")
        ).first()
        if not s["open"]:
            break
        raised = (share * total - s["capped"]) / s["open"]
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.lit(level))
    return weighted.withColumn("target", target).drop("_cap", "_weight")


def _inverse(demand: Column, target: Column, turn: Column, schedules) -> Column:
    """Training time at which the schedule's integral, scaled to ``target``, reaches ``demand``."""
    out = None
    for k, knots in enumerate(schedules):
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        wanted = F.when(target > 0, demand / target).otherwise(F.lit(0.0)) * area
        done, at = 0.0, F.lit(knots[-1][0])
        for a, b in reversed(list(zip(knots, knots[1:]))):
            part = (b[0] - a[0]) * (a[1] + b[1]) / 2
            before = area - done - part
            slope = (b[1] - a[1]) / (b[0] - a[0])
            rest = F.greatest(wanted - before, F.lit(0.0))
            inside = 2 * rest / (F.lit(a[1]) + F.sqrt(F.greatest(F.lit(a[1] ** 2) + 2 * slope * rest, F.lit(0.0))))
            at = F.when(wanted <= before + part, F.lit(a[0]) + inside).otherwise(at)
            done += part
        out = F.when(turn == k, at) if out is None else out.when(turn == k, at)
    return out


def plan_mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES, seed: int = 7, work: Work | None = None
) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target, taken and _positions (a training position per turn taken)."""
    work = work or Work(docs.sparkSession, "curriculum")
    source = F.col("source").cast("string")
    based = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("size", "source_size", "target", "taken")],
        word_count(F.col("text").cast("string")).alias("size"),
        # a key that is never null, in code point order with null last
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("_source"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("_hash"),
    )
    narrow = work.save(based.select("_source", "_hash", "size"), "narrow")
    goals = targets(narrow.groupBy("_source").agg(F.sum("size").alias("source_size")), work, weights, share, most)

    bits = (-(-narrow.count() // ROWS_PER_PIECE)).bit_length()
    piece = F.shiftrightunsigned("_hash", 64 - bits) if bits else F.lit(0).cast("bigint")
    before = Window.partitionBy("_source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        narrow.groupBy("_source", piece.alias("_piece")).agg(F.sum("size").alias("_sum"))
        .withColumn("_carry", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
        .join(goals, "_source")
    )
    own = Window.partitionBy("_source", "_piece").orderBy("_hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    local = based.withColumn("_piece", piece).withColumn("_local", F.coalesce(F.sum("size").over(own), F.lit(0)))
    placed = local.join(work.save(carry, "carry"), ["_source", "_piece"])

    start = F.col("_carry") + F.col("_local")
    middle = lambda turn: (turn * F.col("source_size") + start) + F.col("size") / 2
    taken = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), middle), lambda m: m < F.col("target"))
    return (
        placed.withColumn("_middles", taken)
        .withColumn("taken", (F.size("_middles") * F.col("size")).cast("bigint"))
        .withColumn("_positions", F.transform("_middles", lambda m: _inverse(m, F.col("target"), F.col("_turn"), schedules)))
        .drop("_source", "_hash", "_piece", "_local", "_carry", "_turn", "_middles")
    )


def mix(docs: DataFrame, work: Work | None = None, **options) -> DataFrame:
    """The training set: the rows of ``docs``, once per turn taken, range-sorted by training position."""
    turns = plan_mix(docs, work=work, **options).withColumn("_position", F.explode("_positions"))
    return turns.orderBy("_position", "doc_id").select(docs.columns)
