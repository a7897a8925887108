"""Connected components of a table of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docfleet.llm.work import Work


def smallest_reachable(links: DataFrame, work: Work, name: str) -> DataFrame:
    """For links (a, b): every id that occurs, with the smallest id it can reach (id, label).

    Each round moves every link to the labels of its ends and hangs a label below the smallest one
    it is linked with; links whose ends have met are dropped. A round at least halves the labels that
    still have links, so the rounds grow with the logarithm of the longest chain. Nothing is gathered
    on the driver, and minima are combined before each shuffle, so a hub costs no more than other ids.
    """
    edges = work.save(links.select("a", "b").filter("a <> b").distinct(), f"{name}_edges0")
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("label", F.col("id"))
    step = 0
    while not edges.isEmpty():
        step += 1
        # every label takes the smallest label among itself and its neighbours
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lower = work.save(
            both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")).filter("a <> to"),
            f"{name}_lower{step}",
        )
        # follow the pointers to their ends
        hops = 0
        while True:
            nxt = lower.select(F.col("a").alias("to"), F.col("to").alias("far"))
            joined = lower.join(nxt, "to", "left")
            moved = work.save(joined.select("a", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("m")), f"{name}_hop{step}_{hops}")
            going = not moved.filter("m").isEmpty()
            lower, hops = moved.select("a", "to"), hops + 1
            if not going:
                break
        at = lambda df, c: (
            df.join(lower.select(F.col("a").alias(c), F.col("to").alias("_to")), c, "left")
            .withColumn(c, F.coalesce("_to", c)).drop("_to")
        )
        labels = work.save(at(labels, "label"), f"{name}_labels{step}")
        edges = work.save(at(at(edges, "a"), "b").filter("a <> b").select("a", "b").distinct(), f"{name}_edges{step}")
    return labels
