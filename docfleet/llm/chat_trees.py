"""Reply trees formatted as conversations.

Messages (tree_id, node_id, parent_id, role, text, score) form trees. Every path from a root to a leaf
is a branch; a tree's branches are ranked by the sum of their scores, and each chosen branch becomes
one conversation. Self-joins find the paths by doubling: after round r every node knows its ancestor
2**r steps up and the score of the steps between, so a thread of any length takes log2 rounds of
joins on (tree, node), where no key is hot.

Template, per turn: ``<|im_start|>role LF text <|im_end|> LF``. Inside roles and texts a backslash is put
between ``<`` (and any backslashes that follow it) and ``|``; line feeds and backslashes of roles are
written ``\\n`` and ``\\\\``. Both are undone when read back, so no text can forge a turn. The loss mask
covers the texts of the roles in ``trained``.

Defined results: a null text or role is empty, a null score 0. A node whose parent is not in its tree
is a root. Of rows that repeat a node one counts; a node without node_id takes no part. Messages
without tree_id, and turns without conv_id, are one tree and one conversation, named null. Nodes on a cycle have no root and take no part.
Branches of equal score are ranked by the leaf's id. Other columns take no part and may have any name.
An empty table gives an empty result. A conversation is one row of the result, so its turns meet in one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docfleet.llm.work import Work

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = ("assistant",)
_ESCAPE = r"<(\\*)\|"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ESCAPE, r"<$1\\|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation, as they were."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def branches(messages: DataFrame, most: int | None = 1, work: Work | None = None) -> DataFrame:
    """tree_id, leaf_id, branch_rank, branch_score and every node of the branch with its depth (root 0).

    ``most`` branches per tree, best first; None for all.
    """
    work = work or Work(messages.sparkSession, "chat_trees")
    nodes = work.save(
        # a null tree_id is a tree of its own; inside a struct it equals itself in joins
        messages.filter("node_id IS NOT NULL").withColumn("tree_id", F.struct("tree_id"))
        .groupBy("tree_id", "node_id").agg(F.min(F.struct("parent_id", "role", "text", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))).alias("m"))
        .select("tree_id", "node_id", "m.parent_id", "m.role", "m.text", "m.score"),
        "nodes",
    )
    ids = nodes.select("tree_id", F.col("node_id").alias("parent_id"))
    edges = nodes.select("tree_id", "node_id", "parent_id").join(ids, ["tree_id", "parent_id"], "left_semi")
    # up: the node 2**r steps up; state: steps to the root and score from here to it, once known
    jumps = [work.save(edges.select("tree_id", "node_id", F.col("parent_id").alias("up")), "jump0")]
    known = nodes.join(edges.select("tree_id", "node_id"), ["tree_id", "node_id"], "left_anti").select("tree_id", "node_id", F.lit(0).alias("depth"), F.col("score").alias("total"))
    part = nodes.select("tree_id", "node_id", "score").join(jumps[0], ["tree_id", "node_id"]).select(
        "tree_id", "node_id", "up", F.col("score").alias("part"), F.lit(1).alias("steps")
    )
    part, known = work.save(part, "part0"), work.save(known, "known0")
    at = 0
    while not part.isEmpty():
        at += 1
        ended = known.select("tree_id", F.col("node_id").alias("up"), "depth", "total")
        done = part.join(ended, ["tree_id", "up"]).select("tree_id", "node_id", (F.col("depth") + F.col("steps")).alias("depth"), (F.col("total") + F.col("part")).alias("total"))
        further = part.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("part").alias("part2"), F.col("steps").alias("steps2"))
        onward = part.join(further, ["tree_id", "up"]).select(
            "tree_id", "node_id", F.col("up2").alias("up"), (F.col("part") + F.col("part2")).alias("part"), (F.col("steps") + F.col("steps2")).alias("steps")
        )
        new = work.save(done, f"done{at}")
        if new.isEmpty():
            break  # what is left hangs on a cycle
        known = known.unionByName(new)
        part = work.save(onward, f"part{at}")
        jumps.append(part.select("tree_id", "node_id", "up"))
    known = work.save(known, "known")

    inner = edges.select("tree_id", F.col("parent_id").alias("node_id")).distinct()
    leaves = known.join(inner, ["tree_id", "node_id"], "left_anti")
    order = Window.partitionBy("tree_id").orderBy(F.col("total").desc(), "node_id")
    ranked = leaves.withColumn("branch_rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("branch_rank") <= most)
    path = work.save(ranked.select("tree_id", F.col("node_id").alias("leaf_id"), "branch_rank", F.col("total").alias("branch_score"), "depth", "node_id"), "path")
    # nodes 2**r steps further up join those found so far
    for r, jump in enumerate(jumps):
        more = path.join(jump, ["tree_id", "node_id"]).select("tree_id", "leaf_id", "branch_rank", "branch_score", (F.col("depth") - 2**r).alias("depth"), F.col("up").alias("node_id"))
        path = work.save(path.unionByName(more), f"path{r}")
    whole = path.join(nodes.select("tree_id", "node_id", "role", "text"), ["tree_id", "node_id"])
    return whole.withColumn("tree_id", F.col("tree_id.tree_id"))


def format_branches(path: DataFrame, trained=TRAINED) -> DataFrame:
    """One row per branch: formatted, and mask, the stretches (start, length in characters) of its loss mask."""
    role, text = escaped_role(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turn = F.struct(
        "depth", F.concat(head, text, F.lit(END + "\n")).alias("all"), F.length(head).alias("head"), F.length(text).alias("body"),
        F.coalesce(F.col("role").isin(*trained), F.lit(False)).alias("trained"),
    )
    turns = F.sort_array(F.collect_list(turn))
    grouped = path.groupBy("tree_id", "leaf_id", "branch_rank", "branch_score").agg(turns.alias("_turns"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate(
        "_turns", zero,
        lambda a, t: F.struct(
            (a["at"] + F.length(t["all"])).alias("at"),
            F.when(t["trained"], F.concat(a["spans"], F.array(F.struct((a["at"] + t["head"]).alias("start"), t["body"].alias("length"))))).otherwise(a["spans"]).alias("spans"),
        ),
    )
    return grouped.withColumn("mask", walked["spans"]).withColumn("formatted", F.array_join(F.transform("_turns", lambda t: t["all"]), "")).drop("_turns")


def read_back(formatted: DataFrame) -> DataFrame:
    """tree_id and digests of what the formatted conversation and its mask say."""

    def rows(batches):
        for batch in batches:
            out = {c: [] for c in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist()):
                turns = parse(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(text[m["start"] : m["start"] + m["length"]]) for m in mask)
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest())
                out["loss_chars"].append(len(loss))
                out["loss_sha256"].append(hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest())
                out["formatted_chars"].append(len(text))
            yield pa.RecordBatch.from_pydict({"tree_id": batch.column("tree_id")} | {c: pa.array(v, pa.string() if c.endswith("256") else pa.int64()) for c, v in out.items()})

    return formatted.select("tree_id", "formatted", "mask").mapInArrow(
        rows, "tree_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def threads(conversations: DataFrame, work: Work) -> DataFrame:
    """Conversations in turn order as reply trees of one branch each."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = conversations.withColumn("node_id", F.row_number().over(order).cast("bigint"))
    return numbered.select(
        F.col("conv_id").cast("bigint").alias("tree_id"), "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        "role", "text", F.lit(0.0).alias("score"),
    )
