"""Shards of near equal bytes that keep linked documents together.

Balanced label propagation: documents with equal texts are linked. The linked documents
of a group form nodes of bounded size; in each round a node asks for the shard where most
of its group's bytes lie, and a shard admits as many bytes as its quota leaves room for.
A group larger than a quota fills one shard after the other, node by node.
The plan is then laid out in one global order (shard, group) and cut into equal parts, so
sizes differ by a document at most and a cut parts few groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.ordering import running_totals
from ebbflow.llm.store import stored

BINS = 1_024  # requests for a shard are admitted in this many steps


@dataclass(frozen=True)
class Plan:
    shards: int = 8
    rounds: int = 6
    nodes_per_shard: int = 64  # a node holds at most about this part of a shard's quota
    slack: float = 1.25  # while labels move; the final cut evens sizes out


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, group, text_hash): narrow rows, written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "measured",
    )


def _node(group_bytes: Column, node_bytes: int) -> Column:
    """Which node of its group a document belongs to."""
    nodes = F.ceil(group_bytes / node_bytes).cast("bigint")
    return F.pmod(F.xxhash64(F.lit(1), F.col("doc_id")), nodes)


GROUP = ("text_hash", "text_crc32", "size")


def linked_nodes(rows: DataFrame, node_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Groups of two or more documents, and their nodes (written once)."""
    groups = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    groups = stored(groups.filter("n > 1").withColumn("group_bytes", F.col("n") * F.col("size")), "groups")
    nodes = (
        rows.join(groups, list(GROUP))
        .groupBy(*GROUP, _node(F.col("group_bytes"), node_bytes).alias("node"))
        .agg(F.sum("size").alias("bytes"))
    )
    return groups, nodes


def _goal(turn: int, loads: dict[int, int], quota: float, plan: Plan) -> Column:
    """The shard that the nodes of a group ask for: the one with most of its bytes.

    Nodes of a large group that lie in no shard it holds ask for the next shard with room,
    one beside those it holds if there is one, as the final cut runs over neighbours.
    """
    # equal shares are told apart by a hash of the round, so no shard is asked by all
    tie = lambda s: F.xxhash64(F.lit(200 + turn), *GROUP, s)
    share = lambda s: F.coalesce(F.col("near")[s], F.lit(0).cast("bigint"))
    most = F.array_max(F.transform(F.map_keys("near"), lambda s: F.struct(share(s), tie(s), s.alias("shard"))))["shard"]
    free = [s for s in range(plan.shards) if loads.get(s, 0) + quota / plan.nodes_per_shard <= quota]
    shards = F.filter(F.array(*[F.lit(s) for s in free]).cast("array<int>"), lambda s: ~F.array_contains("held", s))
    beside = lambda s: F.exists("held", lambda h: F.abs(h - s) == 1)
    following = F.array_max(F.transform(shards, lambda s: F.struct(beside(s), share(s), tie(s), s.alias("shard"))))["shard"]
    return F.when(F.col("large"), following).otherwise(most)


def _admitted(load: Column, quota: float, plan: Plan) -> Column:
    """The requests for a shard that fit beside its load, in order; a refused one takes no room."""

    def turn(state: Column, r: Column) -> Column:
        used = state["used"] + r["b"]
        fits = used <= F.when(r["large"], quota).otherwise(quota * plan.slack)
        return F.struct(
            F.when(fits, used).otherwise(state["used"]).alias("used"),
            F.when(fits, F.concat(state["taken"], F.array(r))).otherwise(state["taken"]).alias("taken"),
        )

    none = F.filter("requests", lambda r: F.lit(False))
    start = F.struct(load.cast("bigint").alias("used"), none.alias("taken"))
    return F.aggregate("requests", start, turn, lambda state: state["taken"])


def propagated(nodes: DataFrame, quota: float, plan: Plan) -> DataFrame:
    """Nodes with the shard they end in. Each round is written, which cuts its lineage."""
    start = F.pmod(F.xxhash64(F.lit(2), *GROUP, "node"), F.lit(plan.shards)).cast("int")
    state = stored(nodes.withColumn("shard", start), "labels")
    for turn in range(plan.rounds):
        loads = {r["shard"]: r["b"] for r in state.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
        near = state.groupBy(*GROUP, "shard").agg(F.sum("bytes").alias("b"))
        # a row for each group, with an entry for each shard at most
        groups = near.groupBy(*GROUP).agg(
            F.map_from_entries(F.collect_list(F.struct("shard", "b"))).alias("near"), F.sum("b").alias("group_bytes")
        )
        large = F.col("group_bytes") > quota
        held = F.filter(F.map_keys("near"), lambda s: large & (F.col("near")[s] >= quota / 2))
        goal = _goal(turn, loads, quota, plan)
        best = groups.withColumns({"large": large, "held": held}).withColumn("goal", goal)
        asked = state.join(best.select(*GROUP, "large", "held", "goal"), list(GROUP))
        goes = (F.col("goal") != F.col("shard")) & ~F.array_contains("held", F.col("shard"))
        asked = asked.withColumn("goal", F.when(F.coalesce(goes, F.lit(False)), F.col("goal")).otherwise(F.col("shard")))
        # a group that fits moves as a whole
        whole, node = (F.xxhash64(F.lit(100 + turn), *GROUP, *more) for more in ((), ("node",)))
        draw = F.pmod(F.when(F.col("large"), node).otherwise(whole), F.lit(BINS)).cast("int")
        asked = asked.withColumn("bin", draw)
        per_bin = asked.filter("goal <> shard").groupBy("goal", "large", "bin").agg(F.sum("bytes").alias("b"))
        # what asks to leave a shard makes room there
        staying = F.sum(F.when(F.col("goal") == F.col("shard"), F.col("bytes")).otherwise(0))
        stay = asked.groupBy("shard").agg(staying.alias("load")).withColumnRenamed("shard", "goal")
        # at most 2 x shards x BINS rows
        requests = per_bin.groupBy("goal").agg(F.array_sort(F.collect_list(F.struct("bin", "large", "b"))).alias("requests"))
        room = requests.join(stay, "goal", "left")
        taken = room.select("goal", F.explode(_admitted(F.coalesce("load", F.lit(0)), quota, plan)).alias("r"))
        admitted = taken.select("goal", F.col("r.large").alias("large"), F.col("r.bin").alias("bin"), F.lit(True).alias("admitted"))
        moved = asked.join(F.broadcast(admitted), ["goal", "large", "bin"], "left")
        state = stored(
            moved.select(
                *GROUP, "node", "bytes", F.when(F.col("admitted"), F.col("goal")).otherwise(F.col("shard")).alias("shard")
            ),
            "labels",
        )
    return state


def sharded(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, one row per input row.

    Null text counts as empty. Slots follow doc_id (null first) within a shard. An empty
    table gives no row.
    """
    rows = measured(docs)
    total = rows.agg(F.sum("size")).first()[0] or 0
    quota = total / plan.shards
    node_bytes = max(1, int(quota / plan.nodes_per_shard))
    groups, nodes = linked_nodes(rows, node_bytes)
    labels = propagated(nodes, quota, plan)
    loads = {r["shard"]: r["b"] for r in labels.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    room = [max(0.0, quota - loads.get(s, 0)) for s in range(plan.shards)]
    whole = sum(room) or 1.0
    ends, reached = [], 0.0
    for r in room:
        reached += r / whole
        ends.append(reached)
    # documents without a link go where room is left, by a hash of their id
    u = F.pmod(F.xxhash64(F.lit(3), "doc_id", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    free = F.size(F.filter(F.array(*[F.lit(e) for e in ends[:-1]]), lambda e: e <= u))
    known = rows.join(groups.select(*GROUP, "group_bytes"), list(GROUP), "left").withColumn(
        "node", F.coalesce(_node(F.col("group_bytes"), node_bytes), F.lit(-1))
    )
    planned = known.join(labels.select(*GROUP, "node", F.col("shard").alias("label")), [*GROUP, "node"], "left")
    spread = F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1 << 16))
    # within a shard the groups come first, then the other documents by falling size, so that
    # small ones lie where the parts are cut
    small_last = F.lit((1 << 40) - 1) - F.least("size", F.lit((1 << 39) - 1))
    inside = F.when(F.col("label").isNull(), small_last).otherwise(
        F.pmod(F.col("text_hash"), F.lit(1 << 39))
    )
    place = F.coalesce("label", free).cast("bigint") * (1 << 56) + inside * (1 << 16) + spread
    laid = stored(
        planned.select("doc_id", "size", "text_crc32", "text_hash", place.alias("place")), "laid-out"
    )
    cut = running_totals(laid, [], ["place", "doc_id", "text_hash"], ["size"])
    middle = F.col("size_before") * 2 + F.col("size")
    shard = F.least(F.floor(middle * plan.shards / F.lit(2 * max(total, 1))), F.lit(plan.shards - 1))
    dealt = stored(
        cut.select(
            "doc_id", "size", "text_crc32", "text_hash", shard.cast("int").alias("shard"), F.lit(1).cast("bigint").alias("one")
        ),
        "dealt",
    )
    numbered = running_totals(dealt, ["shard"], ["doc_id", "text_hash"], ["one"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("one_before").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
