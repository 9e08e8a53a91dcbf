"""Mixing sources to target weights, with DataFrame functions only.

Each source's words, in document order, are cut into blocks of fixed length. A source gets
as many slots as its target asks for: whole passes over its blocks, then blocks in
pseudorandom order until the target is met to the word. All slots are dealt to output
shards without replacement by one keyed permutation, so a shard's source counts are a
multinomial draw whose sums over all shards are exact. A slot's rank becomes a block
number by its source's own permutation, and blocks are joined by that number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.ordering import running_totals
from ebbflow.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 16
CHUNK = 65_536


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    most_repeats: int = 3
    block_words: int = 256
    slots_per_shard: int = 1_024
    seed: int = 7


def permuted(x: Column, n: Column, key: Column, backwards: bool = False) -> Column:
    """A keyed permutation of 0..n-1 (swap-or-not rounds), or its inverse."""
    rounds = range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS)

    def turn(v: Column, k: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, k), n) - v, n)
        swap = F.xxhash64(key, k, F.greatest(v, other)).bitwiseAND(F.lit(1).cast("bigint")) == 1
        return F.when(swap, other).otherwise(v)

    return F.aggregate(F.array(*[F.lit(k) for k in rounds]), x, turn)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size): narrow rows, written once. Null text has size 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
    )
    return stored(rows, "sizes")


def targets(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: rank (code point order, null last), source_size, weight, target.

    Shares go by weight; where they pass the repeat limit the source stops there and the
    rest is shared again. In order of limit over weight the stopped sources come first, so
    running sums over the sources give the final level at once.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name).cast("bigint") - 1)
    cycle = F.array(*[F.lit(float(w)) for w in mix.weights])
    limit = F.col("source_size") * float(mix.most_repeats)
    shared = ranked.withColumn(
        "weight", F.get(cycle, (F.col("rank") % len(mix.weights)).cast("int"))
    ).withColumn("_limit", limit)
    order = Window.orderBy(F.col("_limit") / F.col("weight"), "rank")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))) / F.sum(
        "weight"
    ).over(later)
    leveled = shared.withColumn("_level", level)
    stops = leveled.withColumn(
        "_stops",
        F.min((F.col("_limit") / F.col("weight") <= F.col("_level")).cast("int")).over(
            order.rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    # past the first source that goes on, levels only fall
    final = F.max(F.when(F.col("_stops") == 0, F.col("_level"))).over(everything)
    target = F.when(F.col("_stops") == 1, F.col("_limit")).otherwise(F.col("weight") * final)
    return stops.select("source", "rank", "source_size", "weight", target.alias("target"))


def slots(goals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per slot of the mix: rank, block, pass_no, take, shard, place.

    `take` is how many words of the block are taken: all of them, save in a source's last
    slot. `goals` is a stored table of one row per source; rows are made in chunks that
    are dealt to all tasks, so a large source is spread like any other.
    """
    b = mix.block_words
    t, want = F.col("source_size"), F.round("target").cast("bigint")
    passes = F.floor(want / t).cast("bigint")
    n_blocks = F.ceil(t / b).cast("bigint")
    key = F.xxhash64(F.lit(mix.seed), F.col("rank"))
    plan = goals.filter("source_size > 0").select(
        "rank",
        n_blocks.alias("n_blocks"),
        passes.alias("passes"),
        (want - passes * t).alias("rest"),
        (t - (n_blocks - 1) * b).alias("last_words"),
        permuted(n_blocks - 1, n_blocks, key, backwards=True).alias("last_at"),
    )
    straight = F.ceil(F.col("rest") / b).cast("bigint")
    short = F.ceil((F.col("rest") + b - F.col("last_words")) / b).cast("bigint")
    extra = F.when(straight <= F.col("last_at"), straight).otherwise(short)
    plan = plan.withColumn("n_slots", F.col("passes") * F.col("n_blocks") + extra)
    earlier = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumns(
        {
            "base": F.coalesce(F.sum("n_slots").over(earlier), F.lit(0)),
            "all_slots": F.sum("n_slots").over(Window.partitionBy()),
        }
    ).filter("n_slots > 0")
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_slots") - 1) / CHUNK))).alias("chunk")
    chunks = plan.select("*", chunk).repartition("rank", "chunk")
    first = F.col("chunk") * CHUNK
    last = F.least(first + CHUNK, F.col("n_slots")) - 1
    rows = chunks.select("*", F.explode(F.sequence(first, last)).alias("r"))
    i = F.col("r") % F.col("n_blocks")
    rows = rows.withColumns({"i": i, "pass_no": F.floor(F.col("r") / F.col("n_blocks")).cast("bigint")})
    rows = rows.withColumn("block", permuted(F.col("i"), F.col("n_blocks"), key))
    held = F.when(F.col("block") == F.col("n_blocks") - 1, F.col("last_words")).otherwise(F.lit(b))
    before = F.col("i") * b - F.when(F.col("last_at") < F.col("i"), b - F.col("last_words")).otherwise(0)
    left = F.greatest(F.least(F.col("rest") - before, held), F.lit(0))
    drawn = permuted(F.col("base") + F.col("r"), F.col("all_slots"), F.lit(mix.seed))
    return rows.select(
        "rank",
        "block",
        "pass_no",
        F.when(F.col("pass_no") < F.col("passes"), held).otherwise(left).cast("bigint").alias("take"),
        F.floor(drawn / mix.slots_per_shard).cast("bigint").alias("shard"),
        (drawn % mix.slots_per_shard).alias("place"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """The rows of the corpus and the pieces the mix takes of them.

    Rows: doc_id, source, text_hash, size, rank, source_size, target, start (words of its
    source before it). Pieces, one for each slot and document it meets: shard, place,
    pass_no, rank, start, doc_id, text_hash, first_word, n_words (within the document; 0
    words never appear). Repeated rows are separate documents with the same pieces' shape.
    """
    rows = sized(docs)
    goals = stored(targets(rows, mix), "targets")
    same = rows["source"].eqNullSafe(goals["source"])
    named = rows.join(goals, same).select(
        rows["doc_id"], rows["source"], "text_hash", "size", "rank", "source_size", "target"
    )
    named = stored(named, "ranked")
    placed = running_totals(named, ["rank"], ["doc_id", "text_hash"], ["size"])
    placed = stored(placed.withColumnRenamed("size_before", "start"), "placed")
    b = mix.block_words
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / b), F.floor((end - 1) / b))
    parts = placed.filter("size > 0").select(
        "rank", "start", "doc_id", "text_hash", "size", F.explode(blocks).alias("block")
    )
    # slots grow with the corpus though they come from a row per source: never broadcast them
    met = parts.join(slots(goals, mix).hint("merge"), ["rank", "block"])
    low = F.greatest(F.col("block") * b, F.col("start"))
    high = F.least(F.col("block") * b + F.col("take"), end)
    pieces = met.filter(high > low).select(
        "shard",
        "place",
        "pass_no",
        "rank",
        "start",
        "doc_id",
        "text_hash",
        (low - F.col("start")).alias("first_word"),
        (high - low).alias("n_words"),
    )
    return placed, pieces


def taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (repeats counted)."""
    rows, pieces = mixed(docs, mix)
    used = pieces.groupBy("rank", "start").agg(F.sum("n_words").alias("taken"))
    # rows without words share their start with the next row, so they stay out of the join
    filled = rows.filter("size > 0").join(used, ["rank", "start"], "left")
    empty = rows.filter("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    return filled.unionByName(empty).select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: one row for each pass that takes words of a document.

    A document taken whole keeps its text; of a document taken in part the row holds the
    words taken, in order, joined by one space. All other columns stay. Rows of one
    doc_id, source and text are told apart by nothing, so they are kept once and used as
    often as all of them are.
    """
    _, pieces = mixed(docs, mix)
    ranges = F.array_sort(F.collect_list(F.struct("first_word", "n_words")))
    picked = pieces.groupBy("rank", "start", "doc_id", "text_hash", "pass_no").agg(
        ranges.alias("_ranges"), F.sum("n_words").alias("_words")
    )
    picked = picked.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_ranges", "_words"
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    once = docs.withColumns({"_id": F.col("doc_id").cast("bigint"), "_hash": F.xxhash64(text)})
    once = once.dropDuplicates(["_id", "_hash"])
    both = once.join(picked, once["_id"].eqNullSafe(picked["_id"]) & (once["_hash"] == picked["_hash"]))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(
        F.flatten(
            F.transform(
                "_ranges", lambda s: F.slice(words, (s["first_word"] + 1).cast("int"), s["n_words"].cast("int"))
            )
        ),
        " ",
    )
    whole = F.regexp_count("text", F.lit(WORD)) == F.col("_words")
    new_text = F.when(whole, F.col("text")).otherwise(cut)
    return both.select(
        *[new_text.alias("text") if c == "text" else once[c].alias(c) for c in docs.columns]
    )
