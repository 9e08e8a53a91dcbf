"""Merkle manifest of a dataset: a content-addressed DAG and proofs by descent.

Each row is a leaf. The leaves of a source are hashed in runs of `fan_out`, level by level,
to a subroot, and the subroots in the same way to the root. Every inner node is stored as a
record from its digest to its children's digests, in packs of a few levels under the digest
of the pack's top node. A proof is made by descent: a request for a leaf starts at the root,
the digits of its rank choose a child in each record, the children not chosen are collected,
and the path segment of each pack is reversed, as a proof runs from leaf to root. Requests
with a common prefix descend together, so the rows of a step are those of the level reached.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.positions import placed
from ebbflow.llm.store import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Shape:
    fan_out: int = 3
    pack_levels: int = 4

    @property
    def pack(self) -> int:
        """Nodes below the top of a full pack."""
        return self.fan_out**self.pack_levels


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, rank, n, doc_id, leaf, offered. packs: of the sources' trees and of the top tree, lowest first."""

    shape: Shape
    leaves: DataFrame
    sources: DataFrame  # tree, rank, subroot
    packs: list[DataFrame]
    top_packs: list[DataFrame]
    root: str | None  # none for an empty table


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- leaves -------------------------------------------------------------------------------------


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and itself; a null as a dash."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def without_line_ends(docs: DataFrame) -> Column:
    """The text as a careless copy would have it, for half of the documents, by crc32 of the doc_id."""
    half = F.pmod(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")), F.lit(2)) == 0
    return F.when(F.coalesce(half, F.lit(False)), F.translate("text", "\n", "")).otherwise(F.col("text"))


def leaves(docs: DataFrame, offered_text: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, offered): `offered` is the leaf to be verified if it is not the row's own.

    The tree of a source is '=' and its name, that of a null source is empty.
    """
    kinds = {"doc_id": "bigint", "n_chars": "bigint"}
    values = {c: F.col(c).cast(kinds.get(c, "string")) for c in FIELDS}
    leaf = leaf_digest(list(values.values()))
    offered = F.lit(None).cast("string")
    if offered_text is not None:
        offered = leaf_digest([*list(values.values())[:-1], offered_text])
        offered = F.when(~offered_text.eqNullSafe(values["text"]), offered)
    tree = F.coalesce(F.concat(F.lit("="), values["source"]), F.lit(""))
    return docs.select(tree.alias("tree"), values["doc_id"].alias("doc_id"), leaf.alias("leaf"), offered.alias("offered"))


# --- building -----------------------------------------------------------------------------------

RECORDS_KIND = "array<struct<digest:string,children:array<string>>>"
_RECORDS = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))


def packed(nodes: list[str], n: int, shape: Shape) -> tuple[str, int, list[dict], int]:
    """Top digest, levels and records of a pack over `nodes`; and of how many nodes its level is one.

    `n` is the number of nodes of the tree's level: a tree ends where one remains.
    """
    records, depth = [], 0
    while n > 1 and depth < shape.pack_levels:
        above = []
        for i in range(0, len(nodes), shape.fan_out):
            children = nodes[i : i + shape.fan_out]
            above.append(digest(children))
            records.append({"digest": above[-1], "children": children})
        nodes, n, depth = above, -(-n // shape.fan_out), depth + 1
    return nodes[0], depth, records, n


def _mapped(df: DataFrame, row: Callable[[dict], Iterator[dict]], kinds: str, types: pa.Schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(row(batch.slice(i, 1).to_pylist()[0]))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, types)

    return df.mapInArrow(run, kinds)


def packs_of(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """Tables (tree, rank, digest, depth, records, n), one for each step; `nodes` is (tree, rank, digest, n).

    A step takes up to `pack` nodes to one. A tree with n = 1 in a step is finished there.
    """
    found: list[DataFrame] = []
    types = pa.schema(
        [("tree", pa.string()), ("rank", pa.int64()), ("digest", pa.string()), ("depth", pa.int32()), ("records", _RECORDS), ("n", pa.int64())]
    )

    def row(group: dict) -> Iterator[dict]:
        top, depth, records, n = packed([x["digest"] for x in group["nodes"]], group["n"], shape)
        yield {"tree": group["tree"], "rank": group["block"], "digest": top, "depth": depth, "records": records, "n": n}

    kinds = f"tree string, rank bigint, digest string, depth int, records {RECORDS_KIND}, n bigint"
    while True:
        block = F.floor(F.col("rank") / shape.pack).cast("bigint")
        groups = nodes.groupBy("tree", block.alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes"), F.max("n").alias("n")
        )
        found.append(stored(_mapped(groups, row, kinds, types), f"packs-{len(found)}"))
        nodes = found[-1].select("tree", "rank", "digest", "n").filter("n > 1")
        if nodes.isEmpty():
            return found


def build(entries: DataFrame, shape: Shape = Shape()) -> Manifest:
    """The manifest of `leaves`: everything written, the root alone brought to the driver."""
    entries = stored(entries.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("_row")]
    ranked = stored(placed(entries, "tree", order, "ordered-leaves").drop("_row"), "manifest-leaves")
    packs = packs_of(ranked.select("tree", "rank", F.col("leaf").alias("digest"), "n"), shape)
    subroots = packs[0].filter("n = 1").select("tree", "digest")
    for p in packs[1:]:
        subroots = subroots.unionByName(p.filter("n = 1").select("tree", "digest"))
    one_tree = subroots.select(F.lit("").alias("top"), "tree", F.col("digest").alias("subroot"))
    sources = stored(placed(one_tree, "top", [F.col("tree")], "ordered-sources"), "manifest-sources")
    top = packs_of(sources.select(F.col("top").alias("tree"), "rank", F.col("subroot").alias("digest"), "n"), shape)
    last = top[-1].first()
    return Manifest(shape, ranked, sources.select("tree", "rank", "subroot"), packs, top, last and last["digest"])


# --- proofs -------------------------------------------------------------------------------------


def descended(records: dict[str, list[str]], top: str, place: int, depth: int, fan_out: int) -> tuple[str, list[dict]]:
    """The node at a place below `top`, and what stood beside the path, from it upwards."""
    node, segment = top, []
    for level in range(depth - 1, -1, -1):
        children = records[node]
        chosen = place // fan_out**level % fan_out
        segment.append({"before": "".join(children[:chosen]), "after": "".join(children[chosen + 1 :])})
        node = children[chosen]
    segment.reverse()
    return node, segment


def folded(leaf: str, proof: Sequence[dict]) -> str:
    """The root that a leaf and what stands beside its path lead to."""
    for level in proof:
        leaf = digest((level["before"], leaf, level["after"]))
    return leaf


_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
PATH_KIND = "array<struct<before:string,after:string>>"


def _descend(frontier: DataFrame, requests: DataFrame, packs: list[DataFrame], shape: Shape, last: Callable) -> DataFrame:
    """Follow `requests` (tree, rank, request) from `frontier` (tree, rank 0, digest, carried, path) through the packs.

    `last` makes the rows of a request that has arrived. A step joins the frontier with its
    packs by digest and with the ranks wanted below it, at most a pack's; what several
    requests share goes once.
    """
    names = ["tree", "rank", "digest", "carried", "path"]
    types = pa.schema([("tree", pa.string()), ("rank", pa.int64()), ("digest", pa.string()), ("carried", pa.string()), ("path", _PATH)])

    def step(arrive: Callable | None) -> Callable[[dict], Iterator[dict]]:
        def row(x: dict) -> Iterator[dict]:
            records = {r["digest"]: r["children"] for r in x["records"]}
            for wanted in x["wanted"]:
                place = wanted["rank"] % shape.pack
                node, segment = descended(records, x["digest"], place, x["depth"], shape.fan_out)
                path = segment + x["path"]
                if arrive is None:
                    yield {"tree": x["tree"], "rank": wanted["rank"], "digest": node, "carried": x["carried"], "path": path}
                else:
                    yield arrive(x["carried"], node, path, wanted["request"])

        return row

    for t in range(len(packs) - 1, -1, -1):
        at = lambda level: F.floor(F.col("rank") / shape.pack**level).cast("bigint")
        if t:
            here = requests.select("tree", at(t).alias("rank"), at(t + 1).alias("block")).distinct()
            entry = F.struct("rank")
        else:
            here = requests.withColumn("block", at(1))
            entry = F.struct("rank", "request")
        wanted = here.groupBy("tree", F.col("block").alias("rank")).agg(F.collect_list(entry).alias("wanted"))
        records = packs[t].filter("depth > 0").select("digest", "depth", "records").dropDuplicates(["digest"])
        below = frontier.join(records, "digest", "left").join(wanted, ["tree", "rank"])
        below = below.withColumns({"depth": F.coalesce("depth", F.lit(0)), "records": F.coalesce("records", F.array().cast(RECORDS_KIND))})
        if t == 0:
            kinds, schema, arrive = last
            return _mapped(below, step(arrive), kinds, schema)
        kinds = f"tree string, rank bigint, digest string, carried string, path {PATH_KIND}"
        frontier = stored(_mapped(below, step(None), kinds, types).select(*names), f"frontier-{t}")
    raise AssertionError("there is one step at least")


def proofs(manifest: Manifest, requested: DataFrame | None = None) -> DataFrame:
    """doc_id, source_tree, rank, leaf, subroot, root, proof, folded_root: one row per leaf.

    `requested` (tree, rank) names some leaves; all are requested without it. `proof` has
    what stands before and after the path in each level, from leaf to root. `folded_root`
    follows from the offered leaf, or the leaf itself where none is offered, and the proof.
    """
    root, shape = manifest.root or "", manifest.shape
    rows = manifest.leaves
    if requested is not None:
        rows = rows.join(requested.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
    no_path = F.array().cast(PATH_KIND)
    # the top tree: every source is a leaf of it
    kinds = f"tree string, digest string, path {PATH_KIND}"
    schema = pa.schema([("tree", pa.string()), ("digest", pa.string()), ("path", _PATH)])
    arrived = lambda carried, node, path, request: {"tree": request["tree"], "digest": node, "path": path}
    one = manifest.sources.sparkSession.createDataFrame([("", 0, root, "")], "tree string, rank bigint, digest string, carried string")
    start = one.withColumn("path", no_path)
    named = manifest.sources.join(rows.select("tree").distinct(), "tree", "left_semi")
    wanted = named.select(F.lit("").alias("tree"), "rank", F.struct("tree").alias("request"))
    tops = stored(_descend(start, wanted, manifest.top_packs, shape, (kinds, schema, arrived)), "subroot-paths")
    return _leaf_proofs(manifest, rows, tops, root)


def _leaf_proofs(manifest: Manifest, rows: DataFrame, tops: DataFrame, root: str) -> DataFrame:
    kinds = f"doc_id bigint, source_tree string, rank bigint, leaf string, subroot string, root string, proof {PATH_KIND}, folded_root string"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("source_tree", pa.string()), ("rank", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root")], ("proof", _PATH), ("folded_root", pa.string())]
    )

    def arrived(subroot: str, node: str, path: list[dict], request: dict) -> dict:
        offered = request["offered"] or node
        return {
            "doc_id": request["doc_id"],
            "source_tree": request["tree"],
            "rank": request["rank"],
            "leaf": node,
            "subroot": subroot,
            "root": root,
            "proof": path,
            "folded_root": folded(offered, path),
        }

    requests = rows.select("tree", "rank", F.struct("tree", "rank", "doc_id", "offered").alias("request"))
    # a shorter tree's top has been reached already: its packs above hold it with no levels
    frontier = tops.select(
        "tree", F.lit(0).cast("bigint").alias("rank"), "digest", F.col("digest").alias("carried"), "path"
    )
    return _descend(frontier, requests, manifest.packs, manifest.shape, (kinds, schema, arrived))


def verified(docs: DataFrame, offered_text: Column | None = None, shape: Shape = Shape()) -> DataFrame:
    """`proofs` of all rows of `docs`, with `verified`: whether the offered row leads to the root.

    Null values in any column are leaves like others; a null source is a source of its own,
    before all others. Repeated rows are leaves of their own with equal digests. Only the
    five columns of a document are read. An empty table has no root and gives no row.
    """
    manifest = build(leaves(docs, offered_text), shape)
    return proofs(manifest).withColumn("verified", F.col("folded_root") == F.col("root"))


def summary(found: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of `verified`."""
    beside = F.transform("proof", lambda level: F.concat(level["before"], level["after"]))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(beside, ""), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def manifest_sql() -> str:
    """The rows of `summary` with `without_line_ends`, by DuckDB over the table documents."""

    def leaf(text: str) -> str:
        values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def levels(name: str, start: str) -> str:
        return f"""{name} AS (
    SELECT tree, 0 AS lvl, pos, h, n FROM {start}
    UNION ALL
    SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
    FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
)"""

    crc = """xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295))"""
    return f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS h,
        CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS offered
    FROM documents
), r AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, id) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n
    FROM d
), {levels("lv", "r")}, s AS (
    SELECT tree AS source_tree, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n
    FROM lv WHERE n = 1
), {levels("tv", "s")}, node AS (
    SELECT 0 AS part, tree, lvl, pos, h FROM lv WHERE n > 1
    UNION ALL SELECT 1, tree, lvl, pos, h FROM tv WHERE n > 1
), run AS (
    SELECT part, tree, lvl, pos // 3 AS above, list(h ORDER BY pos) AS hs FROM node GROUP BY ALL
), beside AS (
    SELECT part, node.tree, node.lvl, pos, array_to_string(hs[1:pos % 3], '') AS pre, array_to_string(hs[pos % 3 + 2:], '') AS post
    FROM node JOIN run USING (part, tree, lvl) WHERE above = pos // 3
), step AS (
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY part, lvl) - 1 AS k, pre, post FROM (
        SELECT id, part, lvl, pre, post FROM r JOIN beside b ON part = 0 AND b.tree = r.tree AND b.pos = r.pos // (3 ** lvl)::BIGINT
        UNION ALL
        SELECT id, part, lvl, pre, post FROM r JOIN s ON s.source_tree = r.tree
        JOIN beside b ON part = 1 AND b.pos = s.pos // (3 ** lvl)::BIGINT)
), fold AS (
    SELECT id, 0 AS k, offered AS h FROM r
    UNION ALL
    SELECT id, k + 1, sha256(pre || h || post) FROM fold JOIN step USING (id, k)
), folded AS (
    SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id
), proof AS (
    SELECT id, sha256(string_agg(pre || post, '' ORDER BY k)) AS proof_sha256 FROM step GROUP BY id
)
SELECT doc_id, r.h AS leaf, s.h AS subroot, t.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
    folded_root, folded_root = t.h AS verified
FROM r JOIN s ON s.source_tree = r.tree JOIN tv t ON t.n = 1 JOIN folded USING (id) LEFT JOIN proof USING (id)"""
