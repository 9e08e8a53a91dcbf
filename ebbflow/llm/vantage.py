"""Near-duplicate texts by SimHash and vantage-point trees.

Fingerprints of 64 bits are linked when few bits differ. The bits are cut into parts; two
fingerprints that differ in at most `most_bits` bits differ in at most
floor(most_bits / parts) bits of one part. Each part has a vantage-point tree: a node
parts the fingerprints by their Hamming distance, in these bits, to a vantage point, and a
ball around a fingerprint need only follow a side that the triangle inequality leaves open.
The leaves are shards. A fingerprint lives in one and visits the later shards that its ball
overlaps, so each pair meets in a shard. There the tree is carried on in memory, and all
pairs are settled by all their bits.

Equal fingerprints are one fingerprint from the start. A shard returns a star for each
component it finds, never its pairs, so the rows grow with the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.components import components
from ebbflow.llm.store import stored

SEED = 42
LEAF = 192  # fingerprints of a shard compared directly
CHUNK = 16_384  # visitors compared with them at once
COUNTED = 65_536  # hashes whose bits are counted at once
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 4
    most_bits: int = 4  # differing bits of a link
    parts: int = 3
    shard_rows: int = 16_384  # fingerprints that live in a shard, about
    most_shards: int = 16_384  # of a part; beyond it shards grow, their trees deepen
    sample_per_shard: int = 16  # fingerprints that the trees' upper levels are fitted on

    @property
    def radius(self) -> int:
        return self.most_bits // self.parts

    @property
    def masks(self) -> tuple[np.uint64, ...]:
        edges = [64 * i // self.parts for i in range(self.parts + 1)]
        return tuple(np.uint64((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:]))


# --- fingerprints -----------------------------------------------------------------------------


def simhash(text: bytes | None, shingle_words: int = 4) -> int:
    """The fingerprint of a text in UTF-8: a bit is set if over half of the shingles' hashes have it."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    k = min(n, shingle_words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: n - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    hashed, set_bits, m = xxhash.xxh64_intdigest, np.zeros(64, np.int64), n - k + 1
    for at in range(0, m, COUNTED):
        h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[at : at + COUNTED], ends[at : at + COUNTED])], "<u8")
        for k, byte in enumerate(h.view(np.uint8).reshape(-1, 8).T):
            set_bits[8 * k : 8 * k + 8] += np.bincount(byte, minlength=256) @ BITS
    return int(np.packbits(2 * set_bits > m, bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, fp): one row per input row, fp the 64 bits as a bigint; reads whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((simhash(t.as_py(), settings.shingle_words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, fp bigint")


# --- trees ------------------------------------------------------------------------------------


def _distance(values: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((values ^ vantage) & mask).astype(np.int16)


def _cut(values: np.ndarray, mask: np.uint64, radius: int, least: float) -> tuple[np.uint64, int] | None:
    """A vantage point and a distance that part the values, with few of them near the cut.

    None if every trial leaves one side with less than `least` of them.
    """
    best, n = None, len(values)
    m = np.arange(64)
    for v in values[np.linspace(0, n - 1, 4).astype(np.int64)]:
        inside = np.cumsum(np.bincount(_distance(values, v, mask), minlength=65))
        smaller = np.minimum(inside, n - inside)[:64]
        # what a ball around a value inside reaches outside, and the other way round
        near = inside[np.minimum(m + radius, 64)] - np.where(m >= radius, inside[m - radius], 0)
        score = np.where(smaller >= max(1, least * n), near / np.maximum(smaller, 1), np.inf)
        at = int(np.argmin(score))
        if score[at] < np.inf and (best is None or score[at] < best[0]):
            best = (score[at], v, at)
    return None if best is None else (best[1], best[2])


@dataclass(frozen=True)
class Tree:
    """Nodes as (vantage point, distance, inside, outside); a side below 0 is shard -1 - side."""

    mask: np.uint64
    radius: int
    nodes: list[tuple[np.uint64, int, int, int]]

    def routed(self, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, the values that live there, those that visit) for each shard with any."""
        if not len(values):
            return
        todo = [(0 if self.nodes else -1, values, values[:0])]
        while todo:
            at, living, visiting = todo.pop()
            if not len(living) and not len(visiting):
                continue
            if at < 0:
                yield -1 - at, living, visiting
                continue
            vantage, m, inside, outside = self.nodes[at]
            d = _distance(living, vantage, self.mask)
            v = _distance(visiting, vantage, self.mask)
            todo.append((inside, living[d <= m], visiting[v - self.radius <= m]))
            # shards outside come later: what lives inside visits them, not the other way round
            crossing = living[(d <= m) & (d + self.radius > m)]
            todo.append((outside, living[d > m], np.concatenate((visiting[v + self.radius > m], crossing))))


def planted(sample: np.ndarray, mask: np.uint64, radius: int, shards: int) -> Tree:
    """The upper levels of a part's tree, from a sample; about as many leaves as `shards`."""
    nodes: list[list] = []
    least = max(2, len(sample) // max(1, shards))

    def grow(values: np.ndarray, parent: list | None, side: int) -> None:
        cut = _cut(values, mask, radius, 0.25) if len(values) > least and shards > 1 else None
        if cut is None:
            if parent is not None:
                parent[side] = -1 - next(number)
            return
        node = [*cut, 0, 0]
        if parent is not None:
            parent[side] = len(nodes)
        nodes.append(node)
        d = _distance(values, cut[0], mask)
        grow(values[d <= cut[1]], node, 2)
        grow(values[d > cut[1]], node, 3)

    number = iter(range(len(sample) + 1))
    grow(sample, None, 0)
    return Tree(mask, radius, [tuple(n) for n in nodes])


# --- one shard ----------------------------------------------------------------------------------

FULL = np.uint64((1 << 64) - 1)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, least value of its component) of all values that have a link and aren't the least."""
    values, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        # the roots of both ends are hung below the lower one
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            deeper = new[new]
            if np.array_equal(deeper, new):
                break
            new = deeper
        if np.array_equal(new, root):
            break
        root = new
    hung = root != np.arange(len(values))
    return values[hung], values[root[hung]]


def _spread(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of values that no distance parts: each is reached once and then compared no more."""
    left, a, b = values, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        root = queue[0]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= most
            if near.any():
                queue.extend(left[near])
                a.append(left[near])
                b.append(np.full(int(near.sum()), root))
                left = left[~near]
    none = values[:0]
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def shard_links(living: np.ndarray, visiting: np.ndarray, mask: np.uint64, radius: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect just what links of `most` bits connect among living and visiting values.

    Pairs of two visitors, and pairs over `radius` in the part, may be missing: they meet
    in another shard or another part's tree.
    """
    a, b = [], []
    todo = [(living, visiting)]
    while todo:
        living, visiting = todo.pop()
        if not len(living) or len(living) + len(visiting) < 2:
            continue
        if len(living) <= LEAF:
            both = np.concatenate((living, visiting))
            for at in range(0, len(both), CHUNK):
                near = np.bitwise_count(living[:, None] ^ both[None, at : at + CHUNK]) <= most
                x, y = np.nonzero(near)
                x, y = living[x], both[at + y]
                differ = x != y
                if differ.any():
                    s, t = stars(x[differ], y[differ])
                    a.append(s)
                    b.append(t)
            continue
        # both bounds hold for the pairs sought; the part's is the sharper one
        for bits, r in ((mask, radius), (FULL, most)):
            cut = _cut(living[:: max(1, len(living) // 4096)], bits, r, 0.1)
            if cut is not None:
                break
        else:
            s, t = _spread(np.concatenate((living, visiting)), most)
            a.append(s)
            b.append(t)
            continue
        d, v = _distance(living, cut[0], bits), _distance(visiting, cut[0], bits)
        todo.append((living[d <= cut[1]], visiting[v - r <= cut[1]]))
        crossing = living[(d <= cut[1]) & (d + r > cut[1])]
        todo.append((living[d > cut[1]], np.concatenate((visiting[v + r > cut[1]], crossing))))
    if not a:
        none = living[:0]
        return none, none
    return stars(np.concatenate(a), np.concatenate(b))


# --- all shards ---------------------------------------------------------------------------------


def trees(fingerprints: DataFrame, settings: Settings = Settings()) -> list[Tree]:
    """A tree for each part, fitted on a bounded sample of the distinct fingerprints.

    The sample decides how even the shards are and nothing else: every fingerprint is
    routed, every pair found.
    """
    n = fingerprints.count()
    shards = max(1, min(settings.most_shards, n // settings.shard_rows + 1))
    drawn = fingerprints.select("fp").orderBy(F.xxhash64(F.lit(7), "fp"), "fp").limit(settings.sample_per_shard * shards)
    sample = np.array([r["fp"] for r in drawn.collect()], np.int64).view(np.uint64)
    return [planted(sample, m, settings.radius, shards) for m in settings.masks]


def links(fingerprints: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, b): links that connect what all links connect; `fingerprints` are distinct and stored."""
    forest = trees(fingerprints, settings)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part, tree in enumerate(forest):
                for shard, living, visiting in tree.routed(values):
                    both = np.concatenate((living, visiting)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(both), part, np.int32)),
                            pa.array(np.full(len(both), shard, np.int32)),
                            pa.array(both),
                            pa.array(np.arange(len(both)) < len(living)),
                        ],
                        names=["part", "shard", "fp", "lives"],
                    )

    def settle(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        values = group.column("fp").to_numpy().view(np.uint64)
        lives = group.column("lives").to_numpy()
        order = np.argsort(values)  # the same whatever order the rows came in
        values, lives = values[order], lives[order]
        a, b = shard_links(values[lives], values[~lives], settings.masks[part], settings.radius, settings.most_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = fingerprints.select("fp").mapInArrow(route, "part int, shard int, fp bigint, lives boolean")
    return routed.groupBy("part", "shard").applyInArrow(settle, "a bigint, b bigint")


def near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per input row.

    component_id is the smallest doc_id reachable by links, the row's own included; null
    doc_ids count only where a component has no other. Null and empty texts have the
    fingerprint zero. Repeated rows are one document with several rows. Other columns are
    not read. An empty table gives no row.
    """
    rows = stored(fingerprinted(docs, settings), "simhash")
    fps = stored(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")), "fingerprints")
    found = components(stored(links(fps, settings), "near-fingerprints"), "a", "b")
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted.withColumn("linked", F.col("root") != F.col("fp")), "rooted")
    # roots stand for themselves; only what hangs below one is summed over
    below = rooted.filter("linked").groupBy("root").agg(F.min("least").alias("below"))
    tops = rooted.filter("not linked").join(below, "root", "left")
    tops = tops.select("root", F.least("least", "below").alias("component_id"))
    known = stored(rooted.join(tops, "root").select("fp", "n", "component_id"), "fingerprint-components")
    # at most 1,000 fingerprints hold a thousandth of all rows; their rows need no shuffle
    total = rows.count()
    frequent = F.col("n") * 1_000 > total
    often = known.filter(frequent).select("fp", F.col("component_id").alias("of_often"), F.lit(True).alias("often"))
    marked = rows.join(F.broadcast(often), "fp", "left")
    out = lambda df, c: df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col(c).alias("component_id"))
    rest = marked.filter("often is null").join(known.filter(~frequent), "fp")
    return out(marked.filter("often"), "of_often").unionByName(out(rest, "component_id"))
