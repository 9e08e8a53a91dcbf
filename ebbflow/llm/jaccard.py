"""N-gram Jaccard join with several global token orders.

A document's tokens are the hashes of its distinct five-word shingles. Two sets whose
Jaccard similarity reaches the threshold share a token among the first n - ceil(t n) + 1
tokens of either set, whatever global order the tokens are put in. Candidates meet in their
prefixes under the first order, where frequent tokens come last, rarest first, and the rest
follow a hash. Before any set moves, the prefixes under two further hash orders are joined
to the candidates and must share enough tokens, too; then the outlines of the sets, a byte a
token, must leave room for a link. Texts are cut into tokens once to count them and once to
post them; those of candidates are read once more, and those of what is left after all
filters a last time, for the sets themselves.

Which tokens count as frequent has no influence on the result, for any set of them gives a
valid order; it keeps passages that many documents share out of the prefixes. Tokens are
counted over all documents, those with equal leading bits as one. The MOST_FREQUENT commonest at most are known to every
task; all others that still have many posts are compared as stars, like the known ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.components import components
from ebbflow.llm.store import stored

MOST_FREQUENT = 1 << 20  # tokens, eight bytes each
ORDERS = 3
ROWS_AT_ONCE = 256
TOKENS_AT_ONCE = 2_000_000
ROWS_PER_BUCKET = 1 << 14
LEAST_BUCKETS = 1 << 10
BITS_IN_BUCKET = 22
MOST_MARKS = 1 << 26  # bits of a bitmap of documents
MARKS_PER_ROW = 32
WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Likeness:
    """Sets are linked when 100 * |common| >= percent * |either|.

    Sets that post one token are compared pair by pair up to `pairs_up_to` of them. Neither
    this nor `frequent_from` has an influence on the result.
    """

    words: int = 5
    percent: int = 75
    frequent_from: int = 24
    pairs_up_to: int = 4


_SALTS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64
)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _SALTS[salt]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a batch, ordered by document, and each document's end.

    `words` are hashes of all words of the batch, `starts` where each document begins (one
    more at the end). A document with fewer words has its whole sequence as its one token.
    """
    counts = np.diff(starts)
    owner = np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        # a running product over the words, so that their order counts
        h = np.zeros(len(words), np.uint64)
        reach = np.minimum(counts, size)[owner]
        at = np.arange(len(words))
        last = starts[1:][owner] - 1
        for k in range(size):
            use = k < reach
            h = np.where(use, mixed(h, 1) + words[np.minimum(at + k, last)], h)
        h = mixed(h + reach.astype(np.uint64), 2)
    offset = at - starts[:-1][owner]
    full = offset <= np.maximum(counts[owner] - size, 0)
    h, owner = h[full], owner[full]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.cumsum(np.bincount(owner, minlength=len(counts)))


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def prefix(
    tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray, bits: int, percent: int, order: int = 0
) -> tuple[np.ndarray, int]:
    """The first tokens of a set under one global order, and how many of them are not frequent.

    They stand in that order, those that are not frequent first; `tokens` must be sorted, so
    ties go to the smaller token in every set. `frequent` are leading bits of tokens, sorted.
    """
    p = prefix_length(len(tokens), percent)
    key = mixed(tokens, order) >> np.uint64(1)
    if len(frequent):
        lead = tokens >> np.uint64(64 - bits)
        at = np.minimum(np.searchsorted(frequent, lead), len(frequent) - 1)
        known = frequent[at] == lead
        # tokens of one rank follow their hash
        key[known] = np.uint64(1 << 63) + (rank[at[known]] << np.uint64(42)) + (key[known] >> np.uint64(21))
    first = np.argsort(key, kind="stable")[:p]
    return tokens[first], int((key[first] < np.uint64(1 << 63)).sum())


def _word_hashes(docs: DataFrame) -> DataFrame:
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.transform(words, lambda w: F.xxhash64(w)).alias("w")
    )


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_ids, tokens, ends) of a few documents at a time."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        piece = batch.slice(at, ROWS_AT_ONCE)
        lists = piece.column(1)
        starts = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False)
        words = values[starts[0] : starts[-1]].astype(np.int64, copy=False).view(np.uint64)
        tokens, ends = shingles(words, starts - starts[0], size)
        yield piece.column(0), tokens, ends


def set_key(tokens: np.ndarray) -> int:
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def leading_bits(rows: int) -> int:
    """How many leading bits of a token are counted for a corpus of so many documents."""
    buckets = max(LEAST_BUCKETS, 1 << (rows // ROWS_PER_BUCKET).bit_length())
    return buckets.bit_length() - 1 + BITS_IN_BUCKET


def token_counts(docs: DataFrame, bits: int, like: Likeness = Likeness()) -> DataFrame:
    """(token, n): how many sets hold a token with these leading `bits`, if `frequent_from` or more.

    Tasks sort their tokens and send them as packed cells, one for each bucket (the bits but
    the last BITS_IN_BUCKET), as steps of two bytes, or of four where they are wide; equal
    sets of a task count once. Buckets grow in number with the rows, so that one holds some
    millions of tokens, few of them with equal bits, whatever the corpus is.
    """
    names = ["bucket", "wide", "tokens", "counts"]
    inside = np.uint64((1 << BITS_IN_BUCKET) - 1)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        seen: set[int] = set()

        def packed() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held) >> np.uint64(64 - bits), return_counts=True)
            bucket = (found >> np.uint64(BITS_IN_BUCKET)).astype(np.int64)
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            steps = (found & inside).astype(np.int64)
            first = steps[edges]
            steps[1:] -= steps[:-1].copy()
            steps[edges] = first
            wide = np.maximum.reduceat(steps, edges) > 0xFFFF
            repeats = np.maximum.reduceat(n, edges) > 1
            parts = list(zip(edges.tolist(), np.append(edges[1:], len(found)).tolist()))
            tokens = [
                steps[s:e].astype(np.uint32 if w else np.uint16).tobytes() for (s, e), w in zip(parts, wide.tolist())
            ]
            counts = [n[s:e].astype(np.uint32).tobytes() if r else None for (s, e), r in zip(parts, repeats.tolist())]
            columns = [pa.array(bucket[edges]), pa.array(wide)]
            columns += [pa.array(c, pa.binary()) for c in (tokens, counts)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for _, tokens, ends in _sets(batch, like.words):
                begin = 0
                for end in ends.tolist():
                    mine = tokens[begin:end]
                    begin = end
                    key = set_key(mine)
                    if len(mine) and key not in seen:
                        seen.add(key)
                        held.append(mine)
                        size += len(mine)
                if size > TOKENS_AT_ONCE:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, weights = None, [], []

        def summed() -> pa.RecordBatch:
            tokens = np.concatenate(parts)
            order = np.argsort(tokens, kind="stable")
            tokens, n = tokens[order], np.concatenate(weights)[order]
            edges = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            sums = np.add.reduceat(n.astype(np.int64), edges)
            often = sums >= like.frequent_from
            found = tokens[edges[often]]
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[often])], names=["token", "n"])

        for batch in batches:
            for number, wide, steps, counts in zip(*[c.to_pylist() for c in batch.columns]):
                if number != bucket and parts:
                    yield summed()
                    parts, weights = [], []
                bucket = number
                steps = np.frombuffer(steps, np.uint32 if wide else np.uint16)
                parts.append((number << BITS_IN_BUCKET) + np.cumsum(steps, dtype=np.int64))
                ones = np.ones(len(parts[-1]), np.uint32)
                weights.append(ones if counts is None else np.frombuffer(counts, np.uint32))
        if parts:
            yield summed()

    sent = _word_hashes(docs).mapInArrow(cells, "bucket bigint, wide boolean, tokens binary, counts binary")
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(count, "token bigint, n bigint"), "token-counts")


def frequent_tokens(docs: DataFrame, bits: int, like: Likeness = Likeness()) -> list[tuple[int, int]]:
    """(leading bits, count) of the commonest tokens, MOST_FREQUENT of them at most."""
    sums = token_counts(docs, bits, like)
    # the lowest limit that leaves at most MOST_FREQUENT tokens, from counts of counts
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = sums.groupBy(step.alias("s")).agg(
        F.count(F.lit(1)).alias("tokens"), F.min("n").alias("least")
    )
    held, least = 0, None
    for row in steps.orderBy(F.desc("s")).collect():  # some hundred rows at most
        held += row["tokens"]
        if held > MOST_FREQUENT:
            break
        least = row["least"]
    if least is None:
        return []
    kept = sums.filter(F.col("n") >= least).select("token", "n")
    return [(r["token"], r["n"]) for r in kept.toLocalIterator()]


def _ranked(frequent: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent tokens (leading bits) and the place of each in the order of rising counts."""
    tokens = np.array([t for t, _ in frequent], np.int64).view(np.uint64)
    counts = np.array([n for _, n in frequent], np.int64)
    by_token = np.argsort(tokens)
    tokens, counts = tokens[by_token], counts[by_token]
    rank = np.zeros(len(tokens), np.uint64)
    rank[np.lexsort((tokens, counts))] = np.arange(len(tokens), dtype=np.uint64)
    return tokens, rank


def _posted(docs: DataFrame, like: Likeness, shared) -> DataFrame:
    """(doc_id, n_shingles, key, rare, prefix): every document's set key and first tokens.

    Copies within a task give their prefix once, so a group of copies that holds a third of
    all rows posts a set at most once a task; the other copies have the key alone.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        freq, ranks, bits = shared.value
        for batch in batches:
            for ids, tokens, ends in _sets(batch, like.words):
                begin, sizes, found, rares, prefixes = 0, [], [], [], []
                for end in ends.tolist():
                    mine = tokens[begin:end]
                    begin = end
                    key = set_key(mine) if len(mine) else None
                    sizes.append(len(mine))
                    found.append(key)
                    if key is None or key in seen:
                        rares.append(None)
                        prefixes.append(None)
                        continue
                    seen.add(key)
                    first, rare = prefix(mine, freq, ranks, bits, like.percent)
                    rares.append(rare)
                    prefixes.append(first.view(np.int64))
                columns = [pa.array(c, pa.int64()) for c in (sizes, found, rares)]
                columns += [pa.array(prefixes, pa.list_(pa.int64()))]
                names = ["doc_id", "n_shingles", "key", "rare", "prefix"]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

    kinds = "doc_id bigint, n_shingles bigint, key bigint, rare bigint, prefix array<bigint>"
    return _word_hashes(docs).mapInArrow(keys, kinds)


def short_prefix(tokens: np.ndarray, order: int, percent: int) -> bytes:
    """The first tokens of a set under a hash order, 16 bits of each, sorted.

    Different tokens with equal bits can only let a candidate through.
    """
    p = prefix_length(len(tokens), percent)
    key = mixed(tokens, order)
    first = key if p >= len(key) else key[np.argpartition(key, p - 1)[:p]]
    return np.sort((first & np.uint64(0xFFFF)).astype(np.uint16)).tobytes()


def overlap_of_a_link(n1: int, n2: int, percent: int) -> int:
    """How many tokens two linked sets have in common at least."""
    return -(-(n1 + n2) * percent // (100 + percent))


def outline_bits(n: int) -> int:
    """Leading bits of a hash that leave steps of 32 to 64 between n sorted ones."""
    return n.bit_length() + 5


def outline(tokens: np.ndarray) -> bytes:
    """The whole set under a hash order by the `outline_bits` of each hash, as steps of a byte.

    A step of 255 or more is as many bytes 255 as it holds and the remainder after them.
    """
    values = np.sort(mixed(tokens, ORDERS) >> np.uint64(64 - outline_bits(len(tokens)))).astype(np.int64)
    steps = np.diff(values, prepend=0)
    ends = np.cumsum(steps // 255 + 1)
    out = np.full(ends[-1], 255, np.uint8)
    out[ends - 1] = steps % 255
    return out.tobytes()


def outlined(steps: pa.Buffer) -> np.ndarray:
    """The sorted leading bits that make up an outline."""
    steps = np.frombuffer(steps, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def most_common(x: np.ndarray, y: np.ndarray) -> int:
    """How many tokens two outlined sets can have in common at most.

    Leading bits keep their order, so the finer outline is cut to the bits of the other.
    Common tokens have equal bits; others with equal bits only raise the number.
    """
    finer = outline_bits(len(x)) - outline_bits(len(y))
    return shared_values(x >> max(finer, 0), y >> max(-finer, 0))


def least_shared(n1: int, n2: int, percent: int) -> int:
    """How many prefix tokens two sets must share under any order to be linked.

    A link needs `overlap` common tokens. Those beyond the prefix that ends first are at
    most the rest of its set, so the prefixes hold the remainder.
    """
    overlap = overlap_of_a_link(n1, n2, percent)
    rest = max(-(-n * percent // 100) for n in (n1, n2)) - 1
    return overlap - rest


def _paired(posts: DataFrame, like: Likeness) -> DataFrame:
    """(token, k1, n1, k2, n2) of the posts (token, n, key) of tokens that are not known as frequent.

    Posts are dealt by token and sorted, so the sets of a token stand together, the smaller
    first. Up to `pairs_up_to` of them meet pair by pair, as far as their sizes allow: a row
    with the pair and no token. The posts of a token with more sets come back as they were
    (k1 is the key, n1 its size, the others null). A task holds a batch and `pairs_up_to` posts.
    """
    names = ["token", "k1", "n1", "k2", "n2"]
    most = like.pairs_up_to

    def found(token: np.ndarray, n: np.ndarray, key: np.ndarray) -> list[tuple]:
        """Rows of whole tokens."""
        edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        sizes = np.diff(np.append(edges, len(token)))
        many = np.repeat(sizes > most, sizes)
        # the i-th set of a token meets the next ones
        left, right = [], []
        for gap in range(1, most):
            i = np.flatnonzero((token[gap:] == token[:-gap]) & ~many[gap:])
            i = i[n[i] * 100 >= n[i + gap] * like.percent]
            left.append(i)
            right.append(i + gap)
        x, y = np.concatenate(left), np.concatenate(right)
        return [(token[many], key[many], n[many], None, None), (None, key[x], n[x], key[y], n[y])]

    def batch_of(rows: tuple) -> pa.RecordBatch:
        size = len(rows[1])
        columns = [pa.nulls(size, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in rows]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        streaming = None  # a token whose first posts went out as too many already
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            token, n, key = (np.concatenate([h, c]) for h, c in zip(held, columns))
            if not len(token):
                continue
            # copies in several tasks post alike
            new = np.append(True, (token[1:] != token[:-1]) | (key[1:] != key[:-1]))
            token, n, key = token[new], n[new], key[new]
            if streaming is not None:
                cut = int(np.searchsorted(token, streaming, "right"))
                yield batch_of((token[:cut], key[:cut], n[:cut], None, None))
                token, n, key = token[cut:], n[cut:], key[cut:]
                if len(token):
                    streaming = None
            # the last token may go on in the next batch
            cut = int(np.searchsorted(token, token[-1], "left")) if len(token) else 0
            if cut:
                yield from map(batch_of, found(token[:cut], n[:cut], key[:cut]))
            held = [token[cut:], n[cut:], key[cut:]]
            if len(held[0]) > most:
                streaming = held[0][0]
                yield batch_of((held[0], held[2], held[1], None, None))
                held = [np.zeros(0, np.int64)] * 3
        if len(held[0]):
            yield from map(batch_of, found(*held))

    dealt = posts.repartition("token").sortWithinPartitions("token", "n", "key")
    kinds = ", ".join(f"{c} bigint" for c in names)
    return stored(dealt.select("token", "n", "key").mapInArrow(pairs, kinds), "paired")


def _least(like: Likeness) -> Column:
    """`least_shared` of the columns n1 and n2."""
    n1, n2, t = F.col("n1"), F.col("n2"), like.percent
    rest = F.greatest(F.ceil(n1 * t / 100), F.ceil(n2 * t / 100)) - 1
    return F.ceil((n1 + n2) * t / (100 + t)) - rest


def _sharing_enough(pairs: DataFrame, posts: DataFrame, like: Likeness) -> DataFrame:
    """(k1, k2) whose first prefixes can share enough tokens.

    There is a row for each shared token of few sets; of the tokens of many sets two sets share
    no more than either posts.
    """
    shared = pairs.groupBy("k1", "n1", "k2", "n2").agg(F.count(F.lit(1)).alias("shared"))
    many = posts.groupBy("key").agg(F.count(F.lit(1)).alias("many"))
    for i in ("1", "2"):
        shared = shared.join(many.select(F.col("key").alias(f"k{i}"), F.col("many").alias(f"m{i}")), f"k{i}", "left")
    most = F.col("shared") + F.least(F.coalesce("m1", F.lit(0)), F.coalesce("m2", F.lit(0)))
    kept = shared.filter(most >= _least(like))
    # either order of a pair is the same pair
    return kept.select(F.least("k1", "k2").alias("k1"), F.greatest("k1", "k2").alias("k2"))


def _star_candidates(posts: DataFrame, like: Likeness) -> DataFrame:
    """(k1, k2): each set that posts a token of many sets, with two centres of those sets.

    One centre has the fewest tokens of its own (`rare`), then the smallest size: the text
    that the others were made from, or what is nearest to it. The other is chosen by a hash
    of the set alone, so most tokens of a group choose the same few and the pairs stay few.
    Two rows a post, however many sets share the token. Size steps are powers of the size
    ratio; the largest set of a step meets the centre of the next.
    """
    step = F.floor(F.log(F.col("n")) / math.log(100 / like.percent)).cast("int")
    # a set with more tokens of its own can't be linked by those of many sets
    rest = F.col("n") - F.coalesce("rare", F.lit(0))
    stepped = posts.filter(rest * 100 >= F.col("n") * like.percent).withColumn("step", step)
    ends = stepped.groupBy("token", "step").agg(
        F.min_by("key", F.struct("rare", "n", "key")).alias("k1"),
        F.max_by("key", F.struct("n", "key")).alias("top"),
        F.min_by("key", F.xxhash64("key")).alias("any"),
    )
    ends = stored(ends, "token-steps")
    both = stepped.join(ends, ["token", "step"])
    centres = F.explode(F.array("k1", "any")).alias("k1")
    both = both.select(centres, F.col("key").alias("k2")).filter("k1 <> k2")
    # either order of a pair is the same pair
    both = both.select(F.least("k1", "k2").alias("k1"), F.greatest("k1", "k2").alias("k2"))
    below = ends.select("token", (F.col("step") + 1).alias("step"), F.col("top").alias("below"))
    bridges = ends.join(below, ["token", "step"]).select(F.col("below").alias("k1"), F.col("k1").alias("k2"))
    return both.union(bridges).distinct()


def _cross_candidates(posts: DataFrame, roots: DataFrame, like: Likeness) -> DataFrame:
    """(k1, k2) sharing a token of many sets, in different components so far, that can be linked.

    Tokens whose sets are all of one component give nothing; the sets of the others are
    paired across components only. Two linked sets whose first common token is of few sets
    are in one component by now. If it is known as frequent, what they have in common is at
    most what stands from its `place` on in either set; rows of later common tokens may fail
    that, the one of the first can't. If it is not known (`place` is null), only the sizes
    count, and those tokens with all known ones (`often`) must be enough.
    """
    often = posts.filter("place is not null").groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    known = posts.join(often, "key", "left").join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    known = known.withColumn("root", F.coalesce("root", "key"))
    mixed_tokens = known.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    open_posts = stored(known.join(mixed_tokens.select("token"), "token"), "open-posts")
    shared = _late_rows(open_posts, like).groupBy("k1", "k2", "n1", "n2", "often1", "often2").agg(
        F.count_if(F.col("place1").isNull()).alias("unknown")
    )
    enough = F.col("unknown") + F.least("often1", "often2") >= _least(like)
    return shared.filter(enough).select("k1", "k2")


def _late_rows(posts: DataFrame, like: Likeness) -> DataFrame:
    """A row for each token by which two sets of different roots may be linked."""
    a, b = (
        posts.select(
            "token",
            F.col("key").alias(f"k{i}"),
            F.col("n").alias(f"n{i}"),
            F.col("root").alias(f"r{i}"),
            F.col("place").alias(f"place{i}"),
            F.coalesce("often", F.lit(0)).alias(f"often{i}"),
            # the greatest sum of both sizes at which the tokens from here on are enough for a link
            F.floor((F.col("n") - F.coalesce("place", F.lit(0))) * (100 + like.percent) / like.percent).alias(f"most{i}"),
        )
        for i in (1, 2)
    )
    # the smaller of two sets meets none below its own size
    a = a.filter(F.col("n1") * 2 <= F.col("most1"))
    both = F.col("n1") + F.col("n2")
    fits = (both <= F.col("most1")) & (both <= F.col("most2")) & (F.struct("n1", "k1") < F.struct("n2", "k2"))
    return a.join(b, "token").filter((F.col("r1") != F.col("r2")) & fits)


def _meeting(sets: DataFrame, pairs: DataFrame, like: Likeness) -> DataFrame:
    """The candidates (k1, k2) whose prefixes under every further order share enough tokens."""
    left = sets.select(F.col("key").alias("k1"), F.col("n").alias("n1"), F.col("filters").alias("left"))
    right = sets.select(F.col("key").alias("k2"), F.col("n").alias("n2"), F.col("filters").alias("right"))
    compared = pairs.join(left, "k1").join(right, "k2").select("k1", "k2", "n1", "n2", "left", "right")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = [
                _meets(x.as_buffer(), y.as_buffer(), least_shared(n1, n2, like.percent))
                for (n1, n2), x, y in zip(sizes, batch.column(4), batch.column(5))
            ]
            yield batch.select(["k1", "k2"]).filter(pa.array(keep, pa.bool_()))

    return stored(compared.mapInArrow(meet, "k1 bigint, k2 bigint").distinct(), "meeting")


def _meets(x: pa.Buffer, y: pa.Buffer, least: int) -> bool:
    left = np.frombuffer(x, np.uint16).reshape(ORDERS - 1, -1)
    right = np.frombuffer(y, np.uint16).reshape(ORDERS - 1, -1)
    return all(shared_values(a, b) >= least for a, b in zip(left, right))


def shared_values(x: np.ndarray, y: np.ndarray) -> int:
    """How many values of sorted `x` are in sorted `y`."""
    if not len(y):
        return 0
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _marked(texts: DataFrame, wanted: DataFrame, by: str = "doc_id") -> DataFrame:
    """The rows of `texts` whose `by` may be in `wanted`: all that are, and few others.

    Texts don't move. Every task knows a bitmap of hashed ids of MOST_MARKS bits at most,
    whatever the corpus is; fuller bitmaps let more texts through, none is lost. A missing
    doc_id has a hash, too, as a set may have no other document than one without an id.
    """
    bits = min(MOST_MARKS, 1 << (MARKS_PER_ROW * wanted.count()).bit_length())
    mark = F.pmod(F.xxhash64(by), F.lit(bits)) + 1
    bucket, bit = F.bitmap_bucket_number(mark), F.bitmap_bit_position(mark)
    marks = wanted.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("marks"))
    found = texts.withColumns({"bucket": bucket, "bit": bit}).join(F.broadcast(marks), "bucket")
    byte = F.conv(F.hex(F.substring("marks", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    marked = F.call_function("shiftright", byte.cast("int"), (F.col("bit") % 8).cast("int")) % 2 == 1
    return found.filter(marked).select(*texts.columns)


def _outlines_fit(sets: DataFrame, pairs: DataFrame, like: Likeness) -> DataFrame:
    """The candidates (k1, k2) whose outlines leave room for a link: all links, and few others."""
    compared = _side_by_side(sets, pairs, "outline")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = outlined(x.as_buffer()), outlined(y.as_buffer())
                keep.append(most_common(a, b) >= overlap_of_a_link(len(a), len(b), like.percent))
            yield batch.select(["k1", "k2"]).filter(pa.array(keep, pa.bool_()))

    return stored(compared.mapInArrow(fit, "k1 bigint, k2 bigint").distinct(), "fitting")


def _side_by_side(sets: DataFrame, pairs: DataFrame, what: str) -> DataFrame:
    """(k1, k2, left, right): a column of both sets; those that no pair has on a side don't move."""
    left = _marked(sets.select(F.col("key").alias("k1"), F.col(what).alias("left")), pairs.select("k1").distinct(), "k1")
    right = _marked(sets.select(F.col("key").alias("k2"), F.col(what).alias("right")), pairs.select("k2").distinct(), "k2")
    return pairs.join(left, "k1").join(right, "k2").select("k1", "k2", "left", "right")


def _verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame, like: Likeness) -> DataFrame:
    """The candidates that are links: (a, b, common), written once.

    The texts of the documents that stand for a candidate's set are read. Then the prefixes of
    the further orders move, a quarter of each set and order, then the outlines of the sets of
    candidates that meet in them all. What is left are links but for a few; their texts are
    read again, and the sets themselves move.
    """
    first = rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    first = stored(first.join(_keys(pairs), "key", "left_semi"), "wanted")
    # rows of one doc_id in several tasks may give a set more than once: links are distinct
    read = _word_hashes(_marked(texts, first.select("doc_id").distinct()))
    filters = stored(read.mapInArrow(_filters(like), "key bigint, n bigint, filters binary, outline binary"), "filters")
    near = _outlines_fit(filters, _meeting(filters, pairs, like), like)
    again = first.join(_keys(near), "key", "left_semi").select("doc_id").distinct()
    read = _word_hashes(_marked(texts, stored(again, "wanted")))
    sets = stored(read.mapInArrow(_whole(like), "key bigint, tokens binary"), "sets")
    compared = _side_by_side(sets, near, "tokens")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                _common(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), like.percent)
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            common = pa.array(found, pa.int64())
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), common], names=["a", "b", "common"])
            yield out.filter(common.is_valid())

    return stored(compared.mapInArrow(verify, "a bigint, b bigint, common bigint").distinct(), "links")


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("k1").alias("key")).union(pairs.select("k2")).distinct()


def _different_sets(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[dict[int, np.ndarray]]:
    """The tokens of sets that the task has not met before, by key, a few documents at a time."""
    seen: set[int] = set()
    for batch in batches:
        for _, tokens, ends in _sets(batch, like.words):
            begin, new = 0, {}
            for end in ends.tolist():
                mine = tokens[begin:end]
                begin = end
                key = set_key(mine) if len(mine) else None
                if key is not None and key not in seen:
                    seen.add(key)
                    new[key] = mine
            yield new


def _filters(like: Likeness):
    """Task function: key, size, filters and outline of each different set.

    `filters` are the prefixes under the further orders, one after the other.
    """

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _different_sets(batches, like):
            columns = [pa.array(list(sets), pa.int64()), pa.array([len(s) for s in sets.values()], pa.int64())]
            prefixes = [b"".join(short_prefix(s, k, like.percent) for k in range(1, ORDERS)) for s in sets.values()]
            columns += [pa.array(c, pa.binary()) for c in (prefixes, [outline(s) for s in sets.values()])]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "filters", "outline"])

    return filters


def _whole(like: Likeness):
    """Task function: key and tokens of each different set."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _different_sets(batches, like):
            columns = [pa.array(list(sets), pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "tokens"])

    return whole


def _common(x: np.ndarray, y: np.ndarray, percent: int) -> int | None:
    """Size of the intersection of two sets that are alike enough."""
    common = shared_values(x, y)
    return common if 100 * common >= percent * (len(x) + len(y) - common) else None


def joined(docs: DataFrame, like: Likeness = Likeness()) -> tuple[DataFrame, DataFrame]:
    """Documents with the key of their set, and the component of each set that has a link.

    Documents: doc_id, n_shingles, key (null for an empty set). Components: node, root
    (keys). Sets that share a token of few sets are compared pair by pair. Sets that share
    tokens of many sets only (those of large groups of near copies) are first compared with
    centres of each token; after that only sets of different components are left to compare.
    So every two sets that are linked lie in one component,
    and a large group of near copies never becomes all its pairs.
    """
    bits = leading_bits(docs.count())
    frequent = _ranked(frequent_tokens(docs, bits, like))
    # bounded by MOST_FREQUENT, whatever the corpus is
    shared = docs.sparkSession.sparkContext.broadcast((*frequent, bits))
    rows = stored(_posted(docs, like, shared), "prefixes")
    posted = rows.filter("prefix is not null").withColumnRenamed("n_shingles", "n")
    rare = posted.select(
        "key", "n", F.explode(F.slice("prefix", F.lit(1), F.col("rare").cast("int"))).alias("token")
    )
    paired = _paired(rare, like)
    rest = F.slice("prefix", F.col("rare").cast("int") + 1, F.size("prefix"))
    common = posted.select("n", "key", "rare", F.posexplode(rest).alias("place", "token"))
    common = common.select("token", "n", "key", "rare", (F.col("place") + F.col("rare")).alias("place"))
    unknown = F.lit(None).cast("bigint")
    many = paired.filter("token is not null").select(
        "token", F.col("n1").alias("n"), F.col("k1").alias("key"), unknown.alias("rare"), unknown.alias("place")
    )
    common = stored(common.union(many).distinct(), "many-posts")
    few = _sharing_enough(paired.filter("token is null"), common, like)
    pairs = stored(few.union(_star_candidates(common, like)).distinct(), "candidates")
    links = _verified(docs, rows, pairs, like)
    roots = stored(components(links, "a", "b"), "roots")
    more = stored(_cross_candidates(common, roots, like), "candidates")
    if not more.isEmpty():
        late = _verified(docs, rows, more, like)
        roots = components(links.union(late), "a", "b")
    return rows.select("doc_id", "n_shingles", "key"), roots


def grouped(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id, class_size; one row per input row.

    `component_id` is the smallest doc_id reachable by links, `class_size` how many
    documents have an equal set. A null, empty or wordless text has no set, so it stands
    alone with its own doc_id.
    """
    rows, roots = joined(docs, like)
    sizes = rows.filter("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("class_size"), F.min("doc_id").alias("least")
    )
    sets = sizes.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    sets = stored(sets.withColumn("root", F.coalesce("root", "key")), "set-roots")
    named = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    per_set = sets.join(named, "root").select("key", "component_id", "class_size")
    found = rows.join(per_set, "key", "left")
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
    )


def one_of_each(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of `docs` whose doc_id names their component; repeated rows are kept once."""
    kept = grouped(docs, like).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("_kept")).distinct()
    alive = docs.join(kept, docs["doc_id"].cast("bigint").eqNullSafe(kept["_kept"]), "left_semi")
    return alive.dropDuplicates()
