"""Periodic runs of words, by an enhanced suffix array.

A run is a stretch of words in which words one period apart are equal and which no
neighbouring word extends. Every run ends in exactly one branching square: two equal halves
whose next words differ. In the suffix array the halves of such a square are two suffixes
of one LCP interval whose common prefix is as long as the period. So for each LCP index the
suffixes of the smaller side look up, in the inverse array, whether the suffix one depth
before or after stands on the other side. No tree is built: an interval is two numbers.
Squares are then rotated to the left as far as their words repeat, which gives the run, and
squares that lie in a run of a shorter period are merged into it.

Every text is judged alone and whole, where it was read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_WORDS = 200_000  # texts share one array up to about this many words
LOOKUPS = 1_000_000  # suffixes of smaller sides looked up at once


@dataclass(frozen=True)
class Rules:
    least_length: int = 24  # words
    least_exponent: int = 3  # whole periods in a run, 2 at least

    @property
    def window(self) -> int:
        """Every window of so many words of a run stands a second time in the run."""
        return max(1, self.least_length * (self.least_exponent - 2) // self.least_exponent)


@dataclass(frozen=True)
class SuffixArray:
    sa: np.ndarray
    isa: np.ndarray
    lcp: np.ndarray  # lcp[j] of suffixes j - 1 and j; -1 before the first and after the last


def suffix_array(codes: np.ndarray) -> SuffixArray:
    """By prefix doubling; only suffixes that are not alone yet are sorted again.

    The last code, and any that closes a part, must occur once.
    """
    n = len(codes)
    values, rank, counts = np.unique(codes, return_inverse=True, return_counts=True)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    active = np.flatnonzero(counts[rank] > 1)
    rank = first[rank].astype(np.int64)
    levels, k = [rank.astype(np.int32)], 1
    while len(active):
        key = rank[active] * np.int64(n) + rank[active + k]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        at = np.arange(len(active))
        new_bucket = np.concatenate(([True], old[1:] != old[:-1]))
        new_part = np.concatenate(([True], key[1:] != key[:-1]))
        bucket = np.maximum.accumulate(np.where(new_bucket, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        rank[active] = old + part - bucket
        alone = new_part & np.concatenate((new_part[1:], [True]))
        active = active[~alone]
        levels.append(rank.astype(np.int32))
        k *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    a, b = sa[:-1], sa[1:]
    common = np.zeros(max(0, n - 1), np.int64)
    for level in reversed(range(len(levels))):
        equal = levels[level][a + common] == levels[level][b + common]
        common += equal.astype(np.int64) << level
    return SuffixArray(sa, rank, np.concatenate(([-1], common, [-1])))


def _hop(lcp: np.ndarray, js: np.ndarray, step: int) -> np.ndarray:
    """The nearest index before (step -1) with a smaller lcp, or after (1) with none greater.

    All indices hop along the pointers of those they pass, so the rounds are few; the last
    ones hop one by one.
    """
    at = np.arange(len(lcp)) + step
    passes = np.greater_equal if step < 0 else np.greater
    active = js
    while len(active) > 64:
        active = active[passes(lcp[at[active]], lcp[active])]
        at[active] = at[at[active]]
    for j in sorted(active.tolist(), reverse=step > 0):
        p, depth = int(at[j]), int(lcp[j])
        while (lcp[p] >= depth) if step < 0 else (lcp[p] > depth):
            p = int(at[p])
        at[j] = p
    return at[js]


def branching_squares(index: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square whose two halves go on differently, each once."""
    sa, isa, lcp = index.sa, index.isa, index.lcp
    js = np.flatnonzero(lcp > 0)
    before, after = _hop(lcp, js, -1), _hop(lcp, js, 1)
    left_smaller = js - before <= after - js
    low = np.where(left_smaller, before, js)  # the smaller side
    size = np.where(left_smaller, js - before, after - js)
    other_low = np.where(left_smaller, js, before)
    other_high = np.where(left_smaller, after, js)
    depth = lcp[js]
    starts, periods = [], []
    ends = np.cumsum(size)
    begin = 0
    while begin < len(js):
        reached = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, reached + LOOKUPS, "right")))
        n = size[begin:stop]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i = sa[np.repeat(low[begin:stop], n) + inside]
        d, lo, hi = (np.repeat(x[begin:stop], n) for x in (depth, other_low, other_high))
        there = isa[i + d]
        found = (there >= lo) & (there < hi)
        starts.append(i[found])
        periods.append(d[found])
        possible = i >= d
        i, d, lo, hi = i[possible], d[possible], lo[possible], hi[possible]
        there = isa[i - d]
        found = (there >= lo) & (there < hi)
        starts.append(i[found] - d[found])
        periods.append(d[found])
        begin = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def _rotated(codes: np.ndarray, start: int, period: int) -> int:
    """Where the repetition that holds `start` begins; looks back in growing steps."""
    step = 64
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(codes[low:start] != codes[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, 2 * step
    return 0


def merged_runs(codes: np.ndarray, start: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs that the squares belong to.

    Of the squares with one end the shortest is rotated to its run; those inside that run
    have a multiple of its period. The rest, few by the periodicity lemma, go on.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    order = np.lexsort((period, start + 2 * period))
    start, period = start[order], period[order]
    while len(start):
        end = start + 2 * period
        leads = np.concatenate(([True], end[1:] != end[:-1]))
        s, p, e = start[leads].copy(), period[leads], end[leads]
        active = np.arange(len(s))
        for _ in range(32):
            active = active[s[active] > 0]
            active = active[codes[s[active] - 1] == codes[s[active] - 1 + p[active]]]
            s[active] -= 1
        for i in active.tolist():
            s[i] = _rotated(codes, int(s[i]), int(p[i]))
        out.append((s, e, p))
        rest = (start < s[np.cumsum(leads) - 1]) & ~leads
        start, period = start[rest], period[rest]
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def candidate_stretches(words: Sequence[bytes], rules: Rules) -> list[tuple[int, int]]:
    """Parts of a text that can hold a run: every window of a run occurs twice.

    Windows are compared by a hash, so a clash adds a part and never takes one away.
    """
    n, w = len(words), rules.window
    if n < rules.least_length:
        return []
    numbers = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    h = numbers[: n - w + 1].copy()
    for k in range(1, w):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h += numbers[k : n - w + 1 + k]
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.searchsorted(twice, h)
    again = twice[np.minimum(at, len(twice) - 1)] == h
    cover = np.zeros(n + 1, np.int64)
    cover[:-w][again] += 1
    cover[w:][again] -= 1
    inside = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= rules.least_length]


def runs_of(texts: Sequence[Sequence[bytes]], rules: Rules = Rules()) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    codes: list[int] = []
    places: list[tuple[int, int, int]] = []  # where a part begins in codes, its text, its first word
    for t, words in enumerate(texts):
        for a, b in candidate_stretches(words, rules):
            base = len(codes)  # each part has numbers of its own, so intervals don't join parts
            known: dict[bytes, int] = {}
            places.append((base, t, a))
            codes.extend(base + known.setdefault(x, len(known)) for x in words[a:b])
            codes.append(base + len(known))
    if not places:
        return found
    array = np.array(codes, np.int64)
    start, end, period = merged_runs(array, *branching_squares(suffix_array(array)))
    long = end - start >= np.maximum(rules.least_length, rules.least_exponent * period)
    start, end, period = start[long], end[long], period[long]
    part = np.searchsorted(np.array([p[0] for p in places]), start, "right") - 1
    for s, e, p, k in zip(start.tolist(), end.tolist(), period.tolist(), part.tolist()):
        base, t, a = places[k]
        found[t].append((s - base + a, e - s, p))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by single blanks: of a run its first period stays."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    dropped = np.cumsum(cover[:-1]) > 0
    return b" ".join([words[i] for i in np.flatnonzero(~dropped).tolist()])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, n_words, runs, collapsed: one row per input row.

    `runs` holds (start, length, period) in words, by start and period; `collapsed` the text
    without what the runs repeat, its words joined by single blanks. A null or empty text
    has no words, no runs and an empty collapsed text; a null doc_id stays null; repeated
    rows are judged each. Only doc_id and text are read, so other columns may have any name.
    """

    def work(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts, rules)
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in found], _RUNS),
            pa.array([collapsed(t, x).decode() for t, x in zip(texts, found)], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, n = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                ids.append(doc_id.as_py())
                # bytes split at just the six ASCII blanks
                texts.append((text.as_py() or b"").split())
                n += len(texts[-1])
                if n >= BATCH_WORDS:
                    yield work(ids, texts)
                    ids, texts, n = [], [], 0
            if ids:
                yield work(ids, texts)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return narrow.mapInArrow(run, kinds)


WORD = r"[^\x20\x09-\x0D]+"


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts made periodic from some word on.

    Which, from where and with which period is drawn from the crc32 of the decimal doc_id;
    a null doc_id and a text without words stay as they are.
    """
    text, h = F.col("text").cast("string"), F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words).cast("bigint")
    g = F.floor(h / 10).cast("bigint")
    a = F.pmod(g, n)
    p = F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("bigint") + 1

    def periodic(edit: Column) -> Column:
        at = lambda i: F.when(i < edit["a"], i).otherwise(edit["a"] + F.pmod(i - edit["a"], edit["p"]))
        return F.transform(edit["w"], lambda _, i: F.get(edit["w"], at(i.cast("bigint")).cast("int")))

    # one element, so the words are cut once
    edit = F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p")))
    edited = F.array_join(F.transform(edit, periodic)[0], " ")
    chosen = (F.pmod(h, F.lit(10)) == 0) & text.rlike(WORD)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.when(chosen, edited).otherwise(text).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row per document: number of runs, the most repetitive one, digests of runs and text.

    Exponents are compared exactly, as fractions; ties go to the smaller start, then period.
    """

    def order(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        later = F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"])
        return F.when(a > b, -1).when(a < b, 1).otherwise(F.signum(later).cast("int"))

    best = F.get(F.array_sort("runs", order), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000).cast("bigint") * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
