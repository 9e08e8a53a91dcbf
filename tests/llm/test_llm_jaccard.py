from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from ebbflow.llm import jaccard
from ebbflow.llm.queries import QUERIES

WORDS = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans(jaccard.UPPER, jaccard.LOWER)


def shingle_set(text):
    w = WORDS.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_groups(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(d, least.get(find(i), d))
    same = Counter(s for _, s in sets)
    return Counter((d, len(s), least[find(i)], same[s] if s else 1) for i, (d, s) in enumerate(sets))


def ours(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["class_size"]) for r in df.collect())


@pytest.mark.parametrize("frequent_from", [2, 10**9])
def test_join_matches_brute_force(hard_docs, hard_rows, frequent_from):
    like = jaccard.Likeness(frequent_from=frequent_from)
    assert ours(jaccard.grouped(hard_docs, like)) == brute_groups([(d, t) for d, t, *_ in hard_rows])


def test_thresholds_are_exact(spark):
    """Pairs of every overlap around the limit, of equal and of unequal sizes."""
    rows, at = [], 0
    for n in (4, 7, 8, 20, 28, 41):
        for common in range(max(1, int(0.8 * n) - 3), n + 1):
            for extra in (0, 2, n // 4):
                words = [f"{n}.{common}.{extra}.{i}" for i in range(n + 4)]
                other = words[: common + 4] + [f"z{at}.{i}" for i in range(n - common + extra)]
                rows += [(at, " ".join(words)), (at + 1, " ".join(other))]
                at += 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert ours(jaccard.grouped(docs)) == brute_groups(rows)


def test_large_groups_of_near_copies_do_not_become_all_pairs(spark, tmp_path):
    """Chains of near copies whose ends are not alike, all tokens frequent."""
    import random

    r = random.Random(5)
    rows = []
    for g in range(3):
        words = [f"g{g}.{i}" for i in range(80)]
        for step in range(30):
            words = list(words)
            words[r.randrange(80)] = f"g{g}.s{step}"
            rows += [(1000 * g + 10 * step + c, " ".join([*words, *[f"c{c}"] * c])) for c in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    like = jaccard.Likeness(frequent_from=3)
    assert ours(jaccard.grouped(docs, like)) == brute_groups(rows)


def test_short_texts_around_one_passage(spark):
    """Sets that share a frequent passage and differ in a few words of their own, on both sides."""
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for i in range(120):
        own = [f"own{i}.{k}" for k in range(i % 24)]
        cut = passage[i % 5 :] if i % 3 else passage
        rows.append((i, " ".join([*own[: len(own) // 2], *cut, *own[len(own) // 2 :]])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    like = jaccard.Likeness(frequent_from=6)
    assert ours(jaccard.grouped(docs, like)) == brute_groups(rows)


def test_one_of_each_keeps_columns(hard_docs, hard_rows):
    kept = jaccard.one_of_each(hard_docs)
    want = {c for _, _, c, _ in brute_groups([(d, t) for d, t, *_ in hard_rows])}
    got = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == hard_docs.columns and sorted(got) == sorted(want)


def test_join_on_test_table_matches_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert ours(QUERIES["op4_ngram_jaccard_join"](spark, small)) == brute_groups(rows)


def test_join_of_nothing(no_docs, spark):
    assert jaccard.grouped(no_docs).collect() == []
    nulls = spark.createDataFrame([(None, "a b c d e f"), (None, None), (3, "a b c d e f")], "doc_id bigint, text string")
    assert ours(jaccard.grouped(nulls)) == Counter({(None, 2, 3, 2): 1, (None, 0, None, 1): 1, (3, 2, 3, 2): 1})


def test_counts_of_tokens_are_exact(spark, monkeypatch):
    """Tokens spread thinly over tasks and over cells of a task are counted, copies of a task once."""
    monkeypatch.setattr(jaccard, "TOKENS_AT_ONCE", 40)
    passage = " ".join(f"p{i}" for i in range(9))
    rows = [(i, f"{passage} own{i} a{i} b{i} c{i} d{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(30)
    counted = jaccard.token_counts(docs, 50, jaccard.Likeness(frequent_from=20))
    assert [r["n"] for r in counted.collect()] == [30] * 5
    copies = spark.createDataFrame([(i, passage) for i in range(9)], "doc_id bigint, text string").coalesce(1)
    assert jaccard.token_counts(copies, 50, jaccard.Likeness(frequent_from=2)).collect() == []


@pytest.mark.parametrize("batch", [3, 10_000])
def test_posts_of_many_sets_come_back_whole(spark, batch):
    posts = [(t, 10 + k, 100 * t + k) for t, m in ((1, 2), (2, 4), (3, 5), (4, 40), (5, 1), (6, 3)) for k in range(m)]
    df = spark.createDataFrame([*posts, *posts], "token bigint, n bigint, key bigint").repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = jaccard._paired(df, jaccard.Likeness()).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    many = {(r["token"], r["n1"], r["k1"]) for r in rows if r["token"] is not None}
    assert many == {p for p in posts if p[0] in (3, 4)}
    pairs = [(r["k1"], r["k2"]) for r in rows if r["token"] is None]
    sizes = {1: 2, 2: 4, 6: 3}
    assert sorted(pairs) == sorted(
        (100 * t + i, 100 * t + j) for t, m in sizes.items() for j in range(m) for i in range(j)
    )


def test_filters_keep_every_link():
    """Linked sets share at least `least_shared` prefix tokens under each order."""
    r = np.random.default_rng(3)
    for _ in range(300):
        n, own = int(r.integers(1, 90)), int(r.integers(0, 14))
        both = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        x, y = (np.unique(np.append(both, r.integers(0, 2**64, k, dtype=np.uint64))) for k in (own, own // 2))
        if jaccard._common(x, y, 75) is None:
            continue
        least = jaccard.least_shared(len(x), len(y), 75)
        a, b = (b"".join(jaccard.short_prefix(s, k, 75) for k in (1, 2)) for s in (x, y))
        import pyarrow as pa

        assert least >= 1 and jaccard._meets(pa.py_buffer(a), pa.py_buffer(b), least)


def test_a_document_without_an_id_is_linked(spark):
    words = [f"n{i}" for i in range(60)]
    rows = [(None, " ".join([*words, "more"])), (5, " ".join(words)), (None, "something else of five words here"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.grouped(docs).collect()}
    assert got == {(None, 57): 5, (5, 56): 5, (None, 2): None, (7, 0): 7}


def test_prefixes_stand_in_the_global_order():
    rng = np.random.default_rng(5)
    x = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    frequent = np.sort(rng.choice(x, 380, replace=False)) >> np.uint64(14)
    rank = rng.permutation(len(frequent)).astype(np.uint64)
    whole, rare = jaccard.prefix(x, frequent, rank, 50, 0)
    assert rare == len(x) - 380 and set(whole.tolist()) == set(x.tolist())
    part, rare_of_part = jaccard.prefix(x[::2], frequent, rank, 50, 75)
    places = [whole.tolist().index(t) for t in part.tolist()]
    assert places == sorted(places) and rare_of_part == sum(p < rare for p in places)


def test_late_rows_need_enough_tokens_from_their_place_on(spark):
    # 60 sets of 145 tokens with 17 of their own share the known tokens from the 22nd on: 124 at most, of 125
    posts = [(t, 145, k, k, 17, 17, 20, 21 + t) for k in range(60) for t in range(16)]
    names = "token long, n long, key long, root long, rare long, often long, places long, place long"
    late = jaccard._late_rows(spark.createDataFrame(posts, names), jaccard.Likeness())
    assert late.count() == 0
    one_more = [(t, n, k, root, r, o, p, place - 1) for t, n, k, root, r, o, p, place in posts]
    late = jaccard._late_rows(spark.createDataFrame(one_more, names), jaccard.Likeness())
    assert {(r["token"], r["place1"]) for r in late.collect()} == {(0, 20)} and late.count() == 60 * 59 // 2


def test_texts_of_candidates_are_read_without_moving(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    docs = docs.union(spark.sql("SELECT CAST(null AS bigint), 'no id'"))
    wanted = spark.range(0, 3000, 100).selectExpr("id - 1 AS doc_id").union(spark.sql("SELECT CAST(null AS bigint)"))
    must = {None, *range(99, 2900, 100)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard._marked(docs, wanted)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        got = [r["doc_id"] for r in found.collect()]
        assert len(got) == len(set(got)) and must <= set(got) and len(got) < 300
        # a bitmap that is too small lets more through and loses none
        monkeypatch.setattr(jaccard, "MOST_MARKS", 8)
        got = {r["doc_id"] for r in jaccard._marked(docs, wanted).collect()}
        assert must <= got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_outlines_keep_every_link_and_little_else():
    """A byte a token; linked sets of any sizes fit, sets that share two thirds of their tokens don't."""
    import pyarrow as pa

    def outlined(s):
        return jaccard.outlined(pa.py_buffer(jaccard.outline(s)))

    r = np.random.default_rng(4)
    links = 0
    for _ in range(400):
        n, own = int(r.integers(1, 300)), int(r.integers(0, 60))
        both = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        x, y = (np.unique(np.append(both, r.integers(0, 2**64, k, dtype=np.uint64))) for k in (own, own // 3))
        a, b = outlined(x), outlined(y)
        assert (len(a), len(b)) == (len(x), len(y))
        assert min(jaccard.most_common(a, b), jaccard.most_common(b, a)) >= len(both)
        if jaccard._common(x, y, 75) is not None:
            links += 1
            assert jaccard.most_common(a, b) >= jaccard.overlap_of_a_link(len(x), len(y), 75)
    assert links > 100
    both, *own = (np.unique(r.integers(0, 2**64, k, dtype=np.uint64)) for k in (600, 300, 300))
    x, y = (np.unique(np.append(both, o)) for o in own)
    assert jaccard.most_common(outlined(x), outlined(y)) < jaccard.overlap_of_a_link(len(x), len(y), 75)
    assert len(jaccard.outline(x)) < 1.1 * len(x)
    one = np.array([2**64 - 1], np.uint64)
    assert jaccard.most_common(outlined(one), outlined(one)) == 1


def test_sets_of_candidates_that_are_no_links_do_not_move(spark, tmp_path, monkeypatch):
    """Sets that share two thirds of their tokens meet in the prefixes of all orders, but are not stored."""
    from ebbflow.llm.store import stored

    sizes = {}

    def watched(df, name, *codec):
        sizes.setdefault(name, []).append((out := stored(df, name, *codec)).count())
        return out

    monkeypatch.setattr(jaccard, "stored", watched)
    passages = [[f"p{i}.{k}" for k in range(200)] for i in range(20)]
    rows = [(2 * i + s, " ".join(p + [f"o{i}.{s}.{k}" for k in range(90)])) for i, p in enumerate(passages) for s in (0, 1)]
    rows += [(100, " ".join(passages[0] + ["x"] * 5)), (101, " ".join(passages[0]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert ours(jaccard.grouped(docs)) == brute_groups(rows)
    assert sizes["meeting"][0] >= 20 and sizes["sets"][0] <= 6
