"""Periodic runs, Merkle manifest and SimHash near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ebbflow.llm import merkle, periodic, positions, vantage
from ebbflow.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return [*out, word] if word else out


def docs_of(spark, rows):
    """rows: (doc_id, text, lang, source, n_chars); with columns whose names clash."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank bigint, leaf string, fp bigint, runs string, n bigint, tree string"
    return spark.createDataFrame([(*r, 1, "l", 2, "r", 3, "t") for r in rows], schema).repartition(4)


@pytest.fixture(scope="module")
def rows(hard_rows):
    r = random.Random(5)
    more = []
    for i in range(200, 260):
        base = [f"v{r.randrange(40)}" for _ in range(r.randrange(1, 60))]
        at = r.randrange(len(base))
        base[at:at] = base[at : at + r.randrange(1, 9)] * r.randrange(2, 14)
        more.append((i, r.choice([" ", "\n", "\t "]).join(base), None, "p", None))
    more += [(None, "null id one two three four", "en", None, 3), (300, None, None, None, None), (301, "x " * 400, "", "", 0)]
    return [(d, t, lang, s, n) for d, t, lang, s, n in hard_rows] + more


# --- periodic runs ----------------------------------------------------------------------------


def brute_runs(words, least_length=24, least_exponent=3):
    n, found = len(words), {}
    for q in range(1, n // least_exponent + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e + q - s
            if e > s and length >= max(least_length, least_exponent * q):
                found.setdefault((s, length), q)  # the shortest period comes first
            s = e + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("least_length, least_exponent", [(24, 3), (6, 2), (9, 3), (24, 4)])
def test_runs_are_those_of_brute_force(least_length, least_exponent):
    r = random.Random(least_length * least_exponent)
    rules = periodic.Rules(least_length, least_exponent)
    for _ in range(60):
        texts = []
        for _ in range(4):
            few = r.choice([1, 2, 3, 5, 50])
            w = [b"%d" % r.randrange(few) for _ in range(r.randrange(120))]
            for _ in range(r.randrange(4)):
                a = r.randrange(len(w) + 1)
                w[a:a] = w[a : a + r.randrange(1, 15)] * r.randrange(1, 12)
            texts.append(w)
        assert periodic.runs_of(texts, rules) == [brute_runs(w, least_length, least_exponent) for w in texts]


def test_long_text_of_one_word():
    assert periodic.runs_of([[b"a"] * 200_000, [], [b"a"] * 23]) == [[(0, 200_000, 1)], [], []]


def test_suffix_array_is_sorted():
    r = random.Random(3)
    codes = np.array([r.randrange(3) for _ in range(300)] + [9], np.int64)
    index = periodic.suffix_array(codes)
    order = sorted(range(301), key=lambda i: codes[i:].tolist())
    assert index.sa.tolist() == order and index.isa[index.sa].tolist() == list(range(301))
    for j in range(1, 301):
        a, b = codes[order[j - 1] :].tolist(), codes[order[j] :].tolist()
        assert index.lcp[j] == next(k for k, (x, y) in enumerate(zip(a, b)) if x != y)


def brute_op11(doc_id, text):
    w = words_of(text)
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)),
    )


def test_periodic_query_against_brute_force(spark, rows, tmp_path):
    short = [r for r in rows if len(r[1] or "") < 20_000]
    docs_of(spark, short).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter(brute_op11(r[0], r[1]) for r in short)
    assert sum(k[1] > 0 for k in got) > 20


def test_periods_of_the_small_table(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {d: brute_op11(d, t) for d, t in docs if len(t or "") < 12_000}
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    assert len(got) == len(docs) and all(got[d] == w for d, w in want.items())
    assert sum(w[1] > 0 for w in want.values()) >= 10


def test_runs_of_nothing(no_docs):
    assert periodic.periodic_runs(no_docs).collect() == []
    assert periodic.digests(periodic.periodic_runs(periodic.with_planted_periods(no_docs))).collect() == []


# --- Merkle manifest -----------------------------------------------------------------------------


def brute_manifest(rows, fan_out=3):
    H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t, lang, s, n: H(*map(field, (d, s, lang, n, t)))
    trees = {}
    for d, t, lang, s, n in rows:
        even = d is not None and zlib.crc32(str(d).encode()) % 2 == 0
        own = leaf(d, t, lang, s, n)
        offered = leaf(d, t.replace("\n", "") if even and t is not None else t, lang, s, n)
        trees.setdefault(s, []).append(((d is not None, d or 0, own), d, own, offered))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + fan_out]) for i in range(0, len(out[-1]), fan_out)])
        return out

    def beside(all_levels, place):
        path = []
        for nodes in all_levels[:-1]:
            at = place // fan_out * fan_out
            path.append((nodes[at:place], nodes[place + 1 : at + fan_out]))
            place //= fan_out
        return path

    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: (sorted(trees[s], key=lambda x: x[0])) for s in names}
    below = {s: levels([x[2] for x in built[s]]) for s in names}
    top = levels([below[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for place, (_, d, own, offered) in enumerate(built[s]):
            path = beside(below[s], place) + beside(top, k)
            x = offered
            for before, after in path:
                x = H(*before, x, *after)
            out.append((d, own, below[s][-1][0], top[-1][0], H(*[y for a, b in path for y in a + b]), x, x == top[-1][0]))
    return out


@pytest.mark.parametrize("pack_levels", [1, 2, 4])
def test_manifest_against_brute_force(spark, rows, pack_levels):
    docs = docs_of(spark, rows)
    found = merkle.summary(merkle.verified(docs, merkle.without_line_ends(docs), merkle.Shape(3, pack_levels)))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = Counter(tuple(r) for r in found.collect())
    assert got == Counter(brute_manifest(rows))
    assert {k[-1] for k in got} == {True, False}


def test_proofs_of_some_leaves_and_content_addresses(spark, rows):
    manifest = merkle.build(merkle.leaves(docs_of(spark, rows)), merkle.Shape(3, 2))
    for packs in (*manifest.packs, *manifest.top_packs):
        for x in packs.select(F.explode("records").alias("r")).select("r.*").collect():
            assert x["digest"] == merkle.digest(x["children"])
    wanted = manifest.leaves.filter("rank % 7 = 3").select("tree", "rank")
    some = merkle.proofs(manifest, wanted).collect()
    assert len(some) == wanted.count() and all(r["folded_root"] == manifest.root for r in some)
    assert all(merkle.folded(r["leaf"], [p.asDict() for p in r["proof"]]) == manifest.root for r in some)
    # one letter changed anywhere in a proof leads elsewhere
    forged = [p.asDict() for p in some[0]["proof"]]
    level = next(p for p in forged if p["before"] or p["after"])
    side = "before" if level["before"] else "after"
    level[side] = ("0" if level[side][0] != "0" else "1") + level[side][1:]
    assert merkle.folded(some[0]["leaf"], forged) != manifest.root


def test_manifest_of_one_row_and_of_nothing(spark, no_docs):
    one = [(4, "a\nb", None, "s", 3)]
    assert [tuple(r) for r in merkle.summary(merkle.verified(docs_of(spark, one))).collect()] == [
        (4, *[brute_manifest(one)[0][1]] * 3, hashlib.sha256(b"").hexdigest(), brute_manifest(one)[0][1], True)
    ]
    assert merkle.verified(no_docs).collect() == [] and merkle.build(merkle.leaves(no_docs)).root is None


def test_places_with_a_hot_group(spark):
    r = random.Random(8)
    data = [(r.choice(["a", "a", "b", "c"]), r.choice([None, *range(50)]), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k bigint, tie bigint")
    got = {x["tie"]: (x["rank"], x["n"]) for x in positions.placed(df, "g", [F.col("k"), F.col("tie")], "t").collect()}
    for g in "abc":
        mine = sorted((x for x in data if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        assert [got[x[2]] for x in mine] == [(i, len(mine)) for i in range(len(mine))]


# --- SimHash --------------------------------------------------------------------------------------


def brute_simhash(text):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words_of(text)]
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, most):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_fingerprints_are_those_of_brute_force(rows):
    for _, text, *_ in rows:
        assert vantage.simhash(None if text is None else text.encode()) == brute_simhash(text)


def near_values(r, n, centres, flips):
    c = [r.getrandbits(64) for _ in range(centres)]
    out = set()
    for _ in range(n):
        x = r.choice(c)
        for _ in range(r.randrange(flips + 1)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("centres, flips, parts", [(4, 6, 3), (300, 5, 3), (1, 9, 3), (40, 8, 1), (40, 6, 2), (600, 3, 5)])
def test_links_connect_what_all_pairs_connect(spark, centres, flips, parts):
    values = near_values(random.Random(centres * flips), 900, centres, flips)
    settings = vantage.Settings(parts=parts, shard_rows=60)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint").repartition(3)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    found = vantage.links(df, settings).collect()
    assert len(found) <= 3 * parts * 60 * len(values)
    for a, b in ((x["a"] % (1 << 64), x["b"] % (1 << 64)) for x in found):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {v: find(v) for v in values} == brute_roots(values, settings.most_bits)


def test_every_value_lives_in_one_shard_and_pairs_meet():
    r = random.Random(2)
    values = np.array(near_values(r, 3000, 500, 4), np.uint64)
    for mask in vantage.Settings().masks:
        tree = vantage.planted(values[::7], mask, 1, 20)
        homes, seen = {}, {}
        for shard, living, visiting in tree.routed(values):
            homes.update(dict.fromkeys(living.tolist(), shard))
            seen[shard] = {*living.tolist(), *visiting.tolist()}
        assert len(homes) == len(values) and len(seen) > 8
        for i in range(0, len(values), 5):
            near = np.bitwise_count((values ^ values[i]) & mask) <= 1
            for other in values[near].tolist():
                a = int(values[i])
                assert {a, other} <= seen[homes[a]] or {a, other} <= seen[homes[other]]


def test_near_copies_query_against_brute_force(spark, rows, tmp_path):
    r = random.Random(9)
    base = [f"q{r.randrange(5000)}" for _ in range(400)]
    more = []
    for i in range(400, 440):
        copy = list(base)
        copy[r.randrange(400)] = f"z{i}"
        more.append((i, " ".join(copy), "en", "s", 1))
    everything = [*rows, *more, more[0]]
    docs_of(spark, everything).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op13_vantage_simhash"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    prints = {t: brute_simhash(t) for t in {x[1] for x in everything}}
    roots = brute_roots(sorted(set(prints.values())), 4)
    least = {}
    for d, t, *_ in everything:
        if d is not None:
            k = roots[prints[t]]
            least[k] = min(d, least.get(k, d))
    want = Counter((d, f"{prints[t]:016x}", least.get(roots[prints[t]])) for d, t, *_ in everything)
    got = Counter(tuple(x) for x in out.collect())
    assert got == want
    assert len({k[2] for k in got if k[0] and k[0] >= 400}) < 20


def test_near_copies_of_nothing(no_docs):
    assert vantage.near_copies(no_docs).collect() == []
