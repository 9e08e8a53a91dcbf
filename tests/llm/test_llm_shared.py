from __future__ import annotations

import gc
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbflow.llm import tokens
from ebbflow.llm.components import components
from ebbflow.llm.ordering import range_of, running_totals, split_values
from ebbflow.llm.tokens import Encoder


def test_range_of_counts_edges_at_or_below(spark):
    edges = sorted(random.Random(1).sample(range(-500, 500), 90))
    rows = spark.createDataFrame([(k,) for k in [*range(-510, 510), None]], "k bigint")
    for got in rows.select("k", range_of(F.col("k"), edges).alias("r")).collect():
        assert got["r"] == (0 if got["k"] is None else sum(e <= got["k"] for e in edges))


@pytest.mark.parametrize("rows_per_range", [7, 50, 10_000])
def test_running_totals_follow_the_global_order(spark, rows_per_range):
    r = random.Random(2)
    # a third of the rows share one group; ids repeat and are null
    data = [
        (r.choice(["a", "a", "b", "c"]), r.choice([None, *range(60)]), i, r.randrange(9)) for i in range(400)
    ]
    df = spark.createDataFrame(data, "g string, k bigint, tie bigint, v bigint")
    got = {x["tie"]: x["v_before"] for x in running_totals(df, ["g"], ["k", "tie"], ["v"], rows_per_range).collect()}
    for g in "abc":
        so_far = 0
        mine = sorted((x for x in data if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        for _, _, tie, v in mine:
            assert got[tie] == so_far
            so_far += v
    assert len(got) == len(data)


def test_running_totals_without_groups_and_rows(spark):
    df = spark.createDataFrame([], "k bigint, v bigint")
    assert split_values(df, "k") == []
    assert running_totals(df, [], ["k"], ["v"]).collect() == []


def test_components_match_union_find(spark):
    r = random.Random(3)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = {x["node"]: x["root"] for x in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    for node in {n for l in links for n in l}:
        assert found.get(node, node) == find(node)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_runs_encode_like_whole_texts(name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = [
        None, "", " ", "\n\n", "a", "  two  blanks ", "line\n next\n\n  end \n", "tab\tand\x0bodd　space", "it's we'll, don't!",
        "ÀÉÎ ñandú ßtraße", "<|endoftext|> <|startoftext|>x", "é ́x", "日本語 テキスト", "x" * 5000, "İ Σς   z",
    ]
    encoder = Encoder(path)
    for _ in range(2):
        got = encoder.encode(texts)
        for text, blob in zip(texts, got):
            want = plain.encode(text or "", add_special_tokens=False).ids
            assert blob == b"".join(i.to_bytes(4, "little") for i in want), text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoding_sets_off_no_search_for_cycles(name):
    encoder, searches = Encoder(public_tokenizers.path(name)), []
    texts = [" ".join(f"{a}{b}{s}" for b in "abcdefghij") for a in ("Wort", "ñu") for s in ("", "...", "'s", ")!") for _ in range(500)]
    gc.collect()
    gc.callbacks.append(lambda phase, info: searches.append(phase))
    try:
        got = encoder.encode(texts)
    finally:
        gc.callbacks.pop()
    assert gc.isenabled() and not searches
    assert got == encoder._encode(texts)


ODD = [" ", " ", "\n", "\n\n", "  ", "a", "Z", "the", " of", "é", "ß", "÷", "ÿ", "\u0301", "\u0338", "<", ".", ",", "'", "'s", "n't", "1", "日", "ª", "Σ", "İ", "“", "\u200b", "\x00", "%%%"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_texts_encode_like_whole_ones_with_little_memory(name, monkeypatch):
    r = random.Random(3)
    texts = ["".join(r.choices(ODD, k=r.randrange(25))) for _ in range(2000)]
    encoder = Encoder(public_tokenizers.path(name))
    want = encoder._encode(texts)
    assert encoder.encode(texts) == want
    # many groups, and the memory is full and forgets
    monkeypatch.setattr(tokens, "LETTERS_AT_ONCE", 40)
    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    encoder.known = {}
    assert encoder.encode(texts) == want
    assert len(encoder.known) < 200


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_word_is_encoded_once_whatever_signs_and_line_feeds_are_beside_it(name, monkeypatch):
    encoder = Encoder(public_tokenizers.path(name))
    words = [f"{a}{b}ñe" for a in "abcdefgh" for b in "stuv"]
    texts = [" ".join(f"{w}{s}\n{w}{s} {w}" for w in words) for s in ("", ",", ".", "...", ")!")]
    want, merged, whole = encoder._encode(texts), [], []
    merge, encode = encoder.tokenize, encoder._encode
    monkeypatch.setattr(encoder, "tokenize", lambda word: merged.append(word) or merge(word))
    monkeypatch.setattr(encoder, "_encode", lambda runs: whole.extend(runs) or encode(runs))
    assert encoder.encode(texts) == want
    assert len(merged) <= 2 * len(words)  # with a blank before it and without
    assert not any(c.isalpha() for run in whole for c in run)
