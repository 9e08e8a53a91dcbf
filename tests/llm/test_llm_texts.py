from __future__ import annotations

import hashlib
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ebbflow.llm import bitpack, imatch, licences, packing, repetition
from ebbflow.llm.queries import FILE_END, FILE_VOCABULARY, PACK_END, PACK_VOCABULARY, QUERIES

WORDS = re.compile("[^\x20\x09-\x0d]+")


def in_order(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


# --- fingerprints ---------------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_range", [6, 10_000])
def test_fingerprints_of_edited_texts(spark, hard_docs, hard_rows, rows_per_range, monkeypatch):
    monkeypatch.setattr(imatch.with_next_text, "__defaults__", (rows_per_range,))
    rows = imatch.fingerprints(hard_docs).collect()
    ordered = in_order([(d, t or "") for d, t, *_ in hard_rows])
    want = Counter()
    for i, (d, t) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + following[:q]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    text = {d: t or "" for d, t, *_ in hard_rows}
    by_text = {}
    for r in rows:
        by_text.setdefault(text[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by_text.values())
    long = [r for r in rows if r["n_chars"] > 500 and r["doc_id"] < 40]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.3 + sum(r["near_next"] for r in long) / len(long)


def test_fingerprint_hashes_sorted_terms_of_each_subset(spark):
    df = spark.createDataFrame([("b a a c",), ("c, B; A",), ("c b",)], "text string")
    got = [r["fp"] for r in imatch.with_fingerprint(df, "text", "fp", []).collect()]
    assert got[0] == got[1] != got[2]


def test_lexicon_keeps_the_band(spark):
    docs = spark.createDataFrame([(i, f"all half{i % 2} rare{i} pair{i // 2}") for i in range(20)], "doc_id bigint, text string")
    terms = {r["h"] for r in docs.selectExpr("explode(array(xxhash64('half0'), xxhash64('half1'))) h").collect()}
    band = imatch.Band(rarest=0.3, commonest=0.6)
    assert set(imatch.lexicon(docs, band)) == terms
    bounded = imatch.lexicon(docs, imatch.Band(rarest=0.0, commonest=1.0, most_terms=5))
    assert len(bounded) <= 5


def test_fingerprints_of_nothing(no_docs):
    assert imatch.fingerprints(no_docs).collect() == []


# --- repetition -----------------------------------------------------------------------------


def brute_measure(text):
    words = WORDS.findall(text or "")
    threes = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if threes[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines, n_lines = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            n_lines += line in lines
            lines.add(line)
    total = sum(map(len, words))
    share = 0.0
    for n, _ in repetition.N_GRAM_LIMITS:
        seen, held = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if gram in seen:
                held.update(range(i, i + n))
            seen.add(gram)
        share = max(share, sum(len(words[i]) for i in held) / total if total else 0.0)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), total, symbols, n_lines, len(inside), failed, round(share, 9))


def test_repetition_matches_brute_force(hard_docs, hard_rows):
    got = Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], round(r["dup_gram_share"], 9))
        for r in repetition.judged(hard_docs).collect()
    )
    assert got == Counter((d, *brute_measure(t)) for d, t, *_ in hard_rows)


def test_repetition_verdicts(hard_docs, hard_rows, no_docs):
    kept = {r["doc_id"] for r in repetition.judged(hard_docs).collect() if r["kept"]}
    assert {10, 20, 82} <= kept and not kept & {75, 76, 77, 84, 86}
    good = repetition.keep_good(hard_docs)
    assert good.columns == hard_docs.columns
    assert {r["doc_id"] for r in good.collect()} == kept
    assert repetition.judged(no_docs).collect() == []


def test_repetition_on_test_table_matches_brute_force(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op2_repetition_coverage"](spark, small).collect():
        want = brute_measure(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want[:6]
        assert not (r["kept"] and r["base_failed"])


# --- packing --------------------------------------------------------------------------------


def plain_ids(path, text, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def blob(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("longest", [1, 8, 2048])
def test_packing_returns_every_id_once(hard_docs, hard_rows, longest):
    docs = hard_docs.filter("doc_id <> 82") if longest == 1 else hard_docs
    pieces = packing.pack(docs, PACK_VOCABULARY, PACK_END, longest).collect()
    ids = {d: plain_ids(PACK_VOCABULARY, t, PACK_END) for d, t, *_ in hard_rows}
    assert sorted(p["sequence_id"] for p in pieces) == list(range(len(pieces)))
    by_doc = {}
    for p in pieces:
        assert p["length"] & (p["length"] - 1) == 0 and p["length"] <= longest and p["offset"] == 0
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
        assert bytes(p["ids"]) == blob(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]])
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    copies = Counter(d for d, *_ in hard_rows)
    for d, parts in by_doc.items():
        covered = sorted(i for s, n in parts for i in range(s, s + n))
        assert covered == sorted(list(range(len(ids[d]))) * copies[d])
    # one bucket after the other, longest first
    order = [p["length"] for p in sorted(pieces, key=lambda p: p["sequence_id"])]
    assert order == sorted(order, reverse=True)


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, PACK_VOCABULARY, PACK_END).collect() == []
    with pytest.raises(ValueError):
        packing.pack(no_docs, PACK_VOCABULARY, PACK_END, 1000)


# --- bit packing ----------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bits_round_trip_and_random_access(bits):
    r = np.random.default_rng(bits)
    ids = r.integers(0, 2**bits, 1003, dtype=np.uint64).astype(np.uint32)
    payload, offsets = bitpack.pack_ids(ids, bits, 64)
    assert len(payload) == sum((min(64, 1003 - i) * bits + 7) // 8 for i in range(0, 1003, 64))
    segment = {"payload": payload, "block_offsets": offsets, "block_ids": 64, "bits": bits, "n_ids": 1003}
    for s, e in [(0, 1003), (0, 0), (63, 65), (500, 501), (1000, 1003)]:
        assert bitpack.read_ids(segment, s, e).tolist() == ids[s:e].tolist()
    assert bitpack.bits_for(49_408) == 16 and bitpack.bits_for(1) == 1


@pytest.mark.parametrize("rows_per_range", [9, 10_000])
def test_token_files_round_trip(spark, hard_docs, hard_rows, rows_per_range, monkeypatch):
    monkeypatch.setattr(bitpack, "ROWS_PER_RANGE", rows_per_range)
    monkeypatch.setattr(bitpack, "SEGMENT_IDS", 5_000)
    path = bitpack.new_file_set(spark)
    bitpack.write_ids(hard_docs, FILE_VOCABULARY, FILE_END, path, block_ids=128)
    got = Counter(tuple(r) for r in bitpack.read_documents(spark, path).collect())
    start, want = 0, Counter()
    for d, t in in_order([(d, t) for d, t, *_ in hard_rows]):
        ids = plain_ids(FILE_VOCABULARY, t, FILE_END)
        want[(d, start, len(ids), crc32(blob(ids)))] += 1
        start += len(ids)
    assert got == want
    assert bitpack.read_segments(spark, path).count() > 3


def test_token_files_of_nothing(spark, no_docs):
    path = bitpack.new_file_set(spark)
    bitpack.write_ids(no_docs, FILE_VOCABULARY, FILE_END, path)
    assert bitpack.read_documents(spark, path).collect() == []


# --- licences -------------------------------------------------------------------------------

MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use it.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
MIXED = ["prose. Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "nothing licensed here", None, "", "x\nReleased under the MIT License.\ny",
         "This work is licensed under the GNU General Public License, version 3.", "The copyright notice stays.", MIT, MIT.replace("\n\n", "\n"),
         "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.",
         "A warranty " * 3000]


def test_licence_rules(spark):
    docs = spark.createDataFrame(list(enumerate(MIXED)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["licences"] for r in licences.scanned(docs).collect()}
    assert [got[i] for i in range(8)] == ["CC-BY-NC-4.0", "CC-BY-4.0", "", "", "", "MIT", "GPL-3.0", ""]
    assert got[8] == got[9] == "MIT" and got[10] == "Apache-2.0,SPDX"


# a sentence of each identifier
EXAMPLES = {
    "SPDX": "SPDX-License-Identifier: MIT", "COPYRIGHT": "Copyright (c) 2020 Some Body", "ALLRIGHTS": "All rights reserved.",
    "APACHE2": "Released under the Apache License, Version 2.0.", "COMPLIANCE": "you may not use this file except in compliance with the License.",
    "OBTAINCOPY": "You may obtain a copy of the License at", "SEELICENSE": "See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "The MIT License", "GPL3": "GNU General Public License, version 3", "GPL2": "GNU General Public License version 2.0.",
    "LGPL": "GNU Lesser General Public License version 2.1", "MPL2": "This Source Code Form is subject to the terms of the Mozilla Public License, v.2.0.",
    "CCBYNC4": "Distributed under CC BY-NC 4.0.", "CCBYSA4": "CC BY-SA 4.0", "CCBY4": "Released under CC BY 4.0.", "PUBLICDOMAIN": "This work is in the public domain.",
}


def test_licence_sentences_need_no_cue(spark):
    rows = [(i, f"Some prose. {t}") for i, t in enumerate(EXAMPLES.values())]
    out = licences.scanned(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["sentence_ids"] for r in out} == {i: f",{n}," for i, n in enumerate(EXAMPLES)}
    bare = {n for i, n in enumerate(EXAMPLES) for r in out if r["doc_id"] == i and r["n_cue_sentences"] == 0}
    assert bare == {"ALLRIGHTS", "CCBYNC4", "CCBYSA4", "CCBY4"}


# canonical notices at their usual wrapping
NOTICES = [
    ("BSD-3-Clause", """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""),
    ("GPL", """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("Apache-2.0", """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""),
    ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Some Body"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not\ndistributed with this file, You can obtain one."),
    ("LGPL", "Licensed under the GNU Lesser General Public\nLicense version 2.1."),
]


def test_licence_notices_wrapped_as_usual(spark):
    bare = [(n, t.replace("# ", "").replace("#", "")) for n, t in NOTICES]
    starred = [(n, "/*\n" + "\n".join(f" * {x}" for x in t.split("\n")) + "\n */") for n, t in bare]
    cases = [*NOTICES, *bare, *starred]
    two = NOTICES[0][1].replace("3. Neither", "3. Or")
    cases.append(("BSD-2-Clause", two))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in licences.scanned(docs).collect()}
    assert [out[i]["licences"].split(",")[0] for i in range(len(cases))] == [n for n, _ in cases]
    assert ",ALLRIGHTS," in out[0]["sentence_ids"] and ",BSDASIS," in out[0]["sentence_ids"]
    for i in (8, 14):
        assert ",COMPLIANCE,,OBTAINCOPY,,ASISBASIS,,SEELICENSE," in out[i]["sentence_ids"]


def test_licence_query_on_test_table_keeps_sentences_without_cue(spark, small):
    docs = spark.read.parquet(f"{small}/../sf0.01/documents.parquet")
    said = {r["doc_id"] for r in docs.collect() if re.search(r"[.!?;]\s+All rights reserved\.(\s|$)", r["text"])}
    found = {r["doc_id"] for r in licences.scanned(docs).collect() if ",ALLRIGHTS," in r["sentence_ids"]}
    assert said and said <= found


def test_licence_rules_by_sql(spark, hard_docs, no_docs):
    texts = [*MIXED, *[r["text"] for r in hard_docs.collect()]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ours = licences.scanned(docs)
    con = duckdb.connect()
    frame = docs.toPandas()
    con.register("frame", frame)
    con.execute("CREATE VIEW documents AS SELECT doc_id, text FROM frame")
    theirs = con.sql(licences.scan_sql())
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())
    assert licences.scanned(no_docs).collect() == []
    # sequences keep their order
    assert licences.rule_pattern(("A", "B")) == "%,A,%,B,%"


def test_runs_are_cut_by_string_methods_as_by_the_expression():
    import random
    import re
    import sys

    from ebbflow.llm import tokens

    white = {c for c in map(chr, range(sys.maxunicode + 1)) if re.match(r"\s", c)}
    assert white - set(" \n") == set(tokens.OTHER_WHITE)
    assert all(tokens._other_white(f"a b{c}\u4e00") for c in tokens.OTHER_WHITE)
    assert not tokens._other_white("a b\nc\u4e00 \U0001f600\u200b")
    r = random.Random(7)
    texts = ["", " ", "\n", "a", " a ", "a\n \n b \n", "\n\n\na  b"]
    texts += ["".join(r.choices(" \nab\u00e9.\u4e00", k=r.randrange(30))) for _ in range(3000)]
    for text in texts:
        assert tokens._chunks(text) == re.findall(r"[ \n]*[^ \n]+|[ \n]+", text), repr(text)
