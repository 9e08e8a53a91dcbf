"""Deliveries, quarantined lines, late filings and exclusions."""

from __future__ import annotations

import gzip
import random
from collections import Counter

import pytest

from ebbflow.operators import filings
from ebbflow.plans import turnover
from ebbflow.settings import NATIONAL
from ebbflow.sources import landing, sinks

A = "competênciamov;uf;seção;idade;graudeinstrução;cbo2002ocupação;sexo;salário;saldomovimentação;categoria"
B = "Categoria;SaldoMovimentação;ValorSalárioFixo;Salário;Sexo;CBO2002Ocupação;GraudeInstrução;FaixaEtária;Seção;UF;Nova"


@pytest.fixture()
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "XMOV202301.txt").write_text(
        "﻿" + A + "\n202301;21;A;30;7;111;1;1000,50;1;101\n202301;21;B;30;7;111;1;x;-1;101\n"
        '202301;21;A;30;7;111;1;1;1\n202301;99;"A;B";30;7;111;1;1;1;101\n202301;21;A;30;"7;111;1;1;1;101\n'
        "202301;;A;30;7;111;1;1;1;101\n202301;21;;30;7;111;1;1;1;101\n202301;21;A;30;7;111;1;1;5;101\n\n",
        encoding="utf-8",
    )
    # other names and order, compressed; the first alias with a value wins
    body = B + "\n101;1;2000,25;;1;222;7;40;C;22;z\n101;-1;;3000;1;222;7;41;C;22;\n"
    with gzip.open(raw / "XMOV202302.csv.gz", "wb") as f:
        f.write(body.encode())
    whole = gzip.compress((A + "\n" + "202303;21;A;30;7;111;1;1;1;101\n" * 5000).encode())
    (raw / "XMOV202303.txt.gz").write_bytes(whole[: len(whole) // 2])
    (raw / "XMOV202304.txt.gz").write_bytes(b"no gzip at all")
    (raw / "XMOV202305.txt.gz").write_bytes(gzip.compress(b""))
    (raw / "XMOV202309.txt").write_text("")  # scans pass over a file of no bytes
    (raw / "XMOV202306.txt").write_text("a;b;c\n1;2;3\n")
    (raw / "XMOV202302.txt").write_text(A + "\n202302;21;D;1;7;1;1;1;1;101\n", encoding="utf-8")
    (raw / "XFOR202302.txt").write_text(A + "\n", encoding="utf-8")
    (raw / "notes.txt").write_text("hello\n")
    (raw / "XMOV202307").mkdir()
    (raw / "XMOV202307.txt").mkdir()
    (raw / "XMOV202307.txt" / "part-0000.txt").write_text(A + "\n202307;21;A;30;7;111;1;1;1;101\n", encoding="utf-8")
    (raw / "XMOV202307.txt" / "part-0001.txt").write_text(A + "\n202307;22;A;30;7;111;1;1;-1;101\n", encoding="utf-8")
    return str(raw)


def test_statuses_add_up_to_the_deliveries(spark, folder):
    deliveries, files = landing.manifest(spark, folder)
    got = {r.file_name: (r.status, r.problem) for r in deliveries.collect()}
    assert got == {
        "XMOV202301.txt": ("new", None),
        "XMOV202302.csv.gz": ("new", None),
        "XMOV202302.txt": ("duplicate", None),
        "XMOV202303.txt.gz": ("error", "truncated"),
        "XMOV202304.txt.gz": ("error", "unreadable"),
        "XMOV202305.txt.gz": ("error", "empty"),
        "XMOV202306.txt": ("error", "header"),
        "XMOV202307.txt": ("new", None),
        "XFOR202302.txt": ("filtered", None),
        "notes.txt": ("unrecognised", "header"),
    }
    assert files.count() == 11
    assert {r.n_files for r in deliveries.filter("file_name = 'XMOV202307.txt'").collect()} == {2}


def test_good_rows_and_quarantined_lines_are_all_lines(spark, folder, tmp_path):
    base = str(tmp_path / "landed")
    landing.land(spark, folder, base)
    rows = landing.movements(spark, base).collect()
    good = Counter((r.month, r.region, r.section, r.age, r.salary, r.balance) for r in rows)
    assert good == Counter(
        {
            ("202301", 21, "A", 30, 1000.5, 1): 1,
            ("202301", 21, "B", 30, None, -1): 1,
            ("202301", 99, "A;B", 30, 1.0, 1): 1,
            ("202302", 22, "C", 40, 2000.25, 1): 1,
            ("202302", 22, "C", 41, 3000.0, -1): 1,
            ("202307", 21, "A", 30, 1.0, 1): 1,
            ("202307", 22, "A", 30, 1.0, -1): 1,
        }
    )
    bad = [(r.file_name, r.reason, r.line) for r in landing.quarantine(spark, base).collect()]
    assert Counter(r[1] for r in bad) == {"fields": 1, "quote": 1, "region": 1, "section": 1, "balance": 1}
    assert ("XMOV202301.txt", "fields", "202301;21;A;30;7;111;1;1;1") in bad
    # other regions are neither; what has no region is kept apart all the same
    landing.land(spark, folder, base, region_codes=(22,))
    assert landing.movements(spark, base).count() == 3 and landing.quarantine(spark, base).count() == 5
    assert landing.movements(spark, base, ["202307"]).count() == 1


def test_latin_1_and_own_months(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "XMOV202301.txt").write_bytes((A + "\n202212;21;É;30;7;111;1;1;1;101\n").encode("latin-1"))
    spec = landing.Delivery(encoding="ISO-8859-1", month_from_name=False)
    landing.land(spark, str(raw), str(tmp_path / "l"), spec=spec)
    assert [(r.month, r.section) for r in landing.movements(spark, str(tmp_path / "l")).collect()] == [("202212", "É")]


@pytest.mark.parametrize(
    "data, problem",
    [(gzip.compress(b"a" * 5_000_000), None), (gzip.compress(b"a") + gzip.compress(b"b"), None), (b"", "empty"), (b"xyz", "unreadable"), (gzip.compress(b"abc" * 999)[:-9], "truncated")],
)
def test_inflation(data, problem):
    assert landing.inflation_problem(memoryview(data)) == problem


def test_damage_is_found_without_holding_a_file(spark, tmp_path):
    noise = random.Random(1).randbytes(3_000_000)
    whole = gzip.compress(noise)
    contents = {
        "whole": whole, "members": whole + gzip.compress(b"b"), "padded": whole + b"\0" * 5000, "cut": whole[:-9], "cut-early": whole[:1000],
        "feed": whole + b"\n", "feeds": whole + b"\n\n", "padded-feed": whole + b"\0\n", "returns": whole + b"\r\n", "only-feed": b"\n",
        "spoilt": whole[:1000] + b"xx" + whole[1002:], "marked": b"\xef\xbb\xbf" + whole, "text": b"a;b\n1;2\n", "byte": b"\x1f",
    }
    for name, content in contents.items():
        (tmp_path / f"{name}.txt.gz").write_bytes(content)
    (tmp_path / "plain.txt").write_text("a;b\n")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)  # a file as one value is refused
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)  # a file comes in many batches
    try:
        got = {r.file.split("/")[-1][: -len(".txt.gz")]: r.problem for r in landing.damaged(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {k: landing.inflation_problem(memoryview(v)) for k, v in contents.items()}
    assert got == {k: v for k, v in expected.items() if v}
    assert expected["feed"] == "truncated" and expected["feeds"] == "unreadable" and expected["padded"] is None


def test_lines_are_neither_sorted_nor_moved_to_their_headers(spark, folder):
    scanned = landing.lines(spark, folder)
    assert "SortAggregate" not in landing.headers(scanned)._jdf.queryExecution().toString()
    rows = landing.landed_rows(spark, folder, *landing.manifest(spark, folder))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(file" not in plan


def test_study_takes_new_deliveries_once(spark, folder, tmp_path):
    base = str(tmp_path / "study")
    assert turnover.ingest(spark, folder, base, NATIONAL).count() == 7
    assert turnover.ingest(spark, folder, base, NATIONAL).count() == 7
    late = A + "\n202308;21;A;30;7;111;1;1;1;101\n"
    (tmp_path / "raw" / "XMOV202308.txt").write_text(late, encoding="utf-8")
    (tmp_path / "raw" / "OLDXMOV202308.txt").write_text(late, encoding="utf-8")
    bronze = turnover.ingest(spark, folder, base, NATIONAL)
    assert bronze.count() == 8 and bronze.filter("month = '202308'").count() == 1
    statuses = Counter(r.status for r in sinks.read_table(spark, f"{base}/deliveries").collect())
    assert statuses["new"] == 4
    with pytest.raises(FileNotFoundError):
        turnover.ingest(spark, str(tmp_path / "raw" / "XMOV202307"), str(tmp_path / "none"), NATIONAL)


def test_columns_of_families(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "XMOV202301.txt").write_text("uf;seção;saldomovimentação;Salário\n", encoding="utf-8")
    (raw / "XMOV202302.txt").write_text("uf;seção;saldomovimentação\n", encoding="utf-8")
    (raw / "XEXC202301.txt").write_text("uf;seção;saldomovimentação;competênciaexc\n", encoding="utf-8")
    _, files = landing.manifest(spark, str(raw), None, landing.Delivery(family=None))
    got = {(r.family, r.column_name): (r.n_files, r.exclusive) for r in landing.family_columns(files).collect()}
    assert got[("MOV", "salário")] == (1, True) and got[("EXC", "competênciaexc")] == (1, True)
    assert got[("MOV", "uf")] == (2, False) and len(got) == 8


def test_exclusions_cancel_as_many_rows_as_they_are(spark, tmp_path):
    key = ("month", "region", "balance")
    frame = lambda rows: spark.createDataFrame(rows, "month string, region int, balance int")
    old = frame([("202301", 1, 1)] * 3 + [("202301", None, 1), ("202302", 1, 1)])
    late = frame([("202301", 2, -1), ("202303", 5, 1)])
    gone = frame([("202301", 1, 1)] * 2 + [("202301", None, 1), ("202301", 9, 9)])
    assert Counter(tuple(r) for r in filings.merged(old, late, gone, key).collect()) == Counter(
        [("202301", 1, 1), ("202302", 1, 1), ("202301", 2, -1), ("202303", 5, 1)]
    )
    assert [tuple(r) for r in filings.unmatched(old, late, gone, key).collect()] == [("202301", 9, 9)]
    base, target = str(tmp_path / "m"), str(tmp_path / "t")
    sinks.write_months(old, base, rebalance=True)
    assert filings.merge_into_months(spark, base, late, gone, target, key) == ["202301", "202303"]
    stored = sinks.read_table(spark, target)
    assert {r.month: r["count"] for r in stored.groupBy("month").count().collect()} == {"202301": 2, "202302": 1, "202303": 1}
    # a second set of filings touches its own months only
    more = frame([("202302", 7, 1)])
    filings.merge_into_months(spark, base, more, gone.limit(0), target, key)
    assert sinks.read_table(spark, target).count() == 5
