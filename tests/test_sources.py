from __future__ import annotations

import gzip
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import cleaning as cl
from ebbflow.operators.quality import schema_diff
from ebbflow.sources import delimited, files, layers, naming, sinks
from ebbflow.streaming import ingest_new_files

HEADER = " CompetênciaMov ;uf;Seção;idade;graudeinstrução;cbo2002ocupação;sexo;{};saldomovimentação;categoria"
ROWS = [
    "202401;21;G;30;7;521110;1;1412,50;1;101",
    "202401;35;G;31;7;521110;1;1500,00;-1;101",
    "202401;22;;32;7;521110;1;1500,00;-1;101",
    "202401;22;C;abc;7;521110;1;abc;-1;101",
    "202401;22;C;40;7;521110;1;;0;101",
    "202401;22;C;40;7;521110;1;900;x;101",
]


def write(folder, name, salary="salário", rows=ROWS):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join([HEADER.format(salary), *rows]) + "\n", encoding="utf-8")
    return str(path)


def test_file_names(spark):
    names = [
        "LABORMOV202412.7z",
        "laborfor202501.7z",
        "X202401.7z",
        "LABORMOV202413.7z",
        "LABOREXC199912.7z",
        "LABORMOV202401.txt",
    ]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    rows = {r.file_name: r for r in files.file_name_fields(df).collect()}
    assert [rows[n].recognised for n in names] == [True, True, False, False, False, True]
    assert (rows[names[1]].family, rows[names[1]].month) == ("FOR", "202501")
    assert rows[names[3]].family is None
    strict = files.file_name_fields(df, prefix="OTHER").filter("recognised").count()
    assert strict == 0


def test_copies_and_second_files_of_a_month(spark):
    names = ["LABORMOV202401.txt", "OLDLABORMOV202401.txt", "LABORMOV202401.txt.bak", "LABORFOR202401.txt"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    none = spark.createDataFrame([], "file_name string")
    status = {r.file_name: r.status for r in files.ingest_manifest(df, none).collect()}
    assert [status[n] for n in names] == ["new", "duplicate", "unrecognised", "new"]
    done = spark.createDataFrame([(names[1],)], "file_name string")
    status = {r.file_name: r.status for r in files.ingest_manifest(df, done).collect()}
    assert [status[n] for n in names[:2]] == ["duplicate", "ingested"]


def test_header_drift_gives_one_column(spark, tmp_path):
    first = write(tmp_path, "LABORMOV202401.txt", " Salário ")
    second = write(tmp_path, "LABORMOV202402.txt", "ValorSalárioFixo")
    raw = delimited.read_movement_files(spark, [first, second])
    salaries = {
        (r.month, r.salary) for r in raw.filter("age = '30'").select("month", "salary").collect()
    }
    assert salaries == {("202401", "1412,50"), ("202402", "1412,50")}
    with pytest.raises(FileNotFoundError):
        delimited.read_movement_files(spark, first, family="EXC")
    assert "municipality" in raw.columns and raw.filter("municipality is not null").isEmpty()


def test_clean_counts_rejections(spark, tmp_path):
    path = write(tmp_path, "LABORMOV202401.txt")
    rows = cl.typed(delimited.read_movement_files(spark, path))
    reasons = {r.reason: r.n for r in cl.rejected_counts(rows).collect()}
    assert reasons == {"valid": 3, "section": 1, "balance": 2}
    valid = cl.valid_movements(cl.in_regions(rows, (21, 22)))
    assert {(r.region, r.age, r.salary) for r in valid.collect()} == {
        (21, 30, 1412.5),
        (22, None, None),
    }


def test_compressed_files_and_folders(spark, tmp_path):
    text = "\n".join([HEADER.format("salário"), *ROWS]) + "\n"
    packed = tmp_path / "LABORMOV202403.txt.gz"
    packed.write_bytes(gzip.compress(text.encode("utf-8")))
    assert delimited.read_movement_files(spark, str(packed)).count() == 6
    folder = str(tmp_path / "text")
    spark.createDataFrame([("21", "G")], ["uf", "seção"]).write.options(header=True, sep=";").csv(folder)
    row = delimited.scan_delimited(spark, folder).first()
    assert (row["uf"], row["seção"]) == ("21", "G")


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("uf;seção\n21;G\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("seção;uf\nC;22\n", encoding="utf-8")
    (tmp_path / "empty.txt").write_text("", encoding="utf-8")
    rows = delimited.scan_delimited(spark, str(tmp_path)).filter("uf is not null")
    assert {(r["uf"], r["seção"]) for r in rows.collect()} == {("21", "G"), ("22", "C")}


def test_families_are_compared_by_schema(spark, tmp_path):
    """Exclusion files carry two columns the movement files lack; late ones none."""
    mov = write(tmp_path, "LABORMOV202412.txt")
    late = write(tmp_path, "LABORFOR202412.txt", rows=ROWS[:2])
    gone = tmp_path / "LABOREXC202412.txt"
    extra = ";".join([HEADER.format("salário"), "competênciaexc", "indicadordeexclusão"])
    gone.write_text("\n".join([extra, *[f"{r};202412;1" for r in ROWS[:3]]]), encoding="utf-8")
    tables = {
        name: delimited.scan_delimited(spark, path).drop("file_name", delimited.CORRUPT)
        for name, path in (("MOV", mov), ("EXC", str(gone)), ("FOR", late))
    }
    found = {(r.table_name, r.n_rows, r.exclusive_column) for r in schema_diff(tables).collect()}
    assert found == {
        ("MOV", 6, None),
        ("FOR", 2, None),
        ("EXC", 3, "competênciaexc"),
        ("EXC", 3, "indicadordeexclusão"),
    }
    every = delimited.read_movement_files(spark, [mov, late, str(gone)], family=None)
    assert {(r.family, r["count"]) for r in every.groupBy("family").count().collect()} == {
        ("MOV", 6),
        ("FOR", 2),
        ("EXC", 3),
    }


def test_corrupt_rows_are_kept_apart(spark, tmp_path):
    path = write(tmp_path, "LABORMOV202401.txt", rows=["202401;21;G;30", ROWS[0]])
    # whole rows are parsed: with fewer columns asked for, a short row need not be short
    raw = delimited.scan_delimited(spark, path).cache()
    bad = raw.filter(F.col(delimited.CORRUPT).isNotNull())
    assert [r.uf for r in bad.collect()] == ["21"]


def test_same_month_twice_is_one_copy(spark, tmp_path):
    base = str(tmp_path / "bronze")
    df = spark.createDataFrame(
        [("202401", 1), ("202401", 2), ("202402", 3)], "month string, v int"
    )
    sinks.write_months(df, base)
    sinks.write_months(df.filter("month = '202401'").withColumn("v", F.col("v") * 10), base)
    stored = sinks.read_table(spark, base)
    assert sorted(r.v for r in stored.collect()) == [3, 10, 20]
    assert "competencia" in stored.columns


def test_delivered_month_without_rows_is_emptied(spark, tmp_path):
    base, source = str(tmp_path / "bronze"), str(tmp_path / "source")
    rows = [("202401", 1), ("202402", 2), ("202403", 3)]
    spark.createDataFrame(rows, "month string, v int").write.parquet(source)
    df = spark.read.parquet(source)
    sinks.write_months(df, base, months=["202401", "202402", "202403"])
    again = df.filter("month = '202401'").withColumn("v", F.col("v") * 10)
    for rebalance in (False, True):
        sinks.write_months(again, base, rebalance=rebalance, months=["202401", "202402"])
        assert sorted(r.v for r in sinks.read_table(spark, base).collect()) == [3, 10]
    none = spark.createDataFrame([], df.schema)
    sinks.write_months(none, base, months=["202401"])
    assert [r.v for r in sinks.read_table(spark, base).collect()] == [3]


def test_readback_report(spark, tmp_path):
    base = str(tmp_path / "silver")
    df = spark.createDataFrame(
        [(2023, 1, "a"), (2023, 0, ""), (2024, 1, None)], "year int, high_turnover int, s string"
    )
    sinks.write_partitioned(df, base, "year")
    row = sinks.readback_report(df, base, "year", "high_turnover").first()
    assert (row.rows_before, row.rows_after, row.rows_match, row.success_marker) == (3, 3, True, True)
    assert (row.n_partitions, row.n_label_1, row.n_blank_cells) == (2, 2, 2)
    assert row.n_files == spark.read.parquet(base).select("_metadata.file_path").distinct().count() >= 2
    short = sinks.readback_report(df.limit(2), base).first()
    assert not short.rows_match


def test_manifest_statuses(spark):
    listed = spark.createDataFrame(
        [("AMOV202401.txt",), ("AMOV202402.txt",), ("AFOR202401.txt",), ("junk.txt",)],
        "file_name string",
    )
    done = spark.createDataFrame([("AMOV202401.txt",)], "file_name string")
    got = {
        r.file_name: r.status for r in files.ingest_manifest(listed, done, family="MOV").collect()
    }
    assert got == {
        "AMOV202401.txt": "ingested",
        "AMOV202402.txt": "new",
        "AFOR202401.txt": "filtered",
        "junk.txt": "unrecognised",
    }
    only = files.ingest_manifest(listed, done, month="202402").filter("status = 'new'")
    assert [r.file_name for r in only.collect()] == ["AMOV202402.txt"]


def test_upsert_keeps_latest_run(spark):
    schema = "model string, run int, auc double"
    stored = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.6)], schema)
    new = spark.createDataFrame([("b", 2, 0.7), ("c", 2, 0.8)], schema)
    rows = sinks.upsert_metrics(stored, new).orderBy("model").collect()
    assert [tuple(r) for r in rows] == [("a", 1, 0.5), ("b", 2, 0.7), ("c", 2, 0.8)]


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_reports(spark, tmp_path, kind):
    base = str(tmp_path / kind)
    sinks.write_report(spark.createDataFrame([("a", 0.5)], "model string, auc double"), base, kind)
    reader = spark.read.option("header", True)
    back = reader.csv(base) if kind == "csv" else reader.json(base)
    assert back.first().model == "a"


def test_published_names_round_trip(spark, tmp_path):
    """A month table written under the published names feeds the operators."""
    schema = ["competênciamov", "uf", "seção", "idade", "saldomovimentação"]
    base = str(tmp_path / "theirs")
    published = spark.createDataFrame([("202401", 21, "G", 30, 1)], schema)
    published.write.parquet(f"{base}/competencia=202401")
    ours = naming.from_published(spark.read.parquet(base))
    assert cl.valid_movements(ours).count() == 1
    assert {"month", "region", "section", "age", "balance"} < set(ours.columns)
    back = naming.to_published(ours).drop("competencia")
    assert back.columns == published.columns
    assert len(set(naming.NATIONAL_NAMES.values())) == len(naming.NATIONAL_NAMES)


def fake_session(master, named=None):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    context = SimpleNamespace(
        master=master,
        applicationId="fake-app",
        getConf=lambda: SimpleNamespace(get=lambda key: None),
        getCheckpointDir=lambda: None,
    )
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_layers_use_the_named_folder(spark):
    layer = layers.materialise(spark.range(5), "five")
    assert layer.count() == 5
    assert f"{layers.shared_folder(spark)}/ebbflow/" in layer.inputFiles()[0]
    assert layers.shared_folder(fake_session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError):
        layers.shared_folder(fake_session("yarn"))
    local = layers.shared_folder(fake_session("local[2]"))
    assert local == layers.shared_folder(fake_session("local[2]"))


def test_stream_ingests_each_file_once(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "bronze")
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        ingest_new_files(spark, str(raw), base, checkpoint).awaitTermination()
        stored = spark.read.parquet(base)
        return {(r.month, r["count"]) for r in stored.groupBy("month").count().collect()}

    write(raw, "LABORMOV202401.txt")
    write(raw, "LABORFOR202401.txt")
    write(raw, "notes.txt")
    assert run() == {("202401", 3)}
    assert run() == {("202401", 3)}
    write(raw, "LABORMOV202402.txt", "valorsaláriofixo")
    assert run() == {("202401", 3), ("202402", 3)}
