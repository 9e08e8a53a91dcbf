"""A study from raw files to metrics, on the smallest table written as monthly files."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import replace

import duckdb
import pytest

from ebbflow.plans import turnover
from ebbflow.plans.sql import oracle
from ebbflow.settings import NATIONAL, REGIONAL
from ebbflow.sources.samples import raw_movements

COLUMNS = (
    "competênciamov",
    "uf",
    "seção",
    "idade",
    "graudeinstrução",
    "cbo2002ocupação",
    "sexo",
    "salário",
    "saldomovimentação",
    "categoria",
)


@pytest.fixture(scope="module")
def raw_folder(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    files = defaultdict(list)
    for row in raw_movements(spark, small).collect():
        files[row["competênciamov"]].append(";".join(row[c] or "" for c in COLUMNS))
    for i, (month, lines) in enumerate(files.items()):
        header = ";".join(COLUMNS)
        if i % 2:  # half of the files use the other salary name
            header = header.replace("salário", "ValorSalárioFixo")
        year = int(month[:4]) + 25  # into the range of real file names
        path = folder / f"LABORMOV{year}{month[4:]}.txt"
        path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    (folder / "LABORFOR202001.txt").write_text(";".join(COLUMNS) + "\n", encoding="utf-8")
    return str(folder)


def test_national_study_up_to_silver(spark, raw_folder, tmp_path):
    base = str(tmp_path / "study")
    turnover.ingest(spark, raw_folder, base, NATIONAL)
    turnover.build_target(spark, base, NATIONAL)
    silver = turnover.build_silver(spark, base, NATIONAL)
    assert set(NATIONAL.features.columns) <= set(silver.columns)
    assert {r.quarter for r in silver.select("quarter").distinct().collect()} == {"Q1", "Q2", "Q3", "Q4"}


def test_study_end_to_end(spark, small, raw_folder, tmp_path):
    study = replace(REGIONAL, region_codes=None)
    base = str(tmp_path / "study")
    metrics = turnover.run(spark, raw_folder, base, study, tuned=False)
    assert {r.model for r in metrics.collect()} == {
        "baseline",
        "logistic_regression",
        "random_forest",
    }
    bronze = spark.read.parquet(f"{base}/bronze")
    con = duckdb.connect()
    for name in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    valid = "FROM raw WHERE section IS NOT NULL AND balance IN (1, -1)"
    n, cohorts = con.execute(
        oracle(
            f"""SELECT count(*), (SELECT count(*) FROM (SELECT DISTINCT comp, region, section,
            CASE WHEN age < 14 THEN 0 WHEN age < 18 THEN 1 WHEN age < 25 THEN 2
              WHEN age < 35 THEN 3 WHEN age < 45 THEN 4 WHEN age < 55 THEN 5
              WHEN age < 65 THEN 6 ELSE 7 END {valid})) {valid}""",
            "raw",
        )
    ).fetchone()
    assert bronze.count() == n
    assert spark.read.parquet(f"{base}/cohorts").count() == cohorts
    silver = spark.read.parquet(f"{base}/silver")
    assert silver.count() == spark.read.parquet(f"{base}/target_audit").count()
    assert not any("6m" in c for c in spark.read.parquet(f"{base}/modelling").columns)
    keys = spark.read.json(f"{base}/reports/keys").first()
    assert keys.n_duplicates == 0
    again = turnover.train(spark, base, study, tuned=False)
    assert {r.run for r in again.collect()} == {2}
    assert spark.read.parquet(f"{base}/metrics").count() == 6
