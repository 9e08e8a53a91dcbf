"""Every query with an oracle, on the smallest tables; the layout must not matter."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

ROOT = Path(__file__).resolve().parent.parent
_spec = importlib.util.spec_from_file_location("check_oracles", ROOT / "tools/check_oracles.py")
check_oracles = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check_oracles)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in sorted(Path(small).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_oracle(spark, duck, small, name):
    result = queries()[name](spark, small)
    assert check_oracles.difference(result, duck.sql(oracle_sql()[name])) is None


LAYOUT_QUERIES = ["turnover_label", "cohort_granularity", "auc_rank_slotted", "dominant_occupation"]


@pytest.mark.parametrize("name", LAYOUT_QUERIES)
def test_other_partitioning_without_broadcast(spark, duck, small, name):
    changed = {
        "spark.sql.shuffle.partitions": "13",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        result = queries()[name](spark, small)
        assert check_oracles.difference(result, duck.sql(oracle_sql()[name])) is None
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_entry(spark):
    assert {r.high_turnover for r in entry(spark).collect()} == {0, 1}
