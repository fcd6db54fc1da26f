from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def test_find_differences_sql_states_the_rule_of_the_query(spark, tmp_path):
    """A line of the one order that equals another's after the change is on both sides."""
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    spark.createDataFrame([(7, 1, 5.0), (7, 1, 6.0), (7, 2, 1.0), (8, 1, 1.0), (8, 1, 1.0)], "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = entry.queries()["find_differences"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert sorted(map(tuple, found)) == sorted(con.execute(entry.oracle_sql()["find_differences"]).fetchall())
    assert sorted(map(tuple, found)) == [(7, 1, 5.0, "a", 1), (7, 1, 7.0, "b", 1), (7, 2, 1.0, "a", 1), (7, 2, 2.0, "b", 1)]
