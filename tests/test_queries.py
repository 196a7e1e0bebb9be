"""Every query of the flows against the same query in SQL on another engine; those on training text have tests of their own."""

from datetime import datetime
from pathlib import Path

import pytest

from __spark_entry__ import entry
from brooklet.plans.oracles import ORACLES
from brooklet.plans.queries import QUERIES
from check import differences, oracle_rows

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables here")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert differences(got, oracle_rows(SF_DIR, ORACLES[name])) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_lines_of_one_order_number_and_day_are_all_kept(spark, tmp_path):
    day = datetime(1995, 3, 12)
    lines = [(7, n, q, day) for n in (1, 2, 3) for q in (5.0, 5.0, 4.0)] + [(8, 2, 1.0, datetime(1995, 3, 20))]
    names = "l_orderkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["day_lookup"](spark, str(tmp_path)).collect()
    assert sorted((r["l_orderkey"], r["l_linenumber"], r["l_quantity"], r["l_shipdate"]) for r in got) == sorted(lines[:-1])
