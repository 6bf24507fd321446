"""Registered queries of the package over a whole small table."""

import pytest

import __spark_entry__
import check_oracle
from gaugeline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    ok, note = check_oracle.compare(spark, check_oracle.connect(SF), name, SF)
    assert ok, note


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    df = __spark_entry__.queries()[name](spark, SF)
    table = "pages" if name.startswith(("op3_", "op11_")) else "documents"
    rows = df.count()
    per_row = not name.startswith(("op1_", "op12_"))
    assert rows == spark.read.parquet(f"{SF}/{table}.parquet").count() if per_row else rows > 0
