"""Every registered query against its SQL text."""

import os

import pytest

from oracle import compare, connect
from stillroom.plans import PLANS, SQL, load_all

SF_DIR = os.environ.get("STILLROOM_SF_DIR", "/root/testdata/sf0.001")
load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(PLANS) == set(SQL)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(PLANS[name](spark, SF_DIR), con, SQL[name]) == ""


def test_definitions_of_tables_beyond_the_usual(spark, tmp_path):
    """A folder of other tables than those of the benchmark: each of them is defined, whatever its name."""
    spark.sql("SELECT 1L AS id, 'x' AS name, 2.0D AS value").coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 1 AS k, array(1.0F) AS v").coalesce(1).write.parquet(f"{tmp_path}/further.parquet")
    found = PLANS["table_definitions"](spark, str(tmp_path))
    own = connect(str(tmp_path / "none"))
    for name in ("nation", "further"):
        own.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert found.count() == 5 and compare(found, own, SQL["table_definitions"]) == ""
