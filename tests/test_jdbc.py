from unittest.mock import MagicMock

import pytest

from stillroom.schema import TypeMappingError, describe
from stillroom.sources.jdbc import HashPartitions, RangePartitions, SourceColumn, bounds, columns_from_description, connection_options, hash_predicates, jdbc_options, read_jdbc, source_schema, window_predicate

CONNECTION = {"host": "db", "database": "shop", "user": "u", "password": "p"}


@pytest.mark.parametrize(
    "dialect,url",
    [
        ("postgres", "jdbc:postgresql://db:5432/shop"),
        ("redshift", "jdbc:redshift://db:5439/shop"),
        ("mysql", "jdbc:mysql://db:3306/shop"),
        ("azuresql", "jdbc:sqlserver://db:1433;databaseName=shop"),
    ],
)
def test_connections(dialect, url):
    options = connection_options(dialect, CONNECTION)
    assert options["url"] == url and options["fetchsize"] == "10000"
    assert options["user"] == "u" and options["password"] == "p"


def test_bigquery_needs_no_host():
    assert "ProjectId=proj" in connection_options("bigquery", {"database": "proj"})["url"]


def test_connection_needs_its_parts():
    with pytest.raises(ValueError):
        connection_options("mysql", {"host": "db"})
    with pytest.raises(ValueError):
        connection_options("oracle", CONNECTION)
    assert connection_options("mysql", {"url": "jdbc:x:y"})["url"] == "jdbc:x:y"


def test_table_or_query_but_not_both():
    assert jdbc_options("azuresql", CONNECTION, table="dbo.Orders")["dbtable"] == "[dbo].[Orders]"
    assert jdbc_options("mysql", CONNECTION, query="SELECT 1")["query"] == "SELECT 1"
    for wrong in ({}, {"table": "t", "query": "SELECT 1"}):
        with pytest.raises(ValueError):
            jdbc_options("mysql", CONNECTION, **wrong)
    with pytest.raises(ValueError):
        jdbc_options("mysql", CONNECTION, table="orders; DROP TABLE x")


def test_range_partitions_of_a_query():
    options = jdbc_options("postgres", CONNECTION, query="SELECT * FROM t", partition=RangePartitions("id", 1, 100, 8))
    assert options["dbtable"] == "(SELECT * FROM t) q" and "query" not in options
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "100", "8")


def test_hash_partitions_cover_every_row_once(spark):
    from functools import reduce

    predicates = hash_predicates("mysql", HashPartitions("id", 3))
    df = spark.createDataFrame([(i,) for i in [*range(-7, 20), None]], "id long")
    parts = [df.filter(p) for p in predicates]
    assert sorted(str(r[0]) for r in reduce(lambda a, b: a.union(b), parts).collect()) == sorted(str(r[0]) for r in df.collect())


def test_custom_schema_from_overrides():
    options = jdbc_options("azuresql", CONNECTION, table="t", overrides={"amount": {"sqltype": "numeric", "precision": 18, "scale": 3}})
    assert options["customSchema"] == "`amount` decimal(18,3)"


def test_source_types():
    columns = [SourceColumn("id", 20, False), SourceColumn("name", 25), SourceColumn("price", 1700), SourceColumn("at", 1114)]
    assert describe(source_schema("postgres", columns)) == [
        ("id", "bigint", False),
        ("name", "string", True),
        ("price", "decimal(18,9)", True),
        ("at", "timestamp_ntz", True),
    ]
    with pytest.raises(TypeMappingError):
        source_schema("postgres", [SourceColumn("x", 99999)])
    assert describe(source_schema("postgres", [SourceColumn("x", 99999)], {"x": {"sqltype": "text"}})) == [("x", "string", True)]
    with pytest.raises(TypeMappingError):
        source_schema("bigquery", [SourceColumn("tags", "STRING", repeated=True)])


def test_cursor_description():
    import decimal

    described = [("id", int, None, 10, 10, 0, False), ("price", decimal.Decimal, None, 19, 19, 4, True)]
    assert describe(source_schema("azuresql", columns_from_description(described))) == [("id", "int", False), ("price", "decimal(19,4)", True)]


def test_window_predicate():
    assert window_predicate("LOAD_DATE", "2024-01-24", "azuresql") == "[LOAD_DATE] >= '2024-01-24'"
    with pytest.raises(ValueError):
        window_predicate("LOAD_DATE", "2024' OR 1=1 --", "mysql")


def test_reader_gets_the_options():
    spark = MagicMock()
    result = read_jdbc(spark, "postgres", CONNECTION, table="public.orders", partition=RangePartitions("id", 1, 9, 4))
    spark.read.format.assert_called_once_with("jdbc")
    options = spark.read.format.return_value.options.call_args.kwargs
    assert options["dbtable"] == '"public"."orders"' and options["numPartitions"] == "4"
    assert result is spark.read.format.return_value.options.return_value.load.return_value


def test_hash_partitions_become_one_predicate_per_task():
    spark = MagicMock()
    read_jdbc(spark, "azuresql", CONNECTION, query="SELECT * FROM t", partition=HashPartitions("id", 2))
    (url, source), kwargs = spark.read.jdbc.call_args
    assert url.startswith("jdbc:sqlserver:") and source == "(SELECT * FROM t) q"
    assert kwargs["predicates"] == ["ABS(([id] % 2)) = 0 OR [id] IS NULL", "ABS(([id] % 2)) = 1"]
    assert "url" not in kwargs["properties"] and kwargs["properties"]["fetchsize"] == "10000"


def test_bounds_are_computed_by_the_database():
    spark = MagicMock()
    loaded = spark.read.format.return_value.options.return_value.load.return_value
    loaded.first.return_value = (3, 99)
    assert bounds(spark, "mysql", CONNECTION, "orders", "id", 8) == RangePartitions("id", 3, 99, 8)
    query = spark.read.format.return_value.options.call_args.kwargs["query"]
    assert query == "SELECT MIN(`id`) AS low, MAX(`id`) AS high FROM `orders`"
    loaded.first.return_value = (None, None)
    with pytest.raises(ValueError):
        bounds(spark, "mysql", CONNECTION, "orders", "id", 8)
