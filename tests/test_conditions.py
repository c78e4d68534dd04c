import datetime as dt

import pytest
from pyspark.sql import functions as F

from stillroom.operators.conditions import parse_condition

DAY = "2024-03-05"


@pytest.mark.parametrize("op", ["lt", "lte", "gt", "gte", "eq", "neq"])
@pytest.mark.parametrize("moment", [f"{DAY}T00:00:00Z", f"{DAY}T10:30:00"])
def test_a_day_against_a_moment(spark, path, op, moment):
    import operator

    days = [dt.date(2024, 3, d) for d in (4, 5, 6)] + [None]
    spark.createDataFrame([(d,) for d in days], "day date").coalesce(1).write.mode("overwrite").parquet(path("d"))
    df = spark.read.parquet(path("d"))
    found = df.filter(parse_condition({"op": op, "target-col": "day", "const": {"type": "datetime", "v": moment}}, df.schema).predicate)
    at = dt.datetime.fromisoformat(moment.rstrip("Z"))
    compare = getattr(operator, {"lte": "le", "gte": "ge", "neq": "ne"}.get(op, op))
    assert sorted(r.day for r in found.collect()) == [d for d in days if d is not None and compare(dt.datetime.combine(d, dt.time()), at)]
    if op in ("lt", "lte", "gt", "gte"):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(day), " in plan, plan


def test_names_of_any_length_are_listed(spark):
    from stillroom.operators.catalog import list_catalog

    name = "v" * 70 + "_end"
    spark.range(1).createOrReplaceTempView(name)
    try:
        assert list_catalog(spark).filter(F.col("table_name") == name).count() == 1
    finally:
        spark.catalog.dropTempView(name)
