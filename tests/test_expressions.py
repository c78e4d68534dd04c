import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from stillroom.functions import expressions as ex
from stillroom.functions import geo


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("start,length,expected", [(0, 6, "abcde"), (1, 3, "abc"), (-1, 3, "a"), (-5, 3, ""), (3, None, "cdefgh"), (0, None, "abcdefgh"), (7, 10, "gh"), (2, 0, "")])
def test_substring_counts_positions_before_the_text(spark, start, length, expected):
    assert one(spark, ex.sql_substring(F.lit("abcdefgh"), start, length)) == expected


def test_integer_division(spark):
    assert one(spark, ex.integer_divide(F.lit(12), F.lit(2))) == 6
    assert one(spark, ex.integer_divide(F.lit(-7), F.lit(2))) == -3


def test_case_value(spark):
    df = spark.createDataFrame([("Urgent",), ("Low",), ("Later",), (None,)], "p string")
    branches = {"Urgent": 1, "Medium": 2, "Low": 3}
    assert [r[0] for r in df.select(ex.case_value("p", branches)).collect()] == [1, 3, None, None]
    assert [r[0] for r in df.select(ex.case_value("p", branches, 0)).collect()] == [1, 3, 0, 0]
    with pytest.raises(ValueError):
        ex.case_value("p", {})


def test_patterns(spark):
    assert ex.java_pattern("YYYY-MM-DD HH24:MI:SS") == "yyyy-MM-dd HH:mm:ss"
    assert ex.java_pattern("DD/MON/YY HH12:MI AM") == "dd/MMM/yy hh:mm a"
    with pytest.raises(ValueError):
        ex.java_pattern("YYYY-Q")
    assert one(spark, ex.parse_timestamp(F.lit("2012-09-13 10:00:00"), "YYYY-MM-DD HH24:MI:SS")) == dt.datetime(2012, 9, 13, 10)


def test_epoch_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, ex.epoch_to_utc(F.lit(1_700_000_000))) == dt.datetime(2023, 11, 14, 22, 13, 20)
        assert one(spark, ex.epoch_to_utc(F.lit(-1))) == dt.datetime(1969, 12, 31, 23, 59, 59)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_content_hash(spark):
    text = "größer\n"
    assert one(spark, ex.content_hash(F.lit(text))) == hashlib.sha256(text.encode()).hexdigest()


def test_identifiers():
    assert ex.quote_name("Extract.My-Table") == "`Extract`.`My-Table`"
    assert ex.quote_name("dbo.t", "[", "]") == "[dbo].[t]"
    for wrong in (None, "", "a" * 65, "a b", 'x"y', "a;b", "a..b"):
        with pytest.raises(ValueError):
            ex.quote_name(wrong)
    assert ex.quote_column("a`b c") == "`a``b c`"


def test_quotes_in_values_stay_as_they_are(spark):
    df = spark.sql("SELECT :name AS name", args={"name": "O'Brien; --"})
    assert df.filter(F.col("name") == "O'Brien; --").count() == 1


# --- geography ----------------------------------------------------------------------------------------------

WKT = {
    "point(24.9384 60.1699)": "point (24.9384 60.1699)",
    "  POINT ( 1   2 ) ": "point (1.0 2.0)",
    "linestring(1 1,2 2, 3 1)": "linestring (1.0 1.0, 2.0 2.0, 3.0 1.0)",
    "multipoint((1 2),(3 4))": "multipoint ((1.0 2.0), (3.0 4.0))",
    "multipoint(1 2,3 4)": "multipoint ((1.0 2.0), (3.0 4.0))",
    "multilinestring((1 1,2 2),(3 3,4 4))": "multilinestring ((1.0 1.0, 2.0 2.0), (3.0 3.0, 4.0 4.0))",
    "polygon((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 2 1, 2 2, 1 1))": "polygon ((0.0 0.0, 0.0 4.0, 4.0 4.0, 4.0 0.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))",
    "multipolygon(((0 0,0 1,1 1,0 0)),((5 5,6 5,6 6,5 5),(5.5 5.1,5.6 5.1,5.6 5.2,5.5 5.1)))": "multipolygon (((0.0 0.0, 0.0 1.0, 1.0 1.0, 0.0 0.0)), ((5.0 5.0, 6.0 5.0, 6.0 6.0, 5.0 5.0), (5.5 5.1, 5.6 5.1, 5.6 5.2, 5.5 5.1)))",
    "POLYGON EMPTY": "polygon empty",
    "point(1e2 -1.5E-1)": "point (100.0 -0.15)",
}


def test_well_known_text(spark):
    df = spark.createDataFrame([(w,) for w in WKT] + [(None,)], "w string").select("w", geo.geo_to_wkt(geo.wkt_to_geo("w")).alias("t"))
    assert {r["w"]: r["t"] for r in df.collect()} == {**WKT, None: None}
    assert geo.is_geography(spark.range(1).select(geo.wkt_to_geo(F.lit("point(1 2)")).alias("g")).schema["g"].dataType)


@pytest.mark.parametrize("bad", ["", "point(1)", "point(1 2 3)", "point(a b)", "point(1 2, 3 4)", "point(1 2", "point(1 2)x", "circle(1 2)", "polygon(1 2)", "polygon((1 2,3 4)", "multipolygon((1 2))", "multipolygon empty too"])
def test_malformed_text_raises(spark, bad):
    with pytest.raises(Exception, match="malformed geography"):
        spark.createDataFrame([(bad,)], "w string").select(geo.wkt_to_geo("w")).collect()


def test_long_rings(spark):
    """Rings of many thousand vertices go through every step."""
    import math

    n = 20_000
    ring = ", ".join(f"{math.cos(2 * math.pi * i / n)} {math.sin(2 * math.pi * i / n)}" for i in [*range(n), 0])
    df = spark.createDataFrame([(f"polygon(({ring}))",)], "w string").select(geo.wkt_to_geo("w").alias("g"))
    areas = df.select(geo.signed_areas("g")[0][0], geo.signed_areas(geo.invert_vertex_order("g"))[0][0]).first()
    assert areas[0] == pytest.approx(math.pi, abs=1e-4) and areas[1] == pytest.approx(-math.pi, abs=1e-4)


def test_vertex_order(spark):
    texts = [(w,) for w in WKT] + [(None,)]
    df = spark.createDataFrame(texts, "w string").select(geo.wkt_to_geo("w").alias("g"))
    for row in df.select(geo.signed_areas("g").alias("a"), geo.signed_areas(geo.auto_vertex_order("g")).alias("b"), geo.signed_areas(geo.invert_vertex_order("g")).alias("c"), "g.kind").collect():
        if row.kind in geo.AREAL:
            for before, auto, inverted in zip(row.a, row.b, row.c):
                assert all(x > 0 if i == 0 else x < 0 for i, x in enumerate(auto))
                assert [abs(x) for x in auto] == pytest.approx([abs(x) for x in before])
                assert inverted == pytest.approx([-x for x in before])
        else:
            assert row.a == row.b == row.c
    twice = df.select(geo.geo_to_wkt("g").alias("x"), geo.geo_to_wkt(geo.invert_vertex_order(geo.invert_vertex_order("g"))).alias("y"))
    assert all(r.x == r.y for r in twice.collect())
    assert df.filter(geo.invert_vertex_order("g").isNull()).count() == 1


def test_points_and_boxes(spark):
    df = spark.createDataFrame([(18.0686, 59.3293), (5.0, 46.0), (None, 46.0)], "lon double, lat double")
    assert [r[0] for r in df.filter(geo.in_box("lon", "lat", 16, 20, 55, 60)).select("lon").collect()] == [18.0686]
    placed = df.select(geo.point("lon", "lat").alias("p"))
    assert placed.select(geo.longitude("p"), geo.latitude("p")).first() == (18.0686, 59.3293)
