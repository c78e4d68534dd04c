"""Point and polygon columns."""

from pyspark.sql import functions as F

from stillroom.functions import geo
from stillroom.operators.catalog import spatial_columns
from stillroom.operators.tables import copy_tables, map_columns_by_type, write_table
from stillroom.plans import plan, table
from stillroom.session import scratch_path


def ring_text(corners):
    vertices = [F.concat_ws(" ", F.lit(x).cast("string"), F.lit(y).cast("string")) for x, y in corners]
    return F.concat(F.lit("("), F.concat_ws(", ", *vertices), F.lit(")"))


@plan("SELECT c_custkey, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(c_custkey % 180 - 90 AS DOUBLE) AS lat FROM customer")
def geo_point_cast(spark, sf_dir):
    key = F.col("c_custkey")
    text = F.concat(F.lit("point("), (key % 360 - 180).cast("string"), F.lit(" "), (key % 180 - 90).cast("string"), F.lit(")"))
    places = table(spark, sf_dir, "customer").select("c_custkey", geo.wkt_to_geo(text).alias("location"))
    return places.select("c_custkey", geo.longitude("location").alias("lon"), geo.latitude("location").alias("lat"))


@plan("""
SELECT c_custkey FROM customer WHERE (45 + (c_custkey % 30) / 10.0) BETWEEN 45.8389 AND 47.8229 AND (5 + (c_custkey % 70) / 10.0) BETWEEN 5.9962 AND 10.5226
""")
def geo_bbox_filter(spark, sf_dir):
    places = table(spark, sf_dir, "customer").select(
        "c_custkey", (5 + (F.col("c_custkey") % 70) / 10.0).alias("lon"), (45 + (F.col("c_custkey") % 30) / 10.0).alias("lat")
    )
    return places.filter(geo.in_box("lon", "lat", 5.9962, 10.5226, 45.8389, 47.8229)).select("c_custkey")


@plan("""
SELECT s_suppkey, CAST(-1 * (s_suppkey + 1) * (s_suppkey + 1) AS DOUBLE) AS area_before, CAST((s_suppkey + 1) * (s_suppkey + 1) AS DOUBLE) AS area_after FROM supplier
""")
def geo_invert_vertex_order(spark, sf_dir):
    """A table of clockwise squares copied while all of its geography columns are turned around."""
    side = F.col("s_suppkey") + 1
    square = F.concat(F.lit("polygon("), ring_text([(0, 0), (0, side), (side, side), (side, 0), (0, 0)]), F.lit(")"))
    shapes = table(spark, sf_dir, "supplier").select("s_suppkey", geo.wkt_to_geo(square).alias("shape"))
    root = scratch_path(spark, "shapes")
    write_table(shapes, f"{root}/old/shapes", "create")
    copy_tables(spark, f"{root}/old", f"{root}/new", transform_by_type=(geo.is_geography, geo.invert_vertex_order))

    def area(path, name):
        return spark.read.parquet(path).select("s_suppkey", geo.signed_areas("shape")[0][0].alias(name))

    return area(f"{root}/old/shapes", "area_before").join(area(f"{root}/new/shapes", "area_after"), "s_suppkey")


@plan("SELECT s_suppkey, CAST((s_suppkey + 1) * (s_suppkey + 1) AS DOUBLE) AS outer_area, CAST(-0.25 AS DOUBLE) AS hole_area FROM supplier")
def geo_auto_vertex_order(spark, sf_dir):
    """Squares with a hole whose rings run either way, put in order."""
    side = F.col("s_suppkey") + 1
    outer, hole = [(0, 0), (side, 0), (side, side), (0, side), (0, 0)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25)]
    first = F.when(F.col("s_suppkey") % 2 == 0, ring_text(outer)).otherwise(ring_text(outer[::-1]))
    second = F.when(F.col("s_suppkey") % 3 == 0, ring_text(hole)).otherwise(ring_text(hole[::-1]))
    text = F.concat(F.lit("POLYGON("), first, F.lit(", "), second, F.lit(")"))
    shapes = table(spark, sf_dir, "supplier").select("s_suppkey", geo.wkt_to_geo(text).alias("shape"))
    ordered = map_columns_by_type(shapes, geo.is_geography, geo.auto_vertex_order)
    areas = geo.signed_areas("shape")[0]
    return ordered.select("s_suppkey", areas[0].alias("outer_area"), areas[1].alias("hole_area"))


@plan("SELECT 'places' AS table_name, 'location' AS column_name, COUNT(*) AS n FROM customer")
def spatial_column_listing(spark, sf_dir):
    key = F.col("c_custkey")
    places = table(spark, sf_dir, "customer").select("c_custkey", geo.point(key % 180, key % 90).alias("location"))
    return spatial_columns({"places": places, "region": table(spark, sf_dir, "region")})
