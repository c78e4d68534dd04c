from unittest.mock import MagicMock

from stillroom import files
from stillroom.session import SHARED_DIR_KEY, clear_scratch, scratch_path, shared_dir


def session(master, configured):
    spark = MagicMock()
    spark.conf.get.side_effect = lambda key, default=None: configured if key == SHARED_DIR_KEY else default
    spark.sparkContext.master, spark.sparkContext.applicationId = master, f"app-{master}-{configured}"
    return spark


def test_the_cluster_names_the_shared_folder():
    spark = session("yarn", "hdfs://shared/work/")
    assert shared_dir(spark) == "hdfs://shared/work"
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith("hdfs://shared/work/stillroom/app-yarn-")


def test_without_a_setting_the_warehouse_is_the_shared_folder():
    spark = session("yarn", None)
    spark.conf.get.side_effect = lambda key, default=None: "hdfs://warehouse/" if key == "spark.sql.warehouse.dir" else default
    assert shared_dir(spark) == "hdfs://warehouse/_shared"


def test_scratch_is_found_and_cleared(spark, monkeypatch):
    import stillroom.session as module

    monkeypatch.setattr(module, "_scratch_root", lambda s: f"{shared_dir(s)}/only-this-test")
    path = scratch_path(spark, "thing")
    spark.range(3).write.parquet(path)
    assert files.exists(spark, path)
    clear_scratch(spark)
    assert not files.exists(spark, path)
