"""Small helpers the text operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stillroom.session import scratch_path

#: A-Z and their small letters, for lower-casing that leaves every other letter alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it read back: later steps start from files that any
    executor can read, and the planner knows their size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in small letters. A text of ASCII alone takes the faster function, with the same result."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, however the driver came to import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="stillroom-code-")  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/{root.name}-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(name, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(name)
    _SHIPPED.add(context.applicationId)
