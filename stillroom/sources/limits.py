"""Guards and samples taken before a load."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 1_000
#: Footers that a task reads.
FOOTERS_A_TASK = 64
MAX_BYTES = 1024**3


class QueryTooLargeError(RuntimeError):
    """The estimate of a query exceeds the allowed size."""


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the figure EXPLAIN COST shows; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scanned_bytes(df: DataFrame) -> int | None:
    """Bytes the query reads, over all its scans; None where a scan cannot tell.

    A scan of files counts the files it selects, after partition pruning. Any other source counts by its
    statistics; sources without any report the session's default size, which says nothing.
    """
    spark, execution = df.sparkSession, df._jdf.queryExecution()
    default = int(spark._jsparkSession.sessionState().conf().defaultSizeInBytes())
    total, plan = 0, execution.sparkPlan().collectLeaves()
    for i in range(plan.length()):
        leaf = plan.apply(i)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec":
            total += int(leaf.selectedPartitions().totalFileSize())
        elif leaf.logicalLink().isDefined():
            size = int(str(leaf.logicalLink().get().stats().sizeInBytes()))
            if size >= default:
                return None
            total += size
        elif leaf.getClass().getSimpleName() not in ("RangeExec", "LocalTableScanExec", "OneRowRelationExec"):
            return None
    return total


def column_bytes(df: DataFrame) -> int | None:
    """Bytes of the column chunks that the query reads: of its columns alone, in the row groups that its comparisons with
    numbers and days leave over. Tasks read the footers of the selected files; no data is read.

    Scans of other sources count as in ``scanned_bytes``, and so do files on file systems that tasks cannot open.
    """
    total, plan = 0, df._jdf.queryExecution().sparkPlan().collectLeaves()
    leaves = [plan.apply(i) for i in range(plan.length())]
    if any(leaf.getClass().getSimpleName() != "FileSourceScanExec" or leaf.relation().fileFormat().getClass().getSimpleName() != "ParquetFileFormat" for leaf in leaves):
        return scanned_bytes(df)
    for leaf in leaves:
        listed = _selected_files(leaf)
        if not all(_address(path) for path, _ in listed):
            total += sum(size for _, size in listed)
            continue
        if not listed:
            continue
        columns, bounds = list(leaf.requiredSchema().fieldNames()), _bounds(leaf)
        rows = df.sparkSession.createDataFrame([(_address(path),) for path, _ in listed], "path string")
        spread = rows.repartition(max(1, min(len(listed) // FOOTERS_A_TASK, 10_000)))
        total += spread.mapInPandas(_chunk_sizes(columns, bounds), "bytes long").agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return total


def _selected_files(leaf) -> list[tuple[str, int]]:
    found, partitions = [], leaf.selectedPartitions().filePartitionIterator()
    while partitions.hasNext():
        inside = partitions.next().files().iterator()
        while inside.hasNext():
            status = inside.next()
            found.append((status.getPath().toString(), status.getLen()))
    return found


def _address(path: str) -> str | None:
    """A path as pyarrow's file systems name it; None for those it does not know."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or path.startswith("/"):
        return "/" + (rest if scheme == "file" else path).lstrip("/")
    known = {"s3": "s3", "s3a": "s3", "s3n": "s3", "hdfs": "hdfs", "gs": "gs"}
    return f"{known[scheme]}:{rest}" if scheme in known else None


def _bounds(leaf) -> list[tuple[str, str, float | str]]:
    """(column, comparison, value) of the scan's pushed comparisons with numbers and days; all must hold."""
    pushed = leaf.metadata().get("PushedFilters")
    text = pushed.get() if pushed.isDefined() else ""
    found = re.findall(r"(?<![A-Za-z(])(GreaterThan|GreaterThanOrEqual|LessThan|LessThanOrEqual|EqualTo)\(([^,()]+),(-?\d+(?:\.\d+)?|\d{4}-\d\d-\d\d)\)(?=, |\]$)", text)
    return [(column, kind, value if "-" in value[1:] else float(value)) for kind, column, value in found]


def _chunk_sizes(columns: list[str], bounds: list[tuple[str, str, float | str]]):
    """One closure over plain values, so that tasks need nothing of this package."""

    def excluded(low, high, kind, value) -> bool:
        if isinstance(value, str):
            low, high = str(low)[:10], str(high)[:10]
        elif isinstance(low, (str, bytes, bool)) or not hasattr(low, "__float__"):
            return False
        if kind == "EqualTo":
            return value < low or value > high
        if kind.startswith("Greater"):
            return high < value or (kind == "GreaterThan" and high == value and not isinstance(value, str))
        return low > value or (kind == "LessThan" and low == value and not isinstance(value, str))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyarrow import parquet as pq

        for batch in batches:
            sizes = []
            for address in batch["path"]:
                store, path = fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)
                footer, size = pq.read_metadata(path, filesystem=store), 0
                for group in (footer.row_group(g) for g in range(footer.num_row_groups)):
                    chunks = [group.column(c) for c in range(group.num_columns)]
                    stats = {c.path_in_schema: c.statistics for c in chunks if c.statistics is not None and c.statistics.has_min_max}
                    if any(column in stats and excluded(stats[column].min, stats[column].max, kind, value) for column, kind, value in bounds):
                        continue
                    size += sum(c.total_compressed_size for c in chunks if any(c.path_in_schema == n or c.path_in_schema.startswith(n + ".") for n in columns))
                sizes.append(size)
            yield pd.DataFrame({"bytes": sizes}, dtype="int64")

    return run


def guard_size(df: DataFrame, max_bytes: int = MAX_BYTES, allow_unknown: bool = False, by_columns: bool = False) -> DataFrame:
    """Return the frame unless it would read more than ``max_bytes``. A size that no source tells is refused too,
    unless the caller says otherwise. Whole files count, or with ``by_columns`` what the query reads of them."""
    size = column_bytes(df) if by_columns else scanned_bytes(df)
    if size is None and not allow_unknown:
        raise QueryTooLargeError("no source of the query tells how much it would read; allow_unknown admits it")
    if size is not None and size > max_bytes:
        raise QueryTooLargeError(f"the query would read about {size} bytes, allowed are {max_bytes}")
    return df


def sample(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Any ``rows`` rows, to try a load out. Nothing is read until the result is."""
    if rows < 0:
        raise ValueError("a sample cannot have a negative size")
    return df.limit(rows)
