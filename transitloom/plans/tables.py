"""Written tables between the steps of a plan, and numbering of rows without a task that sees all of them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session in one process may leave it unset and then has a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.TemporaryDirectory(prefix="transitloom-")
    return _LOCAL[app].name


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written in the shared folder and read again: a short lineage that survives lost executors."""
    path = f"{shared_folder(rows.sparkSession)}/transitloom/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with consecutive numbers from 0 in ``order``.

    Rows are sorted by range, whatever their values have in common, and
    written; the sizes of the ranges, one row each, tell where each begins.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    kept = written(parts.withColumn("at__", at), "numbered")
    part, place = F.shiftrightunsigned("at__", 33), F.col("at__").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row for each range
    start, begins = 0, []
    for r in sorted(sizes, key=lambda r: r["part"]):
        begins.append((r["part"], start))
        start += r["n"]
    offsets = rows.sparkSession.createDataFrame(begins, "part__ long, begin__ long")
    return kept.join(F.broadcast(offsets), part == F.col("part__")).withColumn(name, F.col("begin__") + place).drop("at__", "part__", "begin__")
