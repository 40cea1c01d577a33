"""Helpers that the training-data operators share."""

from __future__ import annotations

import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
#: Spark's setting that removes a command's shuffle files when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a session that runs in one process may leave it unset; then a
    temporary folder of this process serves, and is set for later readers.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        import atexit

        _LOCAL[app] = tempfile.mkdtemp(prefix="transitloom-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def materialize(df: DataFrame, label: str, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The shuffle files of the write go with its end: nothing reads them again.
    ``by``: a column each value of which gets files of its own; ``codec``: of the files.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/transitloom/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, partitionBy=by, compression=codec)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._transitloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialize`` that no later plan reads."""
    for df in tables:
        spark, path = df.sparkSession, getattr(df, "_transitloom_path", None)
        if path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def without(docs: DataFrame, gone: DataFrame, id_col: str, rows: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` whose id is not in the written table ``gone``, which is sent to all tasks if it has at most ``rows``."""
    return docs.join(F.broadcast(gone) if gone.count() <= rows else gone, id_col, "left_anti")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def text_of(column: str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``edges(u long, v long)``; a component is its smallest node.

    Borůvka-style contraction: each round sends every node to its smallest
    neighbour, jumps once along those pointers, and renames the edges; loops
    and repeated edges vanish. Each round at least halves the nodes that still
    have edges, so rounds grow with the logarithm of the longest chain. All
    state lies in written tables: nothing but an edge count reaches the driver,
    and a hub's edges can be split by the skew handling of the joins.
    Empty edges give an empty table; self loops and repeats are harmless.
    """
    loops = edges.filter("u = v").select("u").distinct()
    live = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    labels = None
    while not live.isEmpty():
        both = live.select("u", "v").unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p")), "cc-up")
        jump = up.alias("a").join(up.alias("b"), F.col("a.p") == F.col("b.u"), "left")
        up2 = materialize(jump.select(F.col("a.u").alias("u"), F.coalesce("b.p", "a.p").alias("p")), "cc-jump")
        step = (
            live.join(up2.select(F.col("u"), F.col("p").alias("pu")), "u")
            .select("pu", F.col("v").alias("x"))
            .join(up2.select(F.col("u").alias("x"), F.col("p").alias("pv")), "x")
            .filter("pu <> pv")
            .select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v"))
            .distinct()
        )
        following = materialize(step, "cc-edges")
        if labels is None:
            labels, old = up2, None
        else:
            old = labels
            renamed = labels.select("u", F.col("p").alias("q")).join(up2.select(F.col("u").alias("q"), F.col("p").alias("r")), "q", "left")
            labels = materialize(renamed.select("u", F.coalesce("r", "q").alias("p")), "cc-labels")
        discard(live, up, *([up2, old] if old is not None else []))
        live = following
    found = live.select(F.col("u"), F.col("v").alias("p")) if labels is None else labels
    alone = loops.join(found, "u", "left_anti").select(F.col("u"), F.col("u").alias("p"))
    return found.unionByName(alone).select(F.col("u").alias("node"), F.col("p").alias("component"))
