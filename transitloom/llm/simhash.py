"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, materialize, text_of, without

#: Words of a shingle, and differing bits up to which fingerprints link.
WORDS, RADIUS = 3, 2


def fingerprint(text: str, words: int = WORDS) -> int:
    """64-bit SimHash of one text: a bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    import xxhash

    tokens = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
    starts = [0, *ends]
    h = xxhash.xxh64_digest
    view = memoryview(joined)
    digests = b"".join([h(view[a : b - 1], 42) for a, b in zip(starts, ends[words - 1 :], strict=False)])
    n = len(digests) // 8
    ones = np.zeros(64, np.int64)
    raw = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(raw[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``(id, fp long)`` of every row; a null text counts as empty, whose fingerprint is zero."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(v.as_py(), words) for v in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], [id_col, "fp"])

    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type}, fp long")


def ball_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` that connect all pairs within ``radius`` bits.

    Every fingerprint emits all variants within half the radius (rounded up, one
    bit here): two within the radius share a variant. At most 65 distinct
    fingerprints share one, so no group grows with the data. Each links to the
    smallest of its group, is verified by its Hamming distance, and repeats go;
    as all of an exact ball's members lie within twice its radius of each other,
    the star joins the same components as all pairs would.
    """
    if radius not in (1, 2):
        raise ValueError("balls of one bit serve a radius of 1 or 2")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    variants = prints.select("fp").distinct().select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    from pyspark.sql import Window

    if radius == 1:  # a pair one bit apart shares both of the pair as variants; only the ball's centre may link
        low = F.when(F.count_if(F.col("fp") == F.col("variant")).over(Window.partitionBy("variant")) > 0, F.col("variant"))
    else:
        low = F.min("fp").over(Window.partitionBy("variant"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("low"))) <= radius
    return variants.withColumn("low", low).filter("low is not null and fp <> low").filter(near).select(F.col("fp").alias("u"), F.col("low").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row with an id.

    Documents link when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id reachable over links. Copies share a
    fingerprint and meet in one row before any link is sought, so a group of
    copies of any size costs one row. Null and empty texts have the zero
    fingerprint and link like any other. Rows with a null id are left out: they
    cannot be named in a result. Repeated rows give equal rows.
    """
    prints = materialize(fingerprints(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, words), "simhash")
    nodes = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("node")), "simhash-nodes")
    links = materialize(ball_links(nodes, radius), "simhash-links")
    edges = links.join(nodes.select(F.col("fp").alias("u"), F.col("node").alias("a")), "u").join(nodes.select(F.col("fp").alias("v"), F.col("node").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = connected_components(edges)
    classes = materialize(
        nodes.join(found.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("fp", F.coalesce("component", "node").alias("component_id")), "simhash-classes"
    )
    discard(links, nodes)
    return prints.join(classes, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows with a null id stay."""
    groups = near_duplicates(docs, id_col, text_col, words, radius)
    gone = materialize(groups.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), "simhash-gone")
    return without(docs, gone, id_col)
