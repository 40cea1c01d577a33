"""Near-duplicates by the Jaccard similarity of five-word shingles: MinHash candidates, each verified by its whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import connected_components, discard, materialize, text_of, without
from .textstats import Words, mix, text_slices

#: Words of a shingle, and the similarity from which two texts link.
WORDS, SIMILAR = 5, 0.8
#: Bands and rows of the MinHash: a pair of similarity 0.8 shares no band with a probability of 5e-8.
BANDS, ROWS = 32, 4
_SALT = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = mix(_SALT) | np.uint64(1)


def shingle_sets(texts: list[str], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one shingle of all, one of none none."""
    w = Words(texts, drop_punctuation=False)
    of_size = {words: w.shingles(words)}
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        k = min(words, b - a)
        if k and k not in of_size:
            of_size[k] = w.shingles(k)
        yield np.unique(of_size[k][a : b - k + 1]) if k else np.zeros(0, np.uint64)


def band_keys(own: np.ndarray) -> np.ndarray:
    """A key for each band of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 2048):
        np.minimum(least, ((own[at : at + 2048] ^ _SALT[:, None]) * _ODD[:, None]).min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + row)
    return key


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, keys: bool) -> DataFrame:
    """``(id, node, n, keys or own)`` of every row with a word; ``node`` names the set, equal for equal sets."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in text_slices(batch.column(1)):
                at, node, size, values = [], [], [], []
                for i, own in enumerate(shingle_sets(texts, words), a):
                    if len(own):
                        at.append(i)
                        node.append(mix(mix(own ^ np.uint64(words)).sum(keepdims=True))[0])
                        size.append(len(own))
                        values.append((band_keys(own) if keys else own).view(np.int64))
                if at:
                    ends = np.cumsum([0, *map(len, values)])
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(size, pa.int32()), lists], [id_col, "node", "n", "own"])

    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type}, node long, n int, own array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``(u, v)`` whose whole sets are as similar as asked."""
    both = F.size(F.array_intersect("a", "b"))
    found = pairs.join(sets.select(F.col("node").alias("u"), F.col("own").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("own").alias("b")), "v")
    return found.filter(both >= least * (F.size("a") + F.size("b") - both) - 1e-9).select("u", "v").distinct()


def similar_links(docs: DataFrame, prints: DataFrame, id_col: str, text_col: str, words: int, least: float) -> DataFrame:
    """Links ``(u, v)`` between nodes of ``prints`` that join the same components as all candidate pairs as similar as asked.

    Each node of a band's bucket is first verified against the bucket's node with
    the most copies, so a group about one text costs a row a member. What shares a bucket
    with another component then is compared by ``_across``, whatever the bucket; no
    candidate pair is passed over.
    """
    reps = materialize(prints.groupBy("node").agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies")), "jaccard-nodes")
    each = prints.join(reps, [id_col, "node"]).select("node", "n", "copies", F.explode("own").alias("key"))
    bucket = Window.partitionBy("key")
    lead, some = F.max(F.struct("copies", "node", "n")).over(bucket), F.min("node").over(bucket)
    buckets = materialize(each.withColumn("lead", lead).withColumn("some", some).filter("lead.node <> some or node <> some").select("key", "node", "n", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n")), "jaccard-buckets")
    wanted = reps.join(buckets.select("node").distinct(), "node").select(id_col).distinct()
    sets = materialize(_sets(docs.join(wanted, id_col), id_col, text_col, words, False).select("node", "n", "own").dropDuplicates(["node"]), "jaccard-sets")
    stars = buckets.filter("node <> lead").filter(F.least("n", "lead_n") >= least * F.greatest("n", "lead_n") - 1e-9).select(F.col("lead").alias("u"), F.col("node").alias("v")).distinct()
    links = materialize(_verified(stars, sets, least), "jaccard-stars")
    joined = connected_components(links).withColumnRenamed("component", "c")
    named = buckets.join(joined, "node", "left").select("key", "node", F.coalesce("c", "node").alias("c"))
    parted = named.withColumn("first", F.min("c").over(bucket)).withColumn("last", F.max("c").over(bucket)).filter("first <> last")
    unjoined = materialize(parted.select("node", "c").distinct(), "jaccard-open")
    rest = materialize(_across(sets.join(unjoined, "node"), least), "jaccard-rest")
    out = materialize(links.unionByName(_verified(rest, sets, least)), "jaccard-links")
    discard(reps, buckets, sets, links, unjoined, rest)
    return out


def _across(sets: DataFrame, least: float) -> DataFrame:
    """Pairs ``(u, v)`` of ``sets(node, n, own, c)`` with different ``c`` among which are all that are as similar as asked.

    Of two such sets of n and m elements each holds one of the other's rarest
    ``n - ceil(least * n) + 1``, whatever the order by which they are rare. Elements
    that no other set has come first in it and join nothing, so copies that were changed
    too much for any link drop out before sets are paired; and two sets can share no
    more than either has beyond such elements, or than follows the place of their
    first common one. Of the sets that share an element those of its first component
    meet the others only.
    """
    each = sets.select("node", "n", "c", F.explode("own").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("c").alias("first"), F.max("c").alias("last")).filter("df > 1")
    node = Window.partitionBy("node")
    ranked = each.join(often, "s").withColumn("rank", F.row_number().over(node.orderBy("df", "s"))).withColumn("m", F.count(F.lit(1)).over(node))
    prefix = F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1
    kept = materialize(ranked.filter(F.col("rank") <= prefix - (F.col("n") - F.col("m"))).filter("first <> last").select("s", "node", "n", "c", "m", (F.col("m") - F.col("rank")).alias("after")), "jaccard-prefixes")
    one = kept.withColumn("first", F.min("c").over(Window.partitionBy("s")))
    a, b = one.filter("c <> first").alias("a"), one.alias("b")
    shared = least / (1 + least) * (F.col("a.n") + F.col("b.n")) - 1e-6
    sized = (F.least("a.m", "b.m") >= shared) & (F.least("a.after", "b.after") + 1 >= shared)
    return a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.c") != F.col("b.c")) & ((F.col("b.c") == F.col("b.first")) | (F.col("a.node") < F.col("b.node"))) & sized).select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows with a null id stay.

    Rows link when their SimHash fingerprints do (see ``simhash.near_duplicates``)
    or when their sets of shingles have a Jaccard similarity of at least ``least``.
    """
    own = docs.filter(F.col(id_col).isNotNull())
    near = materialize(simhash.near_duplicates(own, id_col, text_col).select(id_col, F.col("component_id").alias("c")).distinct(), "jaccard-near")
    prints = materialize(_sets(own, id_col, text_col, words, True), "jaccard-prints")
    links = similar_links(own, prints, id_col, text_col, words, least)
    members = materialize(prints.select(id_col, "node").join(near, id_col).select("node", "c").distinct(), "jaccard-members")
    names = materialize(members.groupBy("node").agg(F.min("c").alias("first")), "jaccard-names")
    same = members.join(names, "node").select(F.col("c").alias("u"), F.col("first").alias("v"))
    alike = links.join(names.select(F.col("node").alias("u"), F.col("first").alias("a")), "u").join(names.select(F.col("node").alias("v"), F.col("first").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = connected_components(same.unionByName(alike).filter("u <> v").distinct())
    gone = materialize(near.join(found.select(F.col("node").alias("c"), "component"), "c", "left").filter(F.col(id_col) != F.coalesce("component", "c")).select(id_col).distinct(), "jaccard-gone")
    discard(near, prints, links, members, names)
    return without(docs, gone, id_col)
