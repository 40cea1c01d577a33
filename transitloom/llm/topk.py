"""Exact top-k search: a sharded inverted index, block-max WAND for BM25 in each shard, exact merge by global statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize, text_of

K1, B, K = 1.2, 0.75, 10
#: Text bytes of a shard, documents of a block (as a power of two), decimals of a score.
SHARD_BYTES, BLOCK_BITS, DECIMALS = 32 << 20, 7, 6
#: Query texts of one pass over the index, in characters; a larger query set takes several passes.
SLAB_CHARS = 8 << 20
_TABLE = bytes(32 if 33 <= i < 127 and not chr(i).isalnum() else i + 32 if 65 <= i < 91 else i for i in range(256))
_NONE = b""  # in the place of a term: the row of a shard's documents
INDEX = "shard long, term binary, ord array<int>, tf array<int>, dl array<int>, block array<int>, block_tf array<int>, block_dl array<int>, ids array<long>, total_dl long"


def tokenize(text: str) -> list[bytes]:
    """Words of a text: A-Z in lower case, ASCII punctuation and white space between words."""
    return text.encode().translate(_TABLE).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of every row as a table ``INDEX``: a row for each shard and term, and one for each shard's documents.

    A task reads its rows in order and closes a shard after ``shard_bytes`` of text, so memory is bounded and
    nothing is shuffled. Postings are sorted by document; blocks of 128 documents carry the largest term count and
    the shortest length, which bound BM25 whatever the global statistics are.
    """

    def shard_of(number: int, ids: list[int], texts: list[str]) -> Iterator[pa.RecordBatch]:
        vocabulary: dict[bytes, int] = {}
        numbers, lengths = [], []
        for text in texts:
            tokens = tokenize(text)
            lengths.append(len(tokens))
            numbers.append(np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in tokens), np.int64, len(tokens)))
        terms = list(vocabulary)
        dl = np.array(lengths, np.int64)
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        pair, tf = np.unique(flat << 32 | np.repeat(np.arange(len(texts)), dl), return_counts=True)
        term, order = pair >> 32, pair & 0xFFFFFFFF
        starts = np.searchsorted(term, np.arange(len(terms) + 1))
        block_key = term << 32 | order >> BLOCK_BITS
        new = np.concatenate([[True], block_key[1:] != block_key[:-1]]) if len(pair) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        block_tf = np.maximum.reduceat(tf, at) if len(at) else tf
        block_dl = np.minimum.reduceat(dl[order], at) if len(at) else tf
        block_starts = np.searchsorted(term[at], np.arange(len(terms) + 1))
        row = lambda offsets, values, a, b: pa.ListArray.from_arrays(pa.array(offsets[a : b + 1] - offsets[a], pa.int32()), pa.array(values[offsets[a] : offsets[b]].astype(np.int32)))
        step = 1 << 14
        for a in range(0, len(terms), step):
            b = min(a + step, len(terms))
            n = b - a
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, number), pa.int64()), pa.array(terms[a:b], pa.binary()),
                    row(starts, order, a, b), row(starts, tf, a, b), row(starts, dl[order], a, b),
                    row(block_starts, order[at] >> BLOCK_BITS, a, b), row(block_starts, block_tf, a, b), row(block_starts, block_dl, a, b),
                    pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64()),
                ],
                names,
            )
        empty = pa.nulls(1, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([_NONE], pa.binary()), *[empty] * 6, pa.array([ids], pa.list_(pa.int64())), pa.array([int(dl.sum())], pa.int64())], names)

    names = [f.split()[0] for f in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                texts.append(t.as_py())
                size += len(texts[-1])
                if size >= shard_bytes:
                    yield from shard_of(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield from shard_of(number, ids, texts)

    return docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_of(text_col)).mapInArrow(run, INDEX)


class Postings:
    """A term's postings in a shard for one query: cursor over blocks, and upper bounds; a block's postings are scored when it is reached."""

    def __init__(self, row: dict, weight: float, average: float) -> None:
        self.order, self.block = row["ord"], row["block"]
        self.tf, self.dl, self.weight, self.average = row["tf"], row["dl"], weight, average
        self.bound = weight * bm25(row["block_tf"], row["block_dl"], average)
        self.most = float(self.bound.max())
        self.starts = np.searchsorted(self.order >> BLOCK_BITS, self.block)
        self.at = 0

    def current(self) -> int:
        return int(self.block[self.at]) if self.at < len(self.block) else 1 << 40

    def add_scores(self, scores: np.ndarray) -> None:
        """Add the current block's scores to those of its documents."""
        a = int(self.starts[self.at])
        b = int(self.starts[self.at + 1]) if self.at + 1 < len(self.starts) else len(self.order)
        scores[self.order[a:b] & ((1 << BLOCK_BITS) - 1)] += self.weight * bm25(self.tf[a:b], self.dl[a:b], self.average)

    def seek(self, block: int) -> None:
        self.at += int(np.searchsorted(self.block[self.at :], block))


def bm25(tf: np.ndarray, dl: np.ndarray, average: float) -> np.ndarray:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / average))


def search_shard(rows: dict[bytes, dict], ids: np.ndarray, query: Counter, idf: dict[bytes, float], average: float, k: int = K, seen: Counter | None = None) -> list[tuple[float, int]]:
    """The ``k`` best ``(score, id)`` of a shard by block-max WAND; equal rounded scores go by the smaller id.

    Lists are kept by their current block. The pivot is the first block at which
    the lists' largest scores could reach the k-th best so far; its block bounds
    are summed next; only if they too could reach it is the block scored. Bounds
    are compared with a margin for rounding, so ties are never lost. ``seen``
    counts the blocks scored and the postings' blocks in all.
    """
    lists = [Postings(rows[t], n * idf[t], average) for t, n in sorted(query.items()) if t in rows]
    if seen is not None:
        seen["blocks"] += sum(len(p.block) for p in lists)
    best: list[tuple[float, int]] = []
    margin = 10.0**-DECIMALS
    while lists:
        least = best[-1][0] - margin if len(best) == k else -math.inf
        lists.sort(key=Postings.current)
        total, pivot = 0.0, None
        for p in lists:
            total += p.most
            if total >= least:
                pivot = p.current()
                break
        if pivot is None or pivot == 1 << 40:
            break
        for p in lists:
            if p.current() < pivot:
                p.seek(pivot)
        here = [p for p in lists if p.current() == pivot]
        if sum(float(p.bound[p.at]) for p in here) >= least:
            scores = np.zeros(1 << BLOCK_BITS)
            for p in here:
                p.add_scores(scores)
            if seen is not None:
                seen["scored"] += len(here)
            scores = np.round(scores, DECIMALS)
            good = np.flatnonzero((scores > 0) & (scores >= least))
            best += [(float(scores[i]), int(ids[(pivot << BLOCK_BITS) + i])) for i in good]
            best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
        for p in here:
            p.at += 1
        lists = [p for p in lists if p.at < len(p.block)]
    return best


def _searcher(shared, pa_type: pa.DataType, average: float, k: int):
    """The function that runs all queries on one shard's rows."""

    def run(table: pa.Table) -> pa.Table:
        queries_, idf_ = shared.value
        found: dict[bytes, dict] = {}
        ids = np.zeros(0, np.int64)
        arrays = ("ord", "tf", "dl", "block", "block_tf", "block_dl")
        for i, term in enumerate(table.column("term").to_pylist()):
            if term == _NONE:
                ids = np.array(table.column("ids")[i].as_py(), np.int64)
            else:
                found[term] = {c: table.column(c)[i].values.to_numpy() for c in arrays}
        hits = [(q, d, s) for q, c in queries_ for s, d in search_shard(found, ids, c, idf_, average, k)]
        shard = table.column("shard")[0].as_py()
        return pa.table({"q": pa.array([h[0] for h in hits], pa_type), "d": pa.array([h[1] for h in hits], pa.int64()), "s": pa.array([h[2] for h in hits], pa.float64()), "salt": pa.array([(shard ^ shard >> 32) % 64] * len(hits), pa.int32())})

    return run


def search(index: DataFrame, queries: DataFrame, query_col: str = "item_id", query_text_col: str = "text", id_col: str = "doc_id", k: int = K) -> DataFrame:
    """``(query, id, rank, score)``: for each query text the ``k`` best documents of all shards.

    Repeated query words count repeatedly; queries without a word found
    nowhere return nothing; a document without a common word is never returned.
    Document frequencies, number and lengths are those of all shards together.
    """
    query_type = queries.schema[query_col].dataType.simpleString()
    rows = queries.select(F.col(query_col).alias("q"), F.col(query_text_col).alias("t")).filter("t is not null and q is not null")
    total = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    pa_type = to_arrow_type(queries.schema[query_col].dataType)
    slabs = max(1, -(-int(total) // SLAB_CHARS))
    whole = index.filter(F.col("term") == F.lit(_NONE)).agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n"), F.coalesce(F.sum("total_dl"), F.lit(0)).alias("dl")).first()
    n_docs, average = int(whole["n"]), max(float(whole["dl"]) / max(1, whole["n"]), 1e-9)
    out = None
    for slab in range(slabs):
        own = [(r["q"], Counter(tokenize(r["t"]))) for r in (rows if slabs == 1 else rows.filter(F.pmod(F.xxhash64("q"), F.lit(slabs)) == slab)).collect()]
        terms = sorted({t for _, c in own for t in c})
        wanted = index.sparkSession.createDataFrame([(bytearray(t),) for t in [*terms, _NONE]], "term binary")
        part = index.filter(F.col("term").isin([F.lit(t) for t in [*terms, _NONE]])) if len(terms) <= 2000 else index.join(F.broadcast(wanted), "term", "left_semi")
        df = {bytes(r["term"]): r["df"] for r in part.filter(F.col("term") != F.lit(_NONE)).groupBy("term").agg(F.sum(F.size("ord")).alias("df")).collect()}
        idf = {t: math.log(1 + (n_docs - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        shared = index.sparkSession.sparkContext.broadcast((own, idf))

        piece = part.groupBy("shard").applyInArrow(_searcher(shared, pa_type, average, k), f"q {query_type}, d long, s double, salt int")
        out = piece if out is None else out.unionByName(piece)
    order = [F.col("s").desc(), F.col("d")]
    some = out.withColumn("r", F.row_number().over(Window.partitionBy("q", "salt").orderBy(*order))).filter(F.col("r") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)
    return best.select(F.col("q").alias(query_col), F.col("d").alias(id_col), "rank", F.col("s").alias("score"))


def top_k(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text_col: str = "text", k: int = K) -> DataFrame:
    """Index every row of ``docs`` (null texts as empty, rows with a null id left out) and search it for every query.

    Whole texts are indexed, however long. Equal scores go by the smaller id, and
    repeated rows each take a rank. Without documents or queries there are no rows.
    """
    return search(materialize(build_index(docs, id_col, text_col), "bm25-index"), queries, query_col, query_text_col, id_col, k)


_SPLIT = r"[\x20\x09-\x0D!-/:-@\[-`{-~]+"
_TOKENS = "unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + _SPLIT + "'))"
ORACLE = f"""
WITH tok AS (SELECT * FROM (SELECT doc_id, {_TOKENS} AS t FROM documents) WHERE t <> ''),
lens AS (SELECT d.doc_id, count(tok.t) AS dl FROM documents d LEFT JOIN tok USING (doc_id) GROUP BY d.doc_id),
stat AS (SELECT count(*) AS n, sum(dl) / count(*) AS average FROM lens),
qtok AS (SELECT item_id, t, count(*) AS qn FROM (SELECT item_id, {_TOKENS} AS t FROM benchmark WHERE item_id % 20 = 0) WHERE t <> '' GROUP BY item_id, t),
tf AS (SELECT doc_id, t, count(*) AS tf FROM tok WHERE t IN (SELECT t FROM qtok) GROUP BY doc_id, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
sc AS (SELECT item_id, doc_id, round(sum(qn * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {K1 + 1} / (tf + {K1} * (1 - {B} + {B} * dl / average))), {DECIMALS}) AS score
  FROM qtok JOIN df USING (t) JOIN tf USING (t) JOIN lens USING (doc_id), stat GROUP BY item_id, doc_id)
SELECT item_id, doc_id, CAST(rank AS INTEGER) AS rank, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc) WHERE rank <= {K}
"""
