"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, text_of
from .textstats import Words, text_slices

#: At most about so many labelled rows are read for training, chosen by a hash of the id.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 60, 4, 64, 0.15, 8
#: The score from which a document is kept.
CUT = 0.3
FEATURES = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "newline", "beyond_ascii", "stop_punct", "pipe", "bang", "symbol", "quote", "punct_words", "kinds", "repeat_pairs", "line_words", "ends_well", "longest_word")
#: Characters counted together, as fixed values.
_CLASSES = {"stop_punct": ".,;:?", "pipe": "|", "bang": "!", "symbol": "#$%&*@^~<>={}[]\\/_+", "quote": "\"'()-"}


def _luts() -> list[np.ndarray]:
    byte = np.arange(256)
    of = lambda s: np.isin(byte, [ord(c) for c in s])
    return [
        (byte >= 65) & (byte <= 90), (byte >= 48) & (byte <= 57), byte == 32, byte == 10, byte >= 128, *[of(v) for v in _CLASSES.values()],
    ]


_LUTS = _luts()


def features(texts: list[str]) -> np.ndarray:
    """One row of statistics for each whole text; empty texts get zeros."""
    n = len(texts)
    raws = [t.encode() for t in texts]
    size = np.array([len(r) for r in raws])
    out = np.zeros((n, len(FEATURES)))
    if not size.sum():
        return out
    data = np.frombuffer(b"".join(raws), np.uint8)
    code = np.zeros(256, np.int64)
    for i, lut in enumerate(_LUTS):
        code[lut] = i + 1
    doc = np.repeat(np.arange(n, dtype=np.int32), size)
    kinds = len(_LUTS) + 1
    counts = np.bincount(doc * kinds + code[data], minlength=n * kinds).reshape(n, kinds)
    safe = np.maximum(size, 1)
    words = Words(texts, drop_punctuation=False)
    n_words = np.diff(words.first)
    some = np.maximum(n_words, 1)
    out[:, 0] = np.log1p(size)
    out[:, 1] = np.log1p(n_words)
    out[:, 2] = (size - counts[:, 3] - counts[:, 4]) / some
    out[:, 3:13] = counts[:, 1:11] / safe[:, None]
    space = (data == 32) | (data == 10)
    head = np.concatenate([[True], doc[1:] != doc[:-1]])  # the first byte of a text
    # the byte before white space or a text's end, if neither letter nor digit, ends a word in a mark
    letter = np.zeros(256, bool)
    letter[48:58] = letter[65:91] = letter[97:123] = letter[128:] = True
    last = np.cumsum(size)[size > 0] - 1
    stops = np.concatenate([last, np.flatnonzero(space[1:] & ~space[:-1] & ~head[1:])])
    out[:, 13] = np.bincount(doc[stops], weights=~letter[data[stops]], minlength=n) / some
    owner = words.doc.astype(np.uint64) << np.uint64(44)
    cut = np.uint64((1 << 44) - 1)
    distinct = np.unique(owner | (words.hash & cut))
    out[:, 14] = np.bincount((distinct >> np.uint64(44)).astype(np.int64), minlength=n) / some
    pairs = words.shingles(2)
    if len(pairs):
        whole = words.doc[1:] == words.doc[:-1]
        kinds2 = np.unique(owner[:-1][whole] | (pairs[whole] & cut))
        out[:, 15] = np.where(n_words > 1, 1 - np.bincount((kinds2 >> np.uint64(44)).astype(np.int64), minlength=n) / np.maximum(n_words - 1, 1), 0)
    lines = counts[:, 4] + 1
    out[:, 16] = np.log1p(n_words / lines)
    ends = np.concatenate([last, np.flatnonzero((data == 10) & ~head) - 1])
    out[:, 17] = np.bincount(doc[ends], weights=np.isin(data[ends], [46, 63, 34]), minlength=n) / lines
    # runs without a blank, from where one begins to where it ends, each within its text
    before, after = np.concatenate([[True], space[:-1]]) | head, np.concatenate([space[1:], [True]])
    after[last] = True
    start, stop = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    np.maximum.at(out[:, 18], doc[start], np.log1p(stop - start + 1))
    out[size == 0] = 0
    return out


@dataclass
class Forest:
    """All trees in flat arrays: ``feature`` -1 marks a leaf; a row goes ``left`` if its value is at most ``threshold``."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum over the trees, every row and tree one level down at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            down = np.where(x[row, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(f < 0, at, down)
        return self.base + self.value[at].sum(axis=1)


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, least: int = LEAST) -> Forest:
    """Logistic boosting; splits are sought among ``bins`` quantile bins of each feature by gradient histograms."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)] if n else [np.zeros(0)] * width
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    mean = min(max(float(y.mean()) if n else 0.5, 1e-4), 1 - 1e-4)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for arr, v in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
            arr.append(v)
        return len(feature) - 1

    offset = np.arange(width) * bins
    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        roots.append(node())
        todo = [(roots[-1], np.arange(n), 0)]
        while todo:
            k, rows, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            value[k] = rate * gs / (hs + 1.0)
            best = None
            if level < depth and len(rows) >= 2 * least:
                flat = (binned[rows] + offset).ravel()
                hist = [np.bincount(flat, weights=w, minlength=width * bins).reshape(width, bins).cumsum(axis=1) for w in (np.repeat(g[rows], width), np.repeat(h[rows], width), None)]
                gl, hl, cl = hist
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(cl < least) | (len(rows) - cl < least)] = -1
                where = int(gain.argmax())
                if gain.flat[where] > 1e-6:
                    best = divmod(where, bins)
            if best is None:
                margin[rows] += value[k]
                continue
            f, b = best
            feature[k], threshold[k] = f, float(edges[f][b])
            low = binned[rows, f] <= b
            left[k], right[k] = node(), node()
            todo += [(left[k], rows[low], level + 1), (right[k], rows[~low], level + 1)]
    return Forest(np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64), np.array(right, np.int64), np.array(value), np.array(roots, np.int64), base, depth)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", modulus: int = 5, held_fold: int = 0, train_rows: int = TRAIN_ROWS) -> Forest:
    """Train on labelled rows outside the held-out fold.

    At most about ``train_rows`` labels are taken, by a hash of the id; their
    whole texts are turned into statistics on the executors, and only those reach
    the driver. Labels without a document, null labels and null ids are ignored;
    of several labels of an id the smallest counts.
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y is not null").filter(fold("id", modulus) != held_fold).groupBy("id").agg(F.min("y").alias("y"))
    n = usable.count()
    if not n:
        return boost(np.zeros((0, len(FEATURES))), np.zeros(0))
    share = int(min(1.0, train_rows / n) * (1 << 30))
    few = F.broadcast(usable.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share))  # about train_rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in text_slices(batch.column(0)):
                x = features(texts)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, len(texts)), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(few, "id").select("text", "y").mapInArrow(run, "y int, x array<double>").collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))
    return boost(np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, score, predicted[, keep...])`` of every row; null and empty texts are scored by their zero statistics."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    id_type = docs.schema[id_col].dataType.simpleString()
    more = [(f"keep_{i}", docs.schema[c].dataType.simpleString()) for i, c in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for a, texts in text_slices(batch.column(1)):
                out[a : a + len(texts)] = 1 / (1 + np.exp(-shared.value.margin(features(texts))))
            cols = [batch.column(0), pa.array(out, pa.float64()), pa.array((out >= cut).astype(np.int32), pa.int32()), *[batch.column(2 + i) for i in range(len(more))]]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "score", "predicted", *[c for c, _ in more]])

    rows = docs.select(F.col(id_col), text_of(text_col).alias("text__"), *[F.col(c).alias(k) for c, (k, _) in zip(keep, more, strict=True)])
    return rows.mapInArrow(run, ", ".join([f"`{id_col}` {id_type}, score double, predicted int", *[f"{k} {t}" for k, t in more]]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, held_fold: int = 0) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row, learned outside the held-out fold; repeated rows give equal rows."""
    out = score(docs, fit(docs, labels, id_col, text_col, "quality", modulus, held_fold), id_col, text_col)
    return out.select(id_col, F.coalesce(fold(id_col, modulus) == held_fold, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the classifier does not reject, with the columns they came with.

    Null and empty texts are judged by their zero statistics; repeated rows share
    a fate; rows with a null id stay or go by their text; an empty table stays empty.
    """
    names = docs.columns
    scored = score(docs, fit(docs, labels, id_col, text_col), id_col, text_col, keep=tuple(c for c in names if c != id_col))
    back = {c: f"keep_{i}" for i, c in enumerate(c for c in names if c != id_col)}
    return scored.filter("predicted = 1").select(*[F.col(back.get(c, c)).alias(c) for c in names])
