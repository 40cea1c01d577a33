"""Language identification by prediction by partial matching.

One variable-order tree of byte contexts holds the counts of all languages.
Escapes follow method C with exclusion: in a context with ``t`` seen bytes of
``d`` kinds a seen byte has ``c / (t + d)`` and the escape ``d / (t + d)``; after an
escape the bytes seen in the longer context no longer count. The statistics are
frozen after training, so the exact code length of a byte depends only on the
few bytes before it: it is worked out once for each node when the tree is built,
and scoring is a walk along child tables, for all bytes of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, text_of

#: Longest context in bytes.
ORDER = 3
#: At most about so many training texts of a language are read; each of them whole.
TRAIN_TEXTS = 400
#: Bytes of a text above which it is not learned from (it is still scored whole).
TRAIN_BYTES = 1 << 16
#: Bytes that a worker scores at once.
CHUNK = 1 << 21


@dataclass
class ContextTrees:
    """children[k][node * 256 + byte]: node of the context of k + 1 bytes, 0 if unseen; cost[k][node]: bits of the
    node's last byte after the bytes before it; skip[k][node]: bits to add when a byte unseen in the context falls back."""

    langs: list[str]
    children: list[np.ndarray]
    cost: list[np.ndarray]
    skip: list[np.ndarray]


def train(texts: dict[str, list[bytes]], order: int = ORDER) -> ContextTrees:
    """Count contexts of up to ``order`` bytes and freeze the code lengths."""
    langs = sorted(texts)
    n_langs = len(langs)
    if not langs:
        return ContextTrees([], [], [], [])
    joined = []
    for lang in langs:
        # a context never reaches over a text's start: order zeros stand before it
        joined.append(np.frombuffer(b"".join(bytes(order) + t for t in texts[lang]) or bytes(order), np.uint8))
    children: list[np.ndarray] = []
    nodes: list[list[np.ndarray]] = [[np.zeros(len(x), np.int64) for x in joined]]
    counts: list[np.ndarray] = [np.zeros((1, n_langs))]
    parents: list[np.ndarray] = []
    last: list[np.ndarray] = []
    for depth in range(order + 1):
        # node of the last depth + 1 bytes = child of the node of the depth bytes before the last one
        before = [np.concatenate([np.zeros(min(1, len(x)), np.int64), x[:-1]]) for x in nodes[depth]]
        key = [b * 256 + x for b, x in zip(before, joined, strict=True)]
        seen = np.unique(np.concatenate(key))
        table = np.zeros(len(counts[depth]) * 256, np.int32)
        table[seen] = np.arange(1, len(seen) + 1)
        children.append(table)
        ids = [table[k].astype(np.int64) for k in key]
        nodes.append(ids)
        count = np.zeros((len(seen) + 1, n_langs))
        for i, (x, text) in enumerate(zip(ids, joined, strict=True)):
            real = np.ones(len(text), bool)
            at, zero = 0, order
            for t in texts[langs[i]]:
                real[at : at + zero] = False
                at += zero + len(t)
            if not texts[langs[i]]:
                real[:] = False
            count[:, i] = np.bincount(x[real], minlength=len(seen) + 1)
        counts.append(count)
        parents.append(np.concatenate([[0], seen // 256]))
        last.append(np.concatenate([[0], seen % 256]))
    cost: list[np.ndarray] = []
    skip: list[np.ndarray] = []
    shorter: np.ndarray | None = None  # node of the same context and byte, without the context's first byte
    for depth in range(order + 1):
        count, parent, byte = counts[depth + 1], parents[depth], last[depth]
        n = len(counts[depth])
        if depth == 0:
            lower = np.full((len(count), n_langs), 8.0)
            ctx_shorter = np.zeros(1, np.int64)
            low_count = np.ones((len(count), n_langs))
            low_total, low_kinds = np.full((1, n_langs), 256.0), np.zeros((1, n_langs))
        else:
            # the context's nodes at depth - 1 were paired with their shorter forms when that depth was made
            ctx_shorter = shorter
            below = children[depth - 1][ctx_shorter[parent] * 256 + byte]
            lower = cost[depth - 1][below]
            low_count = counts[depth][below]
            low_total, low_kinds = total, kinds
        total = np.zeros((n, n_langs))
        kinds = np.zeros((n, n_langs))
        np.add.at(total, parent[1:], count[1:])
        np.add.at(kinds, parent[1:], (count[1:] > 0).astype(float))
        excluded = np.zeros((n, n_langs))
        np.add.at(excluded, parent[1:], np.where(count[1:] > 0, low_count[1:], 0.0))
        whole = (low_total + low_kinds)[ctx_shorter]
        left = np.maximum(whole - excluded, 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            drop = np.log2((total + kinds) / kinds) + np.log2(left / whole)
            drop = np.where(kinds > 0, drop, 0.0)
            here = np.where(count > 0, np.log2((total + kinds)[parent]) - np.log2(count), drop[parent] + lower)
        cost.append(here.astype(np.float32))
        skip.append(drop.astype(np.float32))
        if depth == 0:
            shorter = np.zeros(len(count), np.int64)
        else:
            shorter = children[depth - 1][ctx_shorter[parent] * 256 + byte].astype(np.int64)
        shorter[0] = 0
    return ContextTrees(langs, children, cost, skip)


def code_lengths(trees: ContextTrees, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Total bits of each text under each language; ``data``: the texts' bytes, each text after ORDER zero bytes."""
    order, n = len(trees.children) - 1, len(data)
    node = np.zeros(n + 1, np.int64)  # of the contexts before each byte, shifted by one
    x = data.astype(np.int64)
    made, contexts = [], []
    for depth in range(order + 1):
        contexts.append(node[:n])
        below = trees.children[depth][node[:n] * 256 + x]
        if depth:
            below[contexts[depth] == 0] = 0
        made.append(below)
        node = np.concatenate([[0], below])
    bits = trees.cost[order][made[order]].copy()
    rest = np.flatnonzero(made[order] == 0)
    bits[rest] = 0
    for depth in range(order, -1, -1):
        if depth < order:
            found = made[depth][rest] != 0
            hit = rest[found]
            bits[hit] += trees.cost[depth][made[depth][hit]]
            rest = rest[~found]
        if not len(rest):
            break
        ctx = contexts[depth][rest]
        bits[rest] += trees.skip[depth][ctx] * ((ctx != 0) | (depth == 0))[:, None]
    bits[rest] += 8.0
    real = np.ones(n, bool)
    for k in range(order):
        real[starts + k] = False
    bits[~real] = 0
    return np.add.reduceat(bits, starts, axis=0, dtype=np.float64)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_texts: int = TRAIN_TEXTS, order: int = ORDER) -> ContextTrees:
    """Train on whole texts of about ``train_texts`` rows of each language, chosen by a hash of the id and of the text.

    Only texts of at most ``TRAIN_BYTES`` are learned from, so what reaches the
    driver is bounded; a language without such texts is not learned.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null and text is not null").filter(F.octet_length("text") <= TRAIN_BYTES)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return train({})
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, train_texts / n) * (1 << 30)))])
    picked = rows.filter(F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 30)) < share[F.col("lang")])
    texts: dict[str, list[bytes]] = {lang: [] for lang in sizes}
    for r in picked.select("lang", "text").collect():
        texts[r["lang"]].append(r["text"].encode())
    return train({k: sorted(v) for k, v in texts.items()}, order)


def predict(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row: the language with the shortest code for the whole text, and its share
    ``2^-bits`` of all languages' (tempered per byte, so that long texts do not all score 1).

    A null text or one without a letter is ``und`` with score 0. Ties go to the
    first language in code-point order. Without trained languages all rows are
    ``und``. Repeated rows give equal rows; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        order = len(model.children) - 1
        pad = bytes(max(order, 0))
        for batch in batches:
            texts = [v.as_py() for v in batch.column(1)]
            preds, scores = ["und"] * len(texts), [0.0] * len(texts)
            group: list[int] = []
            size = 0

            def flush(group: list[int], texts=texts, preds=preds, scores=scores) -> None:
                raws = [texts[i].encode() for i in group]
                lengths = np.array([len(r) for r in raws])
                starts = np.concatenate([[0], np.cumsum(lengths + order)[:-1]])
                total = np.zeros((len(raws), len(model.langs)))
                if len(raws) == 1 and lengths[0] > CHUNK:
                    # a long text goes in slices, each after the bytes before it, which are context but not counted
                    raw = memoryview(pad + raws[0])
                    for at in range(0, len(raw) - order, CHUNK):
                        own = raw[at : at + order + CHUNK]
                        total += code_lengths(model, np.frombuffer(own, np.uint8), np.array([0]))
                else:
                    total = code_lengths(model, np.frombuffer(b"".join(pad + r for r in raws), np.uint8), starts)
                best = total.argmin(axis=1)
                rate = (total - total.min(axis=1, keepdims=True)) / np.maximum(lengths, 1)[:, None]
                share = np.exp2(-rate * np.minimum(lengths, 64)[:, None])
                for i, k, s in zip(group, best, 1 / share.sum(axis=1), strict=True):
                    preds[i], scores[i] = model.langs[k], float(s)

            for i, text in enumerate(texts):
                if text is None or not model.langs or not any(map(str.isalpha, text)):
                    continue
                if size + len(text) > CHUNK // 2 and group:
                    flush(group)
                    group, size = [], 0
                group.append(i)
                size += len(text) * 2
            if group:
                flush(group)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", modulus: int = 4, held_fold: int = 2) -> DataFrame:
    """Train outside the held-out fold and predict every row: ``(id, held_out, lang_pred, score)``."""
    trees = fit(docs.filter(fold(id_col, modulus) != held_fold), id_col, text_col, lang_col)
    out = predict(docs, trees, id_col, text_col)
    return out.select(id_col, F.coalesce(fold(id_col, modulus) == held_fold, F.lit(False)).alias("held_out"), "lang_pred", "score")
