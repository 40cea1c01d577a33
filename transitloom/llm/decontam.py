"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .textstats import Words, text_slices

#: Words of a shingle; least similarity; differing bits up to which a window is verified.
WORDS, SIMILAR, RADIUS = 5, 0.8, 20
#: Items are broadcast in slabs of at most so many characters; a larger table takes several passes over the documents.
SLAB_CHARS = 32 << 20
_BITMAP = 22


def _simhash(shingles: np.ndarray) -> int:
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(shingles)).tobytes(), "big")


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two multisets of shingles: sum of smaller over sum of larger counts."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low / max(1, sum(a.values()) + sum(b.values()) - low)


@dataclass
class Group:
    """The items of one length: word and shingle counts, fingerprints, and for each block the items by its value."""

    n: int
    k: int
    items: list[int]
    prints: np.ndarray
    counts: list[Counter]
    blocks: list[dict[int, np.ndarray]]
    bounds: list[tuple[int, int]]


class ItemIndex:
    """Fingerprints of all items in multi-index blocks, and which shingles occur in items of which length.

    ``RADIUS + 1`` blocks: two fingerprints within the radius agree on at least one whole block.
    """

    def __init__(self, texts: list[str], words: int = WORDS, radius: int = RADIUS) -> None:
        self.words, self.radius = words, radius
        w = Words(texts, drop_punctuation=True)
        by_n: dict[int, list[int]] = {}
        for i, n in enumerate(np.diff(w.first)):
            if n:
                by_n.setdefault(int(n), []).append(i)
        edges = np.linspace(0, 64, radius + 2).astype(int)
        bounds = [(int(a), int(b)) for a, b in zip(edges, edges[1:], strict=False)]
        self.groups: list[Group] = []
        shingles: dict[int, list[tuple[np.ndarray, int]]] = {}
        all_sh = {k: w.shingles(k) for k in {min(words, n) for n in by_n}}
        for n, items in sorted(by_n.items()):
            k = min(words, n)
            own = [all_sh[k][w.first[i] : w.first[i] + n - k + 1] for i in items]
            prints = np.array([_simhash(s) for s in own], np.uint64)
            blocks = []
            for a, b in bounds:
                value = (prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
                blocks.append({int(v): np.flatnonzero(value == v) for v in np.unique(value)})
            for s in own:
                shingles.setdefault(k, []).append((s, len(self.groups)))
            self.groups.append(Group(n, k, items, prints, [Counter(s.tolist()) for s in own], blocks, bounds))
        #: by shingle size: bitmap, sorted shingles and, in parallel, their group; a shingle of two groups has two rows
        self.lookup = {}
        for k, parts in shingles.items():
            key = np.concatenate([s for s, _ in parts])
            group = np.concatenate([np.full(len(s), g) for s, g in parts])
            rows = np.unique(np.stack([key, group.astype(np.uint64)], axis=1), axis=0)
            bitmap = np.zeros(1 << _BITMAP, bool)
            bitmap[(rows[:, 0] >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True
            self.lookup[k] = (bitmap, rows[:, 0].copy(), rows[:, 1].astype(np.int64))

    def near(self, group: Group, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs (index in ``prints``, index in the group) within the radius, found by equal blocks."""
        pairs = []
        for (a, b), table in zip(group.bounds, group.blocks, strict=True):
            value = (prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
            for v, items in table.items():
                at = np.flatnonzero(value == v)
                if len(at):
                    pairs.append(np.stack([np.repeat(at, len(items)), np.tile(items, len(at))]))
        if not pairs:
            return
        rows = np.unique(np.concatenate(pairs, axis=1), axis=1)
        close = np.bitwise_count(prints[rows[0]] ^ group.prints[rows[1]]) <= self.radius
        yield from rows[:, close].T.tolist()

    def scan(self, texts: list[str], least: float = SIMILAR) -> Iterator[tuple[int, int, int, int, int, float]]:
        """``(text, item, start, n_words, distance, similarity)``: the most similar window of each text for each item."""
        words = Words(texts, drop_punctuation=True)
        for k, (bitmap, keys, owner) in self.lookup.items():
            sh = words.shingles(k)
            if not len(sh):
                continue
            at = np.flatnonzero(bitmap[(sh >> np.uint64(64 - _BITMAP)).astype(np.int64)])
            at = at[words.doc[at] == words.doc[at + k - 1]]
            lo, hi = np.searchsorted(keys, sh[at], "left"), np.searchsorted(keys, sh[at], "right")
            some = hi > lo
            at, lo, hi = at[some], lo[some], hi[some]
            if not len(at):
                continue
            reps = hi - lo
            pos = np.repeat(at, reps)
            row = np.repeat(lo, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            group = owner[row]
            doc = words.doc[pos]
            order = np.lexsort((pos, group, doc))
            pos, group, doc = pos[order], group[order], doc[order]
            cut = np.flatnonzero((np.diff(doc) != 0) | (np.diff(group) != 0)) + 1
            for part in np.split(np.arange(len(pos)), cut):
                yield from self._windows(words, sh, int(doc[part[0]]), self.groups[group[part[0]]], pos[part], least)

    def _windows(self, words: Words, sh: np.ndarray, doc: int, g: Group, pos: np.ndarray, least: float) -> Iterator[tuple]:
        first, last = int(words.first[doc]), int(words.first[doc + 1])
        n = min(g.n, last - first)  # a text shorter than the items is one window
        m = n - g.k + 1  # shingles of a window
        # A window as similar as asked holds at least this many shingles of an item, whatever its own size.
        need = max(1, int(np.ceil(least * (g.n - g.k + 1) - 1e-9)))
        if m < need:
            return
        # Each position (they are distinct) counts in all windows that hold it: those that start up to m - 1 before it.
        lo, hi = np.maximum(pos - m + 1, first), np.minimum(pos, last - n)
        base = int(lo.min())
        change = np.zeros(int(hi.max()) - base + 2, np.int64)
        np.add.at(change, lo - base, 1)
        np.add.at(change, hi - base + 1, -1)
        starts = np.flatnonzero(np.cumsum(change)[:-1] >= need) + base
        best: dict[int, tuple[float, int, int]] = {}
        for a in range(0, len(starts), 4096):
            some = starts[a : a + 4096]
            low = int(some[0])
            own = sh[low : int(some[-1]) + m]
            bits = np.unpackbits(own.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
            ones = total[some - low + m] - total[some - low]
            prints = np.packbits(ones * 2 > m, axis=1).view(">u8").ravel().astype(np.uint64)
            for i, j in self.near(g, prints):
                s = int(some[i])
                similarity = weighted_similarity(Counter(sh[s : s + m].tolist()), g.counts[j])
                if similarity >= least - 1e-12:
                    found = (similarity, -s, int(np.bitwise_count(prints[i] ^ g.prints[j])))
                    if g.items[j] not in best or found[:2] > best[g.items[j]][:2]:
                        best[g.items[j]] = found
        for item, (similarity, minus, distance) in sorted(best.items()):
            yield doc, item, -minus - first, n, distance, similarity


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = SIMILAR) -> DataFrame:
    """``(id, item, window_start, n_words, distance, similarity)``: for each document and item its most similar window.

    Words are lower-cased (A-Z) and freed of ASCII punctuation; windows have as
    many words as the item and are compared as multisets of five-word shingles
    (items of fewer words: of all their words); a text of fewer words than the
    item is one window. Windows that hold fewer item
    shingles than the similarity asks for cannot reach it and get no
    fingerprint; all others are fingerprinted, looked up and verified. Ties go to
    the first window. Null and empty texts and items match nothing; null ids are
    carried; repeated rows give equal rows. No shuffle: items travel in slabs of
    a bounded size, so a larger benchmark means more passes, not more memory.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    out = None
    for shared in _slabs(items, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, index = shared.value
            for batch in batches:
                ids = batch.column(0)
                for a, texts in text_slices(batch.column(1)):
                    found = list(index.scan(texts, least))
                    if not found:
                        continue
                    doc, item, start, n, distance, similarity = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([a + d for d in doc])), pa.array([names[i] for i in item]), pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array(distance, pa.int32()), pa.array(similarity, pa.float64())],
                        [id_col, item_col, "window_start", "n_words", "distance", "similarity"],
                    )

        piece = docs.select(F.col(id_col), text_of(text_col).alias("text__")).mapInArrow(run, f"`{id_col}` {id_type}, `{item_col}` {item_type}, window_start long, n_words int, distance int, similarity double")
        out = piece if out is None else out.unionByName(piece)
    return out


def _slabs(items: DataFrame, item_col: str, item_text_col: str) -> Iterator[Broadcast]:
    """The items' ids and index, sent to all tasks in slabs of at most about ``SLAB_CHARS`` characters; one slab at least."""
    rows = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).filter("text is not null")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_slabs = max(1, -(-int(total) // SLAB_CHARS))
    for slab in range(n_slabs):
        part = rows if n_slabs == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_slabs)) == slab)
        own = sorted(((r["item"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r))
        yield items.sparkSession.sparkContext.broadcast(([r[0] for r in own], ItemIndex([r[1] for r in own])))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage (see ``contamination``), with the columns they came with.

    Each row is judged by its own text, so nothing is shuffled: rows with null
    or empty texts stay, repeated rows share a fate, and ids play no part.
    """
    at = docs.columns.index(text_col)
    for shared in _slabs(items, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value[1]
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for a, texts in text_slices(batch.column(at)):
                    clean[[a + found[0] for found in index.scan(texts, least)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
