"""Exact removal of long repeated byte strings: threshold-bounded interval expansion on Burrows-Wheeler transforms.

A window is a string of ``least`` bytes. Its anchor is the first of the byte
strings of ``GRAM`` bytes in it with the smallest hash, so equal windows have
equal anchors wherever they stand. A run of windows with one anchor is a
context: the bytes from the first window's start to the last one's end. Every
window lies in exactly one context, and windows can only be equal where their
contexts share an anchor. So contexts are dealt by anchor; those whose anchor
occurs once are done. Equal contexts meet in one row, by count, before any bytes
move. What differs goes, by anchor, into texts of bounded size, on whose
Burrows-Wheeler transforms common prefixes are derived by increasing value; those
that reach ``least`` are the repeated windows. A symbol of a transform stands for a
fixed share of ``least`` bytes (50 of 400) and one begins at every byte, so the
prefixes grow by that many bytes a level and the answer stays exact to the byte. Anchors with very many different
contexts are dealt once more, by window, so no group grows with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, text_of
from .textstats import _BASE, _INVERSE, _powers, mix

LEAST, GRAM = 400, 48
#: Bytes scanned at once; longer texts go in slices. Bytes of a transform; contexts of an anchor that one may hold.
SLICE, SHARD_BYTES, HOT = 4 << 20, 1 << 19, 1024
#: Bytes that a symbol of a transform stands for, at most.
SYMBOL = 64
_BASE2 = 0xD6E8FEB86659FD93
_INVERSE2 = pow(_BASE2, -1, 1 << 64)


def contexts(data: np.ndarray, ends: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first window, last window, anchor hash)`` of every context of texts that end at ``ends`` in ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n, _BASE), dtype=np.uint64)])
    h = mix((total[gram:] - total[:-gram]) * _powers(n - gram + 1, _INVERSE))
    # a hash with its place below: the minimum of a window is its anchor, the first one among equals
    packed = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    width, span, low = least - gram + 1, 1, packed
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(packed) - width + 1], low[width - span : width - span + len(packed) - width + 1])
    anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    owner = np.searchsorted(ends, np.arange(n - least + 1), "right")
    valid = np.arange(n - least + 1) + least <= ends[owner]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new & valid)
    if not len(start):
        return none, none, np.zeros(0, np.uint64)
    stop_mark = np.concatenate([new[1:] | ~valid[1:], [True]]) & valid
    return start, np.flatnonzero(stop_mark), h[anchor[start]]


def _slices(raws: list[bytes], least: int) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Texts in batches of about ``SLICE`` bytes as ``[(text, offset)], bytes``; a long text in slices that share ``least - 1`` bytes."""
    own, parts, size = [], [], 0
    for i, raw in enumerate(raws):
        for at in range(0, max(1, len(raw) - least + 1), SLICE):
            piece = raw[at : at + SLICE + least - 1]
            if parts and size + len(piece) > SLICE:
                yield list(zip(own, map(len, parts), strict=True)), b"".join(parts)
                own, parts, size = [], [], 0
            own.append((i, at))
            parts.append(piece)
            size += len(piece)
    if parts:
        yield list(zip(own, map(len, parts), strict=True)), b"".join(parts)


def stride(least: int) -> int:
    """Bytes of a symbol: the largest divisor of ``least`` up to ``SYMBOL`` that leaves two symbols at least."""
    return max(s for s in range(1, min(SYMBOL, least // 2) + 1) if least % s == 0)


def in_order(key: np.ndarray, bits: int) -> np.ndarray:
    """Places by increasing key, the first place first among equals; keys of up to ``bits`` bits sort with their place below them."""
    low = max(1, len(key) - 1).bit_length()
    if bits + low > 63:
        return np.argsort(key, kind="stable")
    packed = (key.astype(np.int64) << np.int64(low)) | np.arange(len(key))
    packed.sort()
    return packed & np.int64((1 << low) - 1)


def changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it; not at the first."""
    return np.concatenate([[False], values[1:] != values[:-1]])


def symbols(data: np.ndarray, inside: np.ndarray, step: int) -> np.ndarray:
    """The name of the ``step`` bytes from each place on; 0 where they run past a text's end (``inside`` is false there).

    Equal names stand for equal pairs of 64-bit hashes.
    """
    n = len(data)
    names = np.zeros(n, np.int64)
    if n < step:
        return names
    hashes = []
    for base, inverse in ((_BASE, _INVERSE), (_BASE2, _INVERSE2)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n, base), dtype=np.uint64)])
        hashes.append(mix((total[step:] - total[:-step]) * _powers(n - step + 1, inverse)))
    outside = np.concatenate([[0], np.cumsum(~inside)])
    whole = np.flatnonzero(outside[step:] == outside[:-step])
    first, second = hashes[0][whole], hashes[1][whole]
    bits = 63 - max(1, len(whole) - 1).bit_length()
    order = in_order(first >> np.uint64(64 - bits), bits)
    new = changes(first[order] >> np.uint64(64 - bits))
    if (changes(second[order]) & ~new).any():  # two strings share the leading bits
        order = np.lexsort((second, first))
        new = changes(first[order])
    names[whole[order]] = 1 + np.cumsum(new | changes(second[order]))
    return names


def transform(names: np.ndarray, step: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ordered by the ``depth`` symbols from each on, ``step`` apart, and the Burrows-Wheeler transform: the symbol before each."""
    n, rank, have = len(names), names, 1
    bits = n.bit_length()
    order = in_order(rank, bits)
    while have < depth:
        take = min(have, depth - have)
        key = (rank << np.int64(bits)) | np.roll(rank, -take * step)
        order = in_order(key, 2 * bits)
        have += take
        if have < depth:
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(changes(key[order]))
    return order, names[order - step]


def long_prefixes(bwt: np.ndarray, depth: int) -> np.ndarray:
    """For each rank: does its place share ``depth`` symbols with the one before it in order?

    Common prefixes by increasing value: none between different first symbols;
    then, level by level, all intervals found so far are extended backwards by a
    symbol. Two neighbours with one first symbol share one symbol more than the
    least shared between their remainders, which the transform holds in the same
    order: they are parted at the first level at which a bound lies between
    these. Only pairs not parted yet are looked at again; expansion stops at
    ``depth``, and what is not parted then reaches it.
    """
    n = len(bwt)
    order = in_order(bwt, n.bit_length()).astype(np.int32)  # remainder's rank for each rank
    shared = ~changes(bwt[order])
    shared[:1] = False
    live = np.flatnonzero(shared).astype(np.int32)
    low, high = order[live - 1], order[live]
    for _ in range(1, depth):
        bounds = np.cumsum(~shared, dtype=np.int32)
        stays = bounds[high] == bounds[low]
        if stays.all():
            break
        shared[live[~stays]] = False
        live, low, high = live[stays], low[stays], high[stays]
    return shared


def repeated_windows(parts: list[bytes], least: int) -> list[np.ndarray]:
    """For each text the starts of its windows that also start elsewhere in the texts."""
    step = stride(least)
    sizes = np.array([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8)
    inside = np.ones(len(data), bool)
    inside[starts + sizes - 1] = False  # no window holds an end, so one symbol serves for all
    order, bwt = transform(symbols(data, inside, step), step, least // step)
    shared = long_prefixes(bwt, least // step)
    both = shared.copy()
    both[:-1] |= shared[1:]
    mark = np.zeros(len(data), bool)
    mark[order[both]] = True
    return [np.flatnonzero(mark[s : s + max(0, n - least)]) for s, n in zip(starts, sizes, strict=True)]


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of consecutive numbers as (first, last)."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) != 1)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), at[np.concatenate([cut, [len(at) - 1]])].tolist(), strict=True))


_RUNS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
_FOUND = "key long, c1 long, c2 long, runs array<struct<lo:int,hi:int>>"


def _found(rows: list[tuple[int, int, int, list[tuple[int, int]]]]) -> pa.Table:
    return pa.table(
        {
            "key": pa.array([r[0] for r in rows], pa.int64()), "c1": pa.array([r[1] for r in rows], pa.int64()), "c2": pa.array([r[2] for r in rows], pa.int64()),
            "runs": pa.array([[{"lo": a, "hi": b} for a, b in r[3]] for r in rows], _RUNS),
        }
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, keep_text: bool = False) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary])`` of every row.

    A byte goes if some string of ``least`` bytes over it also starts anywhere
    else in the table, in the same text too; overlaps count, and strings are
    judged on the input. Null and empty texts have no bytes; texts shorter than
    ``least`` lose none; a row that is repeated loses all bytes of a text that is
    long enough, in each of its copies; null ids are carried.
    """
    import xxhash

    if least <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    id_type = docs.schema[id_col].dataType.simpleString()
    # u1, u2 name a row by id and text: rows equal in both lose the same bytes
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumns({"u1": F.xxhash64("id", "text"), "u2": F.xxhash64("text", "id", F.lit(1))})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            raws = [v.as_py().encode() for v in batch.column(0)]
            u1, u2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for own, data in _slices(raws, least):
                ends = np.cumsum([n for _, n in own])
                lo, hi, key = contexts(np.frombuffer(data, np.uint8), ends, least, GRAM)
                if not len(lo):
                    continue
                which = np.searchsorted(ends, lo, "right")
                doc, shift = np.array([i for (i, _), _ in own])[which], (np.array([at for (_, at), _ in own]) - (ends - [n for _, n in own]))[which]
                view = memoryview(data)
                c = np.frombuffer(b"".join([digest(view[a:b]) for a, b in zip(lo.tolist(), (hi + least).tolist(), strict=True)]), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(u1[doc]), pa.array(u2[doc]), pa.array((lo + shift).astype(np.int64)), pa.array((hi - lo + least).astype(np.int32))],
                    ["key", "c1", "c2", "u1", "u2", "at", "size"],
                )

    long_ = rows.filter(F.octet_length("text") >= least)
    every = materialize(long_.select("text", "u1", "u2").mapInArrow(scan, "key long, c1 long, c2 long, u1 long, u2 long, at long, size int"), "sa-contexts")
    twice = materialize(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "sa-anchors")
    live = materialize(every.join(twice, "key", "left_semi"), "sa-live")
    discard(every, twice)
    classes = materialize(live.groupBy("key", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.min(F.struct("u1", "u2", "at")).alias("rep")), "sa-classes")
    kinds = materialize(classes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "sa-kinds")
    mixed = classes.join(kinds, "key").select("key", "c1", "c2", "n", "size", "kinds", "rep.u1", "rep.u2", "rep.at")
    # the bytes of one context of each class, cut out of its document
    wanted = mixed.groupBy("u1", "u2").agg(F.collect_list(F.struct("key", "c1", "c2", "n", "size", "kinds", "at")).alias("cut"))
    texts = long_.select("u1", "u2", "text").join(wanted, ["u1", "u2"])

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = text.as_py().encode()
                out += [(c["key"], c["c1"], c["c2"], c["n"], c["kinds"], raw[c["at"] : c["at"] + c["size"]]) for c in cuts]
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.binary())], ["key", "c1", "c2", "n", "kinds", "bytes"])

    # rows equal in id and text come out more than once
    pieces = materialize(texts.select("text", "cut").mapInArrow(cut_out, "key long, c1 long, c2 long, n long, kinds long, bytes binary"), "sa-pieces")
    cool = pieces.filter(F.col("kinds") <= HOT)
    size = cool.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    n_shards = max(1, -(-int(size) // SHARD_BYTES))

    def expand(table: pa.Table) -> pa.Table:
        seen: dict[tuple, tuple[int, bytes]] = {}
        for k, a, b, n, raw in zip(*(table.column(c).to_pylist() for c in ("key", "c1", "c2", "n", "bytes")), strict=True):
            seen[k, a, b] = (n, raw)
        names = sorted(seen)
        marks = repeated_windows([seen[x][1] for x in names], least)
        return _found([(*x, _runs(m)) for x, m in zip(names, marks, strict=True) if seen[x][0] == 1 and len(m)])

    shards = cool.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(n_shards)))
    found = shards.groupBy("shard").applyInArrow(expand, _FOUND)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for k, a, b, n, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                m = len(raw) - least + 1
                w = np.frombuffer(b"".join([digest(raw[i : i + least]) for i in range(m)]), np.int64).reshape(-1, 2)
                full = lambda v, m=m: pa.array(np.full(m, v, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(w[:, 0]), pa.array(w[:, 1]), full(k), full(a), full(b), full(n), pa.array(np.arange(m, dtype=np.int32))], ["w1", "w2", "key", "c1", "c2", "n", "at"])

    hot = pieces.filter(F.col("kinds") > HOT).dropDuplicates(["key", "c1", "c2"])
    if not hot.isEmpty():
        single = materialize(hot.select("key", "c1", "c2", "n", "bytes").mapInArrow(windows, "w1 long, w2 long, key long, c1 long, c2 long, n long, at int"), "sa-windows")
        again = materialize(single.groupBy("w1", "w2").agg(F.sum("n").alias("all")).filter("all > 1").select("w1", "w2"), "sa-again")

        def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k, a, b, at = (batch.column(i).to_pylist() for i in range(4))
                yield from _found([(x, y, z, _runs(np.sort(np.array(v)))) for x, y, z, v in zip(k, a, b, at, strict=True)]).to_batches()

        one = single.filter("n = 1").join(again, ["w1", "w2"], "left_semi").groupBy("key", "c1", "c2").agg(F.collect_list("at").alias("at"))
        found = found.unionByName(one.mapInArrow(join_up, _FOUND))
    whole = classes.filter("n > 1").select("key", "c1", "c2", F.array(F.struct(F.lit(0).alias("lo"), (F.col("size") - least).alias("hi"))).alias("runs"))
    ruled = materialize(found.unionByName(whole), "sa-found")
    spans = live.join(ruled, ["key", "c1", "c2"]).select("u1", "u2", F.explode(F.transform("runs", lambda r: F.struct((F.col("at") + r["lo"]).alias("lo"), (F.col("at") + r["hi"] + least).alias("hi")))).alias("span"))
    removed = materialize(spans.groupBy("u1", "u2").agg(F.collect_list("span").alias("spans")), "sa-removed")
    discard(classes, kinds, pieces, ruled, live)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, digests, kept_ = [], [], [], [], []
            for text, spans_ in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py().encode()
                kept, at, gone, runs = [], 0, 0, 0
                own = spans_.values if spans_.is_valid else None
                pairs = np.stack([own.field("lo").to_numpy(), own.field("hi").to_numpy()], axis=1) if own is not None else np.zeros((0, 2), np.int64)
                end = -1
                for lo, hi in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
                    if lo > end:
                        runs += 1
                        if lo > at:
                            kept.append(raw[at:lo])
                        gone += hi - lo
                        end = hi
                    elif hi > end:
                        gone += hi - end
                        end = hi
                    at = max(at, end)
                kept.append(raw[at:])
                rest = b"".join(kept)
                n_bytes.append(len(raw))
                n_removed.append(gone)
                n_spans.append(runs)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept_.append(rest)
            cols = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array(kept_, pa.binary())] if keep_text else [])], [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])])

    out = rows.join(removed, ["u1", "u2"], "left").select("id", "text", "spans")
    return out.mapInArrow(finish, f"`{id_col}` {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else ""))
