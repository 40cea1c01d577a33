"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: A match of the split pattern has white space only at its start or throughout, so
#: no match spans a place between another character and white space, and no
#: look-ahead sees across it. Texts may be cut there without changing any match.
_SAFE = re.compile(r"[0-9A-Za-z.,;:!?)](?=[ \n])")
#: Texts above so many characters are encoded piece by piece.
PIECE = 1 << 16
#: Runs of so many white-space characters (the Unicode property, as fixed values) do not go through the pattern's search, whose stack they would fill.
LONG_BLANK = 1 << 15
_BLANKS = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_BLANK},}}")
#: What a pattern ends with that takes a run of white space whole at a text's end, else all but the last character.
_RUN_RULE = r"|\s+(?!\S)|\s+"
_ENCODERS: dict[tuple[str, str], object] = {}


def encoder(rank_path: str, pattern: str):
    """The encoding of a rank file, loaded once in each process."""
    if (key := (rank_path, pattern)) not in _ENCODERS:
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe places only; a run without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def blank_runs(pattern: str, text: str) -> Iterator[tuple[str, bool]]:
    """The text in parts ``(part, is one match)``: long runs of white space are one match each, by the pattern's own rule."""
    at = 0
    if pattern.endswith(_RUN_RULE) and "[\\r\\n]" not in pattern:
        for run in _BLANKS.finditer(text) if len(text) >= LONG_BLANK else ():
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield text[at : run.start()], False
            yield text[run.start() : end], True
            at = end
    yield text[at:], False


def encode(enc, text: str) -> array:
    """Token ids of the whole text as an array of unsigned 32-bit integers."""
    ids = array("I")
    for part, whole in blank_runs(enc._pat_str, text):
        if whole:
            ids.extend(enc._encode_single_piece(part))
            continue
        for piece in pieces(part):
            ids.extend(enc.encode_ordinary(piece))
    return ids


def decode(enc, ids) -> bytes:
    """The bytes of token ids; not always valid UTF-8, as ids may split a character."""
    return enc.decode_bytes(list(ids))


def encode_texts(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``(id, n_tokens, ids_sha256, decoded_sha256[, ids])``, one row for
    each input row, repeated rows included. A null text counts as empty: no
    ids and the digests of no bytes. A null id stays null. Other columns are
    ignored, so they may bear any name. ``ids_sha256`` is taken over the ids as
    little-endian unsigned 32-bit integers.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sys

        enc = encoder(rank_path, pattern)
        for batch in batches:
            n, ids_hash, text_hash, all_ids = [], [], [], []
            for value in batch.column(1):
                ids = encode(enc, value.as_py())
                raw = ids if sys.byteorder == "little" else array("I", ids)
                if raw is not ids:
                    raw.byteswap()
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(raw.tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(decode(enc, ids)).hexdigest())
                if keep_ids:
                    all_ids.append(pa.array(ids, pa.uint32()).cast(pa.int32()))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            if keep_ids:
                columns.append(pa.array([x.to_numpy() for x in all_ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])])

    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type}, {fields}")


def decode_ids(encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, decoded binary)`` from rows of ids; null ids decode to no bytes."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_path, pattern)
        for batch in batches:
            raw = [decode(enc, ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], [id_col, "decoded"])

    return encoded.select(id_col, F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, f"`{id_col}` {id_type}, decoded binary")
