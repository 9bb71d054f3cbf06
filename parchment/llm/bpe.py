"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved until its pieces are small; pieces are encoded, and neighbours are joined by
re-encoding a window around their seam. The window grows, to the left and to the right, until it
ends where a space follows a character that is not white space. No match of the split pattern can
span such a place and every scan that reaches it starts a match there, so that tokens outside the
window are those of the joined text: they provably stay. Decoding concatenates bytes up the tree.

Defined cases: a null text is encoded as an empty one, without tokens; repeated rows are encoded
alike; a text of any length is one tree, whose windows are bounded by its longest stretch without
a space; special tokens' strings are ordinary text; an empty table gives an empty result. Extra
columns are ignored. A narrow map without shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

LEAF, STEP = 1 << 14, 64
_ENCODINGS: dict = {}


def encoding(path: str | None = None):
    """The vocabulary at ``path`` (default: the public 50k ranks), loaded once a worker."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def is_seam(text: str, p: int) -> bool:
    """Whether every scan that reaches p starts a match there."""
    return text[p] in " \n" and not text[p - 1].isspace()


def stable_left(text: str, lo: int, p: int) -> int:
    """The last seam at or before p, or lo; found in growing windows."""
    reach = STEP
    while True:
        stop = max(lo, p - reach)
        for q in range(min(p, len(text) - 1), stop, -1):
            if is_seam(text, q):
                return q
        if stop == lo:
            return lo
        p, reach = stop, reach * 2


def stable_right(text: str, p: int, hi: int) -> int:
    """The first seam at or after p, or hi."""
    reach = STEP
    while True:
        stop = min(hi, p + reach)
        for q in range(max(p, 1), stop):
            if is_seam(text, q):
                return q
        if stop == hi:
            return hi
        p, reach = stop, reach * 2


def encode_tree(text: str, encode: Callable[[str], list[int]], leaf: int = LEAF, lo: int = 0, hi: int | None = None) -> list[int]:
    """Token ids of text[lo:hi], by halves."""
    hi = len(text) if hi is None else hi
    if hi - lo <= leaf:
        return encode(text[lo:hi])
    mid = (lo + hi) // 2
    left, right = encode_tree(text, encode, leaf, lo, mid), encode_tree(text, encode, leaf, mid, hi)
    return join(text, lo, mid, hi, left, right, encode)


def join(text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int], encode: Callable[[str], list[int]]) -> list[int]:
    """The monoid's product: ids of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
    q, r = stable_left(text, lo, mid), stable_right(text, mid, hi)
    if q == r == mid:
        return left + right
    keep = len(left) - len(encode(text[q:mid])) if q > lo else 0
    drop = len(encode(text[mid:r])) if r < hi else len(right)
    return left[:keep] + encode(text[q:r]) + right[drop:]


def decode_tree(ids: list[int], decode: Callable[[list[int]], bytes], leaf: int = LEAF) -> bytes:
    if len(ids) <= leaf:
        return decode(ids)
    mid = len(ids) // 2
    return decode_tree(ids[:mid], decode, leaf) + decode_tree(ids[mid:], decode, leaf)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocabulary)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column("text"):
                ids = encode_tree(text.as_py() or "", enc.encode_ordinary)
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                out[2].append(hashlib.sha256(decode_tree(ids, enc.decode_bytes)).hexdigest())
                if with_ids:
                    out[3].append(ids)
            columns = [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(out[3], pa.list_(pa.int32()))] * with_ids, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
