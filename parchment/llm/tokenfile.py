"""Token-ID files of patched frame-of-reference blocks.

A shard is a range of ascending doc_ids; its file is a row for each segment of whole documents:
(shard, seq, n_docs, n_ids, payload). A payload holds the document table (ids, lengths), the block
table (minimum, width, number of exceptions), the index of block starts, the packed words and the
exception lists. A block of 256 ids subtracts its minimum and packs the low bits at the width of
its 90th percentile, as 32 rows of 8 lanes; values that are wider go to the exceptions.

Texts are encoded with the tokenizers library. Its split pattern is applied to whole batches of
code points at once, and each distinct piece is encoded once by the library; texts with a special
token's string or with a code point of unknown class are given to the library as a whole.

Defined cases: a null text holds only the end id; documents with a null doc_id come first; rows
with equal doc_id keep the order of their texts; an empty table makes an empty file; extra columns
are ignored. One shuffle, by range of doc_id; offsets are sums over the segments' index.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import group_count, shared_dir, table

BLOCK, LANES, PERCENTILE = 256, 8, 90
#: Ids in a segment, if its documents allow; code points encoded at once; pieces remembered by a worker.
SEGMENT, BATCH, REMEMBERED = 1 << 18, 1 << 20, 1_500_000
LETTER, NUMBER, OTHER, BLANK, UNKNOWN = 1, 2, 3, 4, 5
_ENCODERS: dict = {}


def code_point_classes() -> np.ndarray:
    """For each code point: letter, number, white space, other, or unknown to this Unicode version."""
    import regex

    every = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(pattern, text):
            a, b = ord(text[m.start()]), ord(text[m.end() - 1]) + 1
            every[a:b] = kind
    every[0x1C:0x20] = OTHER  # separators that only Python counts as white space
    every[[i for i, c in enumerate(text) if unicodedata.category(c) == "Cn" and i < 0xD800]] = UNKNOWN
    every[[i + 0x800 for i, c in enumerate(text) if i >= 0xD800 and unicodedata.category(c) == "Cn"]] = UNKNOWN
    return every


def piece_starts(points: np.ndarray, kinds: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where the split pattern's matches start, over texts laid end to end."""
    n = len(points)
    run = np.empty(n, bool)
    run[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=run[1:])
    fresh = np.zeros(n + 1, bool)
    fresh[doc_starts] = True
    run |= fresh[:n]
    at = np.flatnonzero(run)
    end = np.append(at[1:], n)
    kind = kinds[at]
    start = run.copy()
    inner = end < n
    inner[inner] = ~fresh[end[inner]]  # the run's text goes on after it
    blank = kind == BLANK
    last = end[blank & inner] - 1
    start[last] = True  # the last blank before other characters is not part of the blank run
    start[last[points[last] == 32] + 1] = False  # and a space belongs to what follows
    quote = (kind == OTHER) & (end - at == 1) & inner & (points[at] == 39) & start[at]
    q = np.flatnonzero(quote)
    q = q[kind[q + 1] == LETTER] if len(q) else q
    if len(q):
        a, stop = at[q], end[q + 1]
        one, two = points[a + 1], np.where(stop - a > 2, points[np.minimum(a + 2, n - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for x, y in ("re", "ve", "ll"):
            size[(one == ord(x)) & (two == ord(y))] = 2
        hit = size > 0
        start[a[hit] + 1] = False
        rest = a[hit] + 1 + size[hit]
        start[rest[rest < stop[hit]]] = True
    return np.flatnonzero(start)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Encoder:
    """Ids of many texts at once; remembers the ids of pieces."""

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds = code_point_classes()
        base = np.uint64(0x9E3779B97F4A7C15)
        self.powers, self.inverse = powers(base, 2 * BATCH + 1), powers(np.uint64(pow(int(base), -1, 1 << 64)), 2 * BATCH + 1)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0
        self.where = np.zeros((1 << 16, 2), np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        batch, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.empty(0, np.uint32)
            elif len(text) > BATCH or any(s in text for s in self.special):
                out[i] = self.whole(text)
            else:
                if size + len(text) > 2 * BATCH:
                    self._batch(texts, batch, out)
                    batch, size = [], 0
                batch.append(i)
                size += len(text)
        if batch:
            self._batch(texts, batch, out)
        return out

    def _batch(self, texts: list[str], batch: list[int], out: list) -> None:
        joined = "".join([texts[i] for i in batch])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = np.concatenate(([0], np.cumsum([len(texts[i]) for i in batch])))
        kinds = self.kinds[points]
        at = piece_starts(points, kinds, starts[:-1])
        end = np.append(at[1:], len(points))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.powers[: len(points)], dtype=np.uint64)))
        h = (sums[end] - sums[at]) * self.inverse[at]
        h ^= h >> np.uint64(29)
        h = h * np.uint64(0xBF58476D1CE4E5B9) + (end - at).astype(np.uint64)
        unique, first, place = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        slot = np.fromiter((known.get(x, -1) for x in unique.tolist()), np.int64, len(unique))
        new = np.flatnonzero(slot < 0)
        if len(new):
            a, b = at[first[new]].tolist(), end[first[new]].tolist()
            found = [e.ids for e in self.tokenizer.encode_batch_fast([joined[x:y] for x, y in zip(a, b, strict=True)], add_special_tokens=False)]
            lens = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((x for ids in found for x in ids), np.uint32, int(lens.sum()))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
            base = len(known)
            while base + len(new) > len(self.where):
                self.where = np.concatenate((self.where, np.zeros_like(self.where)))
            self.pool[self.used : self.used + len(flat)] = flat
            slot[new] = np.arange(base, base + len(new))
            self.where[base : base + len(new), 0] = self.used + np.cumsum(lens) - lens
            self.where[base : base + len(new), 1] = lens
            self.used += len(flat)
            known.update(zip(unique[new].tolist(), slot[new].tolist(), strict=True))
        where = self.where[slot[place]]
        lens = where[:, 1]
        upto = np.concatenate(([0], np.cumsum(lens)))
        ids = self.pool[np.repeat(where[:, 0] - upto[:-1], lens) + np.arange(upto[-1])]
        cuts = upto[np.searchsorted(at, starts)]
        strange = np.add.reduceat(kinds == UNKNOWN, starts[:-1]) > 0
        for j, i in enumerate(batch):
            out[i] = self.whole(texts[i]) if strange[j] else ids[cuts[j] : cuts[j + 1]]


def encoder(path: str | None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def bits(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))) + 1, 0).astype(np.uint8)


def pack(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """A segment's payload."""
    n, rows = len(ids), BLOCK // LANES
    k = -(-n // BLOCK)
    padded = np.empty(k * BLOCK, np.uint32)
    padded[:n] = ids
    if k:
        padded[n:] = ids[-1]
    blocks = padded.reshape(k, BLOCK)
    low = blocks.min(axis=1) if k else np.empty(0, np.uint32)
    deltas = blocks - low[:, None]
    width = bits(np.partition(deltas, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100]) if k else np.empty(0, np.uint8)
    wide = deltas >> np.minimum(width, 31)[:, None].astype(np.uint32)
    out_block, out_at = np.nonzero((wide > 0) & (width < 32)[:, None])
    exceptions = np.bincount(out_block, minlength=k).astype(np.uint16)
    starts = np.concatenate(([0], np.cumsum(width.astype(np.uint32) * LANES))).astype(np.uint32)
    words = np.zeros(int(starts[-1]), np.uint32)
    for w in np.unique(width):
        if w == 0:
            continue
        which = np.flatnonzero(width == w)
        values = (deltas[which] & np.uint32((1 << int(w)) - 1)).reshape(-1, rows, LANES)
        packed = np.zeros((len(which), int(w), LANES), np.uint32)
        for r in range(rows):
            word, shift = divmod(r * int(w), 32)
            packed[:, word] |= values[:, r] << np.uint32(shift)
            if shift + w > 32:
                packed[:, word + 1] |= values[:, r] >> np.uint32(32 - shift)
        words[starts[which][:, None] + np.arange(int(w) * LANES)] = packed.reshape(len(which), -1)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = np.array([len(doc_ids), n, k, len(out_at)], "<u4")
    parts = [head, known, np.array([d or 0 for d in doc_ids], "<i8"), np.array(lengths, "<u4"), low.astype("<u4"), width, exceptions.astype("<u2"), starts.astype("<u4"), words.astype("<u4"), out_at.astype(np.uint8), deltas[out_block, out_at].astype("<u4")]
    return b"PFR1" + b"".join(p.tobytes() for p in parts)


def unpack(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of a segment."""
    if payload[:4] != b"PFR1":
        raise ValueError("not a token segment")
    at = 4

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(payload, kind, count, at)
        at += found.nbytes
        return found

    docs, n, k, n_out = (int(x) for x in take("<u4", 4))
    rows = BLOCK // LANES
    known, doc_ids, lengths = take("u1", docs), take("<i8", docs), take("<u4", docs)
    low, width, exceptions, starts = take("<u4", k), take("u1", k), take("<u2", k), take("<u4", k + 1)
    words, out_at, out = take("<u4", int(starts[-1])), take("u1", n_out), take("<u4", n_out)
    deltas = np.zeros((k, BLOCK), np.uint32)
    for w in np.unique(width):
        if w == 0:
            continue
        which = np.flatnonzero(width == w)
        packed = words[starts[which][:, None] + np.arange(int(w) * LANES)].reshape(len(which), int(w), LANES)
        values = np.empty((len(which), rows, LANES), np.uint32)
        mask = np.uint32((1 << int(w)) - 1)
        for r in range(rows):
            word, shift = divmod(r * int(w), 32)
            v = packed[:, word] >> np.uint32(shift)
            if shift + w > 32:
                v = v | (packed[:, word + 1] << np.uint32(32 - shift))
            values[:, r] = v & mask
        deltas[which] = values.reshape(len(which), BLOCK)
    deltas[np.repeat(np.arange(k), exceptions), out_at] = out
    ids = (deltas + low[:, None]).reshape(-1)[:n]
    return [int(d) if ok else None for d, ok in zip(doc_ids, known, strict=True)], lengths, ids


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0) -> None:
    """Encode documents in ascending doc_id order and write their file to ``path``."""
    schema = "shard int, seq int, n_docs bigint, n_ids bigint, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        held_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            lengths = [len(x) for x in held]
            payload = pack(held_ids, lengths, np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([sum(lengths)], pa.int64()), pa.array([payload], pa.binary())], ["shard", "seq", "n_docs", "n_ids", "payload"])

        end = np.array([end_id], np.uint32)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                held_ids.append(doc_id)
                held.append(np.concatenate((ids, end)))
                size += len(held[-1])
                if size >= SEGMENT:
                    yield segment()
                    seq, size = seq + 1, 0
                    held_ids, held = [], []
        if held:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(group_count(rows, 16 << 20), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ranged.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of each document in a file."""
    stored = spark.read.schema("shard int, seq int, n_docs bigint, n_ids bigint, payload binary").parquet(path)
    schema = "shard int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, seq, payload in zip(*(batch.column(c) for c in ("shard", "seq", "payload")), strict=True):
                doc_ids, lengths, ids = unpack(payload.as_py())
                cuts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                data = ids.astype("<u4")
                sums = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                n = len(doc_ids)
                columns = [pa.array([shard.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(cuts[:-1], pa.int64()), pa.array(lengths.astype(np.int64), pa.int64()), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["shard", "seq", "doc_id", "at", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    index = stored.select("shard", "seq", "n_ids")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(F.col("shard").alias("_s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    within = W.partitionBy("shard").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    offsets = index.join(shards, F.col("shard") == F.col("_s")).select(F.col("shard").alias("_shard"), F.col("seq").alias("_seq"), (F.col("_base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("_offset"))
    rows = stored.select("shard", "seq", "payload").mapInArrow(run, schema)
    return rows.join(offsets, (F.col("shard") == F.col("_shard")) & (F.col("seq") == F.col("_seq"))).select("doc_id", (F.col("_offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)
