"""Repeated windows of sequences over many tasks: minimizers, buckets and answers.

Texts become sequences of units (words or bytes). Every window of K units has a minimizer, the
least hash of the grams inside it; equal windows have equal minimizers. Consecutive windows with
the same minimizer form a run. Three exchanges find the runs whose windows repeat:

1. each group of documents sends its distinct minimizers to buckets by hash, which send back those
   that occur more than once;
2. the group's distinct runs with such a minimizer go to buckets again, in full; equal runs of a
   group are folded before that, so that copies are summed before the shuffle;
3. a resolver looks at all runs of a minimizer together and answers each group.

Rows of these exchanges are packed arrays, at most one for each group and bucket. Minimizers with
more than HOT runs are not gathered: each of their windows goes by its own hash, where equal ones
fold, so that one frequent passage is dealt over all buckets; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_count

HOT = 20_000
#: Units hashed at once.
CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK + (1 << 17)), base, np.uint64)
        held[0] = 1
        held = _POWERS[int(base)] = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(units: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(units)), dtype=np.uint64, out=sums[1:])
    return sums


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive units, from prefix sums."""
    n = len(sums) - size
    return mixed((sums[size:] - sums[:n]) * powers(INVERSE, n)) if n > 0 else np.empty(0, np.uint64)


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start] + (end - start).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by minima from both ends of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, x.dtype)
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def doubled_minima(grams: np.ndarray, least: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Minimizers that a run may hold in two places, so that its own windows can be equal."""
    valid = np.zeros(len(grams) + width - 1, np.uint64)
    valid[place + width - 1] = least
    of_some = ~sliding_min(~valid, width) == grams  # the gram is the minimum of a window that holds it
    at = grams[of_some]
    return at[1:][at[1:] == at[:-1]]


@dataclass
class Runs:
    """Runs of windows of a group's documents. doc, start, windows, key, content: one entry a run."""

    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    content: np.ndarray


@dataclass
class Method:
    """What a text's units are, the window and gram sizes, what a run sends, and how a bucket answers."""

    units: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    window: int
    gram: int
    #: (chunk, documents in it, starts in it, windows) of runs, to the bytes each sends.
    payload: Callable
    #: Columns of a bucket's runs, Sent, to (run, offset, windows, source doc, source start) arrays.
    resolve: Callable | None = None
    #: Whether runs fold only where the units before and after them are equal too.
    neighbours: bool = False


@dataclass
class Sent:
    """Runs of a bucket. Documents are in the order of (doc_id, tie, local); body: their payloads end to end, sizes: bytes of each."""

    run: np.ndarray
    key: np.ndarray
    doc_id: np.ndarray
    tie: np.ndarray
    local: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    copies: np.ndarray
    sizes: np.ndarray
    body: np.ndarray


SENT = ("<i4", "<u8", "<i8", "<i8", "<i4", "<i4", "<i4", "u1", "<u4", "u1")


@dataclass
class Found:
    """What one method found in a group: all runs, the first of each content, content numbers, and the buckets' answers
    (content number, offset, windows, source doc, source start)."""

    runs: Runs
    first: np.ndarray
    number: np.ndarray
    answers: list


@dataclass
class Chunk:
    """Units of the documents from ``first`` on; grams by size, made once for all methods."""

    first: int
    units: np.ndarray
    sums: np.ndarray
    bounds: np.ndarray
    doc: np.ndarray
    grams: dict


def chunks(texts: list[bytes], most: int = CHUNK) -> list[tuple[int, int]]:
    """Ranges of documents of about ``most`` bytes."""
    out, first, size = [], 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            out.append((first, i))
            first, size = i, 0
        size += len(t)
    return out + ([(first, len(texts))] if first < len(texts) else [])


def chunk_of(method: Method, texts: list[bytes], first: int) -> Chunk:
    units, bounds = method.units(texts)
    return Chunk(first, units, prefix(units), bounds, np.repeat(np.arange(len(texts)), np.diff(bounds)), {})


def grams_of(method: Method, chunk: Chunk) -> np.ndarray:
    if method.gram not in chunk.grams:
        chunk.grams[method.gram] = gram_hashes(chunk.sums, method.gram)
    return chunk.grams[method.gram]


def windows_of(method: Method, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows inside documents: place, document, minimizer."""
    least = sliding_min(grams_of(method, chunk), method.window - method.gram + 1)
    doc, n = chunk.doc, max(0, len(chunk.units) - method.window + 1)
    place = np.flatnonzero(doc[:n] == doc[len(doc) - n :]) if n else np.empty(0, np.int64)
    return place, doc[place], least[place]


def runs_of(place: np.ndarray, doc: np.ndarray, least: np.ndarray, bounds: np.ndarray, sums: np.ndarray, window: int) -> Runs:
    if not len(place):
        z = np.empty(0, np.int64)
        return Runs(z, z, z, np.empty(0, np.uint64), np.empty(0, np.uint64))
    new = np.ones(len(place), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(place)))
    start = place[first]
    return Runs(doc[first], start - bounds[doc[first]], count, least[first], span_hashes(sums, start, start + count + window - 1))


def blob(*arrays: np.ndarray) -> bytes:
    return b"".join(np.uint32(a.nbytes).tobytes() + a.tobytes() for a in arrays)


def unblob(data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int(np.frombuffer(data, "<u4", 1, at)[0])
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 4))
        at += 4 + size
    return out


def squeezed(data: bytes) -> bytes:
    """Compressed, for what travels as text: a run shares most of its bytes with the next one."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def grouped_documents(docs: DataFrame, groups: int, carry: bool = False) -> DataFrame:
    """doc_id, text, the order of rows with equal doc_id, the whole row if it is carried, and the group of the row.

    Rows of one doc_id, or of none, are dealt over all groups by their text.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]).alias("carried")] if carry else []),
    )
    rows = rows.withColumn("tie", F.xxhash64("text"))
    return rows.withColumn("gid", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "tie", F.lit(7)), F.lit(groups)).cast("int"))


def ordered(data: pa.Table) -> list[int]:
    """A group's rows by (doc_id, tie), null ids first; equal rows keep any order."""
    ids, ties = data.column("doc_id").to_pylist(), data.column("tie").to_pylist()
    return sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, ties[i]))


def in_order(data: pa.Table) -> tuple[list, list[bytes], np.ndarray]:
    ids, texts, ties, order = data.column("doc_id").to_pylist(), data.column("text").to_pylist(), data.column("tie").to_numpy(), ordered(data)
    return [ids[i] for i in order], [texts[i].encode() for i in order], ties[order]


def packed(parts: dict[int, bytes], gid: int) -> pa.Table:
    return pa.table({"bucket": pa.array(list(parts), pa.int32()), "gid": pa.array([gid] * len(parts), pa.int32()), "data": pa.array(list(parts.values()), pa.binary())})


def by_bucket(key: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    bucket = (mixed(key) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return [(int(bucket[order[a]]), order[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True)]


PACKED = "bucket int, gid int, data binary"


def repeating(method: Method, chunk: Chunk, repeated: np.ndarray, hot: np.ndarray) -> Runs:
    """Runs of a chunk that have a repeated minimizer, hot ones cut into single windows."""
    place, doc, least = windows_of(method, chunk)
    at = np.minimum(np.searchsorted(repeated, least), max(len(repeated) - 1, 0))
    hit = repeated[at] == least if len(repeated) else np.zeros(len(least), bool)
    place, doc, least = place[hit], doc[hit], least[hit]
    if len(hot) and len(place):
        at = np.minimum(np.searchsorted(hot, least), len(hot) - 1)
        single = hot[at] == least
        least = least.copy()
        least[single] = span_hashes(chunk.sums, place[single], place[single] + method.window)
    # windows that do not follow each other must not share a run
    gap = np.ones(len(place), bool)
    gap[1:] = (np.diff(place) != 1) | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(gap)
    count = np.diff(np.append(first, len(place)))
    start = place[first]
    end = start + count + method.window - 1
    if method.neighbours and len(first):
        before, after = start > chunk.bounds[doc[first]], end < chunk.bounds[doc[first] + 1]
        content = mixed(span_hashes(chunk.sums, start - before, end + after) + before + np.uint64(2) * after)
    else:
        content = span_hashes(chunk.sums, start, end)
    return Runs(doc[first] + chunk.first, start - chunk.bounds[doc[first]] if len(first) else start, count, least[first], content)


def folded(runs: list[Runs]) -> Found:
    """All runs of a group, the first run of each content, and each run's content number."""
    every = Runs(*(np.concatenate([getattr(r, f) for r in runs]) if runs else np.empty(0, np.int64) for f in ("doc", "start", "windows", "key", "content")))
    if not len(every.key):
        return Found(every, np.empty(0, np.int64), np.empty(0, np.int64), [])
    order = np.lexsort((every.content, every.key))
    new = np.ones(len(order), bool)
    new[1:] = (every.key[order[1:]] != every.key[order[:-1]]) | (every.content[order[1:]] != every.content[order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return Found(every, order[new], number, [])  # lexsort is stable: the first in document order


def sent_runs(rows: DataFrame, methods: tuple[Method, ...], buckets: int) -> DataFrame:
    """From documents in groups, by ``grouped_documents``: what their repeated runs send to buckets, packed.

    Rows of buckets below 0 hold all runs of a group, for the group itself.
    """
    every = range(len(methods))

    def minimizers(key: tuple, data: pa.Table) -> pa.Table:
        _, texts, _ = in_order(data)
        seen: list[list] = [[] for _ in every]
        for a, b in chunks(texts):
            chunk = chunk_of(methods[0], texts[a:b], a)
            for m, method in enumerate(methods):
                place, doc, least = windows_of(method, chunk)
                if not len(place):
                    continue
                r = runs_of(place, doc, least, chunk.bounds, chunk.sums, method.window)
                twice = doubled_minima(grams_of(method, chunk), least, place, method.window - method.gram + 1)
                k, c = np.unique(r.key, return_counts=True)
                seen[m] += [(k, c), (twice, np.full(len(twice), 2))]
        parts = {}
        for m in every:
            if seen[m]:
                k, at = np.unique(np.concatenate([k for k, _ in seen[m]]), return_inverse=True)
                c = np.bincount(at, weights=np.concatenate([c for _, c in seen[m]]), minlength=len(k)).astype(np.uint32)
                parts |= {b * len(methods) + m: blob(k[i], c[i]) for b, i in by_bucket(k, buckets)}
        return packed(parts, key[0].as_py())

    def recurring(key: tuple, data: pa.Table) -> pa.Table:
        gids = data.column("gid").to_pylist()
        parts = [unblob(d.as_py(), "<u8", "<u4") for d in data.column("data")]
        keys = np.concatenate([p[0] for p in parts])
        k, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(k))
        back, low = {}, 0
        for gid, (own, _) in zip(gids, parts, strict=True):
            c = total[at[low : low + len(own)]]
            back[gid] = blob(own[c > 1], (c[c > 1] > HOT).astype(np.uint8))
            low += len(own)
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(back), pa.int32()), "gid": pa.array(list(back), pa.int32()), "data": pa.array(list(back.values()), pa.binary())})

    def told_of(told: pa.Table, m: int) -> pa.Table:
        return told.filter(pa.array([b % len(methods) == m for b in told.column("bucket").to_pylist()], pa.bool_()))

    def known(data: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        parts = [unblob(d.as_py(), "<u8", "u1") for d in data.column("data")]
        if not parts:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        keys, hot = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.argsort(keys)
        return keys[order], keys[order][hot[order] > 0]

    def send(key: tuple, data: pa.Table, told: pa.Table) -> pa.Table:
        """Payloads of the group's distinct runs to their buckets, and its runs to itself, so that the last step need not look for them again."""
        if not data.num_rows:
            return packed({}, 0)
        doc_ids, texts, ties = in_order(data)
        ids, gid = np.array([-(1 << 63) if d is None else d for d in doc_ids], np.int64), key[0].as_py()
        keys = [known(told_of(told, m)) for m in every]
        found: list[list[Runs]] = [[] for _ in every]
        held: list[Chunk] = []
        for a, b in chunks(texts):
            chunk = chunk_of(methods[0], texts[a:b], a)
            for m, method in enumerate(methods):
                found[m].append(repeating(method, chunk, *keys[m]))
            chunk.sums, chunk.doc, chunk.grams = np.empty(0, np.uint64), np.empty(0, np.int64), {}
            held.append(chunk)
        parts = {}
        for m, method in enumerate(methods):
            f = folded(found[m])
            if not len(f.first):
                continue
            runs, r = f.runs, f.first
            body: list[bytes] = [b""] * len(r)
            of = np.searchsorted([c.first for c in held], runs.doc[r], side="right") - 1
            for n, chunk in enumerate(held):
                mine = np.flatnonzero(of == n)
                if len(mine):
                    doc = runs.doc[r[mine]] - chunk.first
                    start = chunk.bounds[doc] + runs.start[r[mine]]
                    for i, x in zip(mine.tolist(), method.payload(chunk, doc, start, runs.windows[r[mine]]), strict=True):
                        body[i] = x
            copies = np.bincount(f.number, minlength=len(r))
            for b, i in by_bucket(runs.key[r], buckets):
                own = [body[x] for x in i.tolist()]
                sent = (i, runs.key[r[i]], ids[runs.doc[r[i]]], ties[runs.doc[r[i]]], runs.doc[r[i]], runs.start[r[i]], runs.windows[r[i]], np.minimum(copies[i], 2), [len(x) for x in own], np.frombuffer(b"".join(own), np.uint8))
                parts[b * len(methods) + m] = squeezed(blob(*(np.asarray(x).astype(kind) for x, kind in zip(sent, SENT, strict=True))))
            parts[-1 - (gid * len(methods) + m)] = squeezed(blob(*(x.astype("<i4") for x in (runs.doc, runs.start, runs.windows, f.first, f.number))))
        return packed(parts, gid)

    seen = rows.groupBy("gid").applyInArrow(minimizers, PACKED)
    again = seen.groupBy("bucket").applyInArrow(recurring, PACKED)
    return rows.groupBy("gid").cogroup(again.groupBy("gid")).applyInArrow(send, PACKED)


def merged(n_docs: int, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[list[tuple[int, int]]]:
    """Each document's spans in order, joined where they touch or overlap."""
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n_docs)]
    order = np.lexsort((end, start, doc))
    for d, x, y in zip(doc[order].tolist(), start[order].tolist(), end[order].tolist(), strict=True):
        if spans[d] and x <= spans[d][-1][1]:
            spans[d][-1] = (spans[d][-1][0], max(spans[d][-1][1], y))
        else:
            spans[d].append((x, y))
    return spans


def received(data: pa.Table) -> tuple[Sent, list[int], np.ndarray]:
    """All runs of a bucket, the groups that sent them, and where each group's begin and end."""
    parts = [unblob(unsqueezed(d.as_py()), *SENT) for d in data.column("data")]
    sent = Sent(*(np.concatenate([p[i] for p in parts]) for i in range(len(SENT))))
    return sent, data.column("gid").to_pylist(), np.concatenate(([0], np.cumsum([len(p[0]) for p in parts])))


def own_runs(data: bytes) -> Found:
    """A group's runs, from what it sent to itself."""
    doc, start, windows, first, number = (x.astype(np.int64) for x in unblob(unsqueezed(data), *["<i4"] * 5))
    return Found(Runs(doc, start, windows, doc, doc), first, number, [np.empty(0, np.int64)] * 5)


def repeated_runs(docs: DataFrame, methods: tuple[Method, ...], finish: Callable, out_schema: str, groups: int | None = None, carry: bool = False) -> DataFrame:
    """``finish(doc_ids, texts, found)`` makes a group's columns from what each method found, in the order of methods.

    Methods share the units of texts and the exchanges. With ``carry``, the other columns of a row follow in a struct ``carried``.
    """
    groups = groups or group_count(docs)
    rows = grouped_documents(docs, groups, carry)
    every = range(len(methods))

    def answer(key: tuple, data: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return data.select(["bucket", "gid", "data"])
        sent, gids, upto = received(data)
        run, offset, windows, source, at = methods[key[0].as_py() % len(methods)].resolve(sent)
        order = np.argsort(run, kind="stable")
        run, offset, windows, source, at = run[order], offset[order], windows[order], source[order], at[order]
        cut = np.searchsorted(run, upto)
        back = {}
        for g, gid in enumerate(gids):
            s = slice(cut[g], cut[g + 1])
            if cut[g + 1] > cut[g]:
                back[gid] = blob(sent.run[run[s]].astype("<i4"), offset[s].astype("<i4"), windows[s].astype("<i4"), source[s].astype("<i8"), at[s].astype("<i4"))
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(back), pa.int32()), "gid": pa.array(list(back), pa.int32()), "data": pa.array(list(back.values()), pa.binary())})

    def close(key: tuple, data: pa.Table, told: pa.Table) -> pa.Table:
        if not data.num_rows:
            return with_carried(finish([], [], []), data, [])
        doc_ids, texts, _ = in_order(data)
        found = [Found(Runs(*[np.empty(0, np.int64)] * 5), np.empty(0, np.int64), np.empty(0, np.int64), [np.empty(0, np.int64)] * 5) for _ in every]
        said: list[list] = [[] for _ in every]
        for bucket, d in zip(told.column("bucket").to_pylist(), told.column("data"), strict=True):
            if bucket < 0:
                found[(-1 - bucket) % len(methods)] = own_runs(d.as_py())
            else:
                said[bucket % len(methods)].append(unblob(d.as_py(), "<i4", "<i4", "<i4", "<i8", "<i4"))
        for f, answers in zip(found, said, strict=True):
            if answers:
                f.answers = [np.concatenate([x[i] for x in answers]) for i in range(5)]
        return with_carried(finish(doc_ids, texts, found), data, ordered(data))

    def with_carried(out: pa.Table, data: pa.Table, order: list[int]) -> pa.Table:
        return out.append_column("carried", data.column("carried").take(pa.array(order, pa.int64()))) if carry else out

    if carry:
        out_schema += f", carried {rows.schema['carried'].dataType.simpleString()}"
    answers = sent_runs(rows, methods, groups).groupBy("bucket").applyInArrow(answer, PACKED)
    return rows.groupBy("gid").cogroup(answers.groupBy("gid")).applyInArrow(close, out_schema)
