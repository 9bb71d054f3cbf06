"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Runs of windows of the minimum length that share a minimizer meet in a bucket. Equal runs fold into
one with a count. The rest is laid end to end and its suffixes are sorted, as deep as the threshold
needs, for the transform. Boundaries between suffixes get their common prefix by increasing value:
those of value v, extended backward by every symbol, are the boundaries of value v + 1 (breadth
first), and the expansion stops at the minimum length. Suffixes that no boundary parts by then share
that many bytes; every such string is removed wherever it starts.

The minimum length is 400 bytes in ``dedup_bytes``. A passage of 51 words weighs less (a median of
367 bytes), so ``dedup_texts``, which the pipeline uses, takes PASSAGE, and ``dedup_bytes`` counts
the bytes in strings of PASSAGE bytes beside those it removes.

Defined cases: a null text is empty; texts of under the minimum length keep all; matches never cross
documents; overlapping and periodic matches inside a document count; rows with equal doc_id are
documents of their own; an empty table gives an empty result; extra columns are ignored, or handed
on by ``dedup_texts``, whatever their names are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import repeats as R
from .common import bounded_batches, table

WINDOW = 400
#: About half of what 51 words weigh: shorter than nearly all passages of over 50 words.
PASSAGE = 200
#: Long grams seldom recur unless a window does, which keeps runs that only share a phrase out of the buckets.
GRAM = 100
#: Bytes of one transform, unless one minimizer has more.
TRANSFORM = 400_000


def byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))


#: Common prefixes shorter than the first doubling from here on are read off the sort, where they come for nothing.
SEED = 80


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, tuple[int, np.ndarray] | None]:
    """Suffixes in the order of their first ``depth`` symbols or more, ties by place; and, from the first doubling of SEED
    or more but less than ``depth``, its length and each place's rank by so many symbols.

    Prefix doubling where a sort key and the place share a 64-bit number, so that plain sorts do.
    """
    n, seed = len(symbols), None
    low = np.uint64(max(1, int(n).bit_length()))
    if 3 * int(low) > 64:  # one minimizer has more than two million bytes: sort by pairs
        rank, known = np.unique(symbols, return_inverse=True)[1], 1
        while known < depth and rank.max() < n - 1:
            pair = rank * (n + 1)
            pair[: n - known] += rank[known:] + 1
            rank, known = np.unique(pair, return_inverse=True)[1], 2 * known
        return np.argsort(rank, kind="stable"), None
    place, mask = np.arange(n, dtype=np.uint64), np.uint64((1 << int(low)) - 1)
    wide = max(1, int(symbols.max()).bit_length())
    known = max(1, (64 - int(low)) // wide)
    code = np.zeros(n, np.uint64)
    for k in range(known):
        code <<= np.uint64(wide)
        code[: n - k] |= symbols[k:]
    while True:
        code <<= low
        code |= place
        code.sort()
        order = (code & mask).astype(np.int64)
        code >>= low
        new = np.empty(n, np.uint64)
        new[:1] = 0
        np.not_equal(code[1:], code[:-1], out=new[1:], casting="unsafe")
        np.cumsum(new, out=new)
        if known >= depth or new[-1] == n - 1:
            return order, seed
        rank = np.empty(n, np.uint64)
        rank[order] = new
        if seed is None and known >= SEED:
            seed = known, rank
        code = rank << low
        code[: n - known] |= rank[known:] + np.uint64(1)
        known *= 2


#: Suffixes after a boundary that are extended one by one before symbols are looked up instead.
STEPS = 6


def parted(symbols: np.ndarray, order: np.ndarray, limit: int, seed: tuple[int, np.ndarray] | None = None) -> np.ndarray:
    """Whether each suffix in order shares less than ``limit`` symbols with the one before it.

    The boundaries of values below the seed's length are given by its ranks; expansion goes on from there.

    A boundary b of value v makes, for a symbol c, one of value v + 1: the first suffix that
    extends one at or after b by c, if it has none yet. Many boundaries are counted into a table of
    all suffixes, few are extended by the suffixes up to the next boundary, or by all symbols.
    """
    n = len(symbols)
    transform = symbols[order - 1]
    came = np.argsort(transform, kind="stable").astype(np.int32)  # the place in the transform that each suffix extends
    sorted_ = transform[came]
    goes = np.empty(n, np.int32)
    goes[came] = np.arange(n, dtype=np.int32)
    alphabet = np.unique(symbols)
    alphabet = alphabet[alphabet > 0]  # nothing extends over the end of a string
    place = sorted_.astype(np.int64) * (n + 1) + came
    done = np.zeros(n + 1, bool)
    bounds = np.flatnonzero(np.diff(sorted_.astype(np.int64), prepend=-1))
    done[bounds] = True
    done[n] = True
    done[: np.searchsorted(sorted_, 1)] = True
    begin = 1
    if seed is not None and seed[0] < limit:
        begin, ranks = seed[0], seed[1][order]
        done[1:n] |= ranks[1:] != ranks[:-1]
        bounds = np.flatnonzero(done[:n])
    left = np.flatnonzero(~done)
    to, since = came[left], came[left - 1]
    for _ in range(limit - begin):
        if not len(bounds) or not len(left):
            break
        found, rest = [], None
        if 32 * len(bounds) < len(left) + n // 4:
            at, of = bounds, bounds
            for _ in range(STEPS):
                x = goes[at]
                found.append(x[~done[x] & (came[x - 1] < of)])
                on = ~done[at + 1]
                at, of = at[on] + 1, of[on]
                if not len(at):
                    break
            rest = of
        if rest is None or 10 * len(rest) * len(alphabet) > len(left) + n // 4:
            keep = ~done[left]
            left, to, since = left[keep], to[keep], since[keep]
            count = np.zeros(n + 1, np.int32)
            count[bounds] = 1
            np.cumsum(count, out=count)
            bounds = left[count[to] > count[since]]
        else:
            if len(rest):
                x = np.searchsorted(place, (alphabet.astype(np.int64)[:, None] * (n + 1) + rest).ravel())
                found.append(x[~done[x]])
            bounds = np.unique(np.concatenate(found))
        done[bounds] = True
    return done[:n]


def repeated_starts(strings: list[bytes], counts: list[int], window: int) -> list[np.ndarray]:
    """For each of distinct strings, whether the window at each start occurs more than once among all, strings counted."""
    sizes = np.array([len(s) for s in strings])
    symbols = np.zeros(int(sizes.sum()) + len(strings), np.uint16)
    base = np.cumsum(sizes + 1) - sizes - 1
    for s, b in zip(strings, base, strict=True):
        symbols[b : b + len(s)] = np.frombuffer(s, np.uint8).astype(np.uint16) + 1
    order, seed = suffix_order(symbols, window + 2)
    group = np.cumsum(parted(symbols, order, window, seed)) - 1
    of = np.searchsorted(base, order, side="right") - 1
    valid = order + window <= base[of] + sizes[of]
    weight = np.bincount(group[valid], weights=np.array(counts)[of[valid]], minlength=int(group[-1]) + 1)
    hit = np.zeros(len(symbols), bool)
    hit[order[valid & (weight[group] > 1)]] = True
    return [hit[b : b + max(0, n - window + 1)] for b, n in zip(base, sizes, strict=True)]


def shared_windows(sent: R.Sent, window: int):
    """Windows of runs that occur elsewhere, as (run, offset, windows, 0, 0)."""
    key, copies = sent.key, sent.copies
    data, cut = sent.body.tobytes(), np.concatenate(([0], np.cumsum(sent.sizes, dtype=np.int64))).tolist()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    strings: list[bytes] = []
    counts: list[int] = []
    members: list[list[int]] = []

    def spans(mask: np.ndarray, runs: list[int]) -> None:
        if mask.all():
            out.append((np.array(runs), np.zeros(len(runs), np.int64), np.full(len(runs), len(mask))))
            return
        edge = np.diff(mask.view(np.int8), prepend=0, append=0)
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(a):
            out.append((np.repeat(runs, len(a)), np.tile(a, len(runs)), np.tile(b - a, len(runs))))

    def expand() -> None:
        if strings:
            for mask, runs in zip(repeated_starts(strings, counts, window), members, strict=True):
                spans(mask, runs)
        strings.clear(), counts.clear(), members.clear()

    size = 0
    order = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.diff(key[order].astype(np.uint64)) != 0) + 1
    for group in np.split(order, ends):
        found: dict[bytes, list[int]] = {}
        for i in group.tolist():
            found.setdefault(data[cut[i] : cut[i + 1]], []).append(i)
        total = {s: int(copies[runs].sum()) for s, runs in found.items()}
        if len(found) == 1:
            (s, runs), = found.items()
            if total[s] > 1:
                spans(np.ones(len(s) - window + 1, bool), runs)
                continue
        for s, runs in found.items():
            if size + len(s) > TRANSFORM and size > 0 and s is next(iter(found)):
                expand()
                size = 0
            strings.append(s)
            counts.append(total[s])
            members.append(runs)
            size += len(s)
    expand()
    if not out:
        z = np.empty(0, np.int64)
        return z, z, z, z, z
    run, offset, count = (np.concatenate([o[i] for o in out]) for i in range(3))
    return run, offset, count, np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)


def byte_method(window: int) -> R.Method:
    def payload(chunk: R.Chunk, doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> list[bytes]:
        return [chunk.units[s : s + n + window - 1].tobytes() for s, n in zip(start.tolist(), windows.tolist(), strict=True)]

    return R.Method(byte_units, window, min(GRAM, max(1, window // 2)), payload, lambda sent: shared_windows(sent, window))


def covered(n_docs: int, found: R.Found, window: int) -> list[list[tuple[int, int]]]:
    """Merged (start, end) byte spans of each document that repeated windows cover."""
    runs, first, number, answers = found.runs, found.first, found.number, found.answers
    if not len(runs.doc):
        return [[] for _ in range(n_docs)]
    is_first = np.zeros(len(runs.doc), bool)
    is_first[first] = True
    whole = np.bincount(number, minlength=len(first))[number] > 1
    docs, a, b = [runs.doc[whole]], [runs.start[whole]], [runs.start[whole] + runs.windows[whole]]
    content, offset, count = answers[0].astype(np.int64), answers[1].astype(np.int64), answers[2].astype(np.int64)
    part = np.flatnonzero(is_first[first[content]] & ~whole[first[content]]) if len(content) else np.empty(0, np.int64)
    of = first[content[part]] if len(part) else part
    docs.append(runs.doc[of])
    a.append(runs.start[of] + offset[part])
    b.append(runs.start[of] + offset[part] + count[part])
    return R.merged(n_docs, np.concatenate(docs), np.concatenate(a), np.concatenate(b) + window - 1)


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def dedup_bytes(docs: DataFrame, groups: int | None = None, window: int = WINDOW, passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left).

    With ``passage``, also n_in_passages: bytes covered by strings of so many bytes that start elsewhere too; they are not removed.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary" + ", n_in_passages bigint" * bool(passage)

    def finish(doc_ids, texts, found) -> pa.Table:
        removed = covered(len(texts), found[0], window) if texts else []
        kept = [without(t, spans) for t, spans in zip(texts, removed, strict=True)]
        columns = {
            "doc_id": pa.array(doc_ids, pa.int64()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
            "n_spans": pa.array([len(x) for x in removed], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array(kept, pa.binary()),
        }
        if passage:
            short = covered(len(texts), found[1], passage) if texts else []
            columns["n_in_passages"] = pa.array([sum(b - a for a, b in x) for x in short], pa.int64())
        return pa.table(columns)

    methods = (byte_method(window), *([byte_method(passage)] if passage else []))
    return R.repeated_runs(docs, methods, finish, schema, groups)


def dedup_texts(docs: DataFrame, window: int = PASSAGE, groups: int | None = None) -> DataFrame:
    """The table with text cut, and n_chars, if it is there, counted again; a character that lost some of its bytes goes.

    A null text becomes empty. All other columns stay as they are.
    """
    bounded_batches(docs.sparkSession)

    def finish(doc_ids, texts, found) -> pa.Table:
        removed = covered(len(texts), found[0], window) if texts else []
        kept = [without(t, spans).decode("utf-8", "ignore") for t, spans in zip(texts, removed, strict=True)]
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "text": pa.array(kept, pa.string())})

    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    left = R.repeated_runs(docs, (byte_method(window),), finish, "doc_id bigint, text string", groups, carry=any(c not in new for c in docs.columns))
    return left.select(*[new.get(c, F.col("carried").getField(c)).alias(c) for c in docs.columns])


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_bytes(table(spark, sf_dir, "documents"), passage=PASSAGE)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_in_passages")
