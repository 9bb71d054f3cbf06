"""Substring dedup: de Bruijn compaction of repeated 20-word windows.

A window of 20 words is an edge from the node of its first 19 words to that of its last 19. The
steps:

1. edges that occur once are left out by their minimizer; the others travel in runs of consecutive
   edges with one minimizer, with the edge before and the edge after each run. A bucket has every
   occurrence of its edges and counts them, with the distinct edges that come before and after each;
   the begin and the end of a document count as an edge of their own;
2. two edges are joined where each is the other's only neighbour at the node between them, so that they
   have the same occurrences, one place apart. A bucket joins those it holds to segments; segments of
   different buckets are joined by Spark, last edge to first edge. A chain of segments lies in its first source
   document without a gap, so that a running window there numbers the paths;
3. the document at a path's source coordinates sends a digest of the words there. A document
   removes an occurrence of a path only if its own words have that digest.

A window is judged by its path, whose occurrences have one source: the first one. Edges have 64-bit
fingerprints, compared among edges with the same 64-bit minimizer; where two still collide, words that differ
from those at the source stay.

Defined cases: a null text has no words; a null doc_id comes before all others; rows with equal
doc_id are ordered by a hash of their text, and a later one repeats an earlier one; texts of under 20 words keep
all; windows that overlap or repeat inside a document count; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import repeats as R
from .common import group_count, stage_table, table

WINDOW, GRAM = 20, 8


def word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each document's bounds among them."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return R.span_hashes(R.prefix(data), start, end), np.searchsorted(start, first)


def edge_payload(chunk: R.Chunk, doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> list[bytes]:
    """Edges of runs with the one before and the one after each; 0 where the document begins or ends."""
    edges = np.concatenate(([0], R.gram_hashes(R.prefix(chunk.units), WINDOW), [0])).astype(np.uint64)
    begins = start == chunk.bounds[doc]
    ends = start + windows + WINDOW > chunk.bounds[doc + 1]
    out = []
    for s, n, b, e in zip(start.tolist(), windows.tolist(), begins.tolist(), ends.tolist(), strict=True):
        own = edges[s : s + n + 2].copy()
        if b:
            own[0] = 0
        if e:
            own[-1] = 0
        out.append(own.tobytes())
    return out


def only(neighbour: np.ndarray, first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Each edge's only neighbour on one side; 0 if it has several or none."""
    held = neighbour[first]
    several = np.bincount(number, weights=neighbour != held[number], minlength=len(first)) > 0
    return np.where(several, np.uint64(0), held)


#: head, tail: first and last edge of a segment; before, after: its only neighbours. The first occurrence has the source and the
#: segment's other columns, the others only where they are: run of the group gid, and the place in it. data: a group's own runs.
SEGMENTS = pa.schema(
    [("gid", pa.int32()), ("head", pa.int64()), ("run", pa.int32()), ("offset", pa.int32()), ("tail", pa.int64()), ("before", pa.int64())]
    + [("after", pa.int64()), ("n", pa.int32()), ("doc", pa.int32()), ("at", pa.int32()), ("data", pa.binary())]
)
SEGMENTS_DDL = "gid int, head bigint, run int, offset int, tail bigint, before bigint, after bigint, n int, doc int, at int, data binary"


def segments(key: tuple, data: pa.Table) -> pa.Table:
    """Unbranched segments of a bucket's repeated edges, and where each of them begins."""
    if key[0].as_py() < 0:
        columns = {"gid": data.column("gid"), "data": data.column("data")}
        return pa.table([columns.get(f.name, pa.nulls(data.num_rows, f.type)) for f in SEGMENTS], schema=SEGMENTS)
    sent, gids, upto = R.received(data)
    order = np.lexsort((sent.start, sent.local, sent.tie, sent.doc_id))
    n = sent.windows[order].astype(np.int64)
    begin = (np.cumsum(sent.sizes, dtype=np.int64) - sent.sizes) // 8
    run = np.repeat(order, n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    flat, place = sent.body.view(np.uint64), begin[run] + offset + 1
    edge = flat[place]
    _, first, number = np.unique(edge, return_index=True, return_inverse=True)
    repeated = np.bincount(number, weights=sent.copies[run], minlength=len(first)) > 1
    before, after = only(flat[place - 1], first, number), only(flat[place + 1], first, number)
    kept = np.flatnonzero(repeated)
    kept = kept[np.argsort(first[kept])]
    source = first[kept]
    joined = np.zeros(len(kept), bool)
    if len(kept) > 1:
        near = (np.diff(source) == 1) & (run[source[1:]] == run[source[:-1]])
        joined[1:] = near & (after[kept[:-1]] == edge[source[1:]]) & (before[kept[1:]] == edge[source[:-1]])
    head = np.flatnonzero(~joined)
    size = np.diff(np.append(head, len(kept)))
    last = kept[head + size - 1] if len(head) else head
    segment = np.full(len(first), -1)
    segment[kept[head]] = np.arange(len(head))
    seen = np.flatnonzero(segment[number] >= 0)
    of = segment[number[seen]]
    is_first = seen == source[head][of] if len(head) else np.zeros(0, bool)
    gid = np.asarray(gids, np.int32)[np.searchsorted(upto, run[seen], side="right") - 1]

    def column(values: np.ndarray, kind: pa.DataType, where: np.ndarray | None = None) -> pa.Array:
        values = values.view(np.int64) if values.dtype == np.uint64 else values
        return pa.array(values.astype(kind.to_pandas_dtype()), kind, mask=None if where is None else ~where)

    start = sent.start[run[seen]].astype(np.int64) + offset[seen]
    values = [(gid, None), (edge[seen], None), (sent.run[run[seen]], None), (offset[seen], None)]
    values += [(x[of], is_first) for x in (edge[first[last]], before[kept[head]], after[last], size)]
    values += [(sent.local[run[seen]], is_first), (start, is_first)]
    columns = [column(x, f.type, where) for (x, where), f in zip(values, SEGMENTS, strict=False)]
    return pa.table([*columns, pa.nulls(len(seen), pa.binary())], schema=SEGMENTS)


def compacted(found: DataFrame) -> DataFrame:
    """Paths: maximal chains of unbranched segments. head, n, and the source: src_gid, src_doc, src_at."""
    held = found.where("tail is not null").select("head", "tail", "n", "doc", "at", "gid", *[F.nullif(c, F.lit(0)).alias(c) for c in ("before", "after")])
    ahead = held.where("after is not null").select(F.col("tail").alias("before"), F.col("after").alias("head"), F.lit(True).alias("follows"))
    linked = held.join(ahead, ["before", "head"], "left")
    in_source = Window.partitionBy("gid", "doc").orderBy("at")
    begin = F.last(F.when(F.col("follows").isNull(), F.col("at")), ignorenulls=True).over(in_source)
    path = linked.withColumn("src_at", begin).groupBy(F.col("gid").alias("src_gid"), F.col("doc").alias("src_doc"), "src_at")
    return path.agg(F.min_by("head", "at").alias("head"), F.sum("n").cast("int").alias("n"))


def digest(words: list[bytes], at: int, n: int) -> bytes:
    """Of the words that ``n`` edges from ``at`` on cover."""
    return hashlib.blake2b(b" ".join(words[at : at + n + WINDOW - 1]), digest_size=16).digest()


def read_sources(key: tuple, data: pa.Table, asked: pa.Table) -> pa.Table:
    """Digests of the words at the source coordinates of paths."""
    out = []
    if asked.num_rows:
        _, texts, _ = R.in_order(data)
        asked = asked.sort_by("src_doc")
        held, words = -1, []
        for doc, at, n in zip(*(asked.column(c).to_pylist() for c in ("src_doc", "src_at", "n")), strict=True):
            if doc != held:
                held, words = doc, texts[doc].split()
            out.append(digest(words, at, n))
    return asked.select(["head", "n", "src_gid", "src_doc", "src_at"]).append_column("digest", pa.array(out, pa.binary()))


def repeats_of(found: R.Found, told: pa.Table, gid: int, texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Word spans of each document that later occurrences of paths cover, where the words are those at the source."""
    if not told.num_rows or not len(found.number):
        return [[] for _ in texts]
    run, offset, n, src_gid, src_doc, src_at = (told.column(c).to_numpy() for c in ("run", "offset", "n", "src_gid", "src_doc", "src_at"))
    by_content = np.argsort(found.number, kind="stable")
    low, high = (np.searchsorted(found.number[by_content], run, side=side) for side in ("left", "right"))
    row = np.repeat(np.arange(len(run)), high - low)
    held = by_content[np.repeat(low, high - low) + np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
    doc, at = found.runs.doc[held], found.runs.start[held] + offset[row]
    later = (src_gid[row] != gid) | (src_doc[row] != doc) | (src_at[row] != at)
    row, doc, at = row[later], doc[later], at[later]
    order = np.argsort(doc, kind="stable")
    row, doc, at, digests = row[order], doc[order], at[order], told.column("digest").to_pylist()
    same, of, words = np.zeros(len(row), bool), -1, []
    for i, (r, d, a) in enumerate(zip(row.tolist(), doc.tolist(), at.tolist(), strict=True)):
        if d != of:
            of, words = d, texts[d].split()
        same[i] = digest(words, a, int(n[r])) == digests[r]
    return R.merged(len(texts), doc[same], at[same], at[same] + n[row[same]] + WINDOW - 1)


METHOD = R.Method(word_units, WINDOW, GRAM, edge_payload, neighbours=True)


def dedup_words(docs: DataFrame, groups: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the text left) and its removed spans as word numbers."""
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, spans array<struct<start:bigint,end:bigint>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    groups = groups or group_count(docs)
    rows = R.grouped_documents(docs, groups)

    def close(key: tuple, data: pa.Table, told: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(6)]
        if data.num_rows:
            doc_ids, texts, _ = R.in_order(data)
            own = told.column("data").drop_null().to_pylist()
            of_paths = told.filter(told.column("digest").is_valid())
            spans = repeats_of(R.own_runs(own[0]), of_paths, key[0].as_py(), texts) if own else [[] for _ in texts]
            for doc_id, text, gone in zip(doc_ids, texts, spans, strict=True):
                words = text.split()
                kept, at = [], 0
                for a, b in gone:
                    kept += words[at:a]
                    at = b
                left = b" ".join(kept + words[at:])
                removed = [{"start": a, "end": b} for a, b in gone]
                values = (doc_id, len(words), sum(b - a for a, b in gone), hashlib.sha256(left).hexdigest(), left.decode(), removed)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), kind)
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"]
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)

    found = stage_table(R.sent_runs(rows, (METHOD,), groups).groupBy("bucket").applyInArrow(segments, SEGMENTS_DDL))
    asked = compacted(found).groupBy("src_gid")
    read = "head bigint, n int, src_gid int, src_doc int, src_at int, digest binary"
    paths = rows.groupBy("gid").cogroup(asked).applyInArrow(read_sources, read)
    begins = found.where("head is not null").select("gid", "head", "run", "offset").join(paths, "head")
    told = begins.drop("head").unionByName(found.where("data is not null").select("gid", "data"), allowMissingColumns=True)
    return rows.groupBy("gid").cogroup(told.groupBy("gid")).applyInArrow(close, schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM w WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(generate_series(0, 19)) AS k FROM later)),
each AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM w)),
kept AS (SELECT e.doc_id, count(*)::BIGINT AS n_words, count(g.i)::BIGINT AS n_removed, coalesce(string_agg(x, ' ' ORDER BY e.i) FILTER (g.i IS NULL), '') AS t FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""
