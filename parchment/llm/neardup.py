"""Near-duplicates by Order MinHash, verified by banded alignment.

A text's shingles are five consecutive words with their occurrence number. Each of REPS sketches
keeps its two least shingles in text order; a bucket key is their hash. Two texts of similarity 0.8
share a key with a probability of 1 - 0.36**REPS. Equal texts fold into one first. In a bucket every
text is paired with the bucket's most shared text, its hub; links make classes; in buckets that then
hold several classes, texts outside the largest are paired with TRIES texts of it, which differ from
bucket to bucket; links make larger classes; buckets that still hold several classes pair their texts across classes. A pair is a candidate where AGREE of the SIGNS
minima of the distinct shingles agree (those of a pair that links agree in four fifths, with a
standard deviation of 0.013), and comes from the first bucket that it shares. Large buckets are dealt
into squares of BLOCK by BLOCK texts. So no link between different texts of different classes is left
out, no task holds a whole bucket, and no group is expanded into all its pairs. A pair links if its shingle sets have a Jaccard
similarity of 0.8 or more and its words align, within a band, with an edit similarity of 0.8 or more.

Defined cases: null texts and texts without words are classes of their own; texts of one to four
words match exact copies only; repeated rows are exact copies; a null doc_id takes part, and a
class is named by its least doc_id (null if all are null); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import repeats as R
from .common import bounded_batches, stage_table, table
from .substrings import word_units

SHINGLE, SIMILARITY, REPS = 5, 0.8, 20
SIGNS, AGREE, BLOCK, TRIES = 1024, 0.75, 2048, 4
#: Four-bit signs that two bytes have in common, by their exclusive or.
ALIKE = np.array([(not x & 15) + (not x >> 4) for x in range(256)], np.uint8)
SEEDS = R.mixed(np.arange(1, REPS + 1, dtype=np.uint64) * R.BASE)
FACTORS = R.mixed(np.arange(1001, 1001 + SIGNS, dtype=np.uint64) * R.BASE) | np.uint64(1)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of texts in order, the document of each, and words of each document."""
    units, bounds = word_units(texts)
    grams = R.gram_hashes(R.prefix(units), SHINGLE)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    n = len(grams)
    at = np.flatnonzero(doc[:n] == doc[len(doc) - n :]) if n else np.empty(0, np.int64)
    return grams[at], doc[at], np.diff(bounds)


def labelled(grams: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence number in the document."""
    own = R.mixed(grams + R.mixed(doc.astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    new = np.ones(len(own), bool)
    new[1:] = own[order[1:]] != own[order[:-1]]
    head = np.flatnonzero(new)
    nth = np.empty(len(own), np.uint64)
    nth[order] = np.arange(len(own)) - np.repeat(head, np.diff(np.append(head, len(own))))
    return R.mixed(grams ^ (nth * R.BASE))


def order_sketches(grams: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with shingles, their keys and the signs of their distinct shingles."""
    with_any, start, size = np.unique(doc, return_index=True, return_counts=True)
    if not len(with_any):
        return with_any, np.empty((0, REPS), np.uint64), np.empty((0, SIGNS // 2), np.uint8)
    marked = labelled(grams, doc)
    top = np.iinfo(np.uint64).max
    keys, sketch = np.empty((len(with_any), REPS), np.uint64), np.zeros((len(with_any), SIGNS // 2), np.uint8)
    for j, seed in enumerate(SEEDS):
        h = R.mixed(marked ^ seed)
        one = np.minimum.reduceat(h, start)
        at_one = start.copy()
        place = np.flatnonzero(h == np.repeat(one, size))
        at_one[np.searchsorted(start, place, side="right") - 1] = place
        h[place] = top
        two = np.minimum.reduceat(h, start)
        at_two = start.copy()
        place = np.flatnonzero(h == np.repeat(two, size))
        at_two[np.searchsorted(start, place, side="right") - 1] = place
        before = at_one < at_two
        keys[:, j] = R.mixed(np.where(before, one, two) * R.BASE + np.where(before, two, one)) ^ seed
    for j, factor in enumerate(FACTORS):  # a least value has few bits at its top, so its middle is kept
        sketch[:, j // 2] |= ((np.minimum.reduceat(grams * factor, start) >> np.uint64(24)) & np.uint64(15)).astype(np.uint8) << (j % 2 * 4)
    return with_any, keys, sketch


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An estimate of the Jaccard similarity: the share of signs that agree, without the sixteenth of the others that do so by chance."""
    return (ALIKE[a ^ b].sum(-1, dtype=np.int64) / SIGNS - 1 / 16) / (15 / 16)


def alignment_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two sequences, over the band of diagonals within ``most`` edits; ``most`` + 1 if it is more."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1

    def slide(i: int, j: int) -> int:
        step = 16
        while i < n and j < m:
            k = min(step, n - i, m - j)
            same = a[i : i + k] == b[j : j + k]
            if not same.all():
                return i + int(same.argmin())
            i, j, step = i + k, j + k, step * 4
        return i

    reach = {0: slide(0, 0)}
    if reach[0] >= n and n == m:
        return 0
    for d in range(1, most + 1):
        nxt = {}
        for k in range(-d, d + 1):  # diagonal: i - j
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2) + 1, reach.get(k + 1, -2))
            i = min(i, n, m + k)
            if i < 0 or i - k < 0:
                continue
            nxt[k] = slide(i, i - k)
            if nxt[k] >= n and nxt[k] - k >= m:
                return d
        reach = nxt
    return most + 1


def alike(a: bytes, b: bytes) -> bool:
    x, y = a.split(), b.split()
    s, t = {tuple(x[i : i + SHINGLE]) for i in range(len(x) - SHINGLE + 1)}, {tuple(y[i : i + SHINGLE]) for i in range(len(y) - SHINGLE + 1)}
    both = len(s & t)
    if not both or both < SIMILARITY * (len(s) + len(t) - both):
        return False
    code: dict[bytes, int] = {}
    p, q = (np.array([code.setdefault(w, len(code)) for w in z]) for z in (x, y))
    most = int((1 - SIMILARITY) * max(len(p), len(q)) + 1e-9)
    return alignment_distance(p, q, most) <= most


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, digest (null without words), n (words), keys, sketch."""
    schema = "doc_id bigint, digest string, n int, keys array<bigint>, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for a, b in R.chunks(texts):
                grams, doc, words = shingles(texts[a:b])
                who, keys, sketch = order_sketches(grams, doc)
                all_keys: list = [None] * (b - a)
                all_sketches: list = [None] * (b - a)
                for d, k, s in zip(who.tolist(), keys.astype(np.int64).tolist(), sketch, strict=True):
                    all_keys[d], all_sketches[d] = k, s.tobytes()
                digests = [hashlib.md5(t).hexdigest() if w else None for t, w in zip(texts[a:b], words.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(digests, pa.string()), pa.array(words.astype(np.int32)), pa.array(all_keys, pa.list_(pa.int64())), pa.array(all_sketches, pa.binary())], ["doc_id", "digest", "n", "keys", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """node, root of each node in ``links`` (a, b), by alternating large and small stars; every step is written to the shared folder."""
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        edges = stage_table(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def sized(x: Column | str, y: Column | str) -> Column:
    return F.least(x, y) >= SIMILARITY * F.greatest(x, y) - SHINGLE


def in_classes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Bucket members with the root of their class; a text without links is its own."""
    return members.select("key", "digest", "n").join(classes, F.col("digest") == F.col("node"), "left").select("key", "digest", "n", F.coalesce("root", "digest").alias("root"))


def towards_largest(placed: DataFrame) -> DataFrame:
    """Pairs of a bucket's texts with TRIES texts of its largest class, for those outside it."""
    picks = [F.min(F.struct(F.xxhash64("digest", "key", F.lit(i)).alias("h"), "digest", "n")).alias(f"p{i}") for i in range(TRIES)]
    within = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), *picks)
    largest = within.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.max(F.struct("c", "root", F.array(*[f"p{i}" for i in range(TRIES)]).alias("picks"))).alias("top")).where("classes > 1 AND top.c > 1").select("key", "top")
    pairs = placed.join(largest, "key").where(F.col("root") != F.col("top.root")).select("digest", "n", F.explode("top.picks").alias("pick"))
    return pairs.where(sized(F.col("n"), F.col("pick.n"))).select(F.greatest("digest", "pick.digest").alias("a"), F.least("digest", "pick.digest").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, digest, root (a name of the class), class_id (its least doc_id), of every row."""
    bounded_batches(docs.sparkSession)
    rows = stage_table(sketched(docs))
    texts = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    keyed = texts.where("keys IS NOT NULL").select("digest", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    members = stage_table(keyed.join(shared, "key"))
    weight = members.groupBy("digest").agg(F.sum(F.log2("c")).alias("w"))
    ranked = members.select("key", "digest", "n").join(weight, "digest")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("w", "digest", "n")).alias("hub"))
    stars = (
        members.select("key", "digest", "n").join(hubs, "key").where(F.col("digest") != F.col("hub.digest")).where(sized(F.col("n"), F.col("hub.n")))
        .select(F.greatest("digest", "hub.digest").alias("a"), F.least("digest", "hub.digest").alias("b")).distinct()
    )
    sketches = texts.select("digest", "sketch")
    tried = stage_table(pruned(stars, sketches))
    first = stage_table(verified(docs, texts, tried))
    placed = stage_table(in_classes(members, components(first)))
    again = stage_table(pruned(towards_largest(placed).join(tried, ["a", "b"], "left_anti"), sketches))
    first = stage_table(first.unionByName(verified(docs, texts, again)))
    tried = tried.unionByName(again)
    placed = stage_table(in_classes(members, components(first)))
    mixed_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).where("lo <> hi").select("key", "blocks")
    own = F.pmod(F.xxhash64("digest"), "blocks").cast("int")
    squares = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, own).alias("x"), F.greatest(i, own).alias("y")))
    dealt = placed.join(mixed_keys, "key").select("key", "digest", "n", "root", own.alias("own"), F.explode(squares).alias("square")).select("key", "digest", "n", "root", "own", "square.x", "square.y")
    across = dealt.join(texts.select("digest", "sketch", "keys"), "digest").groupBy("key", "x", "y").applyInArrow(across_classes, "a string, b string")
    untried = stage_table(across.join(tried, ["a", "b"], "left_anti"))
    links = first.unionByName(verified(docs, texts, untried)).distinct()
    final = components(links)
    roots = texts.select("digest", "doc_id").join(final, F.col("digest") == F.col("node"), "left").select("digest", "doc_id", F.coalesce("root", "digest").alias("root"))
    named = roots.join(roots.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select(F.col("digest").alias("_digest"), "root", "class_id")
    return rows.select("doc_id", "digest").join(named, F.col("digest") == F.col("_digest"), "left").select("doc_id", "digest", "root", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def first_of_classes(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the least doc_id (null first), with the columns of ``docs``."""
    classes = stage_table(near_duplicates(docs))
    chosen = classes.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("bigint").alias("_doc"), F.md5(F.coalesce("text", F.lit(""))).alias("_md5"))
    found = rows.join(chosen, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_digest")))
    single = found.withColumn("_nth", F.row_number().over(W.partitionBy("_doc", "_md5").orderBy("_doc"))).where("_nth = 1")
    wordless = rows.where(~F.coalesce(F.col("_row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return single.select("_row.*").unionByName(wordless.select("_row.*"))


def across_classes(data: pa.Table) -> pa.Table:
    """Pairs of a square's texts of different classes whose signs agree enough and that share no earlier bucket."""
    key, x, y = (data.column(c)[0].as_py() for c in ("key", "x", "y"))
    own = data.column("own").to_numpy()
    order = np.argsort(own, kind="stable")
    left = np.searchsorted(own[order], x, side="right")
    digest, root = np.array(data.column("digest").to_pylist())[order], np.unique(data.column("root").to_pylist(), return_inverse=True)[1][order]
    n = data.column("n").to_numpy()[order]
    sketch = np.frombuffer(b"".join(data.column("sketch").to_pylist()), np.uint8).reshape(len(n), SIGNS // 2)[order]
    keys = np.array(data.column("keys").to_pylist(), np.int64)[order]
    a, b = [], []
    for low in range(0, left, 256):
        high = min(low + 256, left)
        for other in range(low if x == y else left, len(n), 1024):
            i, j = slice(low, high), slice(other, other + 1024)
            ok = root[i, None] != root[None, j]
            ok &= np.minimum(n[i, None], n[None, j]) >= SIMILARITY * np.maximum(n[i, None], n[None, j]) - SHINGLE
            if x == y:
                ok &= np.arange(low, high)[:, None] < np.arange(other, min(other + 1024, len(n)))[None]
            u, v = np.nonzero(ok)
            for part in range(0, len(u), 1 << 15):
                p, q = low + u[part : part + (1 << 15)], other + v[part : part + (1 << 15)]
                fine = agreement(sketch[p], sketch[q]) >= AGREE
                p, q = p[fine], q[fine]
                same = keys[p] == keys[q]
                here = keys[p, same.argmax(1)] == key
                a += digest[p[here]].tolist()
                b += digest[q[here]].tolist()
    pairs = [(max(p), min(p)) for p in zip(a, b, strict=True)]
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.string()), "b": pa.array([p[1] for p in pairs], pa.string())})


def pruned(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SIGNS // 2) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array(agreement(x, y) >= AGREE))

    both = pairs.join(sketches.select(F.col("digest").alias("a"), F.col("sketch").alias("sa")), "a").join(sketches.select(F.col("digest").alias("b"), F.col("sketch").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a string, b string")


def verified(docs: DataFrame, texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the staged ``pairs`` that link; only texts that some pair names are read by the comparison."""
    needed = texts.select("digest", "doc_id").join(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), "digest")
    source = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("text")).withColumn("_d", F.md5("text"))
    held = stage_table(source.join(needed, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_d") == F.col("digest"))).select("digest", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(x.encode(), y.encode()) for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(held.select(F.col("digest").alias("a"), F.col("text").alias("ta")), "a").join(held.select(F.col("digest").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a string, b string")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("is_first"))
