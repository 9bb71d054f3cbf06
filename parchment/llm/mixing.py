"""Mixing sources to target weights by Sainte-Lague apportionment of equal-word blocks.

Sources take weights 5, 2, 1 (repeating, by code point, null last) of a share of all words; a
target stops at ``cap`` times its source and the excess goes to the others by weight. A block is no
larger than the smallest target above 0, so that every such source gets one. Targets
become whole blocks by highest quotients: first per source, then per shard of a source. In its
shard a document has an interval of words in a seeded order, and the shard's blocks are taken as
full passes and one run of blocks that starts at a seeded block and wraps around.

Defined cases: a null text has size 0 and is taken 0 times; a null source is a source of its own;
repeated rows are documents of their own; an empty table gives an empty result. Extra columns are
ignored. No text moves: only (doc_id, source, size) is shuffled, and the windows run over shards
of bounded word counts, so that a source with a third of all rows is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage_table, table, words

WEIGHTS = (5, 2, 1)
SHARE, CAP, SEED = 1.5, 2.0, "mix-1"
#: Words in a shard at least; shards overall at most (besides one for each source); blocks in all words, or more for the sake of a small source.
SHARD_WORDS, SHARDS, BLOCKS = 200_000, 20_000, 1_000_000


def sainte_lague(df: DataFrame, group: list[str], weight: str, seats: str, order: list[str]) -> DataFrame:
    """Add ``quota``: ``seats`` of each group shared by highest quotients weight / (2k + 1).

    Every divisor that hands out N seats to S parties gives a party of exact share q between
    q (1 - S / 2N) - 1/2 and q (1 + S / 2N) + 1/2 seats, so only that band of quotients is ranked:
    about five rows for each party, whatever N is.
    """
    g = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    banded = (
        df.withColumn("_all", F.sum(weight).over(g))
        .withColumn("_n", F.count(F.lit(1)).over(g))
        .withColumn("_q", F.when((F.col("_all") > 0) & (F.col(seats) > 0), F.col(seats) * F.col(weight).cast("double") / F.col("_all")).otherwise(0.0))
        .withColumn("_d", F.when(F.col(seats) > 0, F.col("_n") / (2.0 * F.col(seats))).otherwise(0.0))
        .withColumn("_lo", F.greatest(F.lit(0), F.floor(F.col("_q") * (1 - F.col("_d")) - 1)))
        .withColumn("_hi", F.when(F.col("_q") > 0, F.ceil(F.col("_q") * (1 + F.col("_d")) + 1)).otherwise(F.lit(0)))
        .withColumn("_left", F.col(seats) - F.sum("_lo").over(g))
    )
    ranked = (
        banded.where("_hi > _lo")
        .withColumn("_k", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1)))
        .withColumn("_rank", F.row_number().over(g.orderBy((F.col(weight).cast("double") / (2 * F.col("_k") + 1)).desc(), *order, "_k")))
        .where("_rank <= _left")
        .groupBy(*group, *order)
        .agg(F.count(F.lit(1)).alias("_more"))
    )
    keys = [*group, *order]
    right = ranked.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_more")
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return banded.join(right, on, "left").withColumn("quota", F.col("_lo") + F.coalesce("_more", F.lit(0))).select(*df.columns, "quota")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, taken; passes and cuts say which words; and carried columns."""
    return mix_sized(stage_table(measured(docs, seed, carry)), weights, share, cap, seed, carry)


def measured(docs: DataFrame, seed: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, carried columns, size and h (the seeded order)."""
    return docs.select("doc_id", "source", *carry, F.size(words(F.col("text"))).cast("long").alias("size"), F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("h"))


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Targets by filling up: sources in order of cap / weight are capped as long as that level costs no more than all."""
    every = W.partitionBy(F.lit(0))
    up = every.orderBy("_level", "_pos").rowsBetween(W.unboundedPreceding, -1)
    return (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("_pos", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_pos") % len(weights) + 1).cast("int")))
        .withColumn("_cap", cap * F.col("source_size"))
        .withColumn("_total", share * F.sum("source_size").over(every))
        .withColumn("total_size", F.sum("source_size").over(every))
        .withColumn("_level", F.col("_cap") / F.col("_w"))
        .withColumn("_c", F.coalesce(F.sum("_cap").over(up), F.lit(0.0)))
        .withColumn("_wl", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(up), F.lit(0.0)))
        .withColumn("_full", F.col("_level") * F.col("_wl") + F.col("_c") <= F.col("_total"))
        .withColumn("_rest", F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(every), F.lit(0.0)))
        .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(every))
        .withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_rest") * F.col("_w") / F.col("_open")))
        .select("source", "source_size", "total_size", "target")
    )


def mix_sized(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    targets = (
        source_targets(sized, weights, share, cap)
        .withColumn("_least", F.min(F.when(F.col("target") > 0, F.col("target"))).over(W.partitionBy(F.lit(0))))
        .withColumn("block", F.greatest(F.lit(1), F.floor(F.least(F.col("total_size") / BLOCKS, "_least"))))
        .withColumn("shard_words", F.greatest(F.lit(SHARD_WORDS), F.floor(F.col("total_size") / SHARDS)))
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.col("shard_words"))))
        .withColumn("seats", F.round(F.sum("target").over(W.partitionBy(F.lit(0))) / F.col("block")).cast("long"))
    )
    quotas = sainte_lague(targets, [], "target", "seats", ["source"]).withColumnRenamed("quota", "source_quota")
    q = quotas.select(F.col("source").alias("_s"), "source_size", "target", "block", "shards", "source_quota")
    dealt = (
        sized.join(q, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("shard", F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % F.col("shards"))
    )
    by_shard = dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.max("source_quota").alias("source_quota"), F.max("block").alias("block"))
    shard_quotas = (
        sainte_lague(by_shard, ["source"], "shard_size", "source_quota", ["shard"])
        .withColumn("_words", F.least(F.col("quota") * F.col("block"), (cap * F.col("shard_size")).cast("long")))
        .withColumn("passes", F.when(F.col("shard_size") > 0, F.floor(F.col("_words") / F.col("shard_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("_words") - F.col("passes") * F.col("shard_size"))
        .withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("shard_size") / F.col("block"))))
        .withColumn("_first", F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("start"), F.coalesce("source", F.lit("")), F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long") % F.col("_blocks") * F.col("block"))
        .select(F.col("source").alias("_s"), F.col("shard").alias("_sh"), "shard_size", "passes", "rest", "_first")
    )
    run = W.partitionBy("source", "shard").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("_end", F.sum("size").over(run)).withColumn("_start", F.col("_end") - F.col("size"))

    def cut(start) -> F.Column:
        """The words of a document that a run of blocks from ``start`` covers: first one and count."""
        low, high = F.greatest(F.col("_start"), start), F.least(F.col("_end"), start + F.col("rest"))
        return F.struct((low - F.col("_start")).alias("first"), F.greatest(F.lit(0), high - low).alias("count"))

    return (
        placed.join(shard_quotas, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_sh")))
        .withColumn("cut", cut(F.col("_first"))).withColumn("wrapped", cut(F.col("_first") - F.col("shard_size")))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("cut.count") + F.col("wrapped.count"))
        .select("doc_id", "source", *carry, "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "passes", "cut", "wrapped")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each full pass over a document and one for the words of a partial pass, joined by a space.

    Rows are numbered and written once; the mix works on numbers and sizes, and texts move in one join by number.
    """
    inner = docs.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("_rid"), F.struct(*docs.columns).alias("_row"))
    held = stage_table(measured(inner, seed, ("_rid", "_row")))
    taken = mix_sized(held.drop("_row"), weights, share, cap, seed, ("_rid",)).where("taken > 0").join(held.select("_rid", "_row"), "_rid")
    w = words(F.col("_row.text"))
    piece = lambda c: F.slice(w, (F.col(f"{c}.first") + 1).cast("int"), F.col(f"{c}.count").cast("int"))
    part = F.array_join(F.concat(*[F.when(F.col(f"{c}.count") > 0, piece(c)).otherwise(F.array().cast("array<string>")) for c in ("cut", "wrapped")]), " ")
    texts = F.concat(F.array_repeat(F.col("_row.text"), F.col("passes").cast("int")), F.when(F.col("cut.count") + F.col("wrapped.count") > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    rows = taken.withColumn("_text", F.explode(texts))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("bigint")}
    return rows.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
         md5('{SEED}:' || doc_id::VARCHAR) AS h FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) AS pos, sum(source_size) OVER () AS total_size FROM s0),
s2 AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(pos % 3 + 1)::INT] AS w, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * total_size AS total FROM s1),
s3 AS (SELECT *, cap / w AS level FROM s2),
s4 AS (SELECT *, coalesce(sum(cap) OVER up, 0) AS c, sum(w) OVER () - coalesce(sum(w) OVER up, 0) AS wl FROM s3
       WINDOW up AS (ORDER BY level, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, level * wl + c <= total AS filled FROM s4),
s6 AS (SELECT *, total - coalesce(sum(cap) FILTER (filled) OVER (), 0) AS rest, sum(w) FILTER (NOT filled) OVER () AS open FROM s5),
s7 AS (SELECT source, source_size, total_size, CASE WHEN filled THEN cap ELSE rest * w / open END AS target FROM s6),
t AS (SELECT *, greatest(1, floor(total_size / {BLOCKS}.0))::BIGINT AS block, greatest(1, ceil(source_size / greatest({SHARD_WORDS}, floor(total_size / {SHARDS}.0))))::BIGINT AS shards FROM s7),
t1 AS (SELECT *, round(sum(target) OVER () / block)::BIGINT AS seats, sum(target) OVER () AS allw, count(*) OVER () AS n FROM t),
t2 AS (SELECT *, CASE WHEN allw > 0 AND seats > 0 THEN seats * target / allw ELSE 0 END AS q, CASE WHEN seats > 0 THEN n / (2.0::DOUBLE * seats) ELSE 0 END AS dd FROM t1),
t3 AS (SELECT *, greatest(0, floor(q * (1 - dd) - 1))::BIGINT AS lo, CASE WHEN q > 0 THEN ceil(q * (1 + dd) + 1) ELSE 0 END::BIGINT AS hi FROM t2),
t4 AS (SELECT source, target, lo, hi, seats - sum(lo) OVER () AS missing FROM t3),
t5 AS (SELECT source, missing, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source ASC NULLS FIRST, k) AS r FROM (SELECT *, unnest(generate_series(lo, hi - 1)) AS k FROM t4 WHERE hi > lo)),
t6 AS (SELECT source, count(*) AS more FROM t5 WHERE r <= missing GROUP BY source),
sq AS (SELECT t3.source, t3.source_size, t3.target, t3.block, t3.shards, lo + coalesce(more, 0) AS source_quota FROM t3 LEFT JOIN t6 ON t3.source IS NOT DISTINCT FROM t6.source),
p AS (SELECT d.*, sq.source_size, sq.target, sq.block, sq.source_quota, ('0x' || substr(h, 1, 8))::BIGINT % sq.shards AS shard FROM d JOIN sq ON d.source IS NOT DISTINCT FROM sq.source),
h0 AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, max(source_quota) AS seats, max(block) AS block FROM p GROUP BY source, shard),
h1 AS (SELECT *, sum(shard_size) OVER g AS allw, count(*) OVER g AS n FROM h0 WINDOW g AS (PARTITION BY source)),
h2 AS (SELECT *, CASE WHEN allw > 0 AND seats > 0 THEN seats * shard_size::DOUBLE / allw ELSE 0 END AS q, CASE WHEN seats > 0 THEN n / (2.0::DOUBLE * seats) ELSE 0 END AS dd FROM h1),
h3 AS (SELECT *, greatest(0, floor(q * (1 - dd) - 1))::BIGINT AS lo, CASE WHEN q > 0 THEN ceil(q * (1 + dd) + 1) ELSE 0 END::BIGINT AS hi FROM h2),
h4 AS (SELECT *, seats - sum(lo) OVER (PARTITION BY source) AS missing FROM h3),
h5 AS (SELECT source, shard, missing, row_number() OVER (PARTITION BY source ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard, k) AS r FROM (SELECT *, unnest(generate_series(lo, hi - 1)) AS k FROM h4 WHERE hi > lo)),
h6 AS (SELECT source, shard, count(*) AS more FROM h5 WHERE r <= missing GROUP BY source, shard),
h7 AS (SELECT h3.source, h3.shard, shard_size, block, least((lo + coalesce(more, 0)) * block, 2 * shard_size)::BIGINT AS words FROM h3 LEFT JOIN h6 ON h3.source IS NOT DISTINCT FROM h6.source AND h3.shard = h6.shard),
h8 AS (SELECT *, CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END AS passes, greatest(1, ceil(shard_size / block))::BIGINT AS blocks FROM h7),
h9 AS (SELECT *, words - passes * shard_size AS rest, ('0x' || substr(md5('{SEED}:start:' || coalesce(source, '') || ':' || shard::VARCHAR), 1, 8))::BIGINT % blocks * block AS f FROM h8),
x AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM p)
SELECT x.doc_id, x.size, x.source_size, x.target,
  (passes * size + greatest(0, least(e, f + rest) - greatest(e - size, f)) + greatest(0, least(e, f - shard_size + rest) - greatest(e - size, f - shard_size)))::BIGINT AS taken
FROM x JOIN h9 ON x.source IS NOT DISTINCT FROM h9.source AND x.shard = h9.shard
"""
