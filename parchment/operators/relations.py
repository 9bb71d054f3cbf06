"""Generic relational operators: quality checks, alignment counts, graph and staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import phonetic_key, squeezed


def numbered(rows: DataFrame, group: str, order: str, name: str = "n") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(W.partitionBy(group).orderBy(order)).cast("bigint"))


def near_copies(rows: DataFrame, group: str, order: str, text: str, ahead: int = 4) -> DataFrame:
    """Pairs of a row and one of the next ``ahead`` rows of its group with the same text, by its SHA-256."""
    w = W.partitionBy(group).orderBy(order)
    held = squeezed(F.col(text))
    start = rows.select(group, order, F.when(held != "", F.sha2(held, 256)).alias("_t"))
    for k in range(1, ahead + 1):
        start = start.withColumn(f"_o{k}", F.lead(order, k).over(w)).withColumn(f"_t{k}", F.lead("_t", k).over(w))
    pairs = F.filter(F.array(*[F.struct(F.col(f"_o{k}").alias("other"), F.col(f"_t{k}").alias("t")) for k in range(1, ahead + 1)]), lambda p: p["t"] == F.col("_t"))
    return start.where("_t IS NOT NULL").select(group, order, F.explode(pairs).alias("p")).select(group, order, F.col("p.other").alias("other"))


def chronology_breaks(rows: DataFrame, group: str, order: str, date: str, days: int = 30) -> DataFrame:
    """Rows whose full date is more than ``days`` before that of the row before."""
    o = rows.withColumn("_o", dates.ordinal(F.col(date))).where("_o IS NOT NULL")
    return o.withColumn("_before", F.lag("_o").over(W.partitionBy(group).orderBy(order))).where(F.col("_o") < F.col("_before") - days).select(group, order, date)


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall, f1, rounded to four places."""
    p = F.when(tp + fp > 0, tp / F.nullif(tp + fp, F.lit(0))).otherwise(F.when(fn == 0, 1.0).otherwise(0.0))
    r = F.when(tp + fn > 0, tp / F.nullif(tp + fn, F.lit(0))).otherwise(1.0)
    f = F.when(p + r > 0, 2 * p * r / F.nullif(p + r, F.lit(0.0))).otherwise(0.0)
    return [F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f, 4).alias("f1")]


def block_candidates(mentions: DataFrame, name: str) -> DataFrame:
    """For each phonetic block, its mentions and the pairs it would compare; counted, not made."""
    return mentions.groupBy(phonetic_key(F.col(name)).alias("block")).agg(F.count(F.lit(1)).alias("mentions")).withColumn("pairs", (F.col("mentions") * (F.col("mentions") - 1) / 2).cast("bigint"))


def typed_edges(links: DataFrame, source: str, kind: str, target: str, entry: str) -> DataFrame:
    """Distinct typed edges with the number of links and of entries; self-loops and untyped links go."""
    clean = links.where(F.col(kind).isNotNull() & F.col(source).isNotNull() & F.col(target).isNotNull() & (F.col(source) != F.col(target)))
    return clean.groupBy(F.col(source).alias("source"), F.col(kind).alias("type"), F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("weight"), F.countDistinct(entry).alias("entries"))


def degrees(edges: DataFrame) -> DataFrame:
    """Each typed edge counts once at both ends."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def batches(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Number of the batch that each row of a group is staged in."""
    return numbered(rows, group, order, "_n").withColumn("batch", F.floor((F.col("_n") - 1) / size)).drop("_n")


def running_within(rows: DataFrame, group: str, order: str, amount: str, cap: float) -> DataFrame:
    """Running sum of a ledger and whether it is within the cap."""
    run = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("spent", F.round(F.sum(F.col(amount).cast("decimal(18,2)")).over(run).cast("double"), 2)).withColumn("within", F.col("spent") <= cap)


def term_samples(rows: DataFrame, term: str, order: str, first: int = 3) -> DataFrame:
    """Count of each term and its ``first`` samples; the limit by rank reaches the map side, so a hot term moves few rows."""
    counts = rows.groupBy(F.col(term).alias("term")).agg(F.count(F.lit(1)).alias("n"))
    ranked = rows.select(F.col(term).alias("_term"), F.col(order).alias("_at")).withColumn("_r", F.row_number().over(W.partitionBy("_term").orderBy("_at"))).where(F.col("_r") <= first)
    samples = ranked.groupBy("_term").agg(F.array_join(F.array_sort(F.collect_list("_at")).cast("array<string>"), ",").alias("samples"))
    return counts.join(samples, F.col("term").eqNullSafe(F.col("_term"))).drop("_term")


def conformance(rows: DataFrame, group: str, value: str, vocabulary: tuple[str, ...]) -> DataFrame:
    """Values seen in each group, those in the vocabulary, and their share; blank values are not seen."""
    folded = rows.select(group, F.lower(F.trim(F.col(value))).alias("_v")).where("_v <> ''")
    counts = folded.groupBy(group).agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("_v").isin(*vocabulary)).alias("in_vocab"))
    return counts.withColumn("rate", F.round(F.col("in_vocab") / F.col("seen"), 4))


def nonreciprocal(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Distinct edges whose reverse is missing."""
    one = edges.select(source, target).where(F.col(source) != F.col(target)).distinct()
    back = one.select(F.col(target).alias("_s"), F.col(source).alias("_t"))
    return one.join(back, (F.col(source) == F.col("_s")) & (F.col(target) == F.col("_t")), "left_anti")


def page_chunks(pages: DataFrame, record: str, order: tuple[str, ...], size: int) -> DataFrame:
    """Ranges of ``size`` pages of each record, named by their first and last page."""
    at = pages.select(record, F.row_number().over(W.partitionBy(record).orderBy(*order)).alias("_n"))
    ranges = at.groupBy(record, F.floor((F.col("_n") - 1) / size).alias("_c")).agg(F.min("_n").alias("_a"), F.max("_n").alias("_b"), F.count(F.lit(1)).alias("pages"))
    return ranges.select(record, F.concat(F.col(record).cast("string"), F.format_string("--p%02d-%02d", "_a", "_b")).alias("chunk_id"), "pages")


def matching_rules(keywords: Column, rules: tuple[tuple[str, tuple[str, ...], int], ...]) -> Column:
    """Names of the rules (name, cases, sequence) all of whose cases are among the keywords, in sequence."""
    given = [F.when(F.size(F.array_except(F.array(*map(F.lit, cases)).cast("array<string>"), keywords)) == 0, name) for name, cases, _ in sorted(rules, key=lambda r: r[2])]
    return F.array_join(F.array_compact(F.array(*given)), ",")
