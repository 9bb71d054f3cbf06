"""Quality rules with risk-controlled thresholds.

Four shares of a text (symbols, repeated lines, words in repeated passages, capitals) are each
tested against a falling grid of cutoffs. For every stratum, share and cutoff the labelled good
documents give a binomial test: false rejections k of n, and the exact tail P(X <= k | n, alpha)
must be at most delta divided by the number of all tests (Bonferroni). The lowest certified cutoff
is used; where none is certified, that share rejects nothing in that stratum. The false rejection
of a stratum is then at most alpha for each share, together with probability 1 - delta.

Defined cases: a null or empty text has no words and fails the base rule; a null stratum is a
stratum of its own; several labels of one document count once, as good only if all are; repeated
rows are judged alike; an empty table gives an empty result; no labels certify nothing. Extra
columns are ignored. Only the features of labelled documents are shuffled. The cutoffs, a row for
each stratum, are written and counted; up to STRATA of them are broadcast, so that no text moves,
more are joined by stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage_table, table, words

ALPHA, DELTA = 0.005, 0.05
#: Cutoffs from 0.5 down by a quarter each.
CUTOFFS = tuple(0.5 * 0.75**i for i in range(20))
SHARES = ("symbols", "dup_lines", "repeats", "capitals")
WINDOW = 8
#: Strata whose cutoffs (five numbers each, some megabytes in all) may be broadcast.
STRATA = 20_000


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of all windows in order."""
    tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.lit(None).cast("bigint")
    doubled = F.filter(
        F.zip_with(
            F.zip_with(tagged, F.slice(tagged, 2, F.greatest(F.size(tagged) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b["h"].alias("next"))),
            F.concat(F.array(none), F.transform(tagged, lambda t: t["h"])),
            lambda x, before: F.struct(x["a"].alias("a"), x["next"].alias("next"), before.alias("before")),
        ),
        lambda x: x["a"].isNotNull() & ((x["a"]["h"] == x["next"]) | (x["a"]["h"] == x["before"])),
    )
    at = F.array_sort(F.transform(doubled, lambda x: x["a"]["i"]))
    after = F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0)))
    return F.aggregate(
        F.zip_with(at, after, lambda p, q: F.when(p.isNull(), 0).otherwise(F.least(F.lit(WINDOW), F.coalesce(q - p, F.lit(WINDOW))))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the kept columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def paired(h: Column, gap: int) -> Column:
        return F.zip_with(h, F.slice(h, gap + 1, F.greatest(F.size(h) - gap, F.lit(0))), lambda a, b: F.xxhash64(a, b))

    step = docs.select("doc_id", *keep, text.alias("_t"), words(F.col("text")).alias("_w"))
    step = step.withColumn("n_words", F.size("_w").cast("long")).withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    step = step.withColumn("_h", paired(F.col("_h"), 1)).withColumn("_h", paired(F.col("_h"), 2)).withColumn("_h", paired(F.col("_h"), 4))
    step = step.withColumn("_h", F.slice("_h", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int")))
    step = step.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    step = step.withColumn("n_repeat_words", F.when(F.size(F.array_distinct("_h")) == F.size("_h"), F.lit(0).cast("long")).otherwise(repeated_words(F.col("_h"))))
    less = lambda c: (F.length("_t") - F.length(F.regexp_replace("_t", c, ""))).cast("long")
    return step.select(
        "doc_id", *keep, "n_words",
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        less("[#*$%&|<>]+").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast("long").alias("n_lines"),
        less(r"\p{Lu}+").alias("n_capitals"),
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
    )


def with_shares(df: DataFrame) -> DataFrame:
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))
    return df.withColumns({"symbols": part("n_symbols", "word_chars"), "dup_lines": part("n_dup_lines", "n_lines"), "repeats": part("n_repeat_words", "n_words"), "capitals": part("n_capitals", "word_chars")})


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series above 20 (error below 1e-13)."""
    x = (n + 1).cast("double")
    big = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(big)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k), X binomial(n, p), for k <= n p: the term at k times the falling sum of its predecessors."""
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    reach = F.least(k, F.lit(64) * F.ceil(F.sqrt(n * p + 1)))
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("long"), reach),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct((a["term"] * (k - i) / (n - k + i + 1) * (1 - p) / p).alias("term"), (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"],
    )
    return F.when(k <= n * p, F.exp(top) * terms).otherwise(F.lit(1.0))


def certified_cutoffs(labelled: DataFrame, stratum: str, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum and, for each share, its lowest certified cutoff (null: none). ``labelled`` holds good documents' shares."""
    counts = labelled.groupBy(stratum).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.array(*[F.sum(F.when(F.col(s) > c, 1).otherwise(0)) for c in CUTOFFS]).alias(f"_k_{s}") for s in SHARES],
    )
    strata = counts.withColumn("_strata", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))  # a row for each stratum
    tests = F.col("_strata") * len(SHARES) * len(CUTOFFS)
    grid = F.array(*[F.lit(c) for c in CUTOFFS])
    best = [
        F.array_min(F.transform(F.filter(F.arrays_zip(F.col(f"_k_{s}").alias("k"), grid.alias("c")), lambda x: binomial_tail(x["k"], F.col("n"), alpha) <= delta / tests), lambda x: x["c"])).alias(f"cut_{s}")
        for s in SHARES
    ]
    return strata.select(stratum, *best)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA, keep: tuple[str, ...] = (), staged: bool = True) -> DataFrame:
    """Every document with its features, base_failed and kept."""
    found = features(docs, *dict.fromkeys([stratum, *keep]))
    rows = with_shares(stage_table(found) if staged else found)
    good = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_good")).where("_good = 1")
    cuts = certified_cutoffs(rows.join(good, F.col("doc_id") == F.col("_id")).select(stratum, *SHARES), stratum, alpha, delta).withColumnRenamed(stratum, "_stratum")
    if staged:
        cuts = stage_table(cuts)
        cuts = F.broadcast(cuts) if cuts.count() <= STRATA else cuts
    over = [F.coalesce(F.col(s) > F.col(f"cut_{s}"), F.lit(False)) for s in SHARES]
    rejected = over[0]
    for x in over[1:]:
        rejected = rejected | x
    return rows.join(cuts, F.col(stratum).eqNullSafe(F.col("_stratum")), "left").withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum")


def kept_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    inner = docs.select("doc_id", "text", stratum, F.struct(*docs.columns).alias("_row"))
    return judge(inner, labels, stratum, keep=("_row",)).where("kept").select("_row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_GRID = ", ".join(f"{c!r}::DOUBLE" for c in CUTOFFS)
#: The binomial test in SQL: DuckDB has the log gamma function; the tail is summed from its start.
ORACLE = f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
dbl AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least(8, coalesce(nx - i, 8)))::BIGINT AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM dbl) GROUP BY rid),
f AS (SELECT w.rid, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
   (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
   coalesce(rep.n, 0) AS n_repeat_words, (length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')))::BIGINT AS n_capitals
   FROM w LEFT JOIN rep USING (rid)),
g AS (SELECT *, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
h AS (SELECT *, CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END AS symbols, CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_lines,
   CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeats, CASE WHEN word_chars > 0 THEN n_capitals::DOUBLE / word_chars ELSE 0 END AS capitals FROM g),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
lab AS (SELECT lang, unnest([{{'s': 'symbols', 'v': symbols}}, {{'s': 'dup_lines', 'v': dup_lines}}, {{'s': 'repeats', 'v': repeats}}, {{'s': 'capitals', 'v': capitals}}]) AS x FROM h JOIN good USING (doc_id)),
tests AS (SELECT lang, x.s AS s, c, count(*) AS n, count(*) FILTER (x.v > c) AS k FROM lab, (SELECT unnest([{_GRID}]) AS c) GROUP BY lang, x.s, c),
cnt AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT lang FROM tests)) * {len(SHARES) * len(CUTOFFS)} AS m),
tail AS (SELECT lang, s, c, n, k, CASE WHEN k > n * {ALPHA} THEN 1 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA}))) FROM (SELECT unnest(generate_series(0, k)) AS i)) END AS p FROM tests),
cut AS (SELECT lang, min(c) FILTER (s = 'symbols') AS c1, min(c) FILTER (s = 'dup_lines') AS c2, min(c) FILTER (s = 'repeats') AS c3, min(c) FILTER (s = 'capitals') AS c4 FROM tail, cnt WHERE p <= {DELTA} / m GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(symbols > c1, false) OR coalesce(dup_lines > c2, false) OR coalesce(repeats > c3, false) OR coalesce(capitals > c4, false)) AS kept
FROM h LEFT JOIN cut ON h.lang IS NOT DISTINCT FROM cut.lang
"""
