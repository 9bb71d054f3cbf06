"""Controlled vocabularies: what is known, what it is called in English, and how far records keep to them.

A vocabulary is a table (field, language, pos, value), read from its file and small: a few hundred
values. It is broadcast after its rows are counted, and joined by hash beyond ``SMALL`` rows. Values are
compared without case and accents, and with the other gender of their last vowel (-a and -o).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import folded

# English names of relations and ages, and words for free and legitimate, each with what registers call it.
RELATIONS = {
    "spouse": ("conyuge", "esposo", "esposa", "marido", "mujer", "conjuge", "mulher"),
    "parent": ("padre", "madre", "pai", "mae"),
    "child": ("hijo", "hija", "filho", "filha"),
    "grandparent": ("abuelo", "abuela", "avo"),
    "grandchild": ("nieto", "nieta", "neto", "neta"),
    "enslaver": ("esclavizador", "amo", "ama", "escravizador", "senhor", "senhora"),
    "slave": ("esclavo", "esclava", "escravo", "escrava"),
    "godparent": ("padrino", "madrina", "padrinho", "madrinha"),
    "godchild": ("ahijado", "ahijada", "afilhado", "afilhada"),
}
AGES = {"infant": ("infante", "parvulo", "parvula"), "child": ("nino", "nina", "crianca", "menino", "menina"), "adult": ("adulto", "adulta")}
FREE = {
    "true": ("libre", "liberto", "liberta", "horro", "horra", "livre", "forro", "forra", "free", "freedman", "freedwoman", "verdadero", "verdadeiro"),
    "false": ("esclavo", "esclava", "escravo", "escrava", "enslaved", "falso"),
}
LEGITIMATE = {"true": ("legitimo", "legitima", "legitimate", "verdadero", "verdadeiro"), "false": ("ilegitimo", "ilegitima", "illegitimate", "natural", "falso")}
#: Fields whose languages list the same things in the same order, and those that are never translated.
ALIGNED, UNTRANSLATED = ("ranks", "ethnicity"), ("titles", "phenotype")
SMALL = 100_000


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """field, language, pos, value and folded of a vocabulary file."""
    lists = spark.read.schema("controlled_vocabularies array<struct<key:string,language:string,vocab:array<string>>>").json(path, multiLine=True)
    each = lists.select(F.explode("controlled_vocabularies").alias("v")).select(F.col("v.key").alias("field"), F.col("v.language").alias("language"), F.posexplode("v.vocab").alias("pos", "value"))
    return each.withColumn("folded", folded(F.col("value")))


def vocabulary(spark: SparkSession, rows: list[tuple[str, str, int, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "field string, language string, pos int, value string").withColumn("folded", folded(F.col("value")))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def other_gender(value: Column) -> Column:
    body = F.left(value, F.length(value) - 1)
    return F.when(value.endswith("a"), F.concat(body, F.lit("o"))).when(value.endswith("o"), F.concat(body, F.lit("a")))


def known(rows: DataFrame, value: str, vocab: DataFrame, field: str | None = None) -> DataFrame:
    """rows with ``known``: whether the value, or its other gender, is in the vocabulary of ``field`` (or of the row's own
    column ``field``) in any language."""
    words = _small(vocab.select(F.col("field").alias("_vf"), "folded").distinct())
    once = folded(F.col(value))
    here = rows.withColumns({"_f": once, "_s": other_gender(once), "_vf": F.lit(field) if field else F.col("field")})
    a, b = words.withColumnRenamed("folded", "_f").withColumn("_a", F.lit(True)), words.withColumnRenamed("folded", "_s").withColumn("_b", F.lit(True))
    here = here.join(a, ["_vf", "_f"], "left").join(b, ["_vf", "_s"], "left")
    return here.withColumn("known", F.coalesce("_a", "_b", F.lit(False))).drop("_vf", "_f", "_s", "_a", "_b")


def english(spark: SparkSession, vocab: DataFrame) -> DataFrame:
    """field, folded and english: given words, and lists that are aligned by position and of equal length."""
    given = [(f, w, e) for f, words in (("relationship_type", RELATIONS), ("age", AGES), ("free", FREE), ("legitimate", LEGITIMATE)) for e, surfaces in words.items() for w in (e, *surfaces)]
    sizes = vocab.where(F.col("field").isin(*ALIGNED)).withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("field", "language")))
    target = sizes.where("language = 'English'").select("field", "pos", F.col("value").alias("english"), F.col("_n").alias("_m"))
    aligned = sizes.join(target, ["field", "pos"]).where("_n = _m").groupBy("field", "folded").agg(F.max_by("english", F.struct("language", "pos")).alias("english"))
    return spark.createDataFrame(given, "field string, folded string, english string").unionByName(aligned)


def canonical(rows: DataFrame, field: str, value: str, words: DataFrame) -> DataFrame:
    """rows with ``canonical``: the English word for the value; null where there is none, or the field keeps its language."""
    given = _small(words.where(F.col("field") == ("ranks" if field == "rank" else field)).select(F.col("folded").alias("_f"), F.col("english").alias("canonical")))
    if field in UNTRANSLATED:
        return rows.withColumn("canonical", F.lit(None).cast("string"))
    return rows.withColumn("_f", folded(F.col(value))).join(given, "_f", "left").drop("_f")


def conformance(rows: DataFrame, vocab: DataFrame, first: int = 8) -> DataFrame:
    """For each field of rows (field, value): seen, in_vocab, rate and the ``first`` strays by count, as value=n."""
    judged = known(rows.where(F.trim("value") != ""), "value", vocab)
    totals = judged.groupBy("field").agg(F.count(F.lit(1)).alias("seen"), F.count_if("known").alias("in_vocab")).withColumn("rate", F.round(F.col("in_vocab") / F.col("seen"), 4))
    counts = judged.where("NOT known").groupBy("field", F.trim("value").alias("stray")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.withColumn("_r", F.row_number().over(W.partitionBy("field").orderBy(F.desc("n"), "stray"))).where(F.col("_r") <= first)
    strays = top.groupBy("field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "stray", "n"))), lambda x: F.concat(x["stray"], F.lit("="), x["n"].cast("string"))), ";").alias("strays"))
    return totals.join(strays, "field", "left").withColumn("strays", F.coalesce("strays", F.lit("")))


def conformance_change(old: DataFrame, new: DataFrame, field: str = "field") -> DataFrame:
    """Rates of an old and a new run side by side, with a verdict: better, worse, same, or not comparable where one saw nothing."""
    side = lambda df, name: df.select(field, F.col("seen").alias(f"{name}_seen"), F.col("rate").alias(f"{name}_rate"))
    both = side(old, "old").join(side(new, "new"), field, "full")
    verdict = F.when(F.col("old_rate").isNull() | F.col("new_rate").isNull(), "not comparable").when(F.col("new_rate") > F.col("old_rate"), "better").when(F.col("new_rate") < F.col("old_rate"), "worse").otherwise("same")
    return both.withColumn("verdict", verdict)


def term_audit(rows: DataFrame, value: str, order: str, vocab: DataFrame, field: str, first: int = 3) -> DataFrame:
    """Terms that are not known, by count and then without case: term, n and the places of the ``first`` uses; limits by rank reach the map side."""
    strange = known(rows.where(F.trim(value) != ""), value, vocab, field).where("NOT known").select(F.trim(value).alias("term"), F.col(order).alias("_at"))
    counts = strange.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = strange.withColumn("_r", F.row_number().over(W.partitionBy("term").orderBy("_at"))).where(F.col("_r") <= first)
    uses = ranked.groupBy("term").agg(F.array_join(F.array_sort(F.collect_list("_at")).cast("array<string>"), ",").alias("uses"))
    return counts.join(uses, "term")
