"""Quality checks of extracted records that need no gold: references, shapes, reciprocity, vocabulary, issue counts.

Tables as in resolution.py. Blank and missing values are alike; types are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates

# Each relation and the one that must lead back.
RECIPROCAL = {
    "parent": "child", "child": "parent", "grandparent": "grandchild", "grandchild": "grandparent", "enslaver": "slave", "slave": "enslaver",
    "indenturer": "indentured servant", "indentured servant": "indenturer", "spouse": "spouse", "godparent": "godchild", "godchild": "godparent",
    "patron": "client", "client": "patron", "custodian": "ward", "ward": "custodian", "executor": "testator", "testator": "executor",
    "heir": "benefactor", "benefactor": "heir", "caregiver": "dependent", "dependent": "caregiver", "former spouse": "former spouse", "witness": "witness",
}
#: Number of principals that an event of a type has.
PRINCIPALS = {"baptism": 1, "marriage": 2}
KEY = ["volume", "entry"]


def reciprocal_map():
    return F.create_map(*[F.lit(x) for pair in RECIPROCAL.items() for x in pair])


def principal_names(people: DataFrame, events: DataFrame, principals: DataFrame) -> DataFrame:
    """volume, entry, principal: the first principal of the first baptism or burial that has one; null if nobody has its id."""
    kinds = events.where(F.lower("type").isin("baptism", "burial")).select(*KEY, F.col("pos").alias("event"))
    first = principals.join(kinds, [*KEY, "event"]).groupBy(*KEY).agg(F.min_by("id", F.struct("event", "pos")).alias("id"))
    named = people.groupBy(*KEY, "id").agg(F.max_by("name", "pos").alias("principal"))
    return first.join(named, [*KEY, "id"], "left").select(*KEY, "principal")


def dangling_relations(people: DataFrame, relations: DataFrame) -> DataFrame:
    """Relations to an id that nobody of the entry has."""
    ids = people.select(*KEY, F.col("id").alias("related_person")).distinct()
    return relations.join(ids, [*KEY, "related_person"], "left_anti").select(*KEY, "id", "related_person")


def dangling_principals(people: DataFrame, events: DataFrame, principals: DataFrame) -> DataFrame:
    """Principals with an id that nobody of the entry has, with their event's type."""
    kinds = events.select(*KEY, F.col("pos").alias("event"), F.lower("type").alias("type"))
    return principals.join(people.select(*KEY, "id").distinct(), [*KEY, "id"], "left_anti").join(kinds, [*KEY, "event"], "left").select(*KEY, "event", "type", "id")


def nonreciprocal(people: DataFrame, relations: DataFrame) -> DataFrame:
    """Relations between people of the entry whose counterpart is missing or of another type; of several between two, the last counts."""
    ids = people.select(*KEY, F.col("id").alias("related_person")).distinct()
    last = relations.join(ids, [*KEY, "related_person"]).groupBy(*KEY, "id", "related_person").agg(F.max_by("relationship_type", "pos").alias("type"))
    back = last.select(*KEY, F.col("related_person").alias("id"), F.col("id").alias("related_person"), F.col("type").alias("back"))
    expected = last.withColumn("expected", reciprocal_map()[F.col("type")]).where("expected IS NOT NULL")
    return expected.join(back, [*KEY, "id", "related_person"], "left").where("NOT back <=> expected").select(*KEY, "id", "related_person", "type", "expected", "back")


def misshapen_events(events: DataFrame, principals: DataFrame) -> DataFrame:
    """Events whose type needs another number of principals."""
    n = principals.groupBy(*KEY, F.col("event").alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    need = F.create_map(*[F.lit(x) for pair in PRINCIPALS.items() for x in pair])[F.lower("type")]
    return events.join(n, [*KEY, "pos"], "left").withColumn("n", F.coalesce("n", F.lit(0))).where(need != F.col("n")).select(*KEY, "pos", F.lower("type").alias("type"), "n")


def without_people(entries: DataFrame, people: DataFrame) -> DataFrame:
    return entries.select(*KEY).join(people.select(*KEY).distinct(), KEY, "left_anti")


def strays(rows: DataFrame, field: str, known: DataFrame, first: int = 8) -> DataFrame:
    """field, value and n of the ``first`` values per volume that are not known (known: value, folded), by count and then value."""
    from pyspark.sql import Window as W

    counts = rows.where(F.trim(field) != "").groupBy("volume", F.trim(field).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    folded = F.lower("value")
    swapped = F.when(folded.endswith("a"), F.concat(F.expr("left(lower(value), length(value) - 1)"), F.lit("o"))).when(folded.endswith("o"), F.concat(F.expr("left(lower(value), length(value) - 1)"), F.lit("a")))
    k = known.select(F.col("value").alias("_k")).distinct()
    open_ = counts.withColumns({"_f": folded, "_s": swapped})
    open_ = open_.join(k, F.col("_f") == F.col("_k"), "left_anti").join(k, F.col("_s") == F.col("_k"), "left_anti")
    ranked = open_.withColumn("_r", F.row_number().over(W.partitionBy("volume").orderBy(F.desc("n"), "value"))).where(F.col("_r") <= first)
    return ranked.select("volume", F.lit(field).alias("field"), "value", "n")


def issues(entries: DataFrame, people: DataFrame, relations: DataFrame, events: DataFrame, principals: DataFrame, breaks: DataFrame | None = None, first_year: int = 1500, last_year: int = 1900) -> DataFrame:
    """type, volume, entry and detail of every issue; breaks: volume and entry of chronology breaks, found elsewhere."""
    of = lambda df, kind, *detail: df.select(F.lit(kind).alias("type"), *KEY, F.concat_ws("", *detail).alias("detail"))
    found = [
        of(events.where(dates.impossible(F.col("date"), first_year, last_year)), "impossible_date", F.col("type"), F.lit(" date "), F.col("date")),
        of(dangling_relations(people, relations), "dangling_relationship", F.col("id"), F.lit(" -> missing "), F.col("related_person")),
        of(dangling_principals(people, events, principals), "dangling_principal", F.col("type"), F.lit(" -> missing "), F.col("id")),
        of(misshapen_events(events, principals), "event_shape", F.col("type"), F.lit(" with "), F.col("n"), F.lit(" principals")),
        of(without_people(entries, people), "no_people", F.lit("entry has no people")),
    ]
    if breaks is not None:
        found.append(of(breaks, "chronology_break", F.lit("date before that of the entry before")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def primary_dates(events: DataFrame) -> DataFrame:
    """volume, entry, ord and date of the first event of an entry that is a baptism, marriage or burial and has a full date."""
    full = events.where(F.lower("type").isin("baptism", "marriage", "burial") & dates.ordinal(F.col("date")).isNotNull())
    return full.groupBy("volume", "entry", "ord").agg(F.min_by("date", "pos").alias("date"))


def issue_counts(found: DataFrame, *keys: str) -> DataFrame:
    """Issues by type, in each group of ``keys`` or over the whole corpus."""
    return found.groupBy(*keys, "type").agg(F.count(F.lit(1)).alias("issues"))
