"""Repair of extracted records: from a model's JSON text to complete people, events and relations, with a reason for all that goes.

A record is read once into nested columns by a permissive schema and repaired by higher-order
functions, so that it never leaves its row; each step adds what it found wrong to ``problems``
(array of kind and message). Reciprocity looks at one entry's people together and is a fold over the
entry's few relations.

Fixed values below are names of properties, in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import PRINCIPALS, RECIPROCAL

# Properties of a person that may be null, of all people, and of events.
NULLABLE = ("rank", "origin", "ethnicity", "age", "legitimate", "occupation", "phenotype", "free")
PERSON = ("id", "name", "titles", *NULLABLE, "relationships")
EVENT = ("type", "principals", "date", "witnesses")
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
#: The same as JSON writes them; a backslash before makes it text.
ESCAPED_CONTROL = r"(?<!\\)\\u00(0[0-8bBcCeEfF]|1[0-9a-fA-F]|7[fF])"

VALUES = "map<string,string>"
RELATION = "struct<related_person:string,relationship_type:string>"
PEOPLE = "array<struct<id:string,name:string,titles:array<string>,{}:string,relationships:array<{}>>>".format(":string,".join(NULLABLE), RELATION)
EVENTS = "array<struct<type:string,principals:array<string>,date:string,witnesses:array<string>>>"
PROBLEMS = "array<struct<kind:string,message:string>>"


def without_control(text: Column) -> Column:
    """Text without control characters, written out or as JSON escapes; tabs and line ends stay."""
    return F.regexp_replace(F.regexp_replace(text, CONTROL, ""), ESCAPED_CONTROL, "")


def parsed(rows: DataFrame, text: str) -> DataFrame:
    """Add ``_people`` and ``_events`` (arrays of maps of raw JSON values) and problems; a record that is no JSON, or has no people, has null people.

    Values keep their JSON text: strings quoted, lists in brackets, which tells types apart.
    """
    clean = without_control(F.col(text))
    as_json = F.try_parse_json(clean)
    people = F.try_variant_get(as_json, "$.people", "array<variant>")
    events = F.try_variant_get(as_json, "$.events", "array<variant>")
    maps = lambda array: F.transform(array, lambda v: F.from_json(F.to_json(v), VALUES))
    invalid = F.when(as_json.isNull(), "Invalid json").when(people.isNull(), "Invalid json: missing 'people'")
    one = lambda kind, message: F.when(message.isNotNull(), F.array(F.struct(F.lit(kind).alias("kind"), message.alias("message")))).otherwise(F.array().cast(PROBLEMS))
    return rows.withColumns({"_people": maps(people), "_events": F.coalesce(maps(events), F.array().cast(f"array<{VALUES}>")), "problems": one("json", invalid)})


def _problems(array: Column, kind: str, message) -> Column:
    """A problem for each element that ``message`` has one for."""
    said = F.filter(F.transform(array, message), lambda m: m.isNotNull())
    return F.coalesce(F.transform(said, lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("message"))), F.array().cast(PROBLEMS))


def _is_list(value: Column) -> Column:
    return F.coalesce(value.startswith("["), F.lit(False))


def _strings(value: Column) -> Column:
    """The strings of a JSON list; of anything else, its text in a list of one."""
    return F.when(_is_list(value), F.from_json(value, "array<string>")).when(value.isNotNull(), F.array(value))


def _has(m: Column, key: str) -> Column:
    return F.map_contains_key(m, key)


def _join(*problems: Column) -> Column:
    return F.concat(F.col("problems"), *problems)


def valid_people(rows: DataFrame) -> DataFrame:
    """People without an id or a name go."""
    whole = lambda p: _has(p, "id") & _has(p, "name")
    lost = _problems(F.col("_people"), "people", lambda p: F.when(~whole(p), F.lit("Missing 'name' or 'id' property")))
    return rows.withColumns({"problems": _join(lost), "_people": F.filter("_people", whole)})


def valid_events(rows: DataFrame) -> DataFrame:
    """Events without a type or principals go, and principals that are nobody of the record."""
    ids = F.transform("_people", lambda p: p["id"])
    reason = lambda e: F.when(~_has(e, "type"), F.lit("Missing 'type' property")).when(~_has(e, "principals"), F.lit("Missing 'principals' property"))
    kept = F.filter("_events", lambda e: reason(e).isNull())
    known = lambda e: F.filter(_strings(e["principals"]), lambda x: F.array_contains(ids, x))
    strange = F.flatten(F.transform(kept, lambda e: F.when(_is_list(e["principals"]), F.array_except(_strings(e["principals"]), ids)).otherwise(F.array().cast("array<string>"))))
    put = lambda e: F.when(_is_list(e["principals"]), F.map_concat(F.map_filter(e, lambda k, _: k != "principals"), F.create_map(F.lit("principals"), F.to_json(known(e))))).otherwise(e)
    lost = _problems(F.col("_events"), "events", reason)
    bad = _problems(strange, "events", lambda x: F.concat(F.lit("Invalid principal: "), x))
    return rows.withColumns({"problems": _join(lost, bad), "_events": F.transform(kept, put)})


def relation_reason(r: Column, ids: Column, allowed: tuple[str, ...] = tuple(RECIPROCAL)) -> Column:
    """Why a relation (a map of its properties) is not valid: the first that holds; null if it is."""
    kind, other = r["relationship_type"], r["related_person"]
    return (
        F.when(~_has(r, "related_person"), F.lit("missing related person")).when(~_has(r, "relationship_type"), F.lit("missing relationship type"))
        .when(~F.coalesce(kind.isin(*allowed), F.lit(False)), F.concat(F.lit("invalid relationship type "), F.coalesce(kind, F.lit("null"))))
        .when(~F.coalesce(F.array_contains(ids, other), F.lit(False)), F.concat(F.lit("invalid related person "), F.coalesce(other, F.lit("null"))))
        .when(F.size(F.map_keys(r)) > 2, F.concat(F.lit("unexpected relationship properties: "), F.array_join(F.array_sort(F.map_keys(r)), ", ")))
    )


def filled(rows: DataFrame) -> DataFrame:
    """``people`` and ``events`` with every property: lists become their first string, what is unexpected goes, and so do events with a wrong number of principals."""
    ids = F.transform("_people", lambda p: p["id"])
    listed = lambda p: F.try_variant_get(F.try_parse_json(p["relationships"]), "$", "array<variant>")
    relations = lambda p: F.filter(F.transform(listed(p), lambda v: F.from_json(F.to_json(v), VALUES)), lambda r: r.isNotNull())
    has_relations = lambda p: _has(p, "relationships") & _is_list(p["relationships"])
    empty = F.array().cast(f"array<{RELATION}>")
    good = lambda p: F.transform(F.filter(relations(p), lambda r: relation_reason(r, ids).isNull()), lambda r: F.struct(r["related_person"].alias("related_person"), r["relationship_type"].alias("relationship_type")))
    scalar = lambda p, k: F.when(_is_list(p[k]), F.get(F.filter(F.from_json(p[k], "array<string>"), lambda x: ~x.rlike(r"^(-?[0-9.]+|true|false|\{.*|\[.*)$")), F.lit(0))).otherwise(p[k])
    titles = lambda p: F.coalesce(_strings(p["titles"]), F.array().cast("array<string>"))
    person = lambda p: F.struct(
        p["id"].alias("id"), p["name"].alias("name"), titles(p).alias("titles"), *[scalar(p, k).alias(k) for k in NULLABLE],
        F.when(has_relations(p), good(p)).otherwise(empty).alias("relationships"),
    )
    unexpected = lambda k: lambda p: F.when(_is_list(p[k]), F.concat(F.lit("Unexpected list property type for "), p["id"], F.lit(f": {k}")))
    lists = [_problems(F.col("_people"), "people", unexpected(k)) for k in NULLABLE]
    title_problem = _problems(F.col("_people"), "people", lambda p: F.when(p["titles"].isNotNull() & ~_is_list(p["titles"]), F.concat(F.lit("Titles of "), p["id"], F.lit(" must be a list"))))
    shape = _problems(F.col("_people"), "relationships", lambda p: F.when(p["relationships"].isNotNull() & ~_is_list(p["relationships"]), F.concat(F.lit("Relationships of "), p["id"], F.lit(" must be a list"))))
    wrong = _problems(
        F.flatten(F.transform(F.filter("_people", has_relations), lambda p: F.transform(F.filter(relations(p), lambda r: relation_reason(r, ids).isNotNull()), lambda r: F.concat(F.lit("Invalid relationship for "), p["id"], F.lit(": "), relation_reason(r, ids))))),
        "relationship", lambda m: m,
    )
    extra = lambda array, allowed: F.flatten(F.transform(array, lambda m: F.filter(F.map_keys(m), lambda k: ~k.isin(*allowed))))
    stray = _problems(extra(F.col("_people"), PERSON), "people", lambda k: F.concat(F.lit("Invalid property for person: "), k))
    stray_event = _problems(extra(F.col("_events"), EVENT), "events", lambda k: F.concat(F.lit("Invalid event property: "), k))
    text = lambda v: F.when(v.rlike(r"^(-?[0-9.]+|true|false|\{.*|\[.*)$") & ~v.rlike(r"^[0-9]{3,4}$"), F.lit(None)).otherwise(v)
    event = lambda e: F.struct(e["type"].alias("type"), F.coalesce(_strings(e["principals"]), F.array().cast("array<string>")).alias("principals"), text(e["date"]).alias("date"), F.coalesce(_strings(e["witnesses"]), F.array().cast("array<string>")).alias("witnesses"))
    events = F.transform("_events", event)
    need = F.create_map(*[F.lit(x) for pair in PRINCIPALS.items() for x in pair])
    off = lambda e: F.coalesce(need[e["type"]] != F.size(e["principals"]), F.lit(False))
    arity = _problems(events, "events", lambda e: F.when(off(e), F.concat(F.lit("Invalid event principals: "), e["type"], F.lit(" has "), F.size(e["principals"]).cast("string"))))
    out = rows.withColumns({"problems": _join(*lists, title_problem, shape, wrong, stray, stray_event, arity), "people": F.transform("_people", person), "events": F.filter(events, lambda e: ~off(e))})
    return out.withColumn("valid", F.size("problems") == 0).drop("_people", "_events")


def repaired(rows: DataFrame, text: str) -> DataFrame:
    """rows with people, events, problems and valid, from a model's JSON in ``text``; null people where it is no record."""
    return filled(valid_events(valid_people(parsed(rows, text))))


def reciprocal_relations(relations: list[tuple[str, str, str]], ids: list[str], principals: set[str]) -> tuple[list[tuple[str, str, str]], list[str]]:
    """Relations (person, other, type) of one entry made reciprocal, and what was changed.

    A missing way back is added. If both ways have the same type that is not its own counterpart, the principal is taken for the
    child, slave or godchild side; if neither is a principal, or the types disagree otherwise, both ways go.
    """
    held: dict[str, dict[str, str]] = {i: {} for i in ids}
    for a, b, kind in relations:
        if a in held and b and kind:
            held[a][b] = kind
    shown = {i: [(b, k) for a, b, k in relations if a == i] for i in ids}
    changes: list[str] = []

    def drop(a: str, b: str) -> None:
        if a in shown:
            shown[a] = [x for x in shown[a] if x[0] != b]

    def put(a: str, b: str, kind: str) -> None:
        if a in shown:
            drop(a, b)
            shown[a].append((b, kind))

    for a in list(held):
        for b, kind in list(held[a].items()):
            counterpart, back = RECIPROCAL.get(kind), held.get(b, {}).get(a)
            if counterpart is None or back == counterpart:
                continue
            if back is None:
                changes.append(f"added {counterpart} {b}->{a}")
                put(b, a, counterpart)
                held.setdefault(b, {})[a] = counterpart
            elif back != kind or not {a, b} & principals:
                changes.append(f"dropped {a}<->{b} ({kind}/{back})")
                for x, y in ((a, b), (b, a)):
                    drop(x, y)
                    held.get(x, {}).pop(y, None)
            else:
                one, other = (a, b) if a in principals else (b, a)
                changes.append(f"turned {one}/{other} ({kind})")
                mine, theirs = (counterpart, kind) if kind in ("child", "slave", "godchild") else (kind, counterpart)
                put(one, other, mine)
                put(other, one, theirs)
    return [(a, b, k) for a in ids for b, k in shown[a]], changes


def reciprocal(people: DataFrame, relations: DataFrame, principals: DataFrame) -> DataFrame:
    """volume, entry, relations (id, related_person, relationship_type) and changes, an entry a row; an entry's few rows travel as arrays."""
    key = ["volume", "entry"]
    order = lambda c, *fields: F.transform(F.array_sort(F.collect_list(F.struct(*fields))), lambda x: x[c])
    p = people.groupBy(*key).agg(order("id", "pos", "id").alias("ids"))
    r = relations.join(people.select(*key, "id", F.col("pos").alias("_p")), [*key, "id"]).groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_p", "pos", "id", "related_person", "relationship_type"))), lambda x: F.struct(x["id"].alias("a"), x["related_person"].alias("b"), x["relationship_type"].alias("t"))).alias("links")
    )
    q = principals.groupBy(*key).agg(F.collect_set("id").alias("heads"))
    rows = p.join(r, key, "left").join(q, key, "left")
    kind = people.schema["volume"].dataType.simpleString()

    def fix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = [[(x["a"], x["b"], x["t"]) for x in v] if v is not None else [] for v in batch["links"]]
            heads = [set(v) if v is not None else set() for v in batch["heads"]]
            found = [reciprocal_relations(x, list(ids), h) for x, ids, h in zip(links, batch["ids"], heads, strict=True)]
            fixed = [[{"id": a, "related_person": b, "relationship_type": t} for a, b, t in f[0]] for f in found]
            yield pd.DataFrame({"volume": batch["volume"], "entry": batch["entry"], "relations": fixed, "changes": [f[1] for f in found]})

    return rows.mapInPandas(fix, f"volume {kind}, entry string, relations array<struct<id:string,related_person:string,relationship_type:string>>, changes array<string>")
