"""URL filters: host rules first, then a path-template tree judged by labelled purity.

Paths become segments. Per host, number of segments, place and first segment, a place whose values
hardly repeat becomes a wildcard. Sibling branches, templates alike but for their segment at one
place, merge into their parent unless their share of bad labels differs from the siblings' pooled
share by more than ``Z`` standard errors, level by level from the last place to the first: every place but
the last segment in `op1_url_filters`, last segments too in `op1_url_filters_by_level`. A template is
rejected if its share of good labels, smoothed towards its host's and the whole table's share, is below ``PURITY``.

Defined cases: a null url, or one without ``://``, has an empty host and path and the template of
an empty path; repeated urls share host, path and verdict; without labels every template has the
prior of a good one; a null page_id is kept; an empty table gives an empty result; extra columns
are ignored. All grouping starts from distinct (host, path) pairs with counts, so that a hot host
or url is summed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage_table, table

#: (verdict, rule): a host and a path prefix.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: A place is variable with so many values, each seen less often than REPEAT times on average.
DISTINCT, REPEAT, Z, PRIOR, PURITY = 8, 4.0, 1.96, 4.0, 0.75
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url by the first `://`; both empty without one."""
    pattern = r"://([^/?#]*)([^?#]*)"
    held = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(held, pattern, 1), UPPER, LOWER), F.regexp_extract(held, pattern, 2)


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits, else null; a rule fits its host and all subdomains by path prefix."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def templates(counted: DataFrame) -> DataFrame:
    """host, path -> template, from distinct pairs with a count ``n``."""
    placed = counted.withColumn("segs", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("k", F.size("segs"))
    segs = placed.select(
        "host", "path", "n", "k", F.when(F.col("k") > 0, F.get("segs", F.lit(0))).otherwise("").alias("head"), F.posexplode_outer("segs").alias("at", "seg")
    ).withColumn("context", F.when(F.col("at") > 0, F.col("head")).otherwise(F.lit("")))
    place = ["host", "k", "at", "context"]
    variable = (
        segs.where("seg IS NOT NULL").groupBy(*place, "seg").agg(F.sum("n").alias("c"))
        .groupBy(*place).agg(F.count(F.lit(1)).alias("values"), F.sum("c").alias("rows"))
        .where((F.col("values") >= DISTINCT) & (F.col("rows") < REPEAT * F.col("values")))
        .select(*[F.col(c).alias(f"_{c}") for c in place])
    )
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "host" else F.col(c) == F.col(f"_{c}") for c in place]
    return (
        segs.join(variable, on, "left")
        .withColumn("token", F.when(F.col("_k").isNotNull(), F.lit("*")).otherwise(F.col("seg")))
        .groupBy("host", "path", "n")
        .agg(F.concat(F.lit("/"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("at", "token")))), lambda s: s["token"]), "/")).alias("template"))
    )


def differs(m: Column, b: Column, pm: Column, pb: Column) -> Column:
    """Whether the share b / m of bad labels is more than ``Z`` standard errors from the siblings' pb / pm."""
    p = F.try_divide(pb.cast("double"), pm.cast("double"))
    gap = F.try_divide(b.cast("double"), m.cast("double")) - p
    return ~F.coalesce((m == 0) | (gap * gap * m <= Z * Z * p * (1 - p)), F.lit(True))


def merged_once(leaves: DataFrame) -> DataFrame:
    """host, template, m, b, merged: the first literal segment that is not last, once, as the SQL says."""
    by = leaves.groupBy("host", "template").agg(F.sum("labelled").alias("m"), F.sum("bad").alias("b"))
    by = by.withColumn("parent", F.regexp_replace("template", r"^(/(?:\*/)*)[^*/]+(?=/)", "$1*"))
    pooled = by.groupBy("host", "parent").agg(F.sum("m").alias("pm"), F.sum("b").alias("pb"))
    apart = differs(F.col("m"), F.col("b"), F.col("pm"), F.col("pb"))
    return by.join(pooled, ["host", "parent"]).withColumn("merged", F.when(apart, F.col("template")).otherwise(F.col("parent"))).select("host", "template", "m", "b", "merged")


def merged_by_level(leaves: DataFrame, last: bool = True) -> DataFrame:
    """host, template, m, b, merged: every place from the last to the first, each on what the one before left.

    Siblings are alike but for their segment at the place. ``last``: whether last segments merge too. Each level is
    written, so that a plan holds one level, however long a path is. A place where no two templates of a host part
    has no siblings to compare: its segments merge as they are, so that levels follow the forks and not the depth.
    """
    by = leaves.groupBy("host", "template").agg(F.sum("labelled").alias("m"), F.sum("bad").alias("b"))
    state = stage_table(by.withColumn("now", F.filter(F.split("template", "/"), lambda s: s != "")))
    free = lambda s, i: ~F.contains(s, F.lit("*")) & (i < F.size("now") - F.lit(0 if last else 1))
    # equal hashes of different beginnings only add a level
    begun = F.transform("now", lambda s, i: F.struct(F.when(free(s, i), s).alias("seg"), F.xxhash64(F.slice("now", F.lit(1), i)).alias("begin")))
    placed = state.select("host", F.size("now").alias("k"), F.posexplode(begun).alias("at", "node")).select("host", "k", "at", "node.*")
    parts_at = placed.where("seg IS NOT NULL").groupBy("host", "k", "at", "begin").agg(F.min("seg").alias("low"), F.max("seg").alias("high")).where("low <> high")
    forks = sorted((r["at"] for r in parts_at.select("at").distinct().collect()), reverse=True)
    lone = lambda after: F.transform("now", lambda s, i: F.when((i > after) & ~i.isin(forks) & free(s, i), F.lit("*")).otherwise(s))
    for place in forks:
        state = state.withColumn("now", lone(place))
        at = F.get("now", F.lit(place))
        nodes = state.where(F.coalesce(free(at, F.lit(place)), F.lit(False))).groupBy("host", "now").agg(F.sum("m").alias("nm"), F.sum("b").alias("nb"))
        nodes = nodes.withColumn("parent", F.transform("now", lambda s, i: F.when(i == place, "*").otherwise(s)))  # noqa: B023
        pooled = nodes.groupBy("host", "parent").agg(F.sum("nm").alias("pm"), F.sum("nb").alias("pb"))
        moved = nodes.join(pooled, ["host", "parent"]).where(~differs(F.col("nm"), F.col("nb"), F.col("pm"), F.col("pb"))).select("host", "now", "parent")
        state = stage_table(state.join(moved, ["host", "now"], "left").select("host", "template", "m", "b", F.coalesce("parent", "now").alias("now")))
    return state.select("host", "template", "m", "b", F.concat(F.lit("/"), F.array_join(lone(-1), "/")).alias("merged"))


def merged_branches(leaves: DataFrame) -> DataFrame:
    """host, template, m, b, merged: the branches of the tree level by level; last segments are left to the wildcards."""
    return merged_by_level(leaves, last=False)


def judged_templates(leaves: DataFrame, merging: Callable[[DataFrame], DataFrame] = merged_once) -> DataFrame:
    """template -> merged template, purity and verdict; ``leaves``: host, template, labelled, bad."""
    by = merging(leaves)
    merged = by.groupBy("host", "merged").agg(F.sum("m").alias("mm"), F.sum("b").alias("mb"))
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("hm"), F.sum("bad").alias("hb"))
    every = leaves.groupBy(F.lit(0).alias("_one")).agg(F.sum("labelled").alias("am"), F.sum("bad").alias("ab"))
    smooth = lambda good, n, prior: (good + PRIOR * prior) / (n + PRIOR)
    base = smooth(F.col("am") - F.col("ab"), F.col("am"), F.lit(1.0))
    host = smooth(F.col("hm") - F.col("hb"), F.col("hm"), base)
    verdicts = (
        merged.join(hosts, "host").withColumn("_one", F.lit(0)).join(every, "_one")
        .withColumn("purity", smooth(F.col("mm") - F.col("mb"), F.col("mm"), host))
        .select(F.col("host").alias("_h"), F.col("merged").alias("_m"), "purity")
    )
    return by.select("host", "template", "merged").join(verdicts, (F.col("host") == F.col("_h")) & (F.col("merged") == F.col("_m"))).select("host", "template", "merged", "purity")


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, merging: Callable[[DataFrame], DataFrame] = merged_once) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity. ``labels``: url, bad (0 or 1), a row for each labelled url."""
    def split_up(df: DataFrame) -> DataFrame:
        host, path = parts(F.col("url"))
        return df.withColumn("host", host).withColumn("path", path)

    rows = split_up(pages.select("page_id", "url")).select("page_id", "host", "path")
    marks = split_up(labels.select("url", "bad")).groupBy("host", "path").agg(F.count("bad").alias("labelled"), F.sum("bad").alias("bad"))
    named = templates(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))
    leaves = named.join(marks, ["host", "path"], "left").na.fill(0, ["labelled", "bad"])
    by_path = leaves.join(judged_templates(leaves, merging), ["host", "template"]).select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("merged").alias("template"), "purity")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    said = F.create_map(*[F.lit(x) for verdict, name in rules for x in (name, verdict)])
    return (
        rows.join(by_path, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")))
        .withColumn("rule", rule)
        .withColumn("verdict", F.coalesce(F.element_at(said, F.col("rule")), F.when(F.col("purity") < PURITY, F.lit("block")).otherwise(F.lit("allow"))))
        .select("page_id", "host", "path", "rule", "verdict", "template", "purity")
    )


def labelled_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages, and the labels of their urls: a page's label is that of the document its path ends in; bad is low quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    _, path = parts(F.col("url"))
    marked = pages.withColumn("_doc", F.regexp_extract(path, r"/([0-9]{1,18})[^/0-9]*$", 1).try_cast("bigint")).where("_doc IS NOT NULL")
    return pages, marked.join(labels, F.col("_doc") == F.col("doc_id")).select("url", "bad")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches merge at every level; equal to its SQL, which merges once, on paths of up to two segments."""
    return judge(*labelled_pages(spark, sf_dir), merging=merged_branches)


def op1_url_filters_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates merge level by level from the last segment up."""
    return judge(*labelled_pages(spark, sf_dir), merging=merged_by_level)


def _sql_rule() -> str:
    cases = []
    for _, rule in sorted(RULES, key=lambda r: -len(r[1])):
        name, _, prefix = rule.partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{prefix}') THEN '{rule}'")
    return "CASE " + " ".join(cases) + " END"


_SAID = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in RULES) + " END"
ORACLE = f"""
WITH r AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
mk AS (SELECT host, path, count(bad) AS labelled, sum(bad) AS bad FROM r JOIN l ON try_cast(regexp_extract(path, '/([0-9]{{1,18}})[^/0-9]*$', 1) AS BIGINT) = l.doc_id GROUP BY host, path),
c AS (SELECT host, path, count(*) AS n, list_filter(string_split(path, '/'), lambda s: s <> '') AS segs FROM r GROUP BY host, path),
s AS (SELECT host, path, n, len(segs) AS k, pos, segs[pos] AS seg, CASE WHEN pos > 1 THEN segs[1] ELSE '' END AS context FROM (SELECT *, unnest(generate_series(1, len(segs))) AS pos FROM c)),
v AS (SELECT host, k, pos, context FROM (SELECT host, k, pos, context, seg, sum(n) AS c FROM s GROUP BY ALL) GROUP BY host, k, pos, context HAVING count(*) >= {DISTINCT} AND sum(c) < {REPEAT} * count(*)),
tk AS (SELECT s.host, s.path, string_agg(CASE WHEN v.k IS NOT NULL THEN '*' ELSE seg END, '/' ORDER BY s.pos) AS body FROM s LEFT JOIN v ON s.host = v.host AND s.k = v.k AND s.pos = v.pos AND s.context = v.context GROUP BY s.host, s.path),
lf AS (SELECT c.host, c.path, '/' || coalesce(body, '') AS template, coalesce(labelled, 0) AS labelled, coalesce(bad, 0) AS bad FROM c LEFT JOIN tk USING (host, path) LEFT JOIN mk USING (host, path)),
b0 AS (SELECT host, template, sum(labelled) AS m, sum(bad) AS b, CASE WHEN regexp_matches(template, '^/(\\*/)*[^*/]+/') THEN regexp_replace(template, '^(/(?:\\*/)*)[^*/]+/', '\\1*/') ELSE template END AS parent FROM lf GROUP BY host, template),
b1 AS (SELECT *, sum(m) OVER g AS pm, sum(b) OVER g AS pb FROM b0 WINDOW g AS (PARTITION BY host, parent)),
b2 AS (SELECT *, CASE WHEN m = 0 OR (b / m - pb / pm) * (b / m - pb / pm) * m <= {Z} * {Z} * (pb / pm) * (1 - pb / pm) THEN parent ELSE template END AS merged
  FROM (SELECT host, template, parent, m::DOUBLE AS m, b::DOUBLE AS b, pm::DOUBLE AS pm, pb::DOUBLE AS pb FROM b1)),
pr AS (SELECT host, merged, sum(m) AS mm, sum(b) AS mb FROM b2 GROUP BY host, merged),
hs AS (SELECT host, sum(labelled)::DOUBLE AS hm, sum(bad)::DOUBLE AS hb FROM lf GROUP BY host),
al AS (SELECT sum(labelled)::DOUBLE AS am, sum(bad)::DOUBLE AS ab FROM lf),
pu AS (SELECT pr.host, merged, (mm - mb + {PRIOR} * ((hm - hb + {PRIOR} * ((am - ab + {PRIOR}) / (am + {PRIOR}))) / (hm + {PRIOR}))) / (mm + {PRIOR}) AS purity FROM pr JOIN hs USING (host), al),
o AS (SELECT page_id, r.host, r.path, {_sql_rule()} AS rule, pu.merged AS template, purity FROM r JOIN lf USING (host, path) JOIN b2 ON r.host = b2.host AND lf.template = b2.template JOIN pu ON pu.host = r.host AND pu.merged = b2.merged)
SELECT page_id, host, path, rule, coalesce({_SAID}, CASE WHEN purity < {PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template, purity FROM o
"""
