"""What a run would cost: prices and recipes are tables, costs are columns, recipes are ranked by sorts.

prices: model, input, cached, output (USD a million tokens), batch_mult, cached_batch_mult (null: the two discounts multiply),
quality (1 to 4). components: one row of token counts (sys_extract, sys_normalize, instructions, shot_avg, n_shots, entry_in,
entry_out, norm_in, norm_out, transcription_out) and entries_per_image. scenarios: model, trans_model, shots, cached, batch,
vendor_batch, normalize (separate, folded or none). All are small parameter tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Tokens that frame an entry, tokens of a page's image and of its instruction, images of a volume.
FRAME, IMAGE_TOKENS, IMAGE_PROMPT, IMAGES = 20, 1290, 400, 300
#: What keeps quality up when recipes are recommended.
KEEPS = {"folded": 2, "separate": 1, "none": 0}


def _rates(side: str, cached: Column, vendor: Column) -> tuple[Column, Column, Column]:
    """Input, cached input and output price with the discounts that apply."""
    p = lambda c: F.col(f"{side}.{c}")
    base = F.when(vendor, p("input") * p("batch_mult")).otherwise(p("input"))
    stacked = p("input") * F.coalesce(p("cached_batch_mult"), p("cached") / p("input") * p("batch_mult"))
    return base, F.when(vendor & cached, stacked).when(cached, p("cached")).otherwise(base), F.when(vendor, p("output") * p("batch_mult")).otherwise(p("output"))


def scenario_costs(scenarios: DataFrame, prices: DataFrame, components: DataFrame, images: int = IMAGES) -> DataFrame:
    """scenarios with transcription, normalization, extraction, total and transcription_plus_normalization a page."""
    s, m, t, c = scenarios.alias("s"), F.broadcast(prices).alias("m"), F.broadcast(prices).alias("t"), F.broadcast(components).alias("c")
    rows = s.join(m, F.col("s.model") == F.col("m.model")).join(t, F.col("s.trans_model") == F.col("t.model")).join(c, F.lit(True))
    cached, vendor, batch = F.col("s.cached"), F.col("s.vendor_batch"), F.col("s.batch")
    entries = F.col("c.entries_per_image") * images
    calls = F.ceil(entries / F.greatest(F.lit(1), batch))
    rate, again, out = _rates("m", cached, vendor)

    def one_pass(system: str, given: str, said: str) -> Column:
        prefix = F.col(f"c.{system}") + F.col("c.instructions") + F.col("s.shots") * F.col("c.shot_avg")
        shared = F.when(cached, prefix * rate + (calls - 1) * prefix * again).otherwise(calls * prefix * rate) / 1e6
        own = entries * (F.col(f"c.{given}") + FRAME) * rate / 1e6 + calls * FRAME * batch * rate / 1e6
        return shared + own + entries * F.col(f"c.{said}") * out / 1e6

    extraction = one_pass("sys_extract", "entry_in", "entry_out")
    normalization = F.when(F.col("s.normalize") == "separate", one_pass("sys_normalize", "norm_in", "norm_out")).when(F.col("s.normalize") == "folded", entries * F.col("c.norm_out") * out / 1e6).otherwise(0.0)
    t_in, _, t_out = _rates("t", F.lit(False), vendor)
    transcription = ((IMAGE_TOKENS + IMAGE_PROMPT) * t_in + F.col("c.transcription_out") * t_out) / 1e6 * images
    rows = rows.select("s.*", F.col("m.quality").alias("quality"), transcription.alias("_t"), normalization.alias("_n"), extraction.alias("_e"))
    page = lambda x, name: F.round(x / images, 5).alias(name)
    kept = [x for x in rows.columns if not x.startswith("_")]
    total, both = F.col("_e") + F.col("_n") + F.col("_t"), F.col("_t") + F.col("_n")
    return rows.select(*kept, page(F.col("_t"), "transcription"), page(F.col("_n"), "normalization"), page(F.col("_e"), "extraction"), page(total, "total"), page(both, "transcription_plus_normalization"))


def recipes(models: DataFrame, trans_models: DataFrame, shots: tuple[int, ...], batches: tuple[int, ...] = (1, 5, 10, 20), normalize: tuple[str, ...] = ("separate", "folded", "none")) -> DataFrame:
    """Every combination of the levers; models and trans_models: one column of names each."""
    spread = lambda df, name, values: df.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    rows = models.select("model").join(F.broadcast(trans_models.select(F.col("model").alias("trans_model"))), F.lit(True))
    for name, values in (("shots", shots), ("cached", (True, False)), ("vendor_batch", (True, False)), ("batch", batches), ("normalize", normalize)):
        rows = spread(rows, name, values)
    return rows


def _preference() -> Column:
    keep = F.create_map(*[F.lit(x) for pair in KEEPS.items() for x in pair])[F.col("normalize")]
    return keep + F.when(F.col("cached"), 2).otherwise(0) + F.when(F.col("batch") >= 10, 1).otherwise(0) + F.coalesce("quality", F.lit(0))


ORDER = ("model", "trans_model", "shots", "cached", "vendor_batch", "batch", "normalize")


def within_target(costs: DataFrame, target: float = 0.01, metric: str = "transcription_plus_normalization") -> DataFrame:
    """Recipes that meet the target, cheapest first (rank), and the one that is recommended: the best by quality, then the cheapest."""
    meeting = costs.where(F.col(metric) <= target)
    ranked = meeting.withColumn("rank", F.row_number().over(W.orderBy(metric, *ORDER)))
    best = F.row_number().over(W.orderBy(_preference().desc(), metric, *ORDER)) == 1
    return ranked.withColumn("recommended", best)


def best_quality(costs: DataFrame, budget: float = 0.01, metric: str = "total") -> DataFrame:
    """The recipe of best quality within the budget, then the cheapest; if none is within, the best and cheapest beyond, marked over_budget."""
    fits = F.col(metric) <= budget
    return costs.withColumn("over_budget", ~fits).orderBy(F.col("over_budget"), F.desc("quality"), metric, *ORDER).limit(1)


def waterfall(steps: DataFrame) -> DataFrame:
    """Costs of steps (pos, label and a scenario's costs) in order, with what each saves."""
    return steps.select("pos", "label", F.col("transcription_plus_normalization").alias("trans_norm"), "total", F.round(F.lag("total").over(W.orderBy("pos")) - F.col("total"), 5).alias("saved"))


def corpus_total(costs: DataFrame, images: int) -> DataFrame:
    return costs.withColumn("corpus_usd", F.round(F.col("total") * images, 2))


def measured_components(entries: DataFrame, examples: DataFrame, prompts: dict[str, int], transcription_out: int) -> DataFrame:
    """The one row of components, from entries (page, raw, normalized, data) and examples (normalized, data) by estimated tokens."""
    from ..functions.text import token_estimate

    n = lambda c: F.bround(F.avg(token_estimate(F.col(c)))).cast("bigint")
    e = entries.agg(n("normalized").alias("entry_in"), n("data").alias("entry_out"), n("raw").alias("norm_in"), F.round(F.count(F.lit(1)) / F.countDistinct("page"), 2).alias("entries_per_image"))
    x = examples.agg(F.floor(F.avg(token_estimate(F.col("normalized")) + token_estimate(F.col("data")))).alias("shot_avg"), F.count(F.lit(1)).alias("n_shots"))
    given = [F.lit(v).cast("bigint").alias(k) for k, v in prompts.items()]
    return e.join(x, F.lit(True)).select("*", F.col("entry_in").alias("norm_out"), F.lit(transcription_out).cast("bigint").alias("transcription_out"), *given)


def run_costs(calls: DataFrame, price_in: float, price_out: float, cap: float) -> DataFrame:
    """Spent dollars after each call (pos, custom_id, prompt_tokens, completion_tokens), up to the one that reaches the cap, and cost an entry and a page."""
    usd = F.round((F.col("prompt_tokens") * price_in + F.col("completion_tokens") * price_out) / 1e6, 9)
    w = W.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return calls.withColumn("usd", usd).withColumn("spent", F.round(F.sum(usd.cast("decimal(20,9)")).over(w).cast("double"), 9)).where(F.col("spent") - F.col("usd") < cap)
