"""Near copies by the reference's ratio, over whole texts."""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import same_person

#: Rows of a group that one call compares, besides the few that follow them.
BLOCK = 64


def common_at_most(a: str, b: str, need: int) -> int:
    """Length of the longest common subsequence, which no sum of matching blocks exceeds; stops once it cannot reach ``need``."""
    places: dict[str, int] = {}
    back, zeros = b[::-1], dict.fromkeys(map(ord, b), "0")
    for c in set(a) & set(b):
        places[c] = int(back.translate(zeros | {ord(c): "1"}), 2)
    every = (1 << len(b)) - 1
    v = every
    for i, c in enumerate(a, 1):
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & every
        if i % 512 == 0 and len(b) - v.bit_count() + len(a) - i < need:
            return len(b) - v.bit_count() + len(a) - i
    return len(b) - v.bit_count()


def similar(a: str, b: str, count_a: Counter, count_b: Counter, least: float, autojunk: bool) -> float | None:
    """SequenceMatcher's ratio if it is ``least`` or more. Upper bounds come first; equal texts have 1."""
    if a == b:
        return 1.0
    reaches = lambda m: 2.0 * m / (len(a) + len(b)) >= least
    if not reaches((count_a & count_b).total()) or not reaches(common_at_most(a, b, int(least * (len(a) + len(b)) / 2))):
        return None
    ratio = SequenceMatcher(None, a, b, autojunk).ratio()
    return ratio if ratio >= least else None


def near_copies_by_ratio(rows: DataFrame, group: str, order: str, text: str, principal: str | None = None, ahead: int = 4, least: float = 0.75, gap: float = 0.35, autojunk: bool = True) -> DataFrame:
    """Pairs of a row and one of the next ``ahead`` rows of its group: group, order, other, sim, confidence.

    Lengths may differ by ``gap`` of the longer one, the ratio is ``least`` or more, and known
    principals must be one person's. ``autojunk`` is the reference's: from 200 characters on, one
    that is over 1 % of the second text starts no match. Only keys are numbered a group at a time; texts are dealt in
    blocks of ``BLOCK`` rows, so that a large group is many tasks. Rows of equal order go by text.
    """
    kept = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.col(text).alias("t"), (F.col(principal) if principal else F.lit(None)).cast("string").alias("p"))
    before = W.partitionBy("g").orderBy("o").rowsBetween(W.unboundedPreceding, -1)
    first = kept.groupBy("g", "o").agg(F.count(F.lit(1)).alias("_c")).select(F.col("g").alias("_g"), F.col("o").alias("_o"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_at"))
    numbered = (
        kept.withColumn("_i", F.row_number().over(W.partitionBy("g", "o").orderBy("t", "p")))
        .join(first, F.col("g").eqNullSafe(F.col("_g")) & F.col("o").eqNullSafe(F.col("_o")))
        .withColumn("n", F.col("_at") + F.col("_i") - 1)
    )
    block = BLOCK
    of = lambda n: F.floor(n / block)
    dealt = numbered.withColumn("block", F.explode(F.sequence(of(F.greatest(F.lit(0), F.col("n") - ahead)), of(F.col("n"))))).select("g", "block", "n", "o", "t", "p")
    kinds = kept.schema
    schema = T.StructType([T.StructField(group, kinds["g"].dataType), T.StructField(order, kinds["o"].dataType), T.StructField("other", kinds["o"].dataType), T.StructField("sim", T.DoubleType()), T.StructField("confidence", T.StringType())])

    def compare(part: pa.Table) -> pa.Table:
        part = part.sort_by("n")
        n, home, names = part["n"].to_pylist(), part["block"][0].as_py(), part["p"].to_pylist()
        texts = [re.sub(r"\s+", " ", t or "").strip().lower() for t in part["t"].to_pylist()]
        counts = [Counter(t) for t in texts]
        a, b, sims, says = [], [], [], []
        for i in (i for i, x in enumerate(n) if x // block == home and texts[i]):
            for j in range(i + 1, min(i + 1 + ahead, len(n))):
                x, y = len(texts[i]), len(texts[j])
                if not y or abs(x - y) > gap * max(x, y) or (same := same_person(names[i], names[j])) is False:
                    continue
                if (sim := similar(texts[i], texts[j], counts[i], counts[j], least, autojunk)) is not None:
                    a.append(i)
                    b.append(j)
                    sims.append(round(sim, 3))
                    says.append("confirmed" if same else "unconfirmed(no principal)")
        left, right = part.take(pa.array(a, pa.int64())), part.take(pa.array(b, pa.int64()))
        return pa.table([left["g"], left["o"], right["o"], pa.array(sims, pa.float64()), pa.array(says, pa.string())], names=[group, order, "other", "sim", "confidence"])

    return dealt.groupBy("g", "block").applyInArrow(compare, schema)
