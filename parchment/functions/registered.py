"""The library's functions under SQL names, for one session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf

from . import lines
from .names import folded, tokens
from .similarity import pair_similarity


def register_functions(spark: SparkSession) -> None:
    """normalize_name, phonetic_key, name_similarity, seq_ratio, join_lines, classify_page, and the table function segment_page(image, text)."""
    from difflib import SequenceMatcher

    from ..operators.segmentation import cut

    def each(f, kind):
        @pandas_udf(kind)
        def of(x: pd.Series) -> pd.Series:
            return x.map(f)

        return of

    def pairs(f):
        @pandas_udf("double")
        def of(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series([f(a or "", b or "") for a, b in zip(x, y, strict=True)], dtype="float64")

        return of

    spark.udf.register("normalize_name", each(lambda s: " ".join(tokens(s or "")), "string"))
    spark.udf.register("phonetic_key", each(lambda s: folded(t[0]) if (t := tokens(s or "")) else "", "string"))
    spark.udf.register("name_similarity", pairs(pair_similarity))
    spark.udf.register("seq_ratio", pairs(lambda a, b: SequenceMatcher(None, a, b).ratio()))
    spark.udf.register("join_lines", each(lambda s: lines.flowed((s or "").splitlines()), "string"))
    spark.udf.register("classify_page", each(lambda s: lines.kind_of_page(s or ""), "string"))

    class SegmentPage:
        def eval(self, image: str, text: str):
            for n, entry in enumerate(cut(text or "")["entries"], 1):
                yield image, n, entry["text"], entry["partial"]

    spark.udtf.register("segment_page", udtf(SegmentPage, returnType="image string, n int, text string, partial boolean"))

