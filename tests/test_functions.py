from pyspark.sql import functions as F

from parchment.functions import dates, text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_names_lose_accents_and_titles(spark):
    assert one(spark, text.normalize_name, "Fray Inácio da Ñuble") == "inacio da nuble"
    assert one(spark, text.normalize_name, None) == ""


def test_spellings_of_a_sound_share_a_key(spark):
    for a, b in (("Zoila", "Soila"), ("Chaves", "Chabez"), ("Gil", "Jil"), ("Llano", "Yano"), ("Hector", "Ektor")):
        assert one(spark, text.phonetic_key, a) == one(spark, text.phonetic_key, b)
    assert one(spark, text.phonetic_key, "") == ""


def test_page_types_put_failures_first(spark):
    assert one(spark, text.page_type, "| a\n" * 60 + "[transcription failed") == "error"
    assert one(spark, text.page_type, None) == "blank"
    assert one(spark, text.page_type, "\n".join(f"| a name of some length | f. {i}" for i in range(9))) == "index"
    assert one(spark, text.page_type, "en la villa de " * 20) == "register"


def test_partial_dates_complete_to_both_ends(spark):
    assert one(spark, lambda c: dates.completed(c, False), "1873-01") == "1873-01-01"
    assert one(spark, lambda c: dates.completed(c, True), "1873-01") == "1873-01-31"
    assert one(spark, lambda c: dates.completed(c, True), "1872-02") == "1872-02-28"


def test_impossible_dates_need_a_full_date(spark):
    assert one(spark, dates.impossible, "1873-13-01") is True
    assert one(spark, dates.impossible, "1872-02-29") is False
    assert one(spark, dates.impossible, "1873-02") is None


def test_token_estimate_rounds_half_even_and_counts_underscores_once(spark):
    assert one(spark, text.token_estimate, "abcdefghi jkl, a_very_long_name_indeed") == 2 + 1 + 1 + 1
