import pytest
from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe.functions import names as N


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_fold(spark):
    cases = {
        "  Côte d’Ivoire ": "COTE D'IVOIRE",
        " \tSão Tomé\n": "SAO TOME",
        "Straße": "STRASSE",
        "Œuvre – Æon": "OEUVRE - AEON",
        "Türkiye": "TURKIYE",
        "Łódź Ñandú": "LODZ NANDU",
        "plain": "PLAIN",
        "": "",
    }
    assert values(spark, list(cases) + [None], N.fold_name) == list(cases.values()) + [None]


def test_fold_with_combining_marks_and_rejects(spark):
    assert values(spark, ["Cotê"], N.fold_name) == ["COTE"]
    assert values(spark, ["日本", "Perú"], lambda c: N.has_unfolded(N.fold_name(c))) == [True, False]


def test_raw_alias_only_on_exact_raw_text(spark):
    out = values(spark, ["BOSNIA & HERZEGOVINA", "Bosnia & Herzegovina"], lambda c: N.fold_name(c, R.RAW_ALIASES))
    assert out == ["BOSNIA AND HERZEGOVINA", "BOSNIA & HERZEGOVINA"]


def test_split_orders(spark):
    text = ["Iran (x, y), Syria"]
    assert values(spark, text, N.split_names) == [["IRAN", "SYRIA"]]
    assert values(spark, text, lambda c: N.split_names(c, pre_split=True)) == [["IRAN (X", "Y)", "SYRIA"]]
    both = values(spark, ["Belize and Fiji, Palau"], lambda c: N.split_names(c, pre_split=True, and_as_comma=True))
    assert both == [["BELIZE", "FIJI", "PALAU"]]
    listed = values(spark, ["Laos, Côte d’Ivoire (x)"], lambda c: N.split_names(c, sep=", ", drop_parentheses=False))
    assert listed == [["LAOS", "COTE D'IVOIRE (X)"]]


def test_prefix_and_tokens(spark):
    cut = values(spark, ["Financial sanctions, Belarus", "x"], lambda c: N.after_last(c, "Financial sanctions,"))
    assert cut == ["Belarus", "x"]
    assert values(spark, ["SYRIA; DPRK  Burma", " ; "], N.program_tokens) == [["SYRIA", "DPRK", "BURMA"], []]


def test_slugs(spark):
    assert values(spark, ["CÔTE D'IVOIRE (X)", "A B"], N.slug_cpi) == ["cote-d'ivoire", "a-b"]
    out = values(spark, ["RUSSIE", "COREE DU NORD"], lambda c: N.slug_fr(c, R.FR_SLUGS))
    assert out[0].startswith("russie-en-lien") and out[1] == "coree-du-nord"


@pytest.mark.parametrize(
    "text, value, error",
    [
        ("43.7/100", 43, False), (" 43 / 100", 43, False), ("-3.9", -3, False), ("1e2", 100, False), ("1_0", 10, False),
        ("n/a", None, False), ("", None, False), (None, None, False), ("1.5d", None, False),
        ("nan", None, True), ("-inf/3", None, True), ("9e99", None, True),
    ],
)
def test_score(spark, text, value, error):
    assert tuple(values(spark, [text], N.parse_score)[0]) == (value, error)


def test_rank(spark):
    out = values(spark, ["12/180", "12.5", "x", "inf", None], N.parse_rank)
    assert [tuple(r) for r in out] == [(12, False), (None, True), (None, False), (None, True), (None, False)]


def test_latest_publication(spark):
    dates = ["2024-01-15", "2024-02-01", "2024-06-30", "2024-10-01"]
    keys = values(spark, dates, lambda c: N.latest_publication(c.cast("date")).getField("key"))
    assert keys == ["october-2023", "february-2024", "june-2024", "october-2024"]


def test_flag_comparison(spark):
    df = spark.createDataFrame([("YES", "yes"), (None, "NO"), (None, None)], "a string, b string")
    plain = [r[0] for r in df.select(N.flags_differ(F.col("a"), F.col("b"))).collect()]
    loose = [r[0] for r in df.select(N.flags_differ(N.flag_or_no(F.col("a")), F.col("b"), ignore_case=True)).collect()]
    assert plain == [True, True, False] and loose == [False, False, True]
