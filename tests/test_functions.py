from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions import numeric as N
from access_lake.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()[0]


@pytest.mark.parametrize("raw,expected", [
    ("MURANG'A", "Murang'A"), ("elgeyo-marakwet", "Elgeyo-Marakwet"),
    ("tharaka - nithi", "Tharaka - Nithi"), ("nation_3", "Nation_3"), ("3rd ward", "3Rd Ward"),
    ("straße", "Straße"), ("ßa", "Ssa"), ("", ""),
])
def test_title_case_matches_python(spark, raw, expected):
    assert raw.title() == expected
    assert one(spark, T.title_case("v"), raw) == expected


def test_clean_str_strips_what_python_strips(spark):
    edges = [chr(c) for c in [*range(0x180), 0x1680, *range(0x2000, 0x2070), 0x3000, 0xfeff]]
    texts = [t for c in edges for t in (c + "a é" + c, c, f" {c}b", f"b{c}\n")]
    got = spark.createDataFrame([(t,) for t in texts], "v string").select(T.clean_str("v")).collect()
    assert [r[0] for r in got] == [t.strip() for t in texts]


def test_numbers_with_type_suffixes(spark):
    texts = ["12", "12d", "1.5F", "12d\n", " 7 ", "1e3", "é", "d", "", None, "1d5", "3.", "4.d", "Infinity", "-0"]
    got = spark.createDataFrame([(t,) for t in texts], "v string").select(N.safe_float("v", -1.0), N.safe_int("v", -1)).collect()
    assert [r[0] for r in got] == [12.0, -1.0, -1.0, -1.0, 7.0, 1000.0, -1.0, -1.0, -1.0, -1.0, -1.0, 3.0, -1.0, float("inf"), 0.0]
    assert [r[1] for r in got] == [12, -1, -1, -1, 7, 1000, -1, -1, -1, -1, -1, 3, -1, -1, 0]


def test_arrays_cut_at_quotes_are_those_of_the_parser(spark):
    texts = ['["a"]', '["a","b c"]', '["a", "b"]', '["a","","b"]', '["a",",","b"]', '["",""]', '[""]', '["]', '[]', '[ ]', '["a\\"b"]', '["a\\u0041"]',
             '["a\tb"]', '["a\x01b"]', '["a"]\n', ' ["a"]', '["a"', '["a""b"]', '["a",1,null]', '[["a"]]', '["é","日本"]', '["a","b"] x', '["a",]', '[","]', '["a|b"]']
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    parsed = F.coalesce(F.from_json("v", "array<string>", {"mode": "PERMISSIVE"}), F.array("v"))
    for row in df.select("v", T.as_array("v").alias("cut"), parsed.alias("parsed")).collect():
        assert row.cut == row.parsed, row.v


def test_clean_str(spark):
    assert one(spark, T.clean_str("v"), "  a b\t\n") == "a b"
    assert one(spark, T.clean_str("v"), None) == ""


@pytest.mark.parametrize("raw,f,i", [
    (" -1.2 ", -1.2, -1), ("abc", 0.0, 0), (None, 0.0, 0), ("12.7", 12.7, 12), ("1e3", 1000.0, 1000),
])
def test_safe_float_and_int(spark, raw, f, i):
    assert one(spark, N.safe_float("v"), raw) == f
    assert one(spark, N.safe_int("v"), raw) == i


@pytest.mark.parametrize("raw,expected", [
    ("1,234,567", 1234567), ("1234.0", 0), (" 12 ", 12), ("nan", 0), (None, 0), ("-5", -5),
])
def test_safe_int_commas_rejects_fractions(spark, raw, expected):
    assert one(spark, N.safe_int_commas("v"), raw) == expected


def test_as_array_forms(spark):
    df = spark.createDataFrame([('["A","B"]',), ("Maternity",), (None,), ("",)], "v string")
    got = [r[0] for r in df.select(T.as_array("v")).collect()]
    assert got == [["A", "B"], ["Maternity"], [], []]


def flags_of(spark, services):
    df = spark.createDataFrame([(services,)], "s array<string>")
    return df.select(*T.keyword_flags("s")).first().asDict()




def test_keyword_boundary_traps(spark):
    # 'art ' needs a following element: ART last does not match
    assert flags_of(spark, ["Maternity", "ART"])["has_art"] is False
    assert flags_of(spark, ["ART", "Maternity"])["has_art"] is True
    # preserved false positive: 'heart clinic' contains 'art '
    assert flags_of(spark, ["Heart Clinic"])["has_art"] is True
    assert flags_of(spark, ["TB-screening"])["has_tb"] is True
    assert flags_of(spark, ["TB"])["has_tb"] is False
    assert flags_of(spark, ["Emergency"])["has_emergency"] is True
    assert flags_of(spark, [])["has_maternity"] is False


def test_any_contains(spark):
    df = spark.createDataFrame([(["Off-Grid solar"],), (["Borehole Water"],), (None,), ([None],)],
                               "s array<string>")
    got = [tuple(r) for r in df.select(T.any_contains("s", fixed.ELECTRICITY_KEYWORDS),
                                       T.any_contains("s", fixed.WATER_KEYWORDS)).collect()]
    assert got == [(True, False), (False, True), (False, False), (False, False)]


def test_area_keys(spark):
    assert one(spark, T.area_key("v"), "A-b") == one(spark, T.area_key("v"), "a b")
    assert one(spark, T.area_key("v"), "M'x") == "mx"
    # the two normalisers differ on a spaced dash
    assert one(spark, T.area_key("v"), "tharaka - nithi") == "tharaka   nithi"
    assert one(spark, T.area_key_geo("v"), "Tharaka - Nithi") == "tharaka nithi"
    assert one(spark, T.area_key_geo("v"), "Elegeyo-Marakwet") == "elgeyo marakwet"
    assert one(spark, T.area_key_geo("v"), "Murang'a") == "muranga"
    assert one(spark, T.area_key_geo("v"), "Taita-Taveta") == "taita taveta"


def test_classify_first_match_wins(spark):
    assert one(spark, T.classify("v"), "Hospital with clinic") == "Hospital"
    assert one(spark, T.classify("v"), "Medical Clinic") == "Clinic"
    assert one(spark, T.classify("v"), "Nursing Home") == "Other"
    assert one(spark, T.classify("v"), None) == "Other"


@pytest.mark.parametrize("density,points", [
    (0.99, 4), (1.0, 3), (1.99, 3), (2.0, 2), (4.99, 2), (5.0, 1), (None, 1)])
def test_band_edges(spark, density, points):
    assert one(spark, N.band("v"), density, "v double") == points


def test_rate_golden_values(spark):
    df = spark.createDataFrame([(158, 218388), (18, 291760), (5, 0), (5, None)], "n long, p long")
    got = [r[0] for r in df.select(N.rate_per("n", "p", 10000)).collect()]
    assert got == [7.23, 0.62, None, None]


@pytest.mark.parametrize("pop,n,needed", [
    (1670200, 0, 334),       # quotient 334.04 rounds to 334.0 first: not 335
    (1670570, 314, 21),      # published example: 21 facilities needed
    (1000, 50, 0),           # above baseline
    (None, 3, None),         # NULL population stays NULL (not 0)
])
def test_baseline_gap(spark, pop, n, needed):
    df = spark.createDataFrame([(pop, n)], "p long, n long")
    assert df.select(N.baseline_gap("p", "n")).first()[0] == needed


def test_thresholds_and_zero_flags(spark):
    df = spark.createDataFrame([(3, 2, 2, 1), (2, 1, 1, 0), (None, None, None, None)], "m int, a int, t int, e int")
    got = [tuple(r) for r in df.select(N.below("m", 3), N.below("a", 2), N.below("t", 2), N.is_zero("e")).collect()]
    assert got == [(False, False, False, False), (True, True, True, True), (False, False, False, False)]


def test_projection(spark):
    df = spark.createDataFrame([(247073, 0.023, 5)], "p long, g double, y int")
    assert df.select(N.project_population("p", "g", "y")).first()[0] == round(247073 * 1.023 ** 5)


def test_normalise_header():
    assert T.normalise_header(" Male populatio 2019 ") == "male_populatio_2019"
    assert T.normalise_header("Total-Population") == "total_population"


def test_fixed_values_shape():
    assert len(fixed.HISTORY_CHECK_COLUMNS) == 12
    assert fixed.BASELINE_PER_10K == "2.0" and Decimal(fixed.BASELINE_PER_10K) == 2


def test_truthy_json_follows_the_values_type(spark):
    cases = [("true", True), ("false", False), ('"false"', True), ('"False"', True), ('" "', True), ('""', False), ("0", False), ("0.0", False),
             ("-0.0", False), ("0e5", False), ("1e-3", True), ('"0"', True), ("null", False), ("[]", False), ("[0]", True), ("{}", False), ('{"x":1}', True)]
    df = spark.createDataFrame([(*c,) for c in cases] + [(None, False)], "j string, want boolean").withColumn("v", F.parse_json("j"))
    assert [r.j for r in df.withColumn("got", N.truthy_json("v")).collect() if r.got != r.want] == []


def test_truthy_of_text_keeps_blanks(spark):
    df = spark.createDataFrame([(" ",), ("",), ("false",), ("no",), (None,)], "t string")
    assert [r.b for r in df.select(N.truthy("t").alias("b")).collect()] == [True, False, False, True, False]
