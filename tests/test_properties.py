"""Randomised checks: Spark expressions against Python's own semantics,
which is what the product's standardisers run. Each example set is one
DataFrame, so a whole batch costs one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from access_lake.functions import fixed
from access_lake.functions import numeric as N
from access_lake.functions import text as T

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ascii_words = st.text(alphabet=st.sampled_from(list("abcXYZ'- _3é\t")), max_size=12)
numberish = st.one_of(
    st.integers(-10**9, 10**9).map(str),
    st.integers(0, 10**7).map(lambda n: f"{n:,}"),
    st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: f"{f:.3f}"),
    st.sampled_from(["", " ", "abc", "12.0", " 7 ", "+5", "1,2,3", "nan", "-0"]),
)


def py_int(v):
    try:
        return int(str(v).replace(",", ""))
    except (ValueError, TypeError):
        return 0


def py_float(v):
    try:
        return float(str(v).strip())
    except (ValueError, TypeError):
        return 0.0


def py_flags(names):
    joined = " ".join(s.lower() for s in names)
    return {f: any(k in joined for k in kws) for f, kws in fixed.SERVICE_KEYWORDS.items()}


@settings(**SETTINGS)
@given(st.lists(ascii_words, min_size=1, max_size=25))
def test_title_and_strip_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(T.title_case("v"), T.clean_str("v"), T.area_key("v")).collect()
    for v, (title, stripped, key) in zip(values, got):
        assert title == v.title()
        assert stripped == v.strip()
        assert key == v.lower().replace("-", " ").replace("'", "")


@settings(**SETTINGS)
@given(st.lists(numberish, min_size=1, max_size=25))
def test_safe_numbers_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(N.safe_int_commas("v"), N.safe_float("v")).collect()
    for v, (i, f) in zip(values, got):
        assert i == py_int(v), v
        if v.strip().lower() != "nan":
            assert f == py_float(v), v


service_words = st.sampled_from(["ART", "Maternity", "TB", "TB-screening", "Heart Clinic", "HIV care",
                                 "Emergency", "OPD", "Lab Services", "Pharmacy", "EPI clinic", "x"])


@settings(**SETTINGS)
@given(st.lists(st.lists(service_words, max_size=4), min_size=1, max_size=20))
def test_keyword_flags_match_python(spark, lists):
    df = spark.createDataFrame([(v,) for v in lists], "s array<string>")
    got = df.select(*T.keyword_flags("s")).collect()
    for names, row in zip(lists, got):
        assert row.asDict() == py_flags(names)
