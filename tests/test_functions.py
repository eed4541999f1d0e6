import math
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline import functions as fn
from harborline.functions.dates import month_bounds
from harborline.operators.parsing import parsed_sql, strip_sql, title_sql

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(alphabet="aBß É-'1 \t中 ǆ.é", max_size=12)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@QUICK
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_strip_and_title_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", fn.strip("t").alias("s"), fn.title_case("t").alias("c"),
                     F.expr(strip_sql("t")).alias("s2"), F.expr(title_sql("t")).alias("c2")).collect()
    for r in rows:
        assert r.s == r.s2 == r.t.strip()
        assert r.c == r.c2
        if "ǆ" not in r.t and "中" not in r.t:
            assert r.c == r.t.title()


def test_erfc_matches_math(spark):
    zs = [i / 10 for i in range(0, 120)] + [2.4999, 2.5, 20.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", fn.erfc("z").alias("e")).collect()
    for r in rows:
        assert r.e == pytest.approx(math.erfc(r.z), rel=2e-11)


@pytest.mark.parametrize("x,k,p", [
    # Fixed values from chi-square tables.
    (3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (30.143527, 19, 0.05),
    (124.342113, 100, 0.05), (0.0, 4, 1.0),
])
def test_chi2_tail(spark, x, k, p):
    assert one(spark, fn.chi2_sf(F.lit(x), F.lit(k))) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("k", [9_999, 10_000, 1_000_001])
def test_chi2_tail_of_many_degrees(spark, k):
    """Near the mean the tail follows the cube-root normal approximation; far out it is 0 or 1."""
    for shift in (-1.5, 0.0, 2.0):
        x = k + shift * math.sqrt(2 * k)
        z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
        assert one(spark, fn.chi2_sf(F.lit(x), F.lit(k))) == pytest.approx(math.erfc(z / math.sqrt(2)) / 2, abs=1e-5)
    assert one(spark, fn.chi2_sf(F.lit(float(3 * k)), F.lit(k))) == pytest.approx(0.0, abs=1e-12)
    assert one(spark, fn.chi2_sf(F.lit(k / 3), F.lit(k))) == pytest.approx(1.0, abs=1e-6)


def test_two_proportion(spark):
    assert one(spark, fn.two_proportion_p(F.lit(0), F.lit(0), F.lit(1), F.lit(2))) == 1.0
    assert one(spark, fn.two_proportion_p(F.lit(3), F.lit(3), F.lit(2), F.lit(2))) == 1.0
    pooled, n = 0.7, 10
    z = 0.4 / math.sqrt(pooled * (1 - pooled) * 2 / n)
    assert one(spark, fn.two_proportion_p(F.lit(9), F.lit(10), F.lit(5), F.lit(10))) == pytest.approx(
        math.erfc(z / math.sqrt(2)), rel=1e-6)


def test_number_tokens(spark):
    text = "A12 rose +1,250.50 to -3 and 94.00%, B-7 x 94.00 12,34"
    assert one(spark, fn.number_tokens(F.lit(text))) == ["2", "1250.50", "-3", "94.00", "7", "12", "34"]


def test_text_of_numbers(spark):
    assert one(spark, fn.percent_text(F.lit(0.0625), 1)) == f"{0.0625:.1%}"
    assert one(spark, fn.signed_text(F.lit(14.4567), 2)) == "+14.46"
    assert one(spark, fn.signed_text(F.lit(-0.5), 0)) == f"{-0.5:+.0f}"


def test_ratio_and_clip(spark):
    assert one(spark, fn.safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.clip(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert one(spark, fn.clip(F.lit(7.0), 0.0, 1.0)) == 1.0
    assert one(spark, fn.finite(F.lit(float("inf")))) is None
    assert one(spark, fn.months_apart(F.lit("2025-02"), F.lit("2024-11"))) == 3


@pytest.mark.parametrize("text,kind,value", [
    ("12", "integer", 12), ("12.0", "integer", 12), ("12.5", "integer", None), ("1d", "number", None),
    ("1e3", "number", 1000.0), ("-.5", "number", -0.5), ("NaN", "number", None), ("TRUE", "boolean", True),
    ("yes", "boolean", None), ("1", "boolean", None), ("2024-1-5", "date", None), ("2024-02-30", "date", None),
    ("2024", "date", None), ("2025-01-05 garbage", "date", None), ("2025-01-05Tzz", "date", None),
    ("2025-01-05 ", "date", None), ("2025-01-05 25", "date", None), ("2025-01-05", "date", date(2025, 1, 5)),
    ("2025-01-05T10:20:30.5Z", "date", date(2025, 1, 5)), ("2025-01-05 10:20", "date", date(2025, 1, 5)),
])
def test_parsers(spark, text, kind, value):
    assert spark.createDataFrame([(text,)], "t string").select(
        F.expr(parsed_sql("t", kind)).alias("x")).first()["x"] == value


def test_month_bounds():
    assert [d.isoformat() for d in month_bounds("2025-12")] == ["2025-12-01", "2026-01-01"]
    for bad in ("2025-13", "2025-1", "", "25-01"):
        with pytest.raises(ValueError):
            month_bounds(bad)
