import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierlake import json_field, safe_double, safe_double_variant

TEXTS = [
    "1.5", " 1.5 ", "+3", "-4", "1.", ".5", "1e5", "1E-5", "0", "0.0", "-0.0", "1_000", "1__0",
    "_1", "1_", "1_.5", "1._5", "1.5d", "1.5f", "0x10", "nan", "-nan", "NaN", "inf", "-Infinity",
    "INFINITY", "1e999", "1e-999", "abc", "", " ", "\t7\n", "1\n2", "1 2", "+ 1", "--1", ".", "e5",
    "١٢", "1_١", " 1", "1\x85", "\xa0", "\x1c1", "\x1c1\xa0", "²", "𝟏.𝟓", "1\x00", "infinit",
    "0.1", "123456789012345678901234567890", "9007199254740993", "2.2250738585072011e-308", None,
]


def python_float(text):
    try:
        return float(text) if text else None
    except (ValueError, TypeError):
        return None


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or (
        a == b and math.copysign(1, a) == math.copysign(1, b)
    )


def differing(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", safe_double("t"))
    return [(t, d) for t, d in rows.collect() if not same(d, python_float(t))]


def test_text_follows_python_float(spark):
    assert differing(spark, TEXTS) == []


near_numbers = st.text(alphabet="0123456789_.eE+- \tinfaINFd٣ ", max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(near_numbers, st.text(max_size=6), st.floats().map(repr)), min_size=200))
def test_any_text_follows_python_float(spark, texts):
    clean = [t for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)]
    assert differing(spark, clean) == []


@pytest.mark.parametrize(
    "json, expected",
    [
        ("0", None), ("0.0", None), ("-0.0", None), ("0e5", None), ('"0"', 0.0), ('"0.0"', 0.0),
        ("true", 1.0), ("false", None), ("[]", None), ("[1]", None), ("{}", None),
        ('{"b":1}', None), ("null", None), ("2.5", 2.5), ("3", 3.0), ('""', None), ('" 1_0 "', 10.0),
        ('"1.5d"', None), ('"abc"', None), ("NaN", math.nan), ("-Infinity", -math.inf),
        ("1e999", math.inf), ("123456789012345678901234567890", 123456789012345678901234567890.0),
        ("0.1234567890123456789012345678901234567890123", 0.12345678901234568),
    ],
)
def test_json_values(spark, json, expected):
    frame = spark.createDataFrame([('{"a":' + json + "}",)], "j STRING")
    record = F.from_json("j", "a VARIANT").alias("r")
    assert same(frame.select(record).select(safe_double_variant(F.col("r.a"))).first()[0], expected)


def test_missing_json_field_is_null(spark):
    frame = spark.createDataFrame([('{"a.b":"1.5"}',), ("{}",)], "j STRING")
    texts = frame.select(json_field("j", "a.b").alias("t"))
    assert [r[0] for r in texts.select(safe_double("t")).collect()] == [1.5, None]


def test_stays_in_the_jvm(spark):
    frame = spark.createDataFrame([("1",)], "t STRING").select(safe_double("t"))
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString().replace(
        "ExistingRDD", ""
    )
