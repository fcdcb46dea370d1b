"""Fills, null rows, alignment, counts and previews on literal edge tables."""

import datetime
import decimal
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import align, count_by, fill_defaults, null_rows, preview

TYPES = (
    "s STRING, d DOUBLE, i INT, l BIGINT, f FLOAT, m DECIMAL(10,2), t TIMESTAMP, a ARRAY<INT>, "
    "`a.b` STRING, `q``q` DOUBLE, b BOOLEAN"
)


def test_fill_replaces_only_null_text_and_doubles(spark):
    now = datetime.datetime(2024, 1, 1)
    full = ("", math.nan, 1, 2, 3.0, decimal.Decimal("4.00"), now, [5], "x", -1.0, True)
    filled = fill_defaults(spark.createDataFrame([(None,) * 11, full], TYPES))
    nulls, values = filled.collect()
    assert nulls.asDict() == {
        "s": "TBD", "d": -1.0, "i": None, "l": None, "f": None, "m": None, "t": None, "a": None,
        "a.b": "TBD", "q`q": -1.0, "b": None,
    }
    assert values["s"] == "" and math.isnan(values["d"]) and tuple(values[2:]) == full[2:]
    assert [f.dataType for f in filled.schema] == [f.dataType for f in T.StructType.fromDDL(TYPES)]


def test_fill_takes_other_defaults(spark):
    df = spark.createDataFrame([(None, None)], "s STRING, l BIGINT")
    assert tuple(fill_defaults(df, {"long": 0}).first()) == (None, 0)


def test_fill_is_one_projection(spark, sf_dir):
    plan = fill_defaults(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Project") == 1


def test_null_rows(spark):
    df = spark.createDataFrame([(1, None), (2, math.nan), (3, 0.0)], "id INT, `x.y` DOUBLE")
    assert [r.id for r in null_rows(df, "x.y").collect()] == [1]
    assert [r.id for r in null_rows(df, F.nullif("id", F.lit(2))).collect()] == [2]


def test_align(spark):
    df = spark.createDataFrame([(5, True, 1.5, "x")], "n INT, t BOOLEAN, d DOUBLE, extra STRING")
    schema = T.StructType.fromDDL("d DOUBLE, n STRING, missing DOUBLE, t STRING, note STRING")
    aligned = align(df, schema)
    assert tuple(aligned.first()) == (1.5, "5", None, "true", None)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in schema]


def test_align_refuses_silent_conversions(spark):
    with pytest.raises(TypeError, match="convert it"):
        align(spark.createDataFrame([(5,)], "d INT"), T.StructType.fromDDL("d DOUBLE"))


def test_count_by(spark):
    rows = [("a", "x"), ("a", "x"), ("a", None), (None, "y"), ("", "z"), (None, None)]
    counted = count_by(spark.createDataFrame(rows, "k STRING, id STRING"), ["k"], "id", "n")
    assert {(r.k, r.n) for r in counted.collect()} == {("a", 2), (None, 1), ("", 1)}
    assert [(f.name, f.dataType, f.nullable) for f in counted.schema][1] == ("n", T.LongType(), False)


def test_count_is_partial_before_its_one_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    counted = count_by(df, ["p_type", "p_brand", "p_size"], "p_partkey", "n")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_type:string,p_size:int>" in plan


def test_preview(spark):
    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("x"))
    assert [r.x for r in preview(df, 3, ["x"]).collect()] == [0, 1, 2]
    assert preview(df).count() == 20
    plan = preview(df, 3, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
