"""How rows are dealt out to files: by measured bytes, not by who has read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.fs import Files
from tierlake.names import exact

#: Values with their number of parts that are sent to every task instead of shuffling the rows.
BROADCAST_VALUES = 100_000
#: Files are packed when there are more than this many times as many as needed.
TOO_MANY = 1.5

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
    T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def value_bytes(column: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes; a null takes none."""
    if type(kind) in _FIXED:
        size = F.lit(_FIXED[type(kind)])
    elif isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and type(kind.elementType) in _FIXED:
        size = F.size(column) * _FIXED[type(kind.elementType)]
    elif isinstance(kind, T.ArrayType | T.MapType | T.StructType):
        size = F.octet_length(F.to_json(column))
    else:
        size = F.lit(16)
    return F.when(column.isNull(), 0).otherwise(size).cast("bigint")


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes."""
    total = F.lit(0).cast("bigint")
    for field in schema.fields:
        total = total + value_bytes(exact(field.name), field.dataType)
    return total


def estimated_bytes(df: DataFrame) -> int:
    """What Spark's plan expects ``df`` to hold, by the size of its files; huge if it cannot tell."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def advised_bytes(spark: SparkSession) -> int:
    """``spark.sql.adaptive.advisoryPartitionSizeInBytes`` as a number."""
    conf = spark._jsparkSession.sessionState().conf()
    default = str(64 << 20)
    size = conf.getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", default)
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def clustered(df: DataFrame, column: str) -> DataFrame:
    """``df`` dealt out so that a value of ``column`` shares tasks with few others.

    Values of more bytes than the advised partition size are measured first, in
    one pass that keeps a sum per value, and salted: their rows go by a hash of
    all their columns to as many parts as fill one partition each, wherever they
    were read. The rest goes by value. Adaptive execution then joins small
    partitions. Equal rows of a value stay together. A table that is small as a
    whole is not measured.
    """
    spark, key = df.sparkSession, exact(column)
    advised = advised_bytes(spark)
    # Files are smaller than the rows in them.
    if estimated_bytes(df) <= advised // 4:
        return df.hint("rebalance", key)
    sizes = df.groupBy(key.alias("value")).agg(F.sum(row_bytes(df.schema)).alias("bytes"))
    parts = F.ceil(F.col("bytes") / advised).cast("int").alias("parts")
    large = sizes.where(F.col("bytes") > 2 * advised).select("value", parts)
    found = large.limit(BROADCAST_VALUES + 1).collect()
    if not found:
        return df.hint("rebalance", key)
    if len(found) <= BROADCAST_VALUES:
        large = F.broadcast(spark.createDataFrame(found, large.schema))
    value, count, salt = _free(df, "value"), _free(df, "parts"), _free(df, "salt")
    large = large.toDF(value, count)
    whole = F.xxhash64(*(exact(name) for name in _hashable(df.schema)))
    salted = df.join(large, key.eqNullSafe(exact(value)), "left").withColumn(
        salt, F.when(exact(count).isNotNull(), F.pmod(whole, exact(count))).otherwise(0)
    )
    return salted.hint("rebalance", key, exact(salt)).select(*(exact(n) for n in df.columns))


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def _hashable(schema: T.StructType) -> list[str]:
    """Columns that can be hashed: any but maps and variants."""
    return [f.name for f in schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]


def packed_files(
    spark: SparkSession, path: str, schema: T.StructType, file_bytes: int
) -> DataFrame | None:
    """The rows of the Parquet files at ``path`` in tasks of about ``file_bytes`` of files each.

    None if the files are about that large already. The plan is Spark's own
    packing of files into input splits, told the size that is wanted: each task
    reads some whole files, or row groups of a large one, and nothing is
    shuffled. The session of ``spark`` keeps its settings.
    """
    sizes = [size for _, size, _ in Files(spark).files(path)]
    needed = -(-sum(sizes) // file_bytes)
    if len(sizes) <= max(1, TOO_MANY * needed):
        return None
    packing = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if packing.conf.isModifiable(name):
            packing.conf.set(name, value)
    packing.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    # What opening a file costs beside its bytes; and no fewer bytes a split for more cores.
    packing.conf.set("spark.sql.files.openCostInBytes", "0")
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    return packing.read.schema(schema).parquet(path)
