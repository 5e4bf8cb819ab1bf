"""Small helpers the operators of this package share: input columns, row keys, intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentflow.plans.scratch import new_dir

#: White space that ends a word: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\v\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder below the shared one and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS), lambda w: w != F.lit(""))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names near the stems that the frame does not have, so that extra input columns never clash."""
    taken = {c.lower() for c in df.columns}
    names = []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of a sieve: 2 MB of bitmap, whatever it is made from.
SIEVE_BITS = 1 << 24
_BITMAP = 32768


def maybe_in(df: DataFrame, key: str, wanted: DataFrame, out: str) -> DataFrame:
    """Add a boolean that is true for every row whose ``key`` is among ``wanted``, its only column, and for few others.

    The wanted keys become one bitmap of fixed size, which every task gets. Joins behind it stay exact; the sieve
    only keeps rows that cannot match from being moved. With many more keys than bits it lets all rows pass."""
    column = wanted.columns[0]

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(3), F.col(c)), F.lit(SIEVE_BITS))

    bitmaps = (
        wanted.select(place(column).alias("_p"))
        .groupBy((F.col("_p") / _BITMAP).cast("int").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.col("_p") % _BITMAP).alias("_bits"))
    )
    bucket, bits, at = fresh(df, "bucket", "bits", "at")
    placed = df.withColumn(at, place(key)).withColumn(bucket, (F.col(at) / _BITMAP).cast("int"))
    # At most SIEVE_BITS / 8 bytes.
    joined = placed.join(F.broadcast(bitmaps.toDF(bucket, bits)), bucket, "left")
    bit = F.col(at) % _BITMAP
    byte = F.conv(F.hex(F.substring(F.col(bits), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = (F.call_function("shiftright", byte, (bit % 8).cast("int")) % 2) == 1
    return joined.withColumn(out, F.coalesce(found, F.lit(False))).drop(bucket, bits, at)


def sieved(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be among ``wanted``: all that are, and few others."""
    flag, = fresh(df, "maybe")
    return maybe_in(df, key, wanted, flag).where(flag).drop(flag)
