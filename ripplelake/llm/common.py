"""Helpers shared by the operators: word columns, scratch tables, distributed
running sums.

Words are runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``),
the same in the column expressions here and in ``bytes.split()`` in tasks.
"""

from __future__ import annotations

import math
import sys
from functools import reduce

import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

WHITE = " \t\n\x0b\f\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module_name: str) -> None:
    """Send the module's functions to tasks by value, so that executors need
    not have this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


class WordHashes(dict):
    """64-bit hashes of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: Column | str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of the words of a non-null text."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_RUN))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def fold(doc_id: Column, modulus: int, default: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; rows without an id get ``default``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(default).cast("long"))


def cut(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write the frame under the shared folder and read it back: later steps
    start from the files, also after executors are lost.  ``batch``: rows that
    go to a Python task at once, for frames with whole texts."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        if batch:
            spark.conf.set(key, str(batch))
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


#: Whole texts that go to a Python task at once.
TEXTS = 1000


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Frames of one row per group are broadcast below this many rows, else a group is dealt in SALTS parts.
BROADCAST_GROUPS, SALTS = 50_000, 64


def join_groups(df: DataFrame, groups: DataFrame, keys: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """Join a frame of one row per group, null-safe; ``groups`` is broadcast
    below BROADCAST_GROUPS rows, else every group is salted."""
    right = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    if groups.count() <= BROADCAST_GROUPS:
        out = df.join(F.broadcast(right), on, how)
    else:
        right = right.withColumn("_g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = (df.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
               .join(right, on & (F.col("_salt") == F.col("_g_salt")), how).drop("_salt", "_g_salt"))
    return out.drop(*[f"_g_{k}" for k in keys])


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the group.

    A plain window would gather a hot group in one task.  Here rows are dealt
    by range of (group, order), so that a hot group spans many ranges; each
    range's sums per group are added up first, and the window inside a
    range starts from the sum of the ranges before it.  Rows equal in all of
    ``groups`` and ``order`` take their places in any order; ``groups`` may
    hold nulls.  The frame is written once, as the ranges must not be dealt
    differently when a lost task is run again.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in groups + order]
    dealt = cut(df.repartitionByRange(partitions(spark), *keys).withColumn("_range", F.spark_partition_id()),
                "ranges")
    by_range = dealt.groupBy("_range", *groups).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_range.select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)],
                             F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inside = (Window.partitionBy("_range", *groups).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(starts, same)
            .withColumn(out, (F.col("_start") + F.col("_within")).cast("long"))
            .drop("_range", "_within", "_start", "_r", *[f"_g{i}" for i in range(len(groups))]))


def power_of_two(n: int) -> int:
    """The smallest power of two that is at least ``n``."""
    return 1 << max(0, math.ceil(math.log2(max(1, n))))
