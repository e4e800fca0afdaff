"""Shared helpers of the corpus operators: table reading, written intermediate tables, column digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"  # a word: no blank, tab, line feed, vertical tab, form feed or carriage return
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the work that made them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text in order (NULL: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32(doc_id as text) has the remainder; their labels are never read."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` reads it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
