"""What the operators of this package share: table reading, durable intermediate tables, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows and bytes that go to a Python worker at once; bounds a worker's memory.
ARROW_ROWS, ARROW_BYTES = 2000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by rows and, where this Spark has it, by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the rows as Parquet in the shared folder and reads them back.

    The lineage ends there: a lost executor costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as keep it apart from the columns' names."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Rows of at most a few longs each that may be broadcast: under 64 MB.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The same rows, with a broadcast hint if they were counted and are few enough.

    Beyond the bound the join that uses them shuffles both sides. Give rows that are cheap to
    count, such as a written table.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Bytes of rows with columns of any length that may be broadcast.
BROADCAST_BYTES = 32 << 20


def bounded_bytes(df: DataFrame, size: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """As `bounded`, for rows with a column of any length: `size` is about its bytes in a row."""
    return F.broadcast(df) if (df.agg(F.sum(size + 32)).first()[0] or 0) <= most else df
