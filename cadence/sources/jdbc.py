"""Relational warehouse connector (optional).

For teams that keep the star schema in a relational database: partitioned
JDBC reads (``numPartitions`` parallel range scans on a numeric column)
and batched writes.  Nothing here runs without a reachable database and
its driver jar on the classpath; the library's own warehouse is the
parquet store in ``warehouse.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append",
                properties: dict | None = None, batch_size: int = 10_000,
                num_partitions: int | None = None) -> None:
    """Batched inserts; ``num_partitions`` caps concurrent connections."""
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size)
    if num_partitions is not None:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
