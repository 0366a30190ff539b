"""Size checks behind every broadcast and every extra shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 << 20
# Of the sources behind one file of messages. A stream takes files by number, so small ones make many batches of little work.
FILE_BYTES = 512 << 20


def _width(field: T.StructField) -> Column:
    """Bytes of one value, a little over what a row format needs."""
    kind, col = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(col), F.lit(0)).cast("bigint") * 8 + 16
    if isinstance(kind, (T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("bigint") + 16
    return F.lit(16).cast("bigint")


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact row count and byte size by one aggregate; use it on narrow or settled data, as it runs `df`."""
    width = sum((_width(field) for field in df.schema.fields), F.lit(0).cast("bigint"))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return row["rows"], row["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark `df` for broadcast only after measuring it; beyond the limit the join shuffles and AQE splits hot keys."""
    return F.broadcast(df) if measure(df)[1] <= limit else df


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables that `df` reads, by the statistics of its scans; runs nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))


def spread(df: DataFrame, *unique_key: str) -> DataFrame:
    """Deal a small source out to all cores; a source with at least one full split per core is not shuffled.

    A small file may have one row group, which one task would read and work on alone. The key has to be unique by row
    (not a document or index name), so that no partition gets a hot group.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df if source_bytes(df) >= cores * split else df.repartition(cores, *unique_key)


def packed(df: DataFrame, *unique_key: str) -> DataFrame:
    """Deal rows out to one partition per core, or more where its sources pass `FILE_BYTES` for each, whatever splits they are
    read in. The key has to be unique by row, as with `spread`."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-source_bytes(df) // FILE_BYTES)), *unique_key)
