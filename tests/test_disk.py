"""What writes and reads of the stored log leave on disk and shuffle."""

import os
import time

from pyspark.sql import functions as F

from quillstream.operators.index_state import apply_deletes, latest_rows, live_stored_rows, with_place
from quillstream.plans import derived
from quillstream.schemas import ARRIVAL
from quillstream.session import discard, settle, settled_path
from quillstream.sources.change_log import SCHEMAS, ChangeLog

COLUMNS = ("index_name", "row_id", "doc_id", "text", "arrival", "batch_id")


def arrival(offset):
    return F.struct(F.timestamp_seconds(offset).alias("timestamp"), F.lit(1).alias("rank"), F.lit(0).alias("partition"), offset.cast("bigint").alias("offset")).cast(ARRIVAL)


def versions(spark, batch_id, n=3_000):
    """Every row again in each batch, three rows a document."""
    doc_id = F.concat(F.lit("d"), F.floor(F.col("id") / 3).cast("string"))
    return spark.range(n).select(
        F.lit("i").alias("index_name"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("row_id"),
        doc_id.alias("doc_id"),
        F.concat(F.lit(f"version {batch_id} of "), F.col("id").cast("string")).alias("text"),
        arrival(F.col("id") + 10_000 * batch_id).alias("arrival"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def deleted(spark):
    """Deletions of every seventh document, after all versions."""
    return spark.range(0, 1_000, 7).select(
        F.lit("i").alias("index_name"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("doc_id"), arrival(F.col("id") + 50_000).alias("arrival")
    )


def shown(rows):
    return sorted(rows.select("row_id", "text").collect())


def test_a_write_gives_the_disk_of_its_shuffle_back(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
        return {os.path.basename(name) for name in found if "shuffle_" in name}

    before = files()
    made = settle(spark.range(10_000).repartition(3, "id"))
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert made.count() == 10_000


def test_filters_of_a_few_documents_are_small(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "out"))
    part = log._write("deletes", deleted(spark).withColumn("batch_id", F.lit(0).cast("bigint")), 0, 0)
    files = [entry.stat().st_size for entry in os.scandir(f"{log.path}/{part.folder}") if entry.name.endswith(".parquet")]
    assert files and max(files) < 100_000


def test_rows_overwritten_in_great_number_are_not_shuffled(spark):
    log = with_place(settle(versions(spark, 0).unionByName(versions(spark, 1)).unionByName(versions(spark, 2, 1_000)).unionByName(versions(spark, 2, 1_000))))
    deletes = deleted(spark)
    wanted = shown(apply_deletes(latest_rows(log), deletes))
    few, many = live_stored_rows(log, deletes), live_stored_rows(log, deletes, limit=0)
    assert shown(few) == shown(many) == wanted and 0 < len(wanted) < 3_000
    assert "hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()


def test_a_snapshot_in_ranges_is_the_live_index(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "out"))
    missing = [f for f in SCHEMAS["rows"].fields if f.name not in COLUMNS]
    for batch_id in (0, 1):
        rows = versions(spark, batch_id).select(*COLUMNS, *[F.lit(0 if f.name == "chunk_id" else None).cast(f.dataType).alias(f.name) for f in missing])
        log.write("rows", batch_id, rows)
        log.write("deletes", batch_id, deleted(spark).where(F.lit(batch_id == 1)))
        log.commit(batch_id)
    wanted = shown(log.live())
    assert 0 < len(wanted) < 3_000 and {text.split(" of ")[0] for _, text in wanted} == {"version 1"}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        log.compact()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    version = log._manifest.current()
    assert len(version.of("snapshot")) == 2 and not version.of("rows")
    assert shown(log.live()) == wanted


def test_a_discarded_table_is_gone(spark):
    path = settled_path(spark.range(3))
    discard(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_few_labels_meet_texts_without_a_shuffle(spark, tmp_path):
    spark.range(50).selectExpr("id AS doc_id", "'text' AS text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(0, 50, 2).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = derived.labelled_documents(spark, str(tmp_path))
        assert "hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50 and joined.where("quality = 1").count() == 25
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
