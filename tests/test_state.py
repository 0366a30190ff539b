from dataclasses import replace

import pytest
from messages import creation, deletion, document, envelope
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quillstream.operators.index_state import (
    apply_deletes,
    deletion_outcomes,
    index_outcomes,
    index_stats,
    latest_rows,
    latest_stored_rows,
    stale_chunks,
)
from quillstream.operators.outcomes import outcome_summary
from quillstream.operators.routing import all_system_ready, create_indices, seed_system_indices
from quillstream.plans.replay import replay
from quillstream.session import settle
from quillstream.sources.change_log import SCHEMAS, ChangeLog
from quillstream.sources.messages import MessageSource
from quillstream.streaming.ingest import IngestSettings, Sources, apply_batch, backfill, prepare

SETTINGS = IngestSettings(size=5, overlap=2, dim=8, system_topics="topic_1, topic_2")
LONG, SHORT = "a b c. d e f g h.", "x y."

CREATIONS = [(0, creation("user_1_topic")), (1, creation(" user_1_topic ")), (2, creation("user_2_topic")), (3, creation("odd")), (4, "nope")]
DOCUMENTS = [
    (0, document("same_second", SHORT)),
    (1, document("early", SHORT, "user_2_topic")),
    (10, document("shrinks", LONG)),
    (11, document("shrinks", SHORT)),
    (12, document("deleted", LONG)),
    (13, document("again", LONG)),
    (14, document(" spaced", SHORT)),
    (15, document("blank", "  ")),
    (16, document("sys", SHORT, "system_topic_1", user_id=None)),
    (17, document("nowhere", SHORT, "user_9_topic")),
    (18, document("broken", SHORT, source_type="html")),
    (30, document("again", SHORT)),
]
DELETIONS = [
    (20, deletion("deleted")),
    (21, deletion("deleted")),
    (22, deletion("again")),
    (23, deletion(" spaced")),
    (24, deletion("x", "no_index")),
    (25, deletion("absent")),
    (26, deletion("early", "user_2_topic")),
    (27, deletion("shrinks", "user_2_topic")),
]
LIVE = {
    ("user_1_topic", "same_second_0", "x y."),
    ("user_1_topic", "shrinks_0", "x y."),
    ("user_1_topic", "shrinks_1", "b c. d e f g h."),
    ("user_1_topic", " spaced_0", "x y."),
    ("user_1_topic", "again_0", "x y."),
    ("system_topic_1", "sys_0", "x y."),
}


def all_messages(spark):
    return (
        envelope(spark, "documents", DOCUMENTS),
        envelope(spark, "document_deletions", DELETIONS),
        envelope(spark, "index_creations", CREATIONS),
    )


def shown(rows):
    return {(r["index_name"], r["row_id"], r["text"]) for r in rows.collect()}


def summary(outcomes):
    return {(r["topic"], r["status"], r["reason"]): (r["n_messages"], r["n_chunks"]) for r in outcome_summary(outcomes).collect()}


SUMMARY = {
    ("documents", "indexed", None): (8, 11),
    ("documents", "missing_index", None): (2, 0),
    ("documents", "no_chunks", "no_chunks"): (1, 0),
    ("documents", "rejected", "source_type:literal"): (1, 0),
    ("document_deletions", "deleted", None): (2, 4),
    ("document_deletions", "nothing_found", None): (5, 0),
    ("document_deletions", "missing_index", None): (1, 0),
    ("index_creations", "created", None): (3, 0),
    ("index_creations", "exists", None): (1, 0),
    ("index_creations", "rejected", "bad_json"): (1, 0),
}


def test_replay(spark):
    state = replay(*all_messages(spark), SETTINGS)
    assert shown(state.live()) == LIVE
    stale = ("user_1_topic", "shrinks_1", "b c. d e f g h.")
    assert shown(state.live(replace_document=True)) == LIVE - {stale}
    assert shown(stale_chunks(state.rows(), state.deletes)) == {stale}
    assert summary(state.outcomes()) == SUMMARY
    stats = {r["index_name"]: (r["kind"], r["n_rows"], r["n_docs"]) for r in index_stats(state.registry, state.live()).collect()}
    assert stats == {
        "user_1_topic": ("user", 5, 4), "user_2_topic": ("user", 0, 0), "odd": ("user", 0, 0),
        "system_topic_1": ("system", 1, 1), "system_topic_2": ("system", 0, 0),
    }
    by_kind = {r["index_name"]: r for r in state.live().collect()}
    assert by_kind["system_topic_1"]["upload_time"] and not by_kind["system_topic_1"]["user_upload_time"]
    assert by_kind["user_1_topic"]["user_upload_time"] and by_kind["user_1_topic"]["user_id"] == "1"


DELETED = {
    20: ("deleted", 2, True), 21: ("nothing_found", 0, True), 22: ("deleted", 2, True), 23: ("nothing_found", 0, True),
    24: ("missing_index", 0, False), 25: ("nothing_found", 0, True), 26: ("nothing_found", 0, True),
    27: ("nothing_found", 0, True),
}


def judged(found):
    return {r["offset"]: (r["status"], r["n_deleted"], r["success"]) for r in found.collect()}


def test_deletion_outcomes(spark):
    state = replay(*all_messages(spark), SETTINGS)
    writes = state.rows().where("chunk_id IS NOT NULL")
    assert judged(deletion_outcomes(state.deletes, state.registry, writes).withColumn("offset", F.col("arrival.offset"))) == DELETED


def test_a_deletion_counts_what_was_written_before_it(spark):
    made = [(0, creation("user_1_topic"))]
    written = [(10, document("d", LONG)), (11, document("d", LONG)), (30, document("d", SHORT)), (50, document("d", LONG))]
    deleted = [(5, deletion("d")), (21, deletion("d")), (22, deletion("d")), (40, deletion("d"))]
    state = replay(envelope(spark, "documents", written), envelope(spark, "document_deletions", deleted), envelope(spark, "index_creations", made), SETTINGS)
    found = deletion_outcomes(state.deletes, state.registry, state.rows().where("chunk_id IS NOT NULL"))
    assert {r["arrival"]["offset"]: (r["status"], r["n_deleted"]) for r in found.collect()} == {
        5: ("nothing_found", 0), 21: ("deleted", 2), 22: ("nothing_found", 0), 40: ("deleted", 1),
    }


def test_indices_are_made_once(spark):
    seeds = seed_system_indices(spark, "topic_1, topic_2")
    assert {(r["index_name"], r["kind"]) for r in seeds.collect()} == {("system_topic_1", "system"), ("system_topic_2", "system")}
    state = replay(*all_messages(spark), SETTINGS)
    assert create_indices(state.registry, state.routed.select("index_name", "arrival")).count() == 0
    assert all_system_ready(seeds, "topic_1,topic_2").first()["all_ready"]
    assert not all_system_ready(seeds, "topic_1,topic_3").first()["all_ready"]


def test_partly_stored_document_counts_as_indexed(spark):
    rows = spark.createDataFrame(
        [("i", "d", 0, None), ("i", "d", 1, "dimension:3"), ("i", "e", 0, "dimension:3")],
        "index_name string, doc_id string, chunk_id int, error string",
    )
    found = {r["doc_id"]: (r["n_ok"], r["n_failed"], r["success"]) for r in index_outcomes(rows).collect()}
    assert found == {"d": (1, 1, True), "e": (0, 1, False)}


def write_source(df, path, parts):
    """Files in order of arrival, so that a stream that takes one file at a time gets them in order."""
    for n, (low, high) in enumerate(parts):
        df.where((F.col("offset") >= low) & (F.col("offset") < high)).coalesce(1).write.mode("append").json(str(path))
    return MessageSource("json", str(path), {"maxFilesPerTrigger": "1"})


def sources(spark, folder, parts):
    documents, deletions, creations = all_messages(spark)
    return Sources(
        write_source(documents, folder / "documents", parts),
        write_source(deletions, folder / "deletions", parts),
        write_source(creations, folder / "creations", parts),
    )


def test_stream_equals_replay_and_restart_adds_nothing(spark, tmp_path):
    found = sources(spark, tmp_path, [(0, 12), (12, 23), (23, 99)])
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    backfill(spark, found, out, offsets, SETTINGS)
    log = ChangeLog(spark, out)
    assert log._last("commits") == 2
    assert shown(log.live()) == LIVE
    assert summary(log.outcomes()) == SUMMARY
    backfill(spark, found, out, offsets, SETTINGS)
    assert log._last("commits") == 2
    assert shown(log.live()) == LIVE
    log.compact(files=2)
    assert shown(log.live()) == LIVE
    assert shown(log.live(replace_document=True)) == {row for row in LIVE if row[1] != "shrinks_1"}


def test_batch_written_twice_or_half_changes_nothing(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "out"))
    prepare(log, SETTINGS)
    documents, deletions, creations = all_messages(spark)
    messages = documents.unionByName(deletions).unionByName(creations)
    apply_batch(messages, 0, log, SETTINGS)
    apply_batch(messages, 0, log, SETTINGS)
    assert shown(log.live()) == LIVE
    assert summary(log.outcomes()) == SUMMARY
    assert judged(log.deletion_outcomes().withColumn("offset", F.col("arrival.offset"))) == DELETED
    # a batch without its commit is not seen
    log.write("deletes", 1, log.read("rows").select("index_name", "doc_id", F.col("arrival")).withColumn(
        "arrival", F.struct(F.timestamp_seconds(F.lit(99)).alias("timestamp"), F.lit(2).alias("rank"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"))))
    assert shown(log.live()) == LIVE
    log.commit(1)
    assert shown(log.live()) == set()


def test_stored_log_is_not_shuffled_while_few_rows_are_overwritten(spark):
    log = settle(replay(*all_messages(spark), SETTINGS).rows().where("chunk_id IS NOT NULL"))
    wanted = shown(latest_rows(log))
    few, many = latest_stored_rows(log), latest_stored_rows(log, limit=0)
    assert shown(few) == shown(many) == wanted
    assert "hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in many._jdf.queryExecution().executedPlan().toString()


def test_hot_row_is_cut_before_the_shuffle(spark):
    state = replay(*all_messages(spark), SETTINGS)
    plan = latest_rows(state.rows())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_document_is_split_when_deletes_cannot_be_broadcast(spark, monkeypatch):
    """A document that holds most rows: the join with the deletes splits its partition."""
    import quillstream.operators.index_state as index_state

    arrival = F.struct(F.timestamp_seconds("id").alias("timestamp"), F.lit(1).alias("rank"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    doc = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id").cast("string")))
    rows = spark.range(0, 30_000, 1, 8).select(F.lit("i").alias("index_name"), doc.alias("doc_id"), arrival.alias("arrival"), F.repeat(F.uuid(), 4).alias("text"))
    deletes = spark.range(0, 9_000, 3).select(F.lit("i").alias("index_name"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("doc_id"), arrival.alias("arrival"))
    monkeypatch.setattr(index_state, "broadcast_if_small", lambda df: df)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key) for key in conf if key != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        kept = apply_deletes(rows, deletes)
        assert len(kept.collect()) == 27_000
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for key, value in before.items():
            spark.conf.set(key, value)


def test_messages_that_come_again_count_once(spark, tmp_path, monkeypatch):
    import quillstream.operators.index_state as index_state

    log = ChangeLog(spark, str(tmp_path / "out"))
    prepare(log, SETTINGS)
    documents, deletions, creations = all_messages(spark)
    apply_batch(documents.unionByName(deletions).unionByName(creations), 0, log, SETTINGS)
    # in a later batch, and there twice
    apply_batch(documents.unionByName(documents), 1, log, SETTINGS)
    for limit in (index_state.BROADCAST_BYTES, 0):
        monkeypatch.setattr(index_state.latest_stored_rows, "__defaults__", (limit,))
        live = log.live()
        assert shown(live) == LIVE
        assert live.count() == len(LIVE)


def test_another_checkpoint_is_refused(spark, tmp_path):
    found = sources(spark, tmp_path, [(0, 99)])
    out = str(tmp_path / "out")
    backfill(spark, found, out, str(tmp_path / "offsets"), SETTINGS)
    with pytest.raises(StreamingQueryException, match="belongs to another checkpoint"):
        backfill(spark, found, out, str(tmp_path / "fresh"), SETTINGS)
    log = ChangeLog(spark, out)
    assert log._last("commits") == 0
    assert shown(log.live()) == LIVE


def test_a_restart_never_unmakes_an_index(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "out"))
    prepare(log, SETTINGS)
    documents, deletions, creations = all_messages(spark)
    apply_batch(documents.unionByName(creations), 0, log, SETTINGS)
    other = IngestSettings(size=5, overlap=2, dim=16, system_topics="topic_2,topic_3")
    prepare(log, other)
    prepare(log, other)
    made = {r["index_name"]: r["dim"] for r in log.registry().collect()}
    assert made == {"user_1_topic": 8, "user_2_topic": 8, "odd": 8, "system_topic_1": 8, "system_topic_2": 8, "system_topic_3": 16}
    later = [(40, document("one", SHORT, "system_topic_1", user_id=None)), (41, document("three", SHORT, "system_topic_3", user_id=None))]
    apply_batch(envelope(spark, "documents", later), 1, log, other)
    found = {r["doc_id"]: (r["status"], r["reason"]) for r in log.read("outcomes").where("batch_id = 1").collect()}
    assert found == {"one": ("failed", ["dimension:16"]), "three": ("indexed", [])}


def test_a_creation_after_its_documents_comes_too_late(spark, tmp_path):
    """Unlike in a replay, which knows all creations from the start."""
    log = ChangeLog(spark, str(tmp_path / "out"))
    prepare(log, SETTINGS)
    apply_batch(envelope(spark, "documents", [(5, document("d", SHORT))]), 0, log, SETTINGS)
    apply_batch(envelope(spark, "index_creations", [(0, creation("user_1_topic"))]), 1, log, SETTINGS)
    assert log.live().count() == 0
    assert [r["status"] for r in log.read("outcomes").where("topic = 'documents'").collect()] == ["missing_index"]


def test_a_backlog_is_worked_off_in_bounded_batches(spark, tmp_path, monkeypatch):
    import quillstream.sources.messages as messages

    found = sources(spark, tmp_path, [(0, 12), (12, 23), (23, 99)])
    monkeypatch.setattr(messages, "FILES_PER_TRIGGER", 2)
    unlimited = [MessageSource(s.format, s.path) for s in (found.documents, found.deletions, found.creations)]
    backfill(spark, Sources(*unlimited), str(tmp_path / "out"), str(tmp_path / "offsets"), SETTINGS)
    log = ChangeLog(spark, str(tmp_path / "out"))
    assert log._last("commits") == 1
    assert shown(log.live()) == LIVE
    assert summary(log.outcomes()) == SUMMARY


def test_a_narrow_read_filters_before_keys_are_compared(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "out"))
    prepare(log, SETTINGS)
    documents, deletions, creations = all_messages(spark)
    apply_batch(documents.unionByName(deletions).unionByName(creations), 0, log, SETTINGS)
    narrow = log.live(index_name="user_1_topic", doc_ids=["shrinks", "deleted"])
    assert shown(narrow) == {row for row in LIVE if row[1].startswith("shrinks")}
    assert "PushedFilters: [IsNotNull(index_name), " in narrow._jdf.queryExecution().toString().replace("EqualTo(index_name,user_1_topic), ", "")


def test_a_point_read_equals_the_live_index(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "out"))
    prepare(log, SETTINGS)
    documents, deletions, creations = all_messages(spark)
    everything = documents.unionByName(deletions).unionByName(creations)
    asked = ["shrinks", "deleted", "absent", *sorted({row[1].rsplit("_", 1)[0] for row in LIVE})]

    def agree():
        for replace_document in (False, True):
            narrow = log.live(replace_document, "user_1_topic", asked)
            found = log.documents("user_1_topic", asked, replace_document)
            assert sorted(map(str, found.collect())) == sorted(map(str, narrow.collect()))
            assert found.schema == narrow.schema

    agree()  # an empty log
    apply_batch(everything, 0, log, SETTINGS)
    agree()
    log.compact()
    agree()
    apply_batch(everything, 1, log, SETTINGS)
    agree()
    assert log.documents("user_1_topic", asked).count() > 2
    assert log.documents("user_1_topic", []).count() == 0 == log.documents("absent", asked).count()
    context = spark.sparkContext
    context.setJobGroup("point read", "")
    log.documents("user_1_topic", ["shrinks"]).collect()
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("point read")) <= 3


def test_a_point_read_skips_row_groups(spark, tmp_path):
    """Ids that lie between the bounds of every row group, so that nothing but the Bloom filters tells them apart."""
    log = ChangeLog(spark, str(tmp_path / "out"))
    row = {f.name: F.lit(None).cast(f.dataType) for f in SCHEMAS["snapshot"].fields}
    row |= {"index_name": F.lit("i"), "doc_id": F.concat(F.lit("d"), F.col("id").cast("string")), "row_id": F.concat(F.lit("d"), F.col("id").cast("string"), F.lit("_0"))}
    rows = spark.range(40_000).repartition(8, "id").select(*[value.alias(name) for name, value in row.items()])
    part = log._write("snapshot", rows.withColumn("batch_id", F.lit(0).cast("bigint")), 0, 0)
    log._manifest.publish(lambda old: replace(old.with_parts(snapshot=[part]), committed=0, compacted=0))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for wanted in ("d23456", "d2345x"):
            found = log._frame("snapshot", [part]).where(F.col("doc_id") == wanted)
            assert len(found.collect()) == (wanted == "d23456")
            leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
            read[wanted] = sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["d23456"] <= 10_000 and read["d2345x"] <= 10_000
    assert [r.row_id for r in log.documents("i", ["d23456"]).collect()] == ["d23456_0"]
