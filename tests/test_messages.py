import json

import pytest
from messages import BASE, changed, creation, deletion, envelope
from pyspark.sql import functions as F

from quillstream.operators.decode import VARIANT_BYTES, decode_creations, decode_deletions, decode_documents
from quillstream.operators.validate import validate_deletions, validate_documents, validate_index_creations
from quillstream.functions.times import parse_upload_time

INCOMPLETE = {
    "doc_id": "123",
    "user_id": "1",
    "topic_type": "user",
    "topic_name": "topic_1",
    "source_type": "pdf",
    "metadata": {"k": 1},
    "text": "x",
}

# value, errors, errors with the user rule (None: the same)
DOCUMENTS = [
    (changed(), [], None),
    (json.dumps(INCOMPLETE), ["topic_name:prefix", "document_url:missing", "upload_time:missing"], None),
    (changed(doc_id=12), ["doc_id:string_type"], None),
    (changed(doc_id=None), ["doc_id:string_type"], None),
    (changed(doc_id=...), ["doc_id:missing"], None),
    (changed(doc_id=""), [], None),
    (changed(text=""), ["text:too_short"], None),
    (changed(text="  "), [], None),
    (changed(topic_name="  user_1_topic "), [], None),
    (changed(topic_name=" \t"), ["topic_name:blank"], None),
    (changed(topic_name="team_1"), ["topic_name:prefix"], None),
    (changed(topic_name=["user"]), ["topic_name:string_type"], None),
    (changed(source_type="html"), ["source_type:literal"], None),
    (changed(source_type=1), ["source_type:literal"], None),
    (changed(source_type=None), ["source_type:literal"], None),
    (changed(source_type=...), ["source_type:missing"], None),
    (changed(user_id=7), ["user_id:string_type"], None),
    (changed(user_id=None), [], ["user_id:required"]),
    (changed(user_id=...), [], ["user_id:required"]),
    (changed(user_id=""), [], ["user_id:required"]),
    (changed(topic_name="system_topic_1"), [], ["user_id:forbidden"]),
    (changed(topic_name="systemfoo", user_id=None), [], None),
    (changed(metadata={"text": 5}), [], None),
    (changed(text=True, upload_time={"a": 1}), ["upload_time:string_type", "text:string_type"], None),
    ('{"doc_id":"first",' + changed()[1:], [], None),
    ("  " + changed() + "\n", [], None),
    (changed(extra=float("nan")), [], None),
    ("nope", ["bad_json"], None),
    ("", ["bad_json"], None),
    (None, ["bad_json"], None),
    (changed() + " x", ["bad_json"], None),
    (changed() + changed(), ["bad_json"], None),
    (changed() + ',"w":1', ["bad_json"], None),
    (changed() + "}", ["bad_json"], None),
    (changed() + "], [1", ["bad_json"], None),
    (changed()[:-1], ["bad_json"], None),
    ("{'doc_id':'a'}", ["bad_json"], None),
    ("[1]", ["not_object"], None),
    ('"x"', ["not_object"], None),
    ("null", ["not_object"], None),
    ("12", ["not_object"], None),
]


@pytest.mark.parametrize("enforce", [False, True])
def test_document_rules(spark, enforce):
    df = envelope(spark, "documents", [value for value, _, _ in DOCUMENTS])
    rows = validate_documents(decode_documents(df), enforce_user_scope=enforce).orderBy("offset").collect()
    for (value, errors, scoped), row in zip(DOCUMENTS, rows, strict=True):
        wanted = scoped if enforce and scoped is not None else errors
        assert row["errors"] == wanted, value
        if not wanted:
            python = json.loads(value)
            assert row["index_name"] == python["topic_name"].strip()
            assert {f: row[f] for f in BASE if f != "topic_name"} == {f: python.get(f) for f in BASE if f != "topic_name"}


def test_allowed_source_types_are_a_parameter(spark):
    df = decode_documents(envelope(spark, "documents", [changed(source_type="html")]))
    assert validate_documents(df, allowed=("html",)).first()["errors"] == []


def test_binary_value_has_to_be_utf8(spark):
    df = envelope(spark, "documents", [changed(text="é"), changed()]).withColumn("value", F.col("value").cast("binary"))
    broken = df.withColumn("value", F.when(F.col("offset") == 1, F.unhex(F.lit("7BFF7D"))).otherwise(F.col("value")))
    rows = validate_documents(decode_documents(broken)).orderBy("offset").collect()
    assert [r["errors"] for r in rows] == [[], ["bad_json"]]
    assert rows[0]["text"] == "é"


def test_value_longer_than_a_variant_keeps_its_whole_text(spark):
    long = F.repeat(F.lit("abcdefgh. "), VARIANT_BYTES // 10 + 400_000)
    rest = {k: v for k, v in BASE.items() if k not in ("text", "doc_id")}
    head = [f'{{"doc_id":"{n}",' + json.dumps(rest)[1:-1] + "," for n in range(6)]
    tails = ['"text":"@"}', '"text":["@"]}', '"x":"@","text":5}', '"x":"@"}', '"x":"@","text":null}', '"text":"@"} x']
    df = envelope(spark, "documents", [h + t for h, t in zip(head, tails)])
    df = df.withColumn("value", F.replace(F.col("value"), F.lit("@"), long))
    rows = validate_documents(decode_documents(df)).select("errors", F.length("text"), "doc_id").orderBy("offset").collect()
    assert [r[0] for r in rows] == [
        [], ["text:string_type"], ["text:string_type"], ["text:missing"], ["text:string_type"], ["bad_json"]
    ]
    assert rows[0][1] == (VARIANT_BYTES // 10 + 400_000) * 10


def test_deletion_rules(spark):
    values = [
        deletion(" d "), deletion(" "), json.dumps({"doc_id": 1, "index_name": ""}), "[]",
        json.dumps({"doc_id": "a", "index_name": "i", "request_time": 5}),
    ]
    rows = validate_deletions(decode_deletions(envelope(spark, "d", values))).orderBy("offset").collect()
    assert [r["errors"] for r in rows] == [
        [], ["doc_id:blank"], ["doc_id:string_type", "index_name:blank", "request_time:missing"], ["not_object"],
        ["request_time:string_type"],
    ]
    assert rows[0]["doc_id"] == "d"


def test_creation_rules(spark):
    values = [creation(" any_name "), creation(" "), "{}"]
    rows = validate_index_creations(decode_creations(envelope(spark, "c", values))).orderBy("offset").collect()
    assert [r["errors"] for r in rows] == [[], ["topic_name:blank"], ["topic_name:missing", "request_time:missing"]]
    assert rows[0]["index_name"] == "any_name"


TIMES = [
    ("2025-10-22T12:00:00Z", "2025-10-22 12:00:00"),
    ("2025-10-22T12:00:00+03:00", "2025-10-22 09:00:00"),
    ("2025-10-22T12:00:00+0300", "2025-10-22 09:00:00"),
    ("2025-10-22T12:00:00-03", "2025-10-22 15:00:00"),
    ("2025-10-22 12:00:00.5", "2025-10-22 12:00:00.5"),
    ("2025-10-22x12:00:00,25Z", "2025-10-22 12:00:00.25"),
    ("2025-10-22T12:00:00.1234567Z", "2025-10-22 12:00:00.123456"),
    ("20251022T120000", "2025-10-22 12:00:00"),
    ("20251022T1200+0100", "2025-10-22 11:00:00"),
    ("20251022", "2025-10-22 00:00:00"),
    ("2025-10-22", "2025-10-22 00:00:00"),
    ("2025-10-22T12", "2025-10-22 12:00:00"),
    ("2025-10-22T12:30", "2025-10-22 12:30:00"),
    ("2025-W43-3", "2025-10-22 00:00:00"),
    ("2025W433", "2025-10-22 00:00:00"),
    ("2025-W43", "2025-10-20 00:00:00"),
    ("2020W537T1200+03", "2021-01-03 09:00:00"),
    ("2025-10-22T12:00:00+19:00", "2025-10-21 17:00:00"),
    ("2025-10-22T12:00:00+23:59", "2025-10-21 12:01:00"),
    ("2025-10-22T12:00:00-030000,5", "2025-10-22 15:00:00.5"),
    ("2025-10-22T12:00:00+03:75", "2025-10-22 07:45:00"),
    ("2025-10-22T12:00:00+24:00", None),
    ("2025-W53-1", None),
    ("2025-W433", None),
    ("2025W43-3", None),
    ("2025-W43-0", None),
    ("0000-01-01", None),
    ("bad", None),
    ("", None),
    ("2025", None),
    ("2025-10", None),
    ("T12:00", None),
    ("2025-13-01", None),
    ("2025-02-30T00:00:00Z", None),
    ("2025-10-22T25:00:00Z", None),
    ("2025-10-22T12:00:00 Europe/Paris", None),
    ("2025-10-22T12:00:00Z\n", None),
    (" 2025-10-22", None),
    (None, None),
]


def test_upload_times(spark):
    df = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(TIMES)], "n int, t string")
    found = df.select("n", parse_upload_time(F.col("t")).cast("string").alias("at")).orderBy("n").collect()
    for (raw, wanted), row in zip(TIMES, found, strict=True):
        assert (row["at"] or "").rstrip("0") == (wanted or "").rstrip("0"), raw


def test_a_broken_value_has_no_fields_at_any_length(spark):
    whole = changed(text="x" * 20)
    long = changed(text="x" * (VARIANT_BYTES + 1))
    values = [whole, whole + " 1", long, long + " 1", "[" + whole + "]", "[" + long + "]"]
    rows = decode_documents(envelope(spark, "d", values)).orderBy("offset")
    found = [(r["json_status"], r["doc_id"]["kind"], r["doc_id"]["text"]) for r in rows.collect()]
    good = ("ok", "string", json.loads(whole)["doc_id"])
    assert found == [good, ("bad_json", "missing", None), good, ("bad_json", "missing", None), ("not_object", "missing", None), ("not_object", "missing", None)]
