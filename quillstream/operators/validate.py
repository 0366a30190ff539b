"""Validation of decoded messages: every broken rule is listed, none stops the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank, strip
from ..functions.times import parse_upload_time
from ..schemas import CREATION_FIELDS, DELETION_FIELDS, DOCUMENT_FIELDS, SOURCE_TYPES


def _text(name: str) -> Column:
    return F.col(name)["text"]


def _is_string(name: str) -> Column:
    return F.col(name)["kind"] == "string"


def _string_error(name: str, optional: bool = False) -> Column:
    kind = F.col(name)["kind"]
    wrong = ("other",) if optional else ("other", "null")
    error = F.when(kind.isin(*wrong), F.lit(f"{name}:string_type"))
    return error if optional else error.when(kind == "missing", F.lit(f"{name}:missing"))


def _when_string(name: str, broken: Column, code: str) -> Column:
    return F.when(_is_string(name) & broken, F.lit(f"{name}:{code}"))


def _checked(df: DataFrame, errors: Sequence[Column], values: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """Flatten the decoded fields and add `errors`, empty for a valid message."""
    listed = F.filter(F.array(*errors), lambda error: error.isNotNull())
    status = F.col("json_status")
    kept = [c for c in df.columns if c not in fields and c != "json_status"]
    return df.select(
        *kept,
        *values,
        F.when(status == "ok", listed).otherwise(F.array(status)).alias("errors"),
    )


def validate_documents(
    df: DataFrame, allowed: Sequence[str] = SOURCE_TYPES, enforce_user_scope: bool = False
) -> DataFrame:
    """Check decoded document messages.

    `enforce_user_scope` turns on the rule that user topics need a user id and system topics have none. It is off by
    default because the service this follows declares the rule but never applies it.
    """
    topic = strip(_text("topic_name"))
    good_prefix = topic.startswith("user") | topic.startswith("system")
    user = _text("user_id")
    errors = [
        _string_error("doc_id"),
        _string_error("user_id", optional=True),
        _string_error("topic_name"),
        _when_string("topic_name", topic == "", "blank"),
        _when_string("topic_name", (topic != "") & ~good_prefix, "prefix"),
        F.when(F.col("source_type")["kind"] == "missing", F.lit("source_type:missing")).when(
            ~_is_string("source_type") | ~_text("source_type").isin(*allowed), F.lit("source_type:literal")
        ),
        _string_error("document_url"),
        _string_error("upload_time"),
        _string_error("text"),
        _when_string("text", F.length(_text("text")) < 1, "too_short"),
    ]
    if enforce_user_scope:
        no_user = user.isNull() | (user == "")
        scope_applies = _is_string("topic_name") & (F.col("user_id")["kind"] != "other")
        errors.insert(
            2,
            F.when(scope_applies & topic.startswith("user") & no_user, F.lit("user_id:required")).when(
                scope_applies & topic.startswith("system") & ~no_user, F.lit("user_id:forbidden")
            ),
        )
    values = [topic.alias("index_name") if f == "topic_name" else _text(f).alias(f) for f in DOCUMENT_FIELDS]
    return _checked(df, errors, values, DOCUMENT_FIELDS)


def validate_deletions(df: DataFrame) -> DataFrame:
    errors = [
        _string_error("doc_id"),
        _when_string("doc_id", is_blank(_text("doc_id")), "blank"),
        _string_error("index_name"),
        _when_string("index_name", is_blank(_text("index_name")), "blank"),
        _string_error("request_time"),
    ]
    values = [
        strip(_text("doc_id")).alias("doc_id"),
        strip(_text("index_name")).alias("index_name"),
        _text("request_time").alias("request_time"),
    ]
    return _checked(df, errors, values, DELETION_FIELDS)


def validate_index_creations(df: DataFrame) -> DataFrame:
    errors = [
        _string_error("topic_name"),
        _when_string("topic_name", is_blank(_text("topic_name")), "blank"),
        _string_error("request_time"),
    ]
    values = [strip(_text("topic_name")).alias("index_name"), _text("request_time").alias("request_time")]
    return _checked(df, errors, values, CREATION_FIELDS)


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size("errors") == 0).drop("errors")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.size("errors") > 0)


def with_upload_time(df: DataFrame) -> DataFrame:
    """Keep the raw text and add the parsed instant; a time that cannot be read does not drop the row."""
    return df.withColumnRenamed("upload_time", "upload_time_raw").withColumn(
        "upload_time", parse_upload_time(F.col("upload_time_raw"))
    )
