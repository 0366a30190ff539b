"""Message values to typed fields, without losing what type a field had."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.ids import CREATE_RANK, DELETE_RANK, DOCUMENT_RANK, arrival
from ..schemas import CREATION_FIELDS, DELETION_FIELDS, DOCUMENT_FIELDS

# Strict JSON, with no limit on the length of a text.
JSON_OPTIONS = {"allowSingleQuotes": "false", "maxStringLen": str(2**31 - 1)}

# A variant holds at most 16 MiB; longer values take the path that has no such limit.
VARIANT_BYTES = 16_000_000


# Types other than string that a field of a long value is probed for.
PROBES = ("double", "boolean", "map<string,string>", "array<string>")
# Strings that a JSON reader takes for numbers.
NUMBER_WORDS = ("NaN", "Infinity", "+Infinity", "-Infinity", "INF", "+INF", "-INF")


_OPTIONS = "map(" + ", ".join(f"'{key}', '{value}'" for key, value in JSON_OPTIONS.items()) + ")"


def _long_parts(fields: Sequence[str]) -> dict[str, str]:
    """What is needed to read a value too long for a variant; NULL, and not computed, for all others."""
    long = f"octet_length(_value) > {VARIANT_BYTES}"

    def read(kind: str) -> str:
        schema = ", ".join(f"`{name}` {kind}" for name in fields)
        return f"CASE WHEN {long} THEN from_json(_value, '{schema}', {_OPTIONS}) END"

    parts = {"_long": read("string"), "_keys": f"CASE WHEN {long} THEN json_object_keys(_value) END"}
    return parts | {f"_probe{n}": read(kind) for n, kind in enumerate(PROBES)}


def _field(name: str) -> str:
    """Kind and text of a field, from the variant or, for a long value, from its probes."""
    variant, text = f"_json.`{name}`", f"_long.`{name}`"
    words = ", ".join(f"'{word}'" for word in NUMBER_WORDS)
    other = [f"(_probe0.`{name}` IS NOT NULL AND {text} NOT IN ({words}))"]
    other += [f"_probe{n}.`{name}` IS NOT NULL" for n in range(1, len(PROBES))]
    kind = f"""CASE
      WHEN _keys IS NOT NULL THEN CASE
        WHEN NOT array_contains(_keys, '{name}') THEN 'missing'
        WHEN {text} IS NULL THEN 'null'
        WHEN {" OR ".join(other)} THEN 'other'
        ELSE 'string' END
      WHEN {variant} IS NULL THEN 'missing'
      WHEN is_variant_null({variant}) THEN 'null'
      WHEN schema_of_variant({variant}) = 'STRING' THEN 'string'
      ELSE 'other' END"""
    value = f"CASE WHEN _keys IS NOT NULL THEN {text} ELSE try_variant_get({variant}, '$', 'string') END"
    kind = f"CASE WHEN json_status = 'ok' THEN {kind} ELSE 'missing' END"
    return f"named_struct('kind', {kind}, 'text', CASE WHEN {kind} = 'string' THEN {value} END) AS `{name}`"


# An object is read as the first of two elements; the second one carries the value's hash, and comes out whole only if
# the value ended where its object did. Values that cannot be read so are looked at once more.
_STATUS = f"""CASE
  WHEN octet_length(_value) > {VARIANT_BYTES} THEN CASE
    WHEN coalesce(_values, 0) <> 1 THEN 'bad_json'
    WHEN _keys IS NOT NULL THEN 'ok'
    WHEN _object THEN 'bad_json'
    ELSE 'not_object' END
  WHEN _object THEN CASE
    WHEN size(_pair) = 2 AND try_variant_get(get(_pair, 1).`{{end}}`, '$', 'string') = md5(_value) AND _json IS NOT NULL THEN 'ok'
    ELSE 'bad_json' END
  WHEN _values = 1 THEN 'not_object'
  ELSE 'bad_json' END AS json_status"""


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, computed before anything above: filters on them are not pushed down.

    Pushing a filter on decoded fields to the source would parse each message once more for every field it names. A
    filter cannot pass a generator that makes its columns, so the rows go through one that gives back one row each.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def decode_json(df: DataFrame, fields: Sequence[str], rank: int) -> DataFrame:
    """Replace `value` by one struct `<field>(kind, text)` per known field and by `json_status`.

    `json_status` is `ok`, `bad_json` or `not_object`. Unknown fields are dropped. A value that begins like an object and is
    short enough for a variant is parsed once.
    """
    kept = [name for name in df.columns if name != "value"]
    kinds = ", ".join(f"`{name}`: variant" for name in fields)
    text = F.col("value").cast("string")
    if dict(df.dtypes)["value"] == "binary":
        text = F.when(F.is_valid_utf8(text), text)
    shaped = df.select(*kept, text.alias("_value")).selectExpr(
        *[f"`{name}`" for name in kept], "_value", r"coalesce(_value RLIKE '^[ \\t\\r\\n]*[{]', false) AS _object"
    )
    short = f"_object AND octet_length(_value) <= {VARIANT_BYTES}"
    pair = f"""concat('[', _value, ',{{"{fields[0]}":"', md5(_value), '"}}]')"""
    read = shaped.selectExpr(
        "*",
        f"CASE WHEN {short} THEN from_json({pair}, 'array<struct<{kinds}>>', {_OPTIONS}) END AS _pair",
        f"CASE WHEN NOT ({short}) THEN size(from_json(concat('[', _value, ']'), 'array<string>', {_OPTIONS})) END AS _values",
        *[f"{part} AS {name}" for name, part in _long_parts(fields).items()],
    )
    parsed = read.selectExpr("*", "get(_pair, 0) AS _json")
    placed = parsed.withColumn("arrival", arrival(rank))
    judged = placed.selectExpr("*", _STATUS.format(end=fields[0]))
    # a value that is not one whole object has no fields, whatever part of it could be read
    return computed_once(judged.selectExpr(*[f"`{name}`" for name in kept], "arrival", "json_status", *map(_field, fields)))


def decode_documents(df: DataFrame) -> DataFrame:
    return decode_json(df, DOCUMENT_FIELDS, DOCUMENT_RANK)


def decode_deletions(df: DataFrame) -> DataFrame:
    return decode_json(df, DELETION_FIELDS, DELETE_RANK)


def decode_creations(df: DataFrame) -> DataFrame:
    return decode_json(df, CREATION_FIELDS, CREATE_RANK)
