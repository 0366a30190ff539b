"""Text functions with the white-space rule of Python strings, on Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that Python's str.isspace and \s accept, as a Java character class.
WHITE_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Characters that end a sentence when white space follows.
SENTENCE_END = ".!?"

# Letter and digit runs.
TOKEN = r"[\p{L}\p{N}]+"


def strip(col: Column) -> Column:
    """Remove white space at both ends."""
    return F.regexp_replace(col, rf"^{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")


def is_blank(col: Column) -> Column:
    return strip(col) == ""


def split_words(col: Column) -> Column:
    """Words of a text, in order."""
    return F.filter(F.split(col, f"{WHITE_SPACE}+"), lambda word: word != "")


def split_sentences(col: Column) -> Column:
    """Sentences of a text, stripped; a cut lies at white space after a sentence end."""
    pieces = F.split(col, f"(?<=[{SENTENCE_END}]){WHITE_SPACE}+")
    return F.filter(F.transform(pieces, strip), lambda piece: piece != "")


def analyze(col: Column) -> Column:
    """Lower-case letter and digit runs, the tokens of full-text search."""
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))
