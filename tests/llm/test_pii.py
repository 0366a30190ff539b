"""Personal data: plain spans against the patterns as given, disguised ones by their source characters."""

import hashlib
import random
import re

import pytest

from quillstream.llm import pii as op

SCHEMA = "doc_id bigint, text string, spans string, n_email int"
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - (9 if digit > 4 else 0)
    return total % 10 == 0


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        own = []
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            good = True
            if kind == 1:
                good = all(int(part) <= 255 for part in match.group().split("."))
            elif kind == 2:
                good = 16 <= len(digits) <= 19 and luhn(digits)
            elif kind == 3:
                good = 8 <= len(digits) <= 15
            if good:
                own.append(match.span())
        found.append(own)
    return found


# text, the disguised parts of it by kind
wide = "".join(chr(0xFF10 + int(d)) for d in "4012888888881881")
DISGUISED = [
    ("write john.doe at example dot com now", [("email", "john.doe at example dot com")]),
    ("john [at] example (dot) org!", [("email", "john [at] example (dot) org")]),
    ("ask jane.d7 at mail3.example.com now, look at example.com", [("email", "jane.d7 at mail3.example.com")]),
    ("ask jane [at] host dot co.uk", [("email", "jane [at] host dot co.uk")]),
    ("(jane(at)host.org)", [("email", "jane(at)host.org")]),
    (f"x jo{chr(0x200B)}hn@ex{chr(0x430)}mple.com y", [("email", f"jo{chr(0x200B)}hn@ex{chr(0x430)}mple.com")]),
    (f"j{chr(0xFF20)}b{chr(0xFF0E)}de", [("email", f"j{chr(0xFF20)}b{chr(0xFF0E)}de")]),
    ("call plus four nine one seven two five five five one two", [("phone", "plus four nine one seven two five five five one two")]),
    ("ip one nine two dot one six eight dot one dot five", [("ip", "one nine two dot one six eight dot one dot five")]),
    ("card 4O12 8888 8888 I88l ok", []),
    ("card 4O12 8888 8888 1881 and 4012888888881881", [("card", "4O12 8888 8888 1881")]),
    (f"é {wide}.", [("card", wide)]),
    ("vier null eins zwei acht acht acht acht acht acht acht acht eins acht acht eins", [("card", "vier null eins zwei acht acht acht acht acht acht acht acht eins acht acht eins")]),
    ("we meet at noon. dot by dot, one two three, un deux de trois la quatre at the house", []),
    ("a@b.c at d dot e", []),
    ("+44 20 7946 zero nine five eight", [("phone", "+44 20 7946 zero nine five eight")]),
    ("+44 20 7946 0958 one day", []),
    ("bob@mail.example dot com", [("email", "bob@mail.example dot com")]),
    ("ask john at gmail.com, alice at example.org.", [("email", "john at gmail.com"), ("email", "alice at example.org")]),
    ("look at example.com, meet us at example.org, met at noon.then", []),
    ("+1 (five five five) one two three four", [("phone", "+1 (five five five) one two three four")]),
    ("+1 five five five, one two three four", [("phone", "+1 five five five, one two three four")]),
    ("one, two, three, four (five)", []),
]


@pytest.mark.parametrize("text, wanted", DISGUISED)
def test_disguised_spans_map_to_the_source(text, wanted):
    found = op.disguised(text, op.detect(text))
    assert [(kind, text[a:b]) for kind, own in zip(op.KINDS, found) for a, b in own] == wanted


def test_plain_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice("aZ0123459.@+- ()_%é") for _ in range(rng.randint(0, 60)))
        assert op.detect(text) == plain(text), text


def test_query(spark):
    rng = random.Random(4)
    texts = [text for text, _ in DISGUISED] + [None, "", "x" * 300_000, "1.2.3.4 " * 2000, "a.b@c.de +1 (212) 555-0951 4012 8888 8888 1881 10.0.0.1"]
    texts += ["".join(rng.choice("a05.@+ -") for _ in range(200)) for _ in range(30)]
    rows = [(i, text, "clash", 7) for i, text in enumerate(texts)] + [(None, "m@n.op", None, None), (0, texts[0], "again", 1)]
    for row in op.personal_data(spark.createDataFrame(rows, SCHEMA)).collect():
        text = (texts[row.doc_id] or "") if row.doc_id is not None else "m@n.op"
        base = plain(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(own) for own in base]
        assert row.base_sha256 == hashlib.sha256(op.written(base).encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert set(op.written(base).split(",")) - {""} <= set(spans)
        assert len(spans) == sum(map(len, base)) + row.n_disguised
        assert spans == sorted(spans, key=lambda s: (op.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
    assert op.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


def test_places_survive_several_rewritings():
    text = f"{chr(0x200B)}a{chr(0x430)}bc"
    once = op.rewrite(op.unchanged(text), op.homoglyph_edits(text))
    assert (once.text, once.source(0, 1), once.source(1, 2), once.source(2, 4)) == ("aabc", (1, 2), (2, 3), (3, 5))
    twice = op.rewrite(once, [(1, 3, "X")])
    assert (twice.text, twice.source(1, 2), twice.source(2, 3), twice.source(0, 3)) == ("aXc", (2, 4), (4, 5), (1, 5))


@pytest.mark.parametrize("text", ["a" * 10**5, "1" * 10**5, "1." * 10**5, "a@" * 10**5, "+1" + " " * 10**5, "one " * 10**4, " dot " * 10**4, "a at " + "b." * 10**4])
def test_long_texts_take_linear_time(text):
    op.disguised(text, op.detect(text))
