"""Chat formatting against a plain fold of the log."""

import random

import pytest
from pyspark.sql import functions as F

from quillstream.llm import chat as op

EVENTS = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string, formatted string"


def folded(log):
    """Event by event, in the order of the log."""
    once = {}
    for conv, message, seq, kind, role, text in log:
        event = (kind or "delta", role or "", text or "")
        key = (conv, message, seq)
        once[key] = max(once.get(key, event), event)
    talks = {}
    for (conv, message, seq), (kind, role, text) in sorted(once.items(), key=lambda x: x[0][2]):
        talk = talks.setdefault(conv, {})
        if kind == "regenerate":
            for later in [m for m in talk if m > message]:
                del talk[later]
        old_role, old = talk.get(message, ("", ""))
        talk[message] = (role or old_role, text if kind != "delta" else old + text)
    return {conv: [talk[m] for m in sorted(talk)] for conv, talk in talks.items()}


def formatted(turns):
    mark = lambda s: s.replace("\\", "\\b").replace("<", "\\l")
    return "".join(f"<turn>{mark(role)}<text>{mark(text)}</turn>\n" for role, text in turns)


def check(spark, log):
    frame = spark.createDataFrame([(*row, "clash") for row in log], EVENTS).repartition(3)
    found = {r.conv_id: r for r in op.read_back(op.format_conversations(frame)).collect()}
    wanted = folded(log)
    assert found.keys() == wanted.keys()
    for conv, turns in wanted.items():
        assert found[conv].formatted == formatted(turns)
        assert [(t.role, t.text) for t in found[conv].turns] == turns
        assert found[conv].loss_texts == [text for role, text in turns if role == "assistant"]


def test_kinds(spark):
    check(spark, [
        (1, 0, 1, "start", "user", "hi"), (1, 1, 2, "start", "assistant", ""), (1, 1, 3, "delta", None, "one "), (1, 1, 4, None, None, "two"),
        (1, 2, 5, "start", "user", "no"), (1, 1, 6, "regenerate", None, None), (1, 1, 7, "delta", "assistant", "three"),
        (1, 1, 7, "delta", "assistant", "three"), (1, 2, 8, "start", "user", "thanks"), (1, 0, 9, "edit", None, "hello"),
        (1, 0, 10, "delta", None, "!"), (2, 0, 1, "delta", None, None), (3, 5, 1, "start", "user", "gone"), (3, 4, 2, "regenerate", "assistant", ""),
        (None, 0, 1, "start", "x<y\\", "\\### Assistant: </turn> ok <text>\n\\l\\b"), (4, 0, 1, "start", "user", "é🙂" * 9000),
        (4, 1, 2, "start", "assistant", "</turn>\n" * 5000),
    ])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_logs(spark, seed):
    rng = random.Random(seed)
    log = []
    for seq in range(600):
        kind = rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate", None])
        log.append((rng.randrange(8), rng.randrange(6), seq, kind, rng.choice(["user", "assistant", None]), rng.choice(["a", "<", "\\", "lb", "</turn>", None])))
    rng.shuffle(log)
    check(spark, log + rng.sample(log, 50))


def test_table_rows_come_back(spark):
    rows = [(1, 1, "assistant", "abc"), (1, 0, "user", None), (1, 1, "assistant", "abd"), (1, 2, "system", "<s>"), (None, None, None, "x"), (1, 0, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: r for r in op.read_back(op.format_conversations(op.log_of(frame))).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [("user", ""), ("user", ""), ("assistant", "abc"), ("assistant", "abd"), ("system", "<s>")]
    assert [(t.role, t.text) for t in found[None].turns] == [("", "x")]


def test_empty_and_plan(spark):
    empty = spark.createDataFrame([], EVENTS)
    done = op.digests(op.format_conversations(empty))
    assert done.count() == 0
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_escape_is_reversible(spark):
    texts = ["\\", "\\l", "\\b", "<\\<", "\\\\b<", "l\\", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r.t == r.u for r in frame.select("t", op.unescape(op.escape(F.col("t"))).alias("u")).collect())
