import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapsync.llm import chat
from snapsync.llm.queries import MARKED

SCHEMA = "conv_id long, turn long, role string, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def digests(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in sorted(
        rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    ):
        conversations[conv].append((role or "", text or ""))
    out = {}
    for conv, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


@given(st.text(alphabet="<|\\>ima_ \n", max_size=30), st.text(alphabet="<|\\>n\n a", max_size=12))
def test_escapes_are_reversible_and_break_nothing(text, role):
    assert chat.unescaped(chat.escaped(text)) == text
    assert "<|" not in chat.escaped(text) and "<|" not in chat.escaped_role(role)
    whole = "".join(s for s, _ in chat.turn_segments(role, text, chat.CHATML)) * 2
    assert chat.Parser(chat.CHATML).turns(whole) == [(role, text)] * 2


ROWS = [
    (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", MARKED), (2, 5, "assistant", "first"),
    (2, 9, "user", None), (3, 0, "user", "x"), (3, 0, "user", "x"), (3, 1, "assistant", "é\U0001f600"),
    (None, 0, "user", "n"), (None, 1, None, "<\\|im_end|>"), (4, None, "user", ""), (4, 1, "assistant", "<"),
    (5, 0, "user", "long " * 50_000), (5, 1, "assistant", "y" * 300_000),
]


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"state": F.lit(1), "segments": F.lit("x")})
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(df)).collect()}
    assert {c: tuple(r)[1:5] for c, r in got.items()} == digests(ROWS)
    assert {c for c, r in got.items() if r.valid} == {1, 4, 5}
    whole = "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<<|im_end|>\n"
    assert got[4].formatted_chars == len(whole)


def test_loss_is_on_the_answers_alone(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for r in chat.formatted(df).collect():
        opened = re.match(r"<\|im_start\|>(.*)\n", r.segments[0].text)[1]
        assert [s.loss for s in r.segments] == [False, opened == "assistant", False]


def test_long_conversation_streams(spark):
    df = spark.range(30_000).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    (row,) = chat.read_back(chat.formatted(df)).collect()
    loss = "".join(str(i) for i in range(1, 30_000, 2))
    assert (row.n_turns, row.loss_chars, row.loss_sha256, row.valid) == (30_000, len(loss), sha(loss), True)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.formatted(df)).count() == 0


def test_broken_text_is_refused():
    with pytest.raises(ValueError):
        chat.Parser(chat.CHATML).turns("<|im_start|>user\nhello")


def test_query(spark, sf_dir):
    from snapsync.llm.queries import op8_chat

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)]
    assert {r.conv_id: tuple(r)[1:5] for r in op8_chat(spark, sf_dir).collect()} == digests(rows)


def test_turns_are_formatted_before_they_are_dealt(spark):
    plan = chat.read_back(chat.formatted(spark.createDataFrame(ROWS, SCHEMA)))._jdf.queryExecution().toString()
    before = plan.split("RepartitionByExpression", 1)[1].split("== ")[0]
    assert "MapInArrow" in before


def test_sums_of_turns_with_marks(spark):
    rows = [(1, 0, "us<|er\\\n", "<|a<\\|"), (1, 0, "us<|er\\\n", "<!"), (1, 0, "us<|er\\\n", "<|")]
    rows += [(1, 1, "assistant", "<|é"), (1, 1, "assistant", "<\\|")]
    got = chat.read_back(chat.formatted(spark.createDataFrame(rows, SCHEMA))).first()
    assert tuple(got)[1:5] == digests(rows)[1]
    wholes = ["".join(t for t, _ in chat.turn_segments(r, t, chat.CHATML)) for _, _, r, t in rows]
    assert got.formatted_chars == len("".join(wholes))


def test_digests_come_from_the_segments(spark):
    """A segment that is changed after the turn was formatted changes what is read back."""
    df = spark.createDataFrame([(1, 0, "user", "<|a"), (1, 1, "assistant", "b <|im_end|> c")], SCHEMA)
    turns = chat.formatted(df)
    assert "plain" not in turns.columns
    right = chat.read_back(turns).first()
    spoilt = F.transform("segments", lambda s: F.struct(F.replace(s["text"], F.lit("\\"), F.lit("\\\\")).alias("text"), s["loss"].alias("loss")))
    wrong = chat.read_back(turns.withColumn("segments", spoilt)).first()
    assert wrong.turns_sha256 != right.turns_sha256 and wrong.loss_sha256 != right.loss_sha256
    assert wrong.loss_chars == right.loss_chars + 1
    # A mark that is made by two turns together, and a turn that is never closed.
    cut = F.when(F.col("position") == 0, F.slice("segments", 1, 2)).otherwise(F.col("segments"))
    (joined,) = chat.read_back(turns.withColumn("segments", cut)).collect()
    assert joined.n_turns == 1
    open_ended = F.slice("segments", 1, 2)
    with pytest.raises(Exception, match="no turn at"):
        chat.read_back(turns.withColumn("segments", open_ended)).collect()


def test_parser_takes_pieces():
    parser = chat.Parser(chat.CHATML)
    whole = "".join(t for r in ("user", "assistant") for t, _ in chat.turn_segments(r, "x<|y", chat.CHATML))
    found = [turn for i in range(len(whole)) for turn in parser.feed(whole[i])]
    parser.end()
    assert found == [("user", "x<|y"), ("assistant", "x<|y")]
