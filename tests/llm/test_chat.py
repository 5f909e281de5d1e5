import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import chat

TURNS = "conv_id long, turn long, role string, text string"
PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", "<", "[", "/", "s>", "\n", "é", "😀", "ok", " ", "<\\/s>", "[\\\\INST]", "\\n", "]"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """From the turns alone; ``formatted_chars`` left out."""
    talks = {}
    for row in rows:
        key = (row.turn is not None, row.turn or 0, row.role or "", row.text or "")
        talks.setdefault(row.conv_id, []).append(key)
    out = {}
    for conv_id, turns in talks.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv_id] = (len(turns), sha(said), len(loss), sha(loss))
    return out


def nasty(spark, n=120):
    rng = random.Random(5)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(12)))
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "to\nol\\", "<s>x"]), text()))
    rows += [(500, None, "user", "first"), (500, 1, None, None), (500, 1, "assistant", None), (500, 1, "assistant", None)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (501, 0, "assistant", ""), (502, 0, "user", "</s>" * 3000)]
    return spark.createDataFrame(rows, TURNS)


def read(df):
    return {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.examples(df)).collect()}


def test_round_trip(spark):
    df = nasty(spark)
    assert read(df.repartition(6)) == plain(df.collect())
    clashing = df.selectExpr("*", "'x' AS turns", "1 AS example", "2 AS written", "3 AS at", "4 AS ends")
    assert read(clashing) == plain(df.collect())
    assert chat.read_back(chat.examples(df.where("false"))).count() == 0


def test_each_reply_is_an_example_with_all_before_it(spark):
    df = nasty(spark)
    turns = df.select("conv_id", "turn", "role", "text").collect()
    made = chat.examples(df).collect()
    for conv_id in range(120):
        mine = sorted((r.turn, r.role, r.text) for r in turns if r.conv_id == conv_id)
        ends = [i for i, t in enumerate(mine) if t[1] == "assistant" or i == len(mine) - 1]
        found = sorted((r for r in made if r.conv_id == conv_id), key=lambda r: r.example)
        assert [r.example for r in found] == list(range(1, len(ends) + 1))
        assert [r.last for r in found] == [False] * (len(ends) - 1) + [True]
        for row, end in zip(found, ends):
            assert row.text.count("</s>") == end + 1 == row.text.count("<s>")
            assert "[INST]" not in row.text and "[/INST]" not in row.text
            masked = row.text[row.loss_start : row.loss_end]
            if mine[end][1] == "assistant":
                assert row.text[row.loss_end :] == "</s>" and row.text[: row.loss_start].endswith("<s>assistant\n")
                assert "</s>" not in masked
            else:
                assert masked == "" and row.last


@pytest.mark.parametrize("role", [False, True])
def test_escape_is_reversible(spark, role):
    rng = random.Random(9)
    rows = [("".join(rng.choice(PIECES) for _ in range(rng.randrange(15))),) for _ in range(3000)]
    there, back = (chat.escaped_role, chat.unescaped_role) if role else (chat.escaped, chat.unescaped)
    df = spark.createDataFrame(rows, "t string").withColumn("e", there(F.col("t"))).withColumn("b", back(F.col("e")))
    for row in df.collect():
        assert row.b == row.t and not any(c in row.e for c in chat.CONTROLS) and not (role and "\n" in row.e)


def test_planted_conversation(spark):
    row = chat.read_back(chat.examples(chat.with_planted(nasty(spark)))).where("conv_id = -1").head()
    text = chat.PLANTED_TEXT
    assert (row.n_turns, row.turns_sha256) == (2, sha(f"user\n{text}\nassistant\n{text}\n"))
    assert (row.loss_chars, row.loss_sha256) == (len(text), sha(text))


def test_one_shuffle_and_no_python(spark):
    df = nasty(spark)
    plan = chat.read_back(chat.examples(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan
