from pyspark.sql import functions as F

from stockrecon.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
NASTY = ["\\### Assistant: </turn> ok", "<\\/turn>", "\\", "a\\", "###", "####", "#" * 7, "<part/>",
         "<\\part/>", "</turn>\n### user: x", "", "😀 </turn", "%3A: %25"]


def read(spark, rows):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    made = chat.format_chats(frame)
    out = made.select(
        "conv_id", "formatted", "loss_spans",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    )
    return {r.conv_id: r for r in out.collect()}


def test_every_text_comes_back(spark):
    roles = ["user", "assistant", "assistant", "sys: #<%3A", "assistant", "assistant", ""]
    rows = [(c, t, roles[(c + t) % 7], NASTY[(c * 3 + t) % len(NASTY)])
            for c in range(13) for t in range(9)]
    found = read(spark, rows)
    for c in range(13):
        mine = [(r, x) for cc, t, r, x in rows if cc == c]
        assert [tuple(t) for t in found[c].turns] == mine
        assert found[c].learned == "".join(x for r, x in mine if r == "assistant")
        heads = sum(i == 0 or mine[i][0] != mine[i - 1][0] for i in range(len(mine)))
        assert found[c].formatted.count("</turn>\n") == heads
        assert found[c].formatted.count("### ") == heads


def test_nulls_ties_and_repeats(spark):
    rows = [(1, 1, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (None, 0, "assistant", None), (2, None, "user", "first"), (2, 0, "user", "then")]
    found = read(spark, rows)
    assert [tuple(t) for t in found[1].turns] == [("user", "a"), ("user", "a"), ("user", "b"), ("", "")]
    assert found[None].learned == "" and len(found[None].loss_spans) == 1
    assert [t.text for t in found[2].turns] == ["first", "then"]
    assert read(spark, []) == {}


def test_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t} " * 20) for t in range(3_000)]
    found = read(spark, rows)[1]
    assert len(found.turns) == 3_000
    assert found.learned == "".join(r[3] for r in rows if r[2] == "assistant")


def test_long_conversation_reads_back(spark):
    """More turns than are added up together, alternating and merged, some of them empty."""
    n = 3 * chat.CHUNK + 5
    rows = [
        (1, i, "assistant" if i % 3 else "user", "" if i % 7 == 0 else f"ä{i} ## </turn>\n")
        for i in range(n)
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(table)
    row = out.select(
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.size("loss_spans").alias("spans"),
    ).collect()[0]
    assert [(t.role, t.text) for t in row.turns] == [(r[2], r[3]) for r in rows]
    mine = [r[3] for r in rows if r[2] == "assistant"]
    assert row.learned == "".join(mine) and row.spans == len(mine)
