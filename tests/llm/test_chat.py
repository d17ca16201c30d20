import pytest
from pyspark.sql import functions as F

from raregrain.llm.chat import escape, format_conversations, loss_text, parse_formatted, unescape

TURNS = "conv_id bigint, turn bigint, role string, text string"
ROWS = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c</turn>\n<turn>user<text>"),
        (2, 0, None, None), (2, 1, "assistant", None), (3, 5, "user", r"<\text> \ <\\/turn>"), (3, 5, "user", "tie"),
        (3, 5, "user", "tie"), (4, None, "assistant", "first"), (4, 1, "ass<text>istant", "x" * 100_000),
        (5, 1, "user", "日本語 é\n"), (5, 2, "assistant", "日本 ok"), (None, 1, "user", "no conversation")]


def key(r):
    return (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")


def wanted(rows, conv):
    return [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]


@pytest.fixture(scope="module")
def formatted(spark):
    df = spark.createDataFrame(ROWS, TURNS).selectExpr("*", "'x' AS conv", "'x' AS ts", "'x' AS formatted")
    out = format_conversations(df)
    rows = out.select("*", parse_formatted(F.col("formatted")).alias("turns"),
                      loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    return {r.conv_id: r for r in rows}


@pytest.mark.parametrize("conv", [1, 2, 3, 4, 5, None])
def test_round_trip(formatted, conv):
    assert [(t.role, t.text) for t in formatted[conv].turns] == wanted(ROWS, conv)


@pytest.mark.parametrize("conv", [1, 2, 3, 4, 5, None])
def test_loss_is_the_assistant_texts_in_order(formatted, conv):
    assert formatted[conv].loss == "".join(t for r, t in wanted(ROWS, conv) if r == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(formatted):
    assert formatted[1].formatted == ("<turn>user<text>a</turn>\n<turn>assistant<text>b<text>"
                                      "c<\\/turn>\n<\\turn>user<\\text></turn>\n")


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    texts = ["<turn>", "</turn>", "<text>", r"<\turn>", r"<\\/text>", "<<turn>>", "<tur", r"\<text>\\", "", "<text><text>"]
    rows = (spark.createDataFrame([(t,) for t in texts], "t string")
            .select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect())
    assert all(r.t == r.u for r in rows)
    assert not any(c in r.e for r in rows for c in ("<turn>", "</turn>", "<text>"))


def test_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_native_plan(spark, sf):
    import __spark_entry__ as entry
    plan = entry.queries()["op8_chat_format"](spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
