"""Chat formatting with Spark expressions only.

A conversation becomes one string. Runs of turns of one role are merged into a
block, and every text in it keeps its own segment:

    <turn>role<text>first text<text>second text</turn>\n

The control strings are ``<turn>``, ``</turn>`` and ``<text>``. Where a role or
a text contains one (with any number of backslashes behind the ``<``), one
backslash is added, so no control string is left inside; reading back takes
one away. Nothing else of a text is changed.

Defined cases: a null role or text is an empty one; a null turn sorts first;
turns with equal numbers are ordered by role, then text, and repeated rows
stay; an empty table gives no rows; extra columns are ignored. A conversation is one training
example, so its turns are collected into one array by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table

ASSISTANT = "assistant"
END = "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?)(turn|text)>", r"<\\$1$2$3>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?)(turn|text)>", r"<$1$2$3>")


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv, formatted, loss_spans): spans are (start, length) in code points, from 0, of the assistant texts."""
    rows = turns.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def piece(t: Column, i: Column) -> Column:
        """Head, body and tail of one turn: merged runs share one head and one tail."""
        opens = (i == 0) | (F.get("ts", i - 1)["role"] != t["role"])
        closes = (i == F.size("ts") - 1) | (F.get("ts", i + 1)["role"] != t["role"])
        return F.struct(
            F.concat(F.when(opens, F.concat(F.lit("<turn>"), escape(t["role"]))).otherwise(""),
                     F.lit("<text>")).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(closes, F.lit(END)).otherwise("").alias("tail"),
            (t["role"] == ASSISTANT).alias("learn"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        span = F.struct(start.cast("long").alias("start"), F.length(p["body"]).cast("long").alias("length"))
        return F.struct(
            (start + F.length(p["body"]) + F.length(p["tail"])).cast("long").alias("at"),
            F.when(p["learn"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    empty = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return (convs.select("conv", F.transform("ts", piece).alias("ps"))
            .select(F.col("conv").alias(conv),
                    F.array_join(F.transform("ps", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
                    .alias("formatted"),
                    F.aggregate("ps", empty, step)["spans"].alias("loss_spans")))


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order, as array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, F.lit(END)), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        parts = F.split(F.substr(block, F.lit(len("<turn>") + 1)), F.lit("<text>"))
        return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1),
                           lambda p: F.struct(unescape(F.get(parts, F.lit(0))).alias("role"),
                                              unescape(p).alias("text")))
    return F.flatten(F.transform(blocks, turns_of))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


_ESCAPED = r"""regexp_replace({0}, '<(\\*)(/?)(turn|text)>', '<\\\1\2\3>', 'g')"""
ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
p AS (
  SELECT *, coalesce(lag(role) OVER w <> role, true) AS opens, coalesce(lead(role) OVER w <> role, true) AS closes
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format('text')}) + 6
           + CASE WHEN opens THEN 6 + length({_ESCAPED.format('role')}) ELSE 0 END
           + CASE WHEN closes THEN 8 ELSE 0 END)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""


@query("op8_chat_format", ORACLE)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -7 whose texts hold control strings, formatted and read back."""
    trap = r"\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
                                F.lit(trap).alias("text"))
    out = format_conversations(table(spark, sf_dir, "conversations").unionByName(own))
    back = out.select("conv_id", "formatted", parse_formatted(F.col("formatted")).alias("turns"),
                      loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
