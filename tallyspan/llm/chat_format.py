"""Operator 5, chat formatting: conversations as one training text each, relationally.

Turns are collected as structs and sorted; adjacent turns of one role become one block;
blocks are joined into a text.  Only Spark expressions are used.

A block is ``### role: text</next>text</turn>`` and a line end.  In roles and texts the
characters the marks are made of are written as escapes (``\\`` as ``\\b``, ``#`` as ``\\h``,
``<`` as ``\\l``, in roles also ``:`` as ``\\c``), so no text can hold a mark, and reading
back is exact.

Defined results: NULL text or role counts as empty; turns are ordered by (turn, role, text),
NULL turns first, so ties and repeated rows have one order; rows whose conv_id is NULL form
one conversation; an empty table gives no rows; columns beyond the four are ignored.  One
conversation is one output row, so it has to fit in a row; conversations spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import query, table

# The marks of the template.
HEAD, COLON, NEXT, END = "### ", ": ", "</next>", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
TRAINED_ROLE = "assistant"


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, mark in pairs:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, mark in reversed(pairs):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """conv_id, formatted (the training text), segments (its pieces in order, each with
    whether the loss covers it; the pieces joined are the text)."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct("turn", empty("role").alias("role"), empty("text").alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    # where a block starts, and after the last turn
    new_role = lambda t, i: ~t["role"].eqNullSafe(F.get("_turns", i - 1)["role"])
    firsts = F.filter(F.transform("_turns", lambda t, i: F.when(new_role(t, i), i)), lambda i: i.isNotNull())
    bounds = sorted_turns.withColumn("_bounds", F.concat(firsts, F.array(F.size("_turns"))))
    block = lambda i, k: F.struct(
        F.get("_turns", i)["role"].alias("role"),
        F.slice("_turns", i + 1, F.get("_bounds", k + 1) - i)["text"].alias("texts"),
    )
    blocks = bounds.withColumn(
        "_blocks", F.transform(F.slice("_bounds", 1, F.size("_bounds") - 1), block)
    )
    piece = lambda text, loss: F.struct(text.alias("piece"), loss.alias("loss"))
    merged = lambda b: F.concat(
        F.array(piece(F.concat(F.lit(HEAD), escape(b["role"], ROLE_ESCAPES), F.lit(COLON)), F.lit(False))),
        F.flatten(
            F.transform(
                b["texts"],
                lambda text, i: F.array(
                    piece(F.when(i > 0, F.lit(NEXT)).otherwise(F.lit("")), F.lit(False)),
                    piece(escape(text), b["role"] == trained_role),
                ),
            )
        ),
        F.array(piece(F.lit(END), F.lit(False))),
    )
    pieces = blocks.select("conv_id", F.flatten(F.transform("_blocks", merged)).alias("segments"))
    return pieces.select("conv_id", F.array_join(F.col("segments.piece"), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns a formatted text was made of: array of (role, text)."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    head = lambda b: F.instr(b, COLON)
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substr(b, head(b) + len(COLON)), NEXT),
                lambda text: F.struct(
                    unescape(F.substr(b, F.lit(len(HEAD) + 1), head(b) - len(HEAD) - 1), ROLE_ESCAPES).alias("role"),
                    unescape(text).alias("text"),
                ),
            ),
        )
    )


def read_loss(segments: Column) -> Column:
    """All text the loss covers, as it was before escaping."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["piece"])), "")


_ESC = lambda c: f"replace(replace(replace({c}, '\\', '\\b'), '#', '\\h'), '<', '\\l')"
SQL = f"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
l AS (SELECT *, role IS NOT DISTINCT FROM lag(role) OVER w AS joined FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESC("text")}) + CASE WHEN joined THEN {len(NEXT)}
    ELSE {len(HEAD + COLON + END)} + length(replace({_ESC("role")}, ':', '\\c')) END) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id"""


@query("op5_chat_format", SQL)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    sample = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(sample)
    out = format_conversations(turns)
    read = out.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss")
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
