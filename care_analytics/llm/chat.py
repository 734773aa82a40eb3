"""Chat formatting with DataFrame expressions only.

Turns are sorted by (turn, role, text); adjacent turns of one role form a block:

    <|role|>\\n text <|part|> text <|end|>\\n

(without the spaces).  In roles and texts the characters of control strings are
written as escapes (``\\s`` backslash, ``\\l`` <, ``\\p`` |, ``\\b`` [), so no text
can hold a control string of this or of bracket-style templates, and reading
back is exact.  ``loss_spans`` are the assistant texts in the formatted string.

Window and grouping share one shuffle by conversation; a conversation's string
is one value, so its turns meet in one task by the nature of the result.

Defined cases: null text or role is empty; a null turn sorts first; turns with
the same number are ordered by role and text, repeated rows stay repeated; rows
with a null conv_id form one conversation; an empty table stays empty; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
OPEN, SHUT, PART, END = "<|", "|>\n", "<|part|>", "<|end|>\n"
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("|", "\\p"), ("[", "\\b"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, ``formatted`` and ``loss_spans`` (start and length in characters, from 0)."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.lag("role").over(order)
    header = F.length(escaped(F.col("role"))) + len(OPEN) + len(SHUT)
    # where a turn's text starts: what it adds in front of its text, and all that earlier turns have added
    lead = (F.when(before.isNull(), header)
            .when(before == F.col("role"), F.lit(len(PART)))
            .otherwise(header + len(END)))
    rows = rows.withColumn("lead", lead).withColumn("size", F.length(escaped(F.col("text"))))
    rows = rows.withColumn("start", F.sum(F.col("lead") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    sorted_turns = (rows.groupBy("conv_id")
                    .agg(F.sort_array(F.collect_list(F.struct("start", escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"), "size"))).alias("turns")))
    firsts = sorted_turns.withColumn("firsts", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"])))
    blocks = F.transform("firsts", lambda first, k: F.concat(
        F.lit(OPEN), F.col("turns")[first]["role"], F.lit(SHUT),
        F.array_join(F.transform(
            F.slice("turns", first + 1, F.coalesce(F.get("firsts", k + 1), F.size("turns")) - first), lambda t: t["text"]), PART),
        F.lit(END)))
    spans = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"),
                        lambda t: F.struct(t["start"].alias("start"), t["size"].cast("long").alias("length")))
    return firsts.select("conv_id", F.array_join(blocks, "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, ``turns`` (role, text) parsed from the string, and ``loss_text`` under the mask, both unescaped."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>\n", -1), lambda b: b != "")
    halves = F.transform(blocks, lambda b: F.split(b, r"\|>\n", 2))
    turns = F.flatten(F.transform(halves, lambda h: F.transform(
        F.split(h[1], r"<\|part\|>", -1),
        lambda text: F.struct(unescaped(F.substring(h[0], len(OPEN) + 1, 1 << 30)).alias("role"), unescaped(text).alias("text")))))
    loss = unescaped(F.array_join(F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))), ""))
    return formatted.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))


def chat_digest(turns: DataFrame) -> DataFrame:
    back = read_back(formatted_conversations(turns))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


DIGEST_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), m AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         length(regexp_replace(text, '[\\<|\[]', '..', 'g')) AS n_text,
         length(regexp_replace(role, '[\\<|\[]', '..', 'g')) AS n_role
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(n_text + CASE WHEN before = role THEN 8 ELSE n_role + 13 END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
