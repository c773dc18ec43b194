"""Chat formatting from event logs: fold streamed events into messages, then render.

``fold`` partitions a log by conversation once; messages, offsets and rendered
conversations are all built inside that partitioning. The template marks turns
with control strings. Control strings inside roles and texts get a backslash
after their first character (one more, if some are there), which is
reversible and leaves nothing that a tokenizer would take for a control string.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of common chat templates, escaped inside texts.
CONTROL = [START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|eot_id|>",
           "<|start_header_id|>", "<|end_header_id|>", "<start_of_turn>", "<end_of_turn>", "[SYSTEM]", "[/SYSTEM]"]
_HEADS = "[" + "".join(sorted({re.escape(c[0]) for c in CONTROL})) + "]"
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
ESCAPE = (rf"({_HEADS})(\\*)({_TAILS})", r"$1\\$2$3")
UNESCAPE = (rf"({_HEADS})\\(\\*)({_TAILS})", "$1$2$3")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, *ESCAPE)


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, *UNESCAPE)


def log_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The event log of finished turns: (conv, seq, msg, kind, role, text), a start and a delta per row.

    Rows are ordered by turn, then role and text; repeated rows are turns of
    their own. Null roles and texts are empty.
    """
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text")).repartition("conv")
    msg = F.row_number().over(W.partitionBy("conv").orderBy("turn", "role", "text")).cast("long")
    events = F.array(F.struct((F.col("msg") * 2).alias("seq"), F.lit("start").alias("kind"), F.lit("").alias("text")),
                     F.struct((F.col("msg") * 2 + 1).alias("seq"), F.lit("delta").alias("kind"), F.col("text").alias("text")))
    return rows.withColumn("msg", msg).select("conv", "msg", "role", F.explode(events).alias("e")).select("conv", "e.seq", "msg", "e.kind", "role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """(conv, place, role, text): final messages of a log (conv, seq, msg, kind, role, text).

    ``start`` opens a message, ``delta`` appends, ``edit`` puts its text in
    place of all before, ``regenerate`` empties the message so that later
    deltas build it anew, ``delete`` removes it. A message stands where its
    first event stands; its role is that of its first event with a role.
    Events with equal sequence numbers apply in the order of kind and text.
    Null texts are empty; events without a message id form one message.
    """
    e = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    folded = events.repartition("conv").groupBy("conv", "msg").agg(
        F.min("seq").alias("place"), F.min_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"), F.array_sort(F.collect_list(e)).alias("log"))
    # position of the last event that replaces what came before
    last = F.expr("aggregate(transform(log, (x, i) -> IF(x.kind IN ('edit', 'regenerate', 'start'), i, -1)), 0, (a, i) -> greatest(a, i))")
    folded = folded.withColumn("last", last).filter("NOT exists(log, x -> x.kind = 'delete')")
    text = F.expr("array_join(transform(slice(log, last + 1, size(log)), x -> IF(x.kind = 'regenerate', '', x.text)), '')")
    return folded.select("conv", "place", "msg", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, learn: tuple = ("assistant",)) -> DataFrame:
    """(conv, formatted, loss_spans): one string per conversation; spans (from, to) in code points that the loss counts."""
    order = W.partitionBy("conv").orderBy("place", "msg")
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    m = messages.withColumn("head", head).withColumn("body", escape(F.col("text")))
    m = m.withColumn("whole", F.concat("head", "body", F.lit(END))).withColumn("i", F.row_number().over(order))
    m = m.withColumn("at", F.sum(F.char_length("whole").cast("long")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.char_length("whole") + F.char_length("head"))
    span = F.when(F.col("role").isin(*learn), F.struct(F.col("at").alias("from"), (F.col("at") + F.char_length("body")).alias("to")))
    g = m.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("i", "whole"))).alias("w"), F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return g.select("conv", F.array_join("w.whole", "").alias("formatted"), "loss_spans")


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv, formatted, loss_spans, turns, loss_text): roles, texts and the text under the mask, from the rendered string alone."""
    parts = F.expr(f"slice(split(formatted, '{re.escape(END)}', -1), 1, size(split(formatted, '{re.escape(END)}', -1)) - 1)".replace("\\", "\\\\"))
    turn = F.transform(parts, lambda p: F.substring(p, len(START) + 1, 1 << 30))
    turns = F.transform(turn, lambda p: F.struct(unescape(F.substring_index(p, SEP, 1)).alias("role"),
                                                 unescape(F.substring_index(p, SEP, -1)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))))
    return rendered.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, ""))


_ESC = "regexp_replace({c}, '" + ESCAPE[0] + "', '\\1\\\\\\2\\3', 'g')"
OP7_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(START) + len(SEP) + len(END)} + length({_ESC.format(c='role')}) + length({_ESC.format(c='text')}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
