"""Chat formatting checked by a grammar round trip, in column expressions only.

    conversation := turn*        turn := "### " role ": " text "</turn>" newline

"### " and "</turn>" are control strings: they occur nowhere else in a formatted conversation. A conversation is first
rendered as it is and parsed again; if the recovered turns are not identical to the source, its conflicting content is
escaped and the result is parsed again. An escape puts one backslash inside the control string (``#\\## ``, ``<\\/turn>``,
and ``:\\ `` in a role); content that already looks like an escape gets one backslash more, so that taking one away from
each always recovers the text.

Null text and null role count as empty. Turns are ordered by turn, then role, then text, null turns first; rows that repeat
are turns of their own. Rows without conv_id form one conversation. An empty table gives no rows. Only the four named columns
are read. A conversation is one value of one row, since its digest runs over all of it; different conversations never meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the template.
HEAD, SEPARATOR, END = "### ", ": ", "</turn>"
LEARNT_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """The text with one backslash more inside everything that is or resembles a control string."""
    text = F.regexp_replace(text, r"#(\\*)## ", r"#\\$1## ")
    return F.regexp_replace(text, r"<(\\*)/turn>", r"<\\$1/turn>")


def unescaped(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)/turn>", r"<$1/turn>")
    return F.regexp_replace(text, r"#\\(\\*)## ", r"#$1## ")


def escaped_role(role: Column) -> Column:
    return F.regexp_replace(escaped(role), r":(\\*) ", r":\\$1 ")


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, r":\\(\\*) ", r":$1 "))


def rendered(turns: Column) -> Column:
    """One string for an array of (role, text)."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(HEAD), t["role"], F.lit(SEPARATOR), t["text"], F.lit(END + "\n"))), "")


def recovered(formatted: Column) -> Column:
    """The array of (role, text) that the grammar reads from a string; a null element where a turn is malformed."""
    pieces = F.split(formatted, END)

    def turn(piece: Column, i: Column) -> Column:
        body = F.when(i > 0, F.regexp_replace(piece, r"^\n", "")).otherwise(piece)
        parts = F.split(body, HEAD)
        content = F.get(parts, F.lit(1))
        role = F.substring_index(content, SEPARATOR, 1)
        fits = (F.size(parts) == 2) & (F.get(parts, F.lit(0)) == "") & content.contains(SEPARATOR)
        return F.when(fits, F.struct(
            unescaped_role(role).alias("role"),
            unescaped(F.substring(content, F.length(role) + len(SEPARATOR) + 1, F.length(content))).alias("text")))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def loss_spans(written: Column, learnt_role: str = LEARNT_ROLE) -> Column:
    """Code point spans (start, end) of the learnt role's texts for turns as written, in order."""
    fixed = len(HEAD) + len(SEPARATOR)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + fixed + F.length(t["role"])
        end = start + F.length(t["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"),
                        F.when(t["role"] == learnt_role, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(written, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def format_chats(rows: DataFrame, learnt_role: str = LEARNT_ROLE) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``, ``escaped`` and ``round_trip``."""
    turns = (rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows")))
    source = turns.select("conv_id", F.transform("rows", lambda r: F.struct(
        r["role"].alias("role"), r["text"].alias("text"))).alias("source"))
    safe = F.transform("source", lambda t: F.struct(
        escaped_role(t["role"]).alias("role"), escaped(t["text"]).alias("text")))
    plain = (source.withColumn("plain", rendered(F.col("source")))
             .withColumn("escaped", ~F.coalesce(recovered(F.col("plain")) == F.col("source"), F.lit(False))))
    chosen = plain.withColumn("written", F.when(F.col("escaped"), safe).otherwise(F.col("source")))
    done = chosen.withColumn("formatted", F.when(F.col("escaped"), rendered(F.col("written"))).otherwise(F.col("plain")))
    return done.select(
        "conv_id", "formatted", loss_spans(F.col("written"), learnt_role).alias("loss_spans"), "escaped",
        F.coalesce(recovered(F.col("formatted")) == F.col("source"), F.lit(False)).alias("round_trip"))


def read_back(chats: DataFrame) -> DataFrame:
    """``conv_id``, the parsed ``turns`` and the unescaped ``loss_text`` of formatted conversations."""
    masked = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return chats.select("conv_id", "formatted", recovered(F.col("formatted")).alias("turns"), masked.alias("loss_text"),
                        "escaped", "round_trip")
