"""Chat logs folded into final messages and rendered for training.

A log holds events: ``message`` opens a message of a turn, ``delta`` appends to it, ``edit`` replaces its
text, ``regenerate`` empties it and voids what was said in later turns. Events of one conversation are
ordered by sequence number; each message is folded on its own, and only final messages are gathered per
conversation, because a rendered conversation is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The control strings of the template.
BEGIN, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
# A control string, or one that was escaped before, in three parts: first character, backslashes, rest.
CONTROL = "(<)(\\\\*)(/?s>)|(\\[)(\\\\*)(/?INST\\])"
ESCAPED = "(<)(\\\\*)\\\\(/?s>)|(\\[)(\\\\*)\\\\(/?INST\\])"
LEARNED = "assistant"
# Code points of a streamed delta.
DELTA_CHARS = 200


def escape(text: Column) -> Column:
    """Put one more backslash behind the first character of every control string."""
    return F.regexp_replace(text, CONTROL, "$1$4$2$5\\\\$3$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$4$2$5$3$6")


def events_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """A finished conversation as a log: every row opens one message."""
    return turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("seq"),
                        F.col(turn).cast("long").alias("turn"), F.lit("message").alias("kind"),
                        F.col(role).alias("role"), F.col(text).alias("text"))


def streamed_events(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text", delta_chars: int = DELTA_CHARS) -> DataFrame:
    """A conversation as a service would have logged it: answers streamed, some of them changed.

    Learned turns are opened empty and arrive in deltas of ``delta_chars`` code points. By a checksum of its
    text, an answer is streamed as it is, opened with a draft that an edit takes back, or drafted, followed
    by a question of the next turn, and regenerated, which voids that question. Other turns are one
    message. Folding gives back the rows; repeated rows of a turn stay apart and follow role and text.
    Turns must fit 32 bits, of which null is before all others.
    """
    said = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("int").cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.row_number().over(W.partitionBy("conv_id", "turn").orderBy("role", "text")).cast("long")
    # Room for 2^31 code points of each of the rows of a turn, as parts of one sequence number.
    first = F.coalesce(F.col("turn"), F.lit(-(1 << 31) - 1)).cast("decimal(38,0)") * (1 << 62) + place * (1 << 31)
    said = said.withColumn("first", first)

    def event(step: int | Column, kind: str, text: str | Column, role: Column | None = None, later: int = 0) -> Column:
        step = F.lit(step) if isinstance(step, int) else step
        return F.struct((F.col("first") + step).cast("decimal(38,0)").alias("seq"),
                        (F.col("turn") + later).alias("turn"), F.lit(kind).alias("kind"),
                        (F.col("role") if role is None else role).alias("role"),
                        (F.lit(text) if isinstance(text, str) else text).alias("text"))

    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (F.length("text") - 1).cast("int")), F.lit(delta_chars)),
        lambda at: event(at + 10, "delta", F.substr(F.col("text"), at + 1, F.lit(delta_chars))))
    # A null turn has no next one.
    way = F.when(F.col("turn").isNull(), 0).otherwise(F.crc32(F.col("text").cast("binary")) % 3)
    opened = (F.when(way == 0, F.array(event(0, "message", "")))
              .when(way == 1, F.array(event(0, "message", "a draft"), event(1, "delta", " of it"), event(2, "edit", "")))
              .otherwise(F.array(event(0, "message", "a draft"), event(1, "message", "next", F.lit("user"), 1),
                                 event(2, "regenerate", ""))))
    log = F.when(F.col("role") == LEARNED, F.concat(opened, parts)).otherwise(F.array(event(0, "message", F.col("text"))))
    return said.select("conv_id", F.explode(log).alias("e")).select("conv_id", "e.*")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, turn, opened, role, text`` of a log ``conv_id, seq, turn, kind, role, text``.

    Events of one sequence number follow turn, kind, role and text. Two ``message`` events of a turn are
    two messages; other events belong to the last message opened before them in their turn, and open one
    if there is none. Null texts and roles are empty; unknown kinds are an error. Repeated rows count as
    events of their own.
    """
    known = F.col("kind").isin("message", "delta", "edit", "regenerate")
    bad = F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null"))))
    log = events.select(
        "conv_id", "seq", "turn", F.when(known, F.col("kind")).otherwise(bad.cast("string")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one_turn = W.partitionBy("conv_id", "turn").orderBy("seq", F.desc("kind"), "role", "text")
    log = log.withColumn("_at", F.row_number().over(one_turn)).withColumn("_message", F.greatest(F.lit(1), F.sum(
        F.when(F.col("kind") == "message", 1).otherwise(0)).over(
            one_turn.rowsBetween(W.unboundedPreceding, 0))))
    sets = F.col("kind") != "delta"
    step = F.struct("_at", "kind", "text")
    messages = log.groupBy("conv_id", "turn", "_message").agg(
        F.min("seq").alias("opened"), F.min_by("role", "_at").alias("role"),
        F.max(F.when(sets, F.col("_at"))).alias("_set_at"),
        F.array_sort(F.collect_list(step)).alias("_steps"),
        F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).alias("_voids"))
    last = F.filter("_steps", lambda s: F.col("_set_at").isNull() | (s["_at"] >= F.col("_set_at")))
    text = F.array_join(F.transform(last, lambda s: F.when(
        s["kind"] == "regenerate", F.lit("")).otherwise(s["text"])), "")
    # An edit or a new answer voids the messages of later turns that were opened before it.
    earlier = W.partitionBy("conv_id").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    return (messages.withColumn("_cut", F.max("_voids").over(earlier))
            .filter(F.col("_cut").isNull() | (F.col("opened") > F.col("_cut")))
            .select("conv_id", "turn", "opened", "_message", "role", text.alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` text and ``loss``, the spans (from 1) that are learned.

    A turn is ``<s>[INST]role[/INST]text</s>`` with control strings inside roles and texts escaped, so
    none of them can be taken for a mark.
    """
    head = F.concat(F.lit(BEGIN + HEAD), escape(F.col("role")), F.lit(BODY))
    body = escape(F.col("text"))
    parts = messages.select("conv_id", F.struct(
        "turn", "opened", "_message", F.length(head).alias("before"), F.length(body).alias("size"),
        (F.col("role") == LEARNED).alias("learned"),
        F.concat(head, body, F.lit(END)).alias("piece")).alias("part"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("spans"))

    def add(state: Column, p: Column) -> Column:
        span = F.array(F.struct((state["at"] + p["before"]).alias("start"), p["size"].alias("size")))
        return F.struct(
            (state["at"] + F.length(p["piece"])).alias("at"),
            F.when(p["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return whole.select(
        "conv_id", F.array_join(F.col("parts.piece"), "").alias("formatted"),
        F.aggregate("parts", start, add)["spans"].alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of ``(role, text)``."""
    pieces = F.split(formatted, END)  # the text ends with a mark, so the last piece is empty
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    skip = len(BEGIN + HEAD)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, BODY)
        return F.struct(
            unescape(F.substring(piece, F.lit(skip + 1), at - skip - 1)).alias("role"),
            unescape(F.substr(piece, at + len(BODY))).alias("text"))

    return F.transform(turns, turn)


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(
        formatted, s["start"], s["size"]))), "")
