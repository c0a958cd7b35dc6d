"""Chat formatting from event logs, in DataFrame functions only.

A log holds events (conv_id, seq, kind, message, role, text).  Partitioned by
conversation and sorted by sequence they fold into final messages:

* ``start`` begins a message with its role;
* ``delta`` appends streamed text;
* ``edit`` replaces the text so far, later deltas append to it;
* ``regenerate`` empties the message and drops every message begun between it and
  this event.

Events are folded per message first, so a long conversation is spread over tasks until
its messages, a row each, meet to be rendered.  The template writes each turn as
``[INST]role[/INST]text</s>``; control strings inside roles and texts get a backslash
after their first character (and backslashes are doubled), so that the first control
string found is always the template's and the text comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The strings that mark a turn.  None ends as it begins, so none can straddle a text's end.
OPEN, ROLE_END, CLOSE = "[INST]", "[/INST]", "</s>"
LEARNED = "assistant"   # the role whose texts lie under the loss mask
PIECES, LEAST = 8, 16   # a logged text is streamed in at most so many deltas of at least so many characters
STRIDE = 32             # sequence numbers of a turn's events


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in (OPEN, ROLE_END, CLOSE):
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns_log(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each message is begun, gets a
    draft that a regeneration (of the learned role) or an edit (of others) replaces, and
    is streamed in pieces.  Turns go by number, null first, then by role and text;
    repeated rows are turns of their own; a null role or text is empty."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("message", (F.row_number().over(order) - 1).cast("long"))
    size = F.greatest(F.lit(LEAST), F.ceil(F.length("text") / PIECES)).cast("int")
    count = F.greatest(F.lit(1), F.ceil(F.length("text") / size)).cast("int")
    piece = lambda i: F.substr(F.col("text"), i * size + 1, size)
    learned = F.col("role") == LEARNED

    def event(j, kind: Column, text: Column) -> Column:
        return F.struct((F.col("message") * STRIDE + j).alias("seq"), kind.alias("kind"), text.alias("text"))

    # a regenerated message streams from its first piece on; an edit brings the first piece itself
    first = [event(0, F.lit("start"), F.lit(None).cast("string")), event(1, F.lit("delta"), F.reverse(F.substr("text", F.lit(1), F.lit(LEAST)))),
             event(2, F.when(learned, "regenerate").otherwise("edit"), F.when(~learned, piece(F.lit(0))))]
    rest = F.transform(F.sequence(F.when(learned, 0).otherwise(F.least(F.lit(1), count)), count),
                       lambda i: event(i + 3, F.lit("delta"), piece(i)))  # the piece after the last is empty
    return rows.select("conv_id", "message", "role", F.inline(F.concat(F.array(*first), rest)))


def reconstruct(log: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of every final message.

    A null sequence number comes first; events repeated with one number count once,
    different ones of one number go by text.  A message without a start is begun by
    its first event and has an empty role; null texts are empty; a null conversation
    or message is one of its own; unknown kinds do nothing but begin a message.
    Messages begun at one number go by id.  Other columns are ignored.
    """
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(-2**63).cast("long"))
    e = log.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("message").cast("long").alias("message"), seq.alias("seq"),
                   F.col("kind").alias("kind"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    at = lambda *kinds: F.when(F.col("kind").isin(*kinds), F.col("seq"))
    m = e.groupBy("conv_id", "message").agg(
        F.min("seq").alias("first"), F.min(F.when(F.col("kind") == "start", F.struct("seq", "role"))).alias("start"),
        F.max(at("start", "edit", "regenerate")).alias("reset"), F.max(at("regenerate")).alias("redo"),
        F.collect_set(F.when(F.col("kind").isin("delta", "edit"), F.struct("seq", "text"))).alias("parts"))
    kept = F.filter("parts", lambda p: F.col("reset").isNull() | (p["seq"] >= F.col("reset")))
    m = m.select("conv_id", "message", F.coalesce("start.seq", "first").alias("begun"), F.coalesce("start.role", F.lit("")).alias("role"), "redo",
                 F.array_join(F.transform(F.array_sort(kept), lambda p: p["text"]), "").alias("text"))
    by = Window.partitionBy("conv_id").orderBy("begun", "message")
    redone = F.max("redo").over(by.rowsBetween(Window.unboundedPreceding, -1))  # of the messages before
    m = m.withColumn("redone", redone).where(F.col("redone").isNull() | (F.col("redone") <= F.col("begun")))
    return m.select("conv_id", (F.row_number().over(by) - 1).cast("int").alias("place"), "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): every conversation as one text, and the mask of what is learned.

    ``loss`` lists (turn, begin, start, end) in code points of ``formatted``: the turn
    begins at ``begin``, its escaped text runs from ``start`` to before ``end``.
    """
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(ROLE_END))
    m = messages.select("conv_id", "place", (F.col("role") == LEARNED).alias("learned"), F.length(head).alias("head"),
                        F.concat(head, escaped(F.col("text")), F.lit(CLOSE)).alias("piece"))
    over = Window.partitionBy("conv_id").orderBy("place")
    begin = F.coalesce(F.sum(F.length("piece").cast("long")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    m = m.withColumn("begin", begin)
    span = F.struct(F.col("place").alias("turn"), "begin", (F.col("begin") + F.col("head")).alias("start"),
                    (F.col("begin") + F.length("piece") - len(CLOSE)).alias("end"))
    return m.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda x: x["piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("learned"), span))).alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, learned): the turns (role, text) that the text holds, and the texts under the mask."""
    def turn(piece: Column) -> Column:
        halves = F.split(piece, r"\[/INST\]", 2)
        return F.struct(unescaped(F.substr(halves[0], F.lit(len(OPEN) + 1))).alias("role"), unescaped(halves[1]).alias("text"))

    pieces = F.split("formatted", CLOSE)  # the last is empty
    cut = chats.select("conv_id", "formatted", "loss", F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("pieces"))
    under = F.transform("loss", lambda s: unescaped(F.substr(
        F.get("pieces", s["turn"]), (s["start"] - s["begin"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return cut.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"), under.alias("learned"))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user and an assistant turn that consist of control strings."""
    return spark.range(2, numPartitions=1).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"), F.lit(f"{CLOSE}{OPEN} ok {ROLE_END}").alias("text"))


def chats(turns: DataFrame) -> DataFrame:
    """Finished turns through their event log to rendered conversations; no turns, no rows."""
    return render(reconstruct(turns_log(turns)))
