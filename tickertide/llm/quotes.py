"""Chat formatting: messages without quotations, linked to the messages they quote.

Lines that begin with > are quoted, once per >. Consecutive lines of one level are a passage.
Passages are normalised (white space, case), cut into sentences and hashed, and so are the
own words of each message. A quoted sentence is linked to the latest earlier message of the
conversation that says it. The message that most sentences of the lowest level point to is
the one replied to. A thread is a message that replies to none and all that reply to it, to
its replies, and so on; conversations are ordered by thread, then by turn, so that a reply
comes after what it replies to.

Everything is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.functions.text import let
from tickertide.session import cut_lineage

SHORTEST = 3  # words of a quoted sentence that counts beside longer ones of its passage
SPAN = 256  # turns of a conversation that one task looks through for a sentence
MARKS = r"^(?:[ \t]*>)+"
# A line that announces a quotation.
ANNOUNCED = r"(?i)\b(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"


def lines_of(text: Column) -> Column:
    """Lines as (level, words): how often it is quoted, and what stands behind the marks."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n")
    marks = lambda line: F.regexp_extract(line, MARKS, 0)
    return F.transform(
        lines,
        lambda line: F.struct(
            F.length(F.regexp_replace(marks(line), r"[ \t]", "")).alias("level"),
            F.when(marks(line) == "", line).otherwise(F.trim(F.regexp_replace(line, MARKS, ""))).alias("words"),
        ),
    )


def own_text(lines: Column) -> Column:
    """The lines that are not quoted, without those that announce the quotation below them
    and without empty lines at either end."""
    count = F.size(lines)
    quoted_next = lambda i: (i + 1 < count) & (F.get(lines, i + 1)["level"] > 0)
    kept = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(x["words"].rlike(ANNOUNCED) & quoted_next(i)))
    return F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["words"]), "\n"), r"\A\s+|(?<!\s)\s++\z", "")


def passages(lines: Column) -> Column:
    """Passages as (level, words): consecutive lines of one level joined by spaces; an empty
    line ends a passage.

    The lines are joined to one text with marks where passages begin, and cut there again, so
    the time grows with the lines. The two control characters that serve as marks are spaces
    in the words.
    """
    trimmed = F.transform(lines, lambda x: F.struct(
        x["level"].cast("int").alias("level"), F.trim(F.regexp_replace(x["words"], r"[\x01\x02]", " ")).alias("words")
    ))

    def marked(all_lines: Column) -> Column:
        def joined(line: Column, i: Column) -> Column:
            last = F.get(all_lines, i - 1)
            goes_on = (i > 0) & (last["level"] == line["level"]) & (last["words"] != "") & (line["words"] != "")
            begin = F.concat(F.lit("\x01"), line["level"].cast("string"), F.lit("\x02"))
            return F.concat(F.when(goes_on, F.lit(" ")).otherwise(begin), line["words"])

        return F.split(F.array_join(F.transform(all_lines, joined), ""), "\x01")

    found = F.transform(let(trimmed, marked), lambda p: F.struct(
        F.substring_index(p, "\x02", 1).try_cast("int").alias("level"), F.substring_index(p, "\x02", -1).alias("words")
    ))
    return F.filter(found, lambda p: p["words"] != "")


def units(words: Column, quoted: Column) -> Column:
    """Hashes of the sentences of a passage, and of the whole. A quoted passage leaves out
    sentences of fewer than SHORTEST words if it has longer ones."""
    plain = F.lower(F.trim(F.regexp_replace(words, r"\s+", " ")))
    sentences = F.split(plain, r"(?<=[.!?]) ")
    longer = F.filter(sentences, lambda s: F.size(F.split(s, " ")) >= SHORTEST)
    sentences = F.when(quoted & (F.size(longer) > 0), longer).otherwise(sentences)
    return F.transform(F.array_distinct(F.array_append(sentences, plain)), lambda s: F.xxhash64(s))


def quotation_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, reply_to, sentences): the earlier messages that each message
    quotes, by level.

    ``messages`` has conv_id, turn and lines. A sentence points to the latest earlier turn
    that has it as own words. Of a level, the turn with the most sentences is linked, the
    later of two. The search runs in spans of turns, so a sentence that a long conversation
    repeats in every message is not one task's work.
    """
    known = messages.where("conv_id is not null and turn is not null")
    rows = known.select("conv_id", "turn", F.explode(passages(F.col("lines"))).alias("p"))
    rows = rows.select("conv_id", "turn", F.col("p.level").alias("level"), F.explode(units(F.col("p.words"), F.col("p.level") > 0)).alias("unit")).distinct()
    quoted = rows.where("level > 0")
    # Own sentences that someone in the conversation quotes.
    own = rows.where("level = 0").select("conv_id", "unit", "turn").join(quoted.select("conv_id", "unit").distinct(), ["conv_id", "unit"], "left_semi")
    span = F.floor(F.col("turn") / SPAN)
    said = own.select("conv_id", "unit", "turn", F.lit(None).cast("int").alias("level"), F.col("turn").alias("said"))
    asked = quoted.select("conv_id", "unit", "turn", "level", F.lit(None).cast("bigint").alias("said"))
    events = said.withColumn("said", F.col("said").cast("bigint")).unionByName(asked).withColumn("span", span)
    inside = Window.partitionBy("conv_id", "unit", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("near", F.max("said").over(inside)).where("level is not null")
    before = Window.partitionBy("conv_id", "unit").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    latest = events.groupBy("conv_id", "unit", "span").agg(F.max("said").alias("last")).withColumn("far", F.max("last").over(before))
    found = near.join(latest.select("conv_id", "unit", "span", "far"), ["conv_id", "unit", "span"])
    found = found.withColumn("reply_to", F.coalesce("near", "far")).where("reply_to is not null")
    votes = found.groupBy("conv_id", "turn", "level", "reply_to").agg(F.count("*").alias("sentences"))
    best = votes.groupBy("conv_id", "turn", "level").agg(F.max(F.struct("sentences", "reply_to")).alias("best"))
    return best.select("conv_id", "turn", "level", "best.reply_to", "best.sentences")


def thread_roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of messages that reply to another (conv_id, turn,
    reply_to). Replies point back, so there are no cycles; each round doubles the steps."""
    state = cut_lineage(replies.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("bigint").alias("depth")))
    if state.isEmpty():
        return state
    while True:
        jump = state.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        step = state.join(jump, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        step = cut_lineage(step)
        state = step.drop("moved")
        if step.where("moved").isEmpty():
            return state


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, text without quotations, n_quoted (lines
    taken out), reply_to (turn of the message it quotes, else null), root (turn that its
    thread begins with) and depth (replies between the two).

    Read in order of conv_id, root, turn, each message stands after the one it replies to.
    Null texts are empty. Messages without conv_id or turn are linked to none. Rows that
    share both are one message. Other columns are ignored.
    """
    lines = conversations.select("conv_id", "turn", "role", lines_of(F.col("text")).alias("lines"))
    quoting = lines.where(F.exists("lines", lambda x: x["level"] > 0)).select("conv_id").distinct()
    # Conversations without any quotation need no search.
    links = quotation_links(lines.select("conv_id", "turn", "lines").join(quoting, "conv_id", "left_semi"))
    replies = links.groupBy("conv_id", "turn").agg(F.min(F.struct("level", (-F.col("sentences")).alias("s"), "reply_to")).alias("best"))
    replies = cut_lineage(replies.select("conv_id", "turn", "best.reply_to"))
    roots = thread_roots(replies).join(replies, ["conv_id", "turn"])
    rows = lines.join(roots, ["conv_id", "turn"], "left")
    return rows.select(
        "conv_id", "turn", "role", own_text(F.col("lines")).alias("text"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("bigint").alias("n_quoted"),
        "reply_to", F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
    )


def write_chats(conversations: DataFrame, path: str) -> None:
    """Write the messages in reply order: files follow each other, and so do their rows."""
    ordered = reply_ordered(conversations).repartitionByRange("conv_id", "root", "turn")
    ordered.sortWithinPartitions("conv_id", "root", "turn").write.parquet(path)
