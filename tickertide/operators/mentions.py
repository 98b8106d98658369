"""From messages to ticker mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions.scoring import TextScorer, add_sentiment
from tickertide.functions.text import (
    candidate_words,
    excluded_words,
    extract_signals,
    extract_tickers,
    mention_context,
    words_and_text,
)
from tickertide.operators.clean import with_full_text
from tickertide.operators.skew import SALTS
from tickertide.session import cut_lineage

# A universe of at most this many tickers is put into the plan as a constant set; the result
# is the same for any size.
INLINE_TICKERS = 5000
BITMAP_BITS = 32768  # the size of Spark's bitmaps


def small_universe(universe: DataFrame, limit: int = INLINE_TICKERS) -> list[str] | None:
    """The tickers, or None if there are more than ``limit``."""
    rows = universe.select("ticker").distinct().limit(limit + 1).collect()
    return None if len(rows) > limit else sorted(r.ticker for r in rows if r.ticker)


def with_tickers(
    messages: DataFrame,
    universe: DataFrame | list[str],
    max_tickers: int | None = None,
    max_chars: int | None = None,
    inline: int = INLINE_TICKERS,
) -> DataFrame:
    """Add ``tickers``, the distinct universe tickers in ``text``, first occurrence first.

    A small universe is tested row by row as a constant, a larger one as bitmaps: only words
    of two to five letters can be found, and there are 12 million of them, so the bitmaps of
    any universe have 8 MB at most and are broadcast. Words that begin like no ticker are
    passed over in the text. Neither rows nor text are shuffled.
    """
    if not isinstance(universe, list):
        universe = cut_lineage(universe.select("ticker").distinct())  # read several times
    known = universe if isinstance(universe, list) else small_universe(universe, inline)
    if known is not None:
        found = extract_tickers(F.col("text"), known, max_tickers, max_chars)
        return messages.withColumn("tickers", found)
    marked = messages.crossJoin(F.broadcast(word_bitmaps(universe)))  # with one row
    pairs = ticker_words(universe).select(F.left("ticker", F.lit(2)).alias("pair")).distinct()
    words = candidate_words(F.col("text"), max_chars, [r.pair for r in pairs.collect()])  # 676 at most
    found = F.filter(F.array_distinct(words), lambda w: in_bitmaps(F.col("_bitmaps"), w))
    found = F.slice(found, 1, max_tickers) if max_tickers else found
    return marked.withColumn("tickers", found).drop("_bitmaps")


def word_code(word: Column) -> Column:
    """A word of up to five capital letters as a number to base 36."""
    return F.conv(word, 36, 10).cast("bigint")


def ticker_words(universe: DataFrame) -> DataFrame:
    """The tickers that a word can be."""
    return universe.select("ticker").where(F.col("ticker").rlike("^[A-Z]{2,5}$") & ~F.col("ticker").isin(excluded_words()))


def word_bitmaps(universe: DataFrame) -> DataFrame:
    """One row: the tickers that a word can be, as an array of bitmaps by bucket."""
    words, code = ticker_words(universe), word_code(F.col("ticker"))
    parts = words.groupBy(F.bitmap_bucket_number(code).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("bits")
    )
    # Found by their place: a map is searched entry by entry.
    held = parts.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("held"))
    buckets = F.sequence(F.lit(0), F.lit(36**5 // BITMAP_BITS + 1))
    return held.select(F.transform(buckets, lambda b: F.try_element_at("held", b.cast("bigint"))).alias("_bitmaps"))


def in_bitmaps(bitmaps: Column, word: Column) -> Column:
    code = word_code(word)
    place = F.bitmap_bit_position(code)
    bits = F.get(bitmaps, F.bitmap_bucket_number(code).cast("int"))
    byte = F.substr(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (place % 8).cast("int"))
    return F.coalesce(bit == 1, F.lit(False))


def ticker_positions(messages: DataFrame, universe: DataFrame, max_chars: int | None = None) -> DataFrame:
    """(message_id, pos, ticker): candidate words that are in the universe, by a join.

    Some words are in most messages, so the join is salted by message; the universe is
    repeated once per salt. Only ids and words travel, never the text.
    """
    words = F.array_distinct(candidate_words(F.col("text"), max_chars))
    pairs = messages.select("message_id", F.posexplode(words).alias("pos", "ticker")).withColumn(
        "salt", F.pmod(F.xxhash64("message_id", "pos"), F.lit(SALTS)).cast("int")
    )
    tickers = (
        universe.select("ticker")
        .where(~F.col("ticker").isin(excluded_words()))
        .distinct()
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    return pairs.join(tickers, ["ticker", "salt"]).select("message_id", "pos", "ticker")


def explode_mentions(
    messages: DataFrame, universe: DataFrame | list[str], limits: V.TextLimits = V.WHOLE_TEXT
) -> DataFrame:
    """One row per message and ticker with ``context``; the message columns stay."""
    tagged = with_tickers(with_full_text(messages), universe, limits.max_tickers, limits.max_chars)
    # explode_outer plus a filter: plain explode would add a size filter below it and so
    # compute the tickers twice.
    rows = tagged.withColumn("ticker", F.explode_outer("tickers")).where(
        F.col("ticker").isNotNull()
    )
    return rows.withColumn("context", mention_context(F.col("text"), F.col("ticker"), limits)).drop(
        "text", "tickers"
    )


def find_mentions(
    messages: DataFrame,
    universe: DataFrame | list[str],
    scorer: TextScorer | None = None,
    limits: V.TextLimits = V.WHOLE_TEXT,
) -> DataFrame:
    """Stock mentions of deduplicated messages, with sentiment, signals and confidence.

    The whole step is one pass without an exchange. It reads whole texts, unless ``limits``
    says otherwise.
    """
    rows = explode_mentions(messages, universe, limits).withColumn(
        "score", F.coalesce("score", F.lit(0)).cast("bigint")
    )
    if scorer is not None:
        # Ends the projection, so that the scorer's input is a column and not an expression.
        rows = rows.withColumn("context", F.explode(F.array("context")))
    # Searched once for sentiment and signals.
    rows = rows.withColumn("parts", words_and_text(F.col("context")))
    scored = add_sentiment(rows, "context", "score", scorer, limits.scorer_chars, F.col("parts"))
    stored = F.substring("context", 1, limits.stored_chars) if limits.stored_chars else F.col("context")
    return scored.select(
        "message_id", "ticker", "author", "created_at", "subreddit", "url", "score",
        "message_type", "sentiment_compound", "sentiment_positive", "sentiment_negative",
        "sentiment_neutral",
        extract_signals(F.col("context"), F.col("parts")).alias("signals"),
        stored.alias("context"),
        "confidence",
        F.current_timestamp().alias("etl_timestamp"),
    )
