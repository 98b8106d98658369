"""Forum messages, prices and listings derived from the provided tables.

Each table is given twice: as a DataFrame and as SQL for the check. The two must say the
same. Messages use every event and the whole text of every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.session import prepare

PHRASES = (
    "bullish on|time to buy|sell it all|going down soon|hold and wait|"
    "earnings beat, up 12.5%|news of a merger|target $250.50|puts and calls|"
    "down -7.25 % to $88|breakout pattern|diamond hands for|FDA approval for|"
    "calls 5% then 10% to|overvalued, short|no view about"
)
SYMBOLS = "AAPL|MSFT|TSLA|GME|AMC|NVDA|SPY|QQQ|F|BRK.B|CEO|IT|abc|AMD|PLTR|INTC"
FORUM_NAMES = "wallstreetbets|stocks|investing|stockmarket|options"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: str, index: Column) -> Column:
    return F.split_part(F.lit(options), F.lit("|"), (index + 1).cast("int"))


def _text_tasks(spark: SparkSession) -> int:
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, 3 * spark.sparkContext.defaultParallelism)


def raw_messages(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Messages with copies, deleted and empty content, replies and discussion threads.

    With ``ids`` (event_id) only those of these events; texts are joined to them alone.
    Further columns of ``ids`` stay, and each of its rows gives one message.
    """
    events = table(spark, sf_dir, "events")
    more = [c for c in ids.columns if c != "event_id"] if ids is not None else []
    if ids is not None:
        events = events.join(ids.hint("shuffle_hash"), "event_id", "inner" if more else "left_semi")
    documents = table(spark, sf_dir, "documents")
    n_docs = documents.select(F.count("*")).scalar()
    e, user = F.col("event_id"), F.col("user_id")
    is_post = F.col("event_type").isin("signup", "purchase")

    def turn(event: Column) -> Column:
        # Shifts by one from each pass over the documents to the next, so that no document
        # is always the one that is deleted or repeated.
        return event + F.floor(event / n_docs)

    def copied(event: Column) -> Column:
        # One event in ten repeats the message id of the one before it.
        return F.when(turn(event) % 10 == 9, F.greatest(event - 1, F.lit(0))).otherwise(event)

    symbol = _pick(SYMBOLS, (e * 7) % 16)
    content = (
        F.when(turn(e) % 50 == 7, "[deleted]")
        .when(turn(e) % 50 == 8, "")
        .when(turn(e) % 50 == 17, F.lit(None))
        .otherwise(
            F.concat(
                _pick(PHRASES, e % 16),
                F.lit(" "),
                F.when(e % 3 == 0, "$").otherwise(""),
                F.when(e % 7 == 0, F.lower(symbol)).otherwise(symbol),
                F.lit(" and "),
                _pick(SYMBOLS, user % 16),
                F.lit(". "),
                # Clicks stay short, all other messages carry a whole document.
                F.when(F.col("event_type") == "click", "").otherwise(
                    F.coalesce(F.col("text"), F.lit(""))
                ),
            )
        )
    )
    title = F.when(
        is_post,
        F.concat(
            F.when(e % 8 == 2, "Daily Discussion Thread ")
            .when(e % 8 == 3, "What are your moves? WEEKEND Discussion Thread ")
            .otherwise("Thread "),
            e.cast("string"),
        ),
    )
    parent = F.floor(e / 4).cast("bigint")
    created = F.col("ts").cast("timestamp")
    # The given events are one file; spread by document, its few columns are all that travels.
    # So the exchange is small however much text is joined behind it, and adaptive execution
    # would leave a few tasks with all the texts: their number is given.
    # A merge join leaves messages with one document one after the other, so that what is
    # written of them holds little more than each text once.
    rows = events.withColumn("doc_key", e % n_docs).repartition(_text_tasks(spark), "doc_key").join(
        documents.select(F.col("doc_id").alias("doc_key"), "text").hint("merge"), "doc_key", "left"
    )
    return rows.select(
        F.concat(F.lit("d"), e.cast("string")).alias("document_id"),
        F.concat(F.lit("m"), copied(e).cast("string")).alias("message_id"),
        content.alias("content"),
        F.when(user % 23 != 5, F.concat(F.lit("u"), user.cast("string"))).alias("author"),
        created.alias("timestamp"),
        F.concat(F.lit("https://example.com/"), e.cast("string")).alias("url"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("bigint") - 20).alias("score"),
        created.alias("created_at"),
        F.when(is_post, "REDDIT_POST").otherwise("REDDIT_COMMENT").alias("message_type"),
        F.when(e % 3 == 1, "reddit").alias("source"),
        title.alias("title"),
        F.when(is_post, F.concat(F.lit("self "), e.cast("string"))).alias("selftext"),
        (e % 37).alias("num_comments"),
        _pick(FORUM_NAMES, user % 5).alias("subreddit"),
        F.when(
            ~is_post & (e != 0), F.concat(F.lit("m"), copied(parent).cast("string"))
        ).alias("parent_id"),
        F.lit(None).cast("string").alias("submission_id"),
        F.lit(None).cast("int").alias("depth"),
        (created + F.expr("interval 1 hour")).alias("ingestion_timestamp"),
        e.alias("event_id"),
        *more,
    )


def _pick_sql(options: str, index: str) -> str:
    return f"split_part('{options}', '|', cast({index} as int) + 1)"


def _turn_sql(event: str) -> str:
    return f"({event} + {event} // (select count(*) from documents))"


def _copied_sql(event: str) -> str:
    return f"case when {_turn_sql(event)} % 10 = 9 then greatest({event} - 1, 0) else {event} end"


RAW_MESSAGES_SQL = f"""
select
  concat('d', cast(event_id as varchar)) as document_id,
  concat('m', cast({_copied_sql('event_id')} as varchar)) as message_id,
  case when {_turn_sql('event_id')} % 50 = 7 then '[deleted]' when {_turn_sql('event_id')} % 50 = 8 then ''
    when {_turn_sql('event_id')} % 50 = 17 then null
    else concat({_pick_sql(PHRASES, 'event_id % 16')}, ' ',
      case when event_id % 3 = 0 then '$' else '' end,
      case when event_id % 7 = 0 then lower({_pick_sql(SYMBOLS, '(event_id * 7) % 16')})
        else {_pick_sql(SYMBOLS, '(event_id * 7) % 16')} end,
      ' and ', {_pick_sql(SYMBOLS, 'user_id % 16')}, '. ',
      case when event_type = 'click' then '' else coalesce(d.text, '') end) end as content,
  case when user_id % 23 <> 5 then concat('u', cast(user_id as varchar)) end as author,
  ts as "timestamp",
  concat('https://example.com/', cast(event_id as varchar)) as url,
  cast(regexp_extract(props, '([0-9]+)', 1) as bigint) - 20 as score,
  ts as created_at,
  case when event_type in ('signup', 'purchase') then 'REDDIT_POST' else 'REDDIT_COMMENT' end as message_type,
  case when event_id % 3 = 1 then 'reddit' end as source,
  case when event_type in ('signup', 'purchase') then concat(
    case when event_id % 8 = 2 then 'Daily Discussion Thread '
      when event_id % 8 = 3 then 'What are your moves? WEEKEND Discussion Thread ' else 'Thread ' end,
    cast(event_id as varchar)) end as title,
  case when event_type in ('signup', 'purchase') then concat('self ', cast(event_id as varchar)) end as selftext,
  event_id % 37 as num_comments,
  {_pick_sql(FORUM_NAMES, 'user_id % 5')} as subreddit,
  case when event_type in ('signup', 'purchase') or event_id = 0 then null
    else concat('m', cast({_copied_sql('(event_id // 4)')} as varchar)) end as parent_id,
  cast(null as varchar) as submission_id,
  cast(null as int) as depth,
  ts + interval '1' hour as ingestion_timestamp,
  event_id
from events e left join documents d on d.doc_id = e.event_id % (select count(*) from documents)
"""


def ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices and volume per symbol, from line items."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.to_date("l_shipdate").alias("trade_date"),
            _pick(SYMBOLS, F.col("l_partkey") % 16).alias("ticker"),
        )
        .agg(
            F.min(price).alias("low"),
            F.max(price).alias("high"),
            (F.sum("l_quantity").cast("bigint") * 100).alias("volume"),
        )
    )


OHLCV_SQL = f"""
select cast(l_shipdate as date) as trade_date, {_pick_sql(SYMBOLS, 'l_partkey % 16')} as ticker,
  min(l_extendedprice / l_quantity) as low, max(l_extendedprice / l_quantity) as high,
  cast(sum(l_quantity) as bigint) * 100 as volume
from lineitem group by 1, 2
"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange listing rows, from parts."""
    part = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _pick(SYMBOLS, part % 16).alias("symbol"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("security_name"),
        F.when(part % 11 == 0, "Y").otherwise("N").alias("test_issue"),
        F.when(part % 2 == 0, "NASDAQ").otherwise("NYSE").alias("exchange"),
    )


LISTING_SQL = f"""
select {_pick_sql(SYMBOLS, 'p_partkey % 16')} as symbol, concat(' ', p_name, ' ') as security_name,
  case when p_partkey % 11 = 0 then 'Y' else 'N' end as test_issue,
  case when p_partkey % 2 = 0 then 'NASDAQ' else 'NYSE' end as exchange
from part
"""

# Stored mentions for the summary operators: one batch up to noon of a day, one after.
BATCH_CUT = "2024-01-15 12:00:00"
