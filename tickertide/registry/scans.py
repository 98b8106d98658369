"""Scans, sources and the ticker universe."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.operators import universe as U
from tickertide.registry import derived
from tickertide.registry.base import by_id, listing_frame, query, raw
from tickertide.registry.sql import VALID, select
from tickertide.session import scratch_path
from tickertide.sources import messages as M
from tickertide.sources import prices as P
from tickertide.sources.listing import listing_scan

COLUMNS = ", ".join(M.MESSAGE_COLUMNS)
COLUMNS_TEXT = COLUMNS.replace("created_at", "cast(created_at as varchar) as created_at")


@query("scan_messages", select(f"select {COLUMNS_TEXT} from clean", "clean"))
def _scan_messages(spark, sf):
    return M.scan_messages(raw(spark, sf), **by_id(spark, sf))


_SINCE = "2024-01-10 06:30:15"


@query("scan_messages_newest", f"""with raw as ({derived.RAW_MESSAGES_SQL})
select {COLUMNS_TEXT} from (select *, row_number() over (partition by message_id
    order by created_at desc, "timestamp" desc, event_id desc) as rn
  from raw where {VALID} and created_at > timestamp '{_SINCE}') where rn = 1
order by created_at desc, message_id limit 250""")
def _scan_messages_newest(spark, sf):
    return M.scan_messages(raw(spark, sf), F.lit(f"{_SINCE}.75"), limit=250, **by_id(spark, sf))


@query("recent_valid_messages", f"""with raw as ({derived.RAW_MESSAGES_SQL})
select {COLUMNS_TEXT} from raw where {VALID} order by created_at desc, message_id limit 100""")
def _recent_valid_messages(spark, sf):
    return M.recent_valid_messages(raw(spark, sf), 100)


STAGED = (
    "document_id string, id string, content string, author string, timestamp double, "
    "url string, score bigint, created_at string, message_type string, source string, "
    "title string, num_comments bigint, subreddit string, parent_id string"
)


def staged_path(spark, sf) -> str:
    """The messages as staged JSON documents: epoch timestamps and ISO creation times."""
    path = scratch_path(spark, "staging")
    documents = raw(spark, sf).select(
        "document_id", F.col("message_id").alias("id"), "content", "author",
        F.col("timestamp").cast("double").alias("timestamp"), "url", "score",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        "message_type", "source", "title", "num_comments", "subreddit", "parent_id",
    )
    documents.write.option("compression", "gzip").json(path)
    return path


@query("scan_staging", select(
    "select document_id, message_id as id, content, score, num_comments from raw", "raw"))
def _scan_staging(spark, sf):
    return M.scan_staging(spark, staged_path(spark, sf), STAGED).select(
        "document_id", "id", "content", "score", "num_comments"
    )


@query("staging_with_key", select("select document_id as id, content, author, title from raw", "raw"))
def _staging_with_key(spark, sf):
    staged = M.staging_with_key(spark, staged_path(spark, sf), STAGED)
    return staged.select("id", "content", "author", "title")


def listing_files(spark, sf) -> dict[str, str]:
    """Pipe-separated listing files per exchange."""
    rows = derived.listing(spark, sf)
    paths = {}
    for exchange, symbol in V.LISTING_SYMBOL_COLUMN.items():
        paths[exchange] = scratch_path(spark, f"listing-{exchange}")
        rows.where(F.col("exchange") == exchange).select(
            F.col("symbol").alias(symbol),
            F.col("security_name").alias("Security Name"),
            F.col("test_issue").alias("Test Issue"),
        ).write.csv(
            paths[exchange], sep="|", header=True, ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    return paths


@query("listing_scan", select(
    "select ticker, exchange, company_name from listed where regexp_full_match(ticker, '[A-Z]{1,5}')",
    "listed"))
def _listing_scan(spark, sf):
    return listing_scan(spark, listing_files(spark, sf)).drop("last_updated")


@query("listing_symbols", select(
    "select distinct ticker from listed where regexp_full_match(ticker, '[A-Z]{1,5}')", "listed"))
def _listing_symbols(spark, sf):
    return U.require_rows(U.listing_symbols(listing_frame(spark, sf)))


@query("valid_tickers", select(
    "select distinct ticker from ohlcv where ticker is not null and length(ticker) between 1 and 5 "
    "and regexp_full_match(ticker, '[A-Z]+')", "ohlcv"))
def _valid_tickers(spark, sf):
    return U.valid_tickers(derived.ohlcv(spark, sf))


def price_rows(spark, sf):
    """Prices with all measures, still as text."""
    return derived.ohlcv(spark, sf).select(
        F.col("trade_date").cast("string").alias("Date"),
        F.col("ticker").alias("Ticker"),
        *[F.col(c).cast("string").alias(n) for c, n in zip(
            ("low", "high", "low", "high", "high", "volume"), V.PRICE_COLUMNS)],
    )


PRICES_SQL = """select cast(trade_date as varchar) as "Date", ticker as "Ticker", low as "Open", high as "High",
  low as "Low", high as "Close", high as "Adj_Close", volume as "Volume" from ohlcv"""


def wide_prices(spark, sf):
    """One column per field and ticker, as a price download gives them."""
    names = [s for s in derived.SYMBOLS.split("|")]
    fields = zip(P.FIELDS, ("low", "high", "low", "high", "high", "volume"))
    return (
        derived.ohlcv(spark, sf)
        .groupBy(F.col("trade_date").alias("Date"))
        .pivot("ticker", names)
        .agg(*[F.max(c).alias(f) for f, c in fields])
        .toDF("Date", *[f"{f}|{n}" for n in names for f in P.FIELDS])
    )


@query("price_long", select(PRICES_SQL.replace('volume as "Volume"', 'cast(volume as double) as "Volume"'), "ohlcv"))
def _price_long(spark, sf):
    return P.price_long(wide_prices(spark, sf))


@query("price_cast", select(PRICES_SQL, "ohlcv"))
def _price_cast(spark, sf):
    return P.price_cast(price_rows(spark, sf))


@query("price_concat", select(
    """select count(distinct ticker) as tickers, count(*) as n_rows from ohlcv""", "ohlcv"))
def _price_concat(spark, sf):
    prices = P.price_cast(price_rows(spark, sf))
    early, late = (prices.where(c) for c in ("Date < '1995-01-01'", "Date >= '1995-01-01'"))
    return P.price_totals(P.price_concat([early, late]))


@query("index_fallback_universe", select(
    f"""select distinct ticker from (
      select unnest([{', '.join(f"'{t}'" for t in V.INDEX_TICKERS)}]) as ticker
      union all select upper(ticker) from listed where regexp_full_match(upper(ticker), '[A-Z]{{1,5}}'))""", "listed"))
def _index_fallback_universe(spark, sf):
    return U.index_fallback_universe(listing_frame(spark, sf))


@query("ticker_union", select(
    """select ticker from listed where regexp_full_match(ticker, '[A-Z]{1,5}') union
    select ticker from universe""", "listed", "universe"))
def _ticker_union(spark, sf):
    listed = U.listing_symbols(listing_frame(spark, sf))
    by_volume = U.volume_universe(derived.ohlcv(spark, sf)).select("ticker")
    return listed.unionByName(by_volume).distinct()


@query("volume_universe", select(
    """select ticker, v as avg_volume from (select ticker, avg(volume) as v from ohlcv group by 1
    order by v desc, ticker limit 1000) where regexp_full_match(ticker, '[A-Z]{1,5}')""", "ohlcv"))
def _volume_universe(spark, sf):
    return U.volume_universe(derived.ohlcv(spark, sf))


@query("latest_volume_top_n", select(
    """select l.ticker, coalesce(p.volume, 0) as volume from (select distinct ticker from listed
      union select ticker from (values ('ZZTOP')) as z(ticker)) l
    left join (select ticker, arg_max(volume, trade_date) as volume from ohlcv group by 1) p
    on l.ticker = p.ticker order by volume desc, l.ticker limit 1000""", "listed", "ohlcv"))
def _latest_volume_top_n(spark, sf):
    unpriced = spark.createDataFrame([("ZZTOP",)], "ticker string")
    listed = listing_frame(spark, sf).select("ticker").unionByName(unpriced)
    return U.latest_volume_top_n(listed, derived.ohlcv(spark, sf))
