"""Table schemas as DDL text. Nested values are native columns; JSON text appears only at a sink."""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_MESSAGES = (
    "document_id string, message_id string, content string, author string, "
    "timestamp timestamp, url string, score bigint, created_at timestamp, "
    "message_type string, source string, title string, selftext string, "
    "num_comments bigint, subreddit string, parent_id string, submission_id string, "
    "depth int, ingestion_timestamp timestamp"
)

STOCK_MENTIONS = (
    "message_id string, ticker string, author string, created_at timestamp, "
    "subreddit string, url string, score bigint, message_type string, "
    "sentiment_compound double, sentiment_positive double, sentiment_negative double, "
    "sentiment_neutral double, signals array<string>, context string, confidence double, "
    "etl_timestamp timestamp"
)

STOCK_HOURLY_SUMMARY = (
    "ticker string, hour_start timestamp, mention_count bigint, avg_sentiment double, "
    "weighted_sentiment double, buy_signals bigint, sell_signals bigint, "
    "hold_signals bigint, avg_confidence double, subreddits map<string,bigint>, "
    "etl_timestamp timestamp"
)

STOCK_DAILY_SUMMARY = (
    "ticker string, date date, mention_count bigint, avg_sentiment double, "
    "weighted_sentiment double, buy_signals bigint, sell_signals bigint, "
    "hold_signals bigint, price_targets map<string,bigint>, news_signals bigint, "
    "earnings_signals bigint, technical_signals bigint, options_signals bigint, "
    "avg_confidence double, high_conf_sentiment double, "
    "top_contexts array<struct<context:string,confidence:double,sentiment:double>>, "
    "subreddits map<string,bigint>, etl_timestamp timestamp"
)

STOCK_WEEKLY_SUMMARY = (
    "ticker string, week_start timestamp, mention_count bigint, avg_sentiment double, "
    "weighted_sentiment double, buy_signals bigint, sell_signals bigint, "
    "hold_signals bigint, price_targets map<string,bigint>, news_signals bigint, "
    "earnings_signals bigint, technical_signals bigint, options_signals bigint, "
    "avg_confidence double, daily_breakdown map<string,bigint>, "
    "subreddits map<string,bigint>, etl_timestamp timestamp"
)

SENTIMENT_BY_SUBREDDIT = (
    "subreddit string, message_count bigint, avg_sentiment double, "
    "analysis_timestamp timestamp"
)

ANALYSIS_SUMMARY = (
    "analysis_date timestamp, total_messages bigint, total_posts bigint, "
    "total_comments bigint, top_subreddit string, top_subreddit_count bigint"
)

STOCK_TICKERS = (
    "ticker string, exchange string, company_name string, last_updated timestamp"
)

DAILY_PRICES = (
    "Date date, Ticker string, Open double, High double, Low double, Close double, "
    "Adj_Close double, Volume bigint"
)

RUN_STATE = (
    "step string, last_run timestamp, updated_at timestamp"
)

VERSIONS = "version bigint, path string"

RAW_DAYS = "message_id string, event_date date"

BATCHES = "batch string, event_date date, done boolean"

THREAD_STATE = (
    "source string, last_daily_discussion_id string, last_updated timestamp"
)

TABLES = {
    "stock_mentions": STOCK_MENTIONS,
    "stock_daily_summary": STOCK_DAILY_SUMMARY,
    "stock_hourly_summary": STOCK_HOURLY_SUMMARY,
    "stock_weekly_summary": STOCK_WEEKLY_SUMMARY,
}


def columns(table: str) -> list[str]:
    """Column names of a result table."""
    return StructType.fromDDL(TABLES[table]).fieldNames()
