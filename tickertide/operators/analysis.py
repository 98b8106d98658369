"""Reports over raw messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions.text import keyword_sentiment
from tickertide.operators.clean import valid_content


def sentiment_by_subreddit(messages: DataFrame, more_than: int = V.MIN_FORUM_MESSAGES) -> DataFrame:
    """Messages and mean keyword sentiment of forums with more than so many messages."""
    scored = valid_content(messages).select(
        "subreddit", keyword_sentiment(F.col("content")).alias("score")
    )
    return (
        scored.groupBy("subreddit")
        .agg(F.count("*").alias("message_count"), F.avg("score").alias("avg_sentiment"))
        .where(F.col("message_count") > more_than)
        .withColumn("analysis_timestamp", F.current_timestamp())
        .orderBy(F.desc("message_count"), "subreddit")
    )


def count_by_type(messages: DataFrame) -> DataFrame:
    return (
        messages.groupBy("message_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "message_type")
    )


def top_subreddits(messages: DataFrame, n: int = 10) -> DataFrame:
    return (
        messages.where(F.col("subreddit").isNotNull())
        .groupBy("subreddit")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "subreddit")
        .limit(n)
    )


def daily_counts(messages: DataFrame) -> DataFrame:
    return (
        valid_content(messages)
        .groupBy(F.to_date("created_at").alias("date"))
        .agg(F.count("*").alias("count"))
        .orderBy("date")
    )


def analysis_summary(messages: DataFrame) -> DataFrame:
    """One row: totals, posts, comments and the forum with the most messages.

    Per forum first, then over the forums: one scan, no join.
    """
    kind = F.col("message_type")
    forums = messages.groupBy("subreddit").agg(
        F.count("*").alias("n"),
        F.count_if(kind == V.POST).alias("posts"),
        F.count_if(kind == V.COMMENT).alias("comments"),
    )
    best = F.min(
        F.when(F.col("subreddit").isNotNull(), F.struct((-F.col("n")).alias("rank"), "subreddit"))
    )
    return forums.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_messages"),
        F.coalesce(F.sum("posts"), F.lit(0)).alias("total_posts"),
        F.coalesce(F.sum("comments"), F.lit(0)).alias("total_comments"),
        best.alias("best"),
    ).select(
        F.current_timestamp().alias("analysis_date"),
        "total_messages", "total_posts", "total_comments",
        F.col("best.subreddit").alias("top_subreddit"),
        F.coalesce(-F.col("best.rank"), F.lit(0)).alias("top_subreddit_count"),
    )


def comments_per_depth(threaded: DataFrame) -> DataFrame:
    return threaded.groupBy("depth").agg(F.count("*").alias("comments"))


def comment_time_range(threaded: DataFrame) -> DataFrame:
    """Oldest and newest comment per thread."""
    return threaded.groupBy("thread_id").agg(
        F.min("created_at").alias("oldest"), F.max("created_at").alias("newest")
    )
