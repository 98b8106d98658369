"""Sentiment and confidence."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tickertide.functions.text import let, lexicon_hits

LABELS = ("positive", "negative", "neutral")
SCORE_TYPE = StructType([StructField(name, DoubleType()) for name in LABELS])

# Takes batches of texts, gives frames with the three label columns.
TextScorer = Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]


def compound(positive: Column, negative: Column) -> Column:
    """Net sentiment, 3 decimals; a missing label counts as 0."""
    net = F.coalesce(positive, F.lit(0.0)) - F.coalesce(negative, F.lit(0.0))
    return F.round(net.cast("decimal(18,6)"), 3).cast("double")


def compound_from_top_label(labels: Column) -> Column:
    """Net sentiment of the best label in an array of (label, score).

    The first of equal scores wins, and a label must score above 0.
    """
    begin = F.struct(F.lit("NEUTRAL").alias("label"), F.lit(0.0).alias("score"))
    best = F.aggregate(
        labels,
        begin,
        lambda top, item: F.when(
            item["score"] > top["score"],
            F.struct(item["label"].alias("label"), item["score"].cast("double").alias("score")),
        ).otherwise(top),
    )
    signed = (
        F.when(best["label"] == "POSITIVE", best["score"])
        .when(best["label"] == "NEGATIVE", -best["score"])
        .otherwise(0.0)
    )
    return F.round(signed.cast("decimal(18,6)"), 3).cast("double")


def confidence(compound_score: Column, score: Column) -> Column:
    """0.7 of the sentiment strength and 0.3 of the capped log of the votes, 2 decimals."""
    votes = F.abs(F.coalesce(F.nanvl(score.cast("double"), F.lit(0.0)), F.lit(0.0)))
    factor = F.when(votes == 0, 0.0).otherwise(F.least(F.lit(1.0), F.ln(votes + 1) / 10))
    value = F.lit(0.7) * F.abs(compound_score) + F.lit(0.3) * factor
    return F.round(value.cast("decimal(18,6)"), 2).cast("double")


def lexicon_scores(text: Column, parts: Column | None = None) -> Column:
    """Default scorer: shares of buy and sell terms; neutral where neither occurs.

    ``parts`` is ``words_and_text(text)`` where that is known.
    """

    def shares(hits: Column) -> Column:
        total = hits["buys"] + hits["sells"]
        return F.struct(
            F.coalesce(F.try_divide(hits["buys"], total), F.lit(0.0)).alias("positive"),
            F.coalesce(F.try_divide(hits["sells"], total), F.lit(0.0)).alias("negative"),
            F.when(total > 0, 0.0).otherwise(1.0).alias("neutral"),
        )

    return let(lexicon_hits(text, parts), shares)


def text_scores(
    text: Column, scorer: TextScorer | None = None, max_chars: int | None = None, parts: Column | None = None
) -> Column:
    """Label scores of a text or its beginning, by ``scorer`` or by the lexicon.

    ``parts`` is ``words_and_text(text)`` where that is known; the lexicon uses it for whole texts.

    ``scorer`` runs as an iterator UDF, so whatever it loads is loaded once per task.
    """
    head = F.substring(text, 1, max_chars) if max_chars else text
    if scorer is None:
        return lexicon_scores(head, None if max_chars else parts)

    def batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return scorer(texts)

    batches.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(batches, SCORE_TYPE)(head)


def add_sentiment(
    df: DataFrame,
    text: str,
    score: str,
    scorer: TextScorer | None = None,
    max_chars: int | None = None,
    parts: Column | None = None,
) -> DataFrame:
    """Add the four sentiment columns and confidence to rows with ``text`` and ``score``."""
    scored = df.withColumn("scores", text_scores(F.col(text), scorer, max_chars, parts)).withColumn(
        "sentiment_compound", compound(F.col("scores.positive"), F.col("scores.negative"))
    )
    return scored.withColumns(
        {
            **{f"sentiment_{n}": F.coalesce(F.col(f"scores.{n}"), F.lit(0.0)) for n in LABELS},
            "confidence": confidence(F.col("sentiment_compound"), F.col(score)),
        }
    ).drop("scores")
