"""The scheduled flow: one pass over all tables from raw messages to the export."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tickertide.operators.analysis import sentiment_by_subreddit
from tickertide.operators.dedup import dedup_by_ingestion
from tickertide.plans import run as R
from tickertide.sources.tables import backup_truncate_reload, current_path, export_relational, overwrite

STAGES = ("dedup", "sentiment", "mentions", "export")


def scheduled(
    spark: SparkSession,
    root: str,
    universe: DataFrame | list[str],
    export_to: str | dict[str, str],
    stages: Iterable[str] = STAGES,
    row_id: str | None = None,
    **options: object,
) -> DataFrame:
    """Deduplicate the stored messages, refresh the sentiment table, the mentions and their
    summaries, and export the sentiment; returns the report of the run.

    ``{root}/messages`` is a versioned table (``tables.write_version``). The first error ends
    the flow, and running it again continues: each stage replaces what it writes or adds only
    what is new. ``row_id`` names a column that differs between all messages; see
    ``dedup.first_rows``. ``options`` go to ``run``.
    """
    wanted, messages = set(stages), f"{root}/messages"
    if "dedup" in wanted:
        backup_truncate_reload(spark, messages, lambda df: dedup_by_ingestion(df, row_id=row_id))
    current = spark.read.parquet(current_path(spark, messages))
    if "sentiment" in wanted:
        overwrite(sentiment_by_subreddit(current), f"{root}/sentiment_by_subreddit")
    run_stages = R.STAGES if "mentions" in wanted else ("extract",)
    report = R.run(spark, root, current, universe, stages=run_stages, row_id=row_id, **options)
    if "export" in wanted:
        export_relational(spark.read.parquet(f"{root}/sentiment_by_subreddit"), export_to, mode="overwrite")
    return report
