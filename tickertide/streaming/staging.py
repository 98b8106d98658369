"""Staged documents as a stream of JSON files into the raw messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tickertide.session import written
from tickertide.sources.tables import merge_raw, numbered

FILES_PER_BATCH = 1000


def staged_stream(
    spark: SparkSession, path: str, schema: str, archive: str | None = None, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """The JSON files of a folder, as they arrive.

    Which files were read is kept by the stream's checkpoint. With ``archive``, a folder
    outside ``path``, files move there once the batch after theirs begins: what is still in
    ``path`` may still wait, what is in the archive is stored.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def ingest_stream(
    staged: DataFrame,
    root: str,
    checkpoint: str,
    normalize: Callable[[DataFrame], DataFrame] | None = None,
) -> DataStreamWriter:
    """Merge each batch of staged documents into the stored raw messages.

    ``normalize`` gives them the columns of the table; ``clean.normalize_message`` where
    they have none of their own. A batch counts as processed, and its files may be archived,
    when its merge is written; one that was killed before is merged again, which changes
    nothing. No table of processed documents is kept.
    """

    def save(batch: DataFrame, _: int) -> None:
        rows = normalize(batch) if normalize else batch
        staged = written(numbered(rows), "staged")
        merge_raw(batch.sparkSession, root, staged, staged)

    return staged.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode("append")
