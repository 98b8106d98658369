"""Exact duplicates by an extendible-hash index on shared files.

1. Spark counts the texts of each 64-bit key. A key that occurs once has no copies.
2. Rows of repeated keys go, with their text, to the owner of their key range. Tasks first
   join equal texts of a batch, so a text that fills a third of the table arrives as one
   record per batch. An owner reads its records in order of key, holds the chain of
   different texts under one key at a time and compares bytes, so keys that collide are told
   apart. Each class goes into the owner's part of the index.
3. All rows look themselves up in the index; nothing is joined.

An owner's part of the index is a directory of 2^depth slots over the key bits behind its
range, and buckets that slots point to. An overfull bucket is split by its next bit; where
it already uses all bits of the directory, the directory doubles. Classes of one key cannot
be split and stay in one bucket as a chain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.shared import (
    U64, find, listed, read_arrays, shard_bits, shard_of, shards, shared_path, write_arrays, write_sorted,
)
from tickertide.llm.words import plain

BUCKET = 32  # classes in a bucket
DEEPEST = 18  # bits of a directory; keys that agree in more of them share a bucket as a chain
RECORD = "owner int, key bigint, digest string, text string, top bigint, n bigint, n_top bigint"
FOUND = "keep_id bigint, group_size bigint, kept_rows bigint"


class ExtendibleIndex:
    """The index of one owner while it is built. ``used`` bits of a key name the owner."""

    def __init__(self, used: int, capacity: int = BUCKET):
        self.used, self.capacity, self.depth = used, capacity, 0
        self.directory = [0]
        self.buckets: list[list[tuple]] = [[]]
        self.depths = [0]

    def slot(self, key: int) -> int:
        return (key << self.used & 0xFFFFFFFFFFFFFFFF) >> (64 - self.depth) if self.depth else 0

    def insert(self, entry: tuple) -> None:
        """Add (key, ...) to its bucket, splitting it as long as it is overfull."""
        key = entry[0]
        while True:
            number = self.directory[self.slot(key)]
            bucket = self.buckets[number]
            one_key = all(e[0] == key for e in bucket)
            if len(bucket) < self.capacity or one_key or self.depths[number] >= min(DEEPEST, 64 - self.used):
                bucket.append(entry)
                return
            self.split(number)

    def split(self, number: int) -> None:
        if self.depths[number] == self.depth:
            self.directory = [b for b in self.directory for _ in (0, 1)]
            self.depth += 1
        self.depths[number] += 1
        self.depths.append(self.depths[number])
        new, old = len(self.buckets), self.buckets[number]
        mask = 1 << (64 - self.used - self.depths[number])
        self.buckets[number] = [e for e in old if not e[0] & mask]
        self.buckets.append([e for e in old if e[0] & mask])
        bit = 1 << (self.depth - self.depths[number])
        self.directory = [new if b == number and s & bit else b for s, b in enumerate(self.directory)]

    def write(self, uri: str) -> None:
        """Buckets one after the other, and where the bucket of each slot begins and ends."""
        entries = [e for bucket in self.buckets for e in bucket]
        ends = np.cumsum([len(b) for b in self.buckets])
        digests = np.frombuffer(b"".join(bytes.fromhex(e[1])[:16] for e in entries), ">u8").astype(U64).reshape(-1, 2)
        write_arrays(f"{uri}.buckets", {
            "key": np.array([e[0] for e in entries], U64), "digest0": digests[:, 0], "digest1": digests[:, 1],
            "top": np.array([e[2] or 0 for e in entries], np.int64), "known": np.array([e[2] is not None for e in entries], np.int8),
            "n": np.array([e[3] for e in entries], np.int64), "n_top": np.array([e[4] for e in entries], np.int64),
        })
        at = np.array(self.directory)
        sizes = np.array([len(b) for b in self.buckets])
        write_arrays(f"{uri}.slots", {"begin": (ends - sizes)[at].astype(np.int64), "end": ends[at].astype(np.int64)})


def lookup(folder: str, used: int, keys: np.ndarray, digests: np.ndarray) -> dict[str, np.ndarray]:
    """The class of each (key, digest), where there is one."""
    out = {n: np.zeros(len(keys), np.int64) for n in ("top", "known", "n", "n_top")}
    owners = shards(keys, used)
    for owner in np.unique(owners):
        if f"{owner}.slots" not in listed(folder):
            continue
        slots, stored = read_arrays(f"{folder}/{owner}.slots"), read_arrays(f"{folder}/{owner}.buckets")
        rows = np.flatnonzero(owners == owner)
        depth = len(slots["begin"]).bit_length() - 1
        rest = keys[rows] << U64(used)
        slot = (rest >> U64(64 - depth)).astype(np.int64) if depth else np.zeros(len(rows), np.int64)
        at, end = slots["begin"][slot].copy(), slots["end"][slot]
        while len(rows):
            inside = at < end
            rows, at, end = rows[inside], at[inside], end[inside]
            same = (stored["key"][at] == keys[rows]) & (stored["digest0"][at] == digests[rows, 0]) & (stored["digest1"][at] == digests[rows, 1])
            for n in out:
                out[n][rows[same]] = stored[n][at[same]]
            rows, at, end = rows[~same], at[~same] + 1, end[~same]
    return out


def join_copies(used: int):
    """Equal texts of a batch as one record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list] = {}
            for key, digest, text, doc in zip(*[c.to_pylist() for c in batch.columns]):
                record = seen.setdefault(text, [key, digest, text, None, 0, 0])
                add_copies(record, 3, doc, 1, 1)
            if seen:
                columns = [pa.array(c) for c in zip(*seen.values())]
                owner = shards(columns[0].to_numpy().view(U64), used)
                arrays = [pa.array(owner, pa.int32()), *columns[:3], columns[3].cast(pa.int64()), *columns[4:]]
                yield pa.record_batch(arrays, names=["owner", "key", "digest", "text", "top", "n", "n_top"])

    return run


def add_copies(record: list, at: int, top: int | None, n: int, n_top: int) -> None:
    """Add ``n`` copies, ``n_top`` of them with their largest id ``top``, to top, n, n_top."""
    old = record[at]
    if old == top:
        record[at + 2] += n_top
    elif old is None or (top is not None and top > old):
        record[at], record[at + 2] = top, n_top
    record[at + 1] += n


def own(folder: str, used: int, capacity: int):
    """Reads records sorted by owner and key; writes each owner's index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, owner, key, chain, total = None, None, None, [], 0

        def close_key() -> None:
            for text, digest, top, n, n_top in chain:
                index.insert((key & 0xFFFFFFFFFFFFFFFF, digest, top, n, n_top))

        for batch in batches:
            for o, k, digest, text, top, n, n_top in zip(*[c.to_pylist() for c in batch.columns]):
                if k != key or o != owner:
                    if index is not None:
                        close_key()
                    key, chain = k, []
                if o != owner:
                    if index is not None:
                        index.write(f"{folder}/{owner}")
                    index, owner = ExtendibleIndex(used, capacity), o
                for record in chain:
                    if record[0] == text:  # bytes, not hashes
                        add_copies(record, 2, top, n, n_top)
                        break
                else:
                    total += 1
                    chain.append([text, digest, top, n, n_top])
        if index is not None:
            close_key()
            index.write(f"{folder}/{owner}")
        yield pa.record_batch([pa.array([total], pa.int64())], names=["n"])

    return run


def repeated_keys(folder: str, used: int, key: Column) -> Column:
    @F.arrow_udf("boolean")
    def repeated(keys: pa.Array) -> pa.Array:
        return pa.array(find(folder, used, keys.to_numpy(zero_copy_only=False).view(U64), [])["found"])

    return repeated(key)


def class_of(folder: str, used: int, key: Column, digest: Column, doc: Column) -> Column:
    @F.arrow_udf(FOUND)
    def found(keys: pa.Array, digests: pa.Array, docs: pa.Array) -> pa.Array:
        halves = np.frombuffer(b"".join(digests.to_pylist()), ">u8").astype(U64).reshape(-1, 2)
        hit = lookup(folder, used, keys.to_numpy(zero_copy_only=False).view(U64), halves)
        ids = docs.cast(pa.int64())
        single = pa.array(hit["n"] == 0)
        top = pa.array(hit["top"], pa.int64(), mask=hit["known"] == 0)
        one = pa.array(np.ones(len(ids), np.int64))
        keep = pa.compute.if_else(single, ids, top)
        columns = [keep, pa.compute.if_else(single, one, pa.array(hit["n"])), pa.compute.if_else(single, one, pa.array(hit["n_top"]))]
        return pa.StructArray.from_arrays(columns, ["keep_id", "group_size", "kept_rows"])

    return found(key, digest, doc)


def build_index(documents: DataFrame, key_of: Callable[[Column], Column] = F.xxhash64, capacity: int = BUCKET) -> tuple[str, int]:
    """Index the repeated texts; returns its folder and the bits of an owner's key range."""
    spark = documents.sparkSession
    used = shard_bits(spark)
    folder = shared_path(spark, "exact")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = documents.select("doc_id", text.alias("text"), key_of(text).cast("bigint").alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key")
    write_sorted(counts, f"{folder}/repeated", used)
    records = (
        keyed.where(repeated_keys(f"{folder}/repeated", used, F.col("key")))
        .select("key", F.sha2("text", 256).alias("digest"), "text", F.col("doc_id").cast("bigint"))
        .mapInArrow(join_copies(used), RECORD)
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_records = records.repartition(parts, "owner").sortWithinPartitions("owner", "key")
    sorted_records.mapInArrow(own(f"{folder}/index", used, capacity), "n bigint").agg(F.sum("n")).collect()
    return f"{folder}/index", used


def duplicate_groups(documents: DataFrame, key_of: Callable[[Column], Column] = F.xxhash64, capacity: int = BUCKET) -> DataFrame:
    """The rows of documents as struct ``row``, each with its text_sha256 and its group of
    equal texts: keep_id (the largest doc_id), group_size, kept (it has that id) and
    kept_rows (rows of the group with that id).

    Null texts count as empty, and empty texts are equal to each other. Rows without doc_id
    stay only in groups without any id, whose keep_id is null. Rows that repeat both id and
    text count as copies and are kept or dropped together. Needs doc_id and text; other
    columns travel along under any name.
    """
    folder, used = build_index(documents, key_of, capacity)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), key_of(text).cast("bigint").alias("key"), F.sha2(text, 256).alias("text_sha256")
    )
    half = F.substring(F.unhex("text_sha256"), 1, 16)
    rows = rows.withColumn("found", class_of(folder, used, F.col("key"), half, F.col("id")))
    kept = F.col("id").eqNullSafe(F.col("found.keep_id"))
    return rows.select("row", "id", "found.keep_id", "found.group_size", kept.alias("kept"), "found.kept_rows", "text_sha256")


def drop_duplicates(documents: DataFrame, key_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row of each group of equal texts, the one with the largest doc_id."""
    kept = duplicate_groups(documents, key_of).where("kept")
    single = kept.where("kept_rows = 1").select("row.*")
    # Rows that also repeat the id: one of them, by a hash of the row.
    order = Window.partitionBy("id", "text_sha256").orderBy(F.xxhash64(F.to_json("row")))
    repeats = kept.where("kept_rows > 1").withColumn("rank", F.row_number().over(order))
    return single.unionByName(repeats.where("rank = 1").select("row.*"))
