"""Repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the run of ``SEED``
words in it with the smallest hash, the leftmost of equal ones. Consecutive windows that
share a minimiser form a super-k-mer, which travels as one string of words to the bucket of
the minimiser; equal windows always meet there.

1. Spark counts the super-k-mers of each minimiser. Windows of a minimiser that occurs once
   repeat nowhere and do not travel.
2. The other super-k-mers go to the bucket of their minimiser, with the place where they
   start. A task reads buckets in order, numbers the words of the strings, sorts all windows
   by hash and place, compares the words of neighbours, and so knows which windows start
   earlier elsewhere.
3. A minimiser with more than ``CROWD`` super-k-mers would fill one bucket (a passage that a
   third of all documents hold). Its windows travel one by one instead: Spark finds the first
   place of each different window, combined in each task before the shuffle.
4. Strings that repeat, or hold windows that do, are entered in sorted arrays: first place
   and which windows are first there. Texts look their super-k-mers up; nothing is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.shared import bits_for, find, shared_path, write_sorted
from tickertide.llm.words import U64, hash_spans, join_hashes, mix, pieces, plain, raw_bytes, runs, word_spans, words_per_text

WINDOW = 20  # words
SEED = 6  # words of a minimiser
CROWD = 4096  # super-k-mers that one bucket takes
CHUNK_BYTES = 16 << 20  # packed text of whole buckets that is compared at once
CHECK = 0x5851F42D  # seed of the second half of a digest

RECORD = "bucket bigint, packed binary, doc bigint, start int"
ENTRY = "key bigint, check bigint, doc bigint, known tinyint, start int, firsts int"
FOUND = "n_words bigint, n_removed bigint, kept_text string"


class Piece(NamedTuple):
    """The words of some texts, each followed by one space, and their super-k-mers."""

    data: np.ndarray
    at: np.ndarray  # where each word begins in data, and the end
    words: np.ndarray  # words of each text
    minimiser: np.ndarray
    first: np.ndarray  # first word of each super-k-mer
    windows: np.ndarray  # windows in it
    text: np.ndarray  # the text it is from
    start: np.ndarray  # its first word, counted in that text


def packed_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and where each begins."""
    sizes = ends - starts
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    out = np.full(at[-1], 32, np.uint8)
    word = np.repeat(np.arange(len(starts)), sizes)
    shift = at[:-1] - starts
    source = np.arange(sizes.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    out[source + shift[word]] = data[source]
    return out, at


def cut(texts: pa.Array, window: int, seed: int) -> Piece:
    """Super-k-mers of a piece of texts."""
    data, offsets = raw_bytes(texts)
    starts, ends = word_spans(data, offsets)
    words = words_per_text(starts, offsets)
    begin = np.concatenate(([0], np.cumsum(words)))
    hashes = hash_spans(data, starts, ends)
    packed, at = packed_words(data, starts, ends)
    none = np.zeros(0, np.int64)
    per_text = np.maximum(words - window + 1, 0)
    if not per_text.sum():
        return Piece(packed, at, words, none.astype(U64), none, none, none, none)
    span = len(hashes) - seed + 1
    grams = join_hashes(*[hashes[j : j + span] for j in range(seed)])
    best, where = grams[: len(hashes) - window + 1].copy(), np.arange(len(hashes) - window + 1)
    for j in range(1, window - seed + 1):
        other = grams[j : j + len(best)]
        less = other < best
        best[less] = other[less]
        where[less] = np.flatnonzero(less) + j
    text = np.repeat(np.arange(len(words)), per_text)
    windows = np.arange(per_text.sum()) + (begin[:-1] - (np.cumsum(per_text) - per_text))[text]
    head = runs(where[windows])
    first = windows[head]
    count = np.diff(np.append(head, len(windows)))
    # The smallest of many hashes is small; mixed again, keys spread evenly over shards.
    return Piece(packed, at, words, mix(best[first]), first, count, text[head], first - begin[text[head]])


def expand(piece: Piece, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first words of all windows of the chosen super-k-mers, and whose they are."""
    of = np.repeat(chosen, piece.windows[chosen])
    count = piece.windows[chosen]
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return piece.first[of] + within, of


def strings(piece: Piece, first: np.ndarray, n_words: np.ndarray | int) -> pa.Array:
    """Runs of words, joined by one space."""
    data = piece.data.tobytes()
    begin, end = piece.at[first].tolist(), (piece.at[first + n_words] - 1).tolist()
    return pa.array([data[a:b] for a, b in zip(begin, end)], pa.binary())


def digests(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hash_spans(data, begin, end), hash_spans(data, begin, end, CHECK)


def string_digests(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw_bytes(packed)
    return digests(data, offsets[:-1], offsets[1:])


def bigints(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def count_minimisers(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(plain(batch.column("text"))):
                keys, counts = np.unique(cut(texts, window, seed).minimiser, return_counts=True)
                yield pa.record_batch([bigints(keys), pa.array(counts, pa.int64())], names=["key", "n"])

    return run


def pack(folder: str, bits: int, window: int, seed: int):
    """Super-k-mers of minimisers that occur more than once but not too often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc")
            for place, texts in pieces(plain(batch.column("text"))):
                piece = cut(texts, window, seed)
                known = find(folder, bits, piece.minimiser, ["crowded"])
                chosen = np.flatnonzero(known["found"] & (known["crowded"] == 0))
                yield pa.record_batch([
                    bigints(piece.minimiser[chosen]),
                    strings(piece, piece.first[chosen], piece.windows[chosen] + window - 1),
                    docs.take(pa.array(piece.text[chosen] + place)),
                    pa.array(piece.start[chosen], pa.int32()),
                ], names=["bucket", "packed", "doc", "start"])

    return run


def crowded_windows(folder: str, bits: int, window: int, seed: int):
    """Windows of crowded minimisers, those of a piece combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc")
            for place, texts in pieces(plain(batch.column("text"))):
                piece = cut(texts, window, seed)
                chosen = np.flatnonzero(find(folder, bits, piece.minimiser, ["crowded"])["crowded"] == 1)
                first, of = expand(piece, chosen)
                if not len(first):
                    continue
                start = piece.start[of] + first - piece.first[of]
                doc = docs.take(pa.array(piece.text[of] + place))
                known = np.asarray(doc.is_valid())
                number = np.asarray(doc.fill_null(0))
                same = strings(piece, first, window).dictionary_encode()
                order = np.lexsort((start, number, known, same.indices.to_numpy()))
                head = order[runs(same.indices.to_numpy()[order])]
                count = np.bincount(same.indices.to_numpy(), minlength=len(same.dictionary))
                yield pa.record_batch([
                    same.dictionary, doc.take(pa.array(head)), pa.array(start[head], pa.int32()), pa.array(count, pa.int64()),
                ], names=["packed", "doc", "start", "n"])

    return run


def enter_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of windows that occur more than once, from packed, doc, start."""
    for batch in batches:
        key, check = string_digests(batch.column("packed"))
        doc, one = batch.column("doc"), np.ones(len(key))
        yield pa.record_batch([
            bigints(key), bigints(check), doc.fill_null(0), doc.is_valid().cast(pa.int8()), batch.column("start"), pa.array(one, pa.int32()),
        ], names=["key", "check", "doc", "known", "start", "firsts"])


def equal_windows(ids: np.ndarray, window: int) -> np.ndarray:
    """The hash of each run of ``window`` word numbers."""
    out = np.zeros(len(ids) - window + 1, U64)
    with np.errstate(over="ignore"):
        for j in range(window):
            out = out * U64(0x9E3779B97F4A7C15) + ids[j : j + len(out)].astype(U64) + U64(1)
    return out ^ (out >> U64(29))


def first_places(table: pa.Table, window: int, hash_of=equal_windows) -> pa.RecordBatch | None:
    """Entries of the super-k-mers of whole buckets."""
    packed = table["packed"].combine_chunks()
    doc = table["doc"].combine_chunks()
    known, number = np.asarray(doc.is_valid()), np.asarray(doc.fill_null(0))
    start = table["start"].to_numpy()
    split = pc.split_pattern(packed.cast(pa.string()), " ")
    ids = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    begin = split.offsets.to_numpy().astype(np.int64)
    count = np.diff(begin) - window + 1
    of = np.repeat(np.arange(len(packed)), count)
    within = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    word = begin[of] + within
    # The order of documents as one number, with the place in the document behind it.
    order = np.lexsort((number, known))
    change = (np.diff(number[order]) != 0) | (np.diff(known[order].astype(np.int8)) != 0)
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(change)))
    place = (rank << 32) + start
    at = place[of] + within
    hashes = hash_of(ids, window)[word]
    order = np.lexsort((at, hashes))
    same = np.concatenate(([False], hashes[order][1:] == hashes[order][:-1]))
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)
    pairs = np.flatnonzero(same)
    if not (rows[word[order[pairs]]] == rows[word[order[pairs - 1]]]).all():
        # Different windows of one hash: tell them apart by their words.
        exact = np.unique(rows[word], axis=0, return_inverse=True)[1].ravel()
        order = np.lexsort((at, exact))
        same = np.concatenate(([False], exact[order][1:] == exact[order][:-1]))
    head = np.flatnonzero(~same)
    earliest = at[order][head][np.cumsum(~same) - 1]
    own = np.zeros(len(of), bool)
    own[order] = at[order] == earliest
    firsts = np.bincount(of, weights=own * 2.0 ** within, minlength=len(packed)).astype(np.int32)
    number_of = packed.dictionary_encode().indices.to_numpy()
    order = np.lexsort((place, number_of))
    head = runs(number_of[order])
    copies = np.diff(np.append(head, len(order)))
    one = order[head]
    one = one[(copies > 1) | (firsts[one] != 2 ** count[one] - 1)]
    if not len(one):
        return None
    key, check = string_digests(packed.take(pa.array(one)))
    return pa.record_batch([
        bigints(key), bigints(check), pa.array(number[one], pa.int64()), pa.array(known[one], pa.int8()),
        pa.array(start[one], pa.int32()), pa.array(firsts[one], pa.int32()),
    ], names=["key", "check", "doc", "known", "start", "firsts"])


def compare_buckets(window: int):
    """Reads records sorted by bucket; compares as many whole buckets at once as fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if size >= CHUNK_BYTES:
                table = pa.Table.from_batches(held)
                bucket = table["bucket"].to_numpy()
                # The last bucket may go on in the next batch.
                whole = int(np.searchsorted(bucket, bucket[-1]))
                if whole:
                    found = first_places(table.slice(0, whole), window)
                    if found is not None:
                        yield found
                    held = table.slice(whole).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
            held.append(batch)
            size += batch.nbytes
        if held:
            found = first_places(pa.Table.from_batches(held), window)
            if found is not None:
                yield found

    return run


def index_repeats(texts: DataFrame, window: int, seed: int, crowd: int) -> tuple[str, int]:
    """Write the arrays of minimisers and of repeated strings of texts (doc, text)."""
    spark = texts.sparkSession
    folder, bits = shared_path(spark, "repeats"), bits_for(texts)
    counts = texts.select("text").mapInArrow(count_minimisers(window, seed), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    write_sorted(counts.select("key", (F.col("n") > crowd).cast("tinyint").alias("crowded")), f"{folder}/minimisers", bits)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << bits)
    buckets = (
        texts.mapInArrow(pack(f"{folder}/minimisers", bits, window, seed), RECORD)
        .repartition(parts, "bucket").sortWithinPartitions("bucket")
    )
    entries = buckets.mapInArrow(compare_buckets(window), ENTRY)
    crowded = texts.mapInArrow(crowded_windows(f"{folder}/minimisers", bits, window, seed), "packed binary, doc bigint, start int, n bigint")
    crowded = crowded.groupBy("packed").agg(F.min(F.struct("doc", "start")).alias("place"), F.sum("n").alias("n")).where("n > 1")
    crowded = crowded.select("packed", "place.doc", "place.start").mapInArrow(enter_windows, ENTRY)
    write_sorted(entries.unionByName(crowded), f"{folder}/strings", bits)
    return folder, bits


def repeated_words(piece: Piece, docs: pa.Array, folder: str, bits: int, window: int) -> np.ndarray:
    """True for each word of a piece that a repeated window covers."""
    known = find(f"{folder}/minimisers", bits, piece.minimiser, ["crowded"])
    calm = np.flatnonzero(known["found"] & (known["crowded"] == 0))
    first, of = expand(piece, np.flatnonzero(known["crowded"] == 1))
    begin = np.concatenate((piece.first[calm], first))
    count = np.concatenate((piece.windows[calm], np.ones(len(first), np.int64)))
    of = np.concatenate((calm, of))
    start = piece.start[of] + begin - piece.first[of]
    key, check = digests(piece.data, piece.at[begin], piece.at[begin + count + window - 1] - 1)
    names = ["doc", "known", "start", "firsts"]
    entry = find(f"{folder}/strings", bits, key, names, also={"check": check.view(np.int64)})
    doc = docs.take(pa.array(piece.text[of]))
    here = (entry["known"] == np.asarray(doc.is_valid())) & (entry["doc"] == np.asarray(doc.fill_null(0))) & (entry["start"] == start)
    firsts = np.where(here, entry["firsts"], 0)
    hit = np.flatnonzero(entry["found"])
    row = np.repeat(hit, count[hit])
    within = np.arange(len(row)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
    repeat = (firsts[row] >> within) & 1 == 0
    gone = (begin[row] + within)[repeat]
    edge = np.bincount(gone, minlength=len(piece.at) + window) - np.bincount(gone + window, minlength=len(piece.at) + window)
    return np.cumsum(edge)[: len(piece.at) - 1] > 0


def without_repeats(folder: str, bits: int, window: int, seed: int, doc: Column, text: Column) -> Column:
    @F.arrow_udf(FOUND)
    def kept(docs: pa.Array, texts: pa.Array) -> pa.Array:
        out, docs = [], docs.cast(pa.int64())
        for place, some in pieces(plain(texts)):
            piece = cut(some, window, seed)
            gone = repeated_words(piece, docs.slice(place, len(some)), folder, bits, window)
            of = np.repeat(np.arange(len(some)), piece.words)
            removed = np.bincount(of[gone], minlength=len(some))
            size = np.diff(piece.at)
            stay = piece.data[np.repeat(~gone, size)]
            ends = np.concatenate(([0], np.cumsum(np.bincount(of, weights=size * ~gone, minlength=len(some)).astype(np.int64))))
            joined = pa.Array.from_buffers(pa.large_string(), len(some), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(stay)])
            texts_left = pc.ascii_rtrim(joined, characters=" ").cast(pa.string())
            out.append(pa.StructArray.from_arrays(
                [pa.array(piece.words, pa.int64()), pa.array(removed, pa.int64()), texts_left], ["n_words", "n_removed", "kept_text"],
            ))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]))

    return kept(doc, text)


def remove_repeats(documents: DataFrame, window: int = WINDOW, seed: int = SEED, crowd: int = CROWD) -> DataFrame:
    """The rows of documents as struct ``row``, with id, n_words, n_removed and kept_text:
    the words that no window covers whose words also start earlier, joined by one space.

    Earlier is a smaller doc_id, or an earlier word of the same one; a null doc_id is smaller
    than all. Rows that repeat a doc_id count as one document: windows at the same word of
    both are not earlier than each other. Words are split at white space (space and control
    characters 9 to 13) and compared unchanged. Windows are judged on the texts as given. A
    null text has no words, and texts of fewer than ``window`` words lose none. Needs doc_id
    and text; other columns travel along under any name.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc"), "text")
    folder, bits = index_repeats(texts, window, seed, crowd)
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.col("text").alias("_text"))
    rows = rows.withColumn("kept", without_repeats(folder, bits, window, seed, F.col("id"), F.col("_text")))
    return rows.select("row", "id", "kept.*")
