"""Benchmark decontamination by templates.

Texts are read as templates: numbers, names and units become typed placeholders, other words
are lower-cased and stand without the punctuation around them. Windows of a template are
hashed and joined with the windows of the benchmark items. A run of matching windows at one
distance between the texts is an item again, perhaps with other parameters, if its slots
agree: one value of the item always stands for the same value of the document.

Besides, windows of the real words are matched, in lower case without punctuation and
placeholders, so a copy is found whatever its case and punctuation make of its names, and
where the slots of a part do not agree. An item of fewer words
than a window is one such window, whatever its words are, so verbatim copies of any item are
found. Items of fewer than five words are common phrases, so they must be whole sentences or
lines of a document.

The hashes of the items' windows lie in shared files as sorted arrays. Tasks that read
documents look windows up there, so only windows that occur in an item are shuffled.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.nearcopies import id_set, in_set
from tickertide.llm.shared import U64, find, listed, read_arrays, shard_bits, shared_path, write_sorted
from tickertide.llm.words import hash_spans, hash_word, lowered, mix, pieces, plain, raw_bytes, release, word_spans

PIECE = 1 << 19  # text bytes worked on at once; each takes some 60 bytes of arrays meanwhile
WINDOW = 8  # words of a window
SHORTEST = 5  # words of the shortest item with a template; up to WINDOW it is one window
LITERALS = 4  # words of a window that are no placeholders
MARK_BITS = 22
EXACT = 64  # tells hashes of real words from those of templates
MATCHES = 5  # windows of an item that a document must have, or all of a shorter item

# -- fixed values: units, as they are written behind a number --
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons oz lb lbs pound pounds "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years km/h mph percent degrees celsius fahrenheit dollars euros usd eur"
).split()

# -- fixed values: what lower case leaves different, and what is no part of a real word --
SAME = {"\u00a0": " ", "ß": "ss", "ς": "σ"}
PUNCTUATION = r"[^\pL\pN\pM\t-\r ]+"
SENTENCE_END = r"[.!?:\x{2026}\x{3002}]+[^\pL\pN\pM\t-\r ]*[\t-\r ]"

NUMBER, NAME, UNIT = (U64(x) for x in (0x4E554D, 0x4E414D45, 0x554E4954))


def byte_set(test) -> np.ndarray:
    return np.array([test(chr(i)) if i < 128 else True for i in range(256)])


CORE = byte_set(str.isalnum)
DIGIT = byte_set(str.isdigit) & (np.arange(256) < 128)
CAPITAL = byte_set(str.isupper) & (np.arange(256) < 128)
SMALL = byte_set(str.islower)
STOP = byte_set(lambda c: c in ".!?:") & (np.arange(256) < 128)


def templates(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, canonical word, slot) of the words of a piece of texts.

    The slot is the hash of the word behind a placeholder and 0 elsewhere. A number is a word
    with a digit in front. A name is a capitalised word that neither begins its text or line
    nor follows the end of a sentence. Words of punctuation only do not count.
    """
    data, offsets = raw_bytes(texts)
    starts, ends = word_spans(data, offsets)
    core = CORE[data]
    rank = np.concatenate(([0], np.cumsum(core, dtype=np.int64)))
    at = np.flatnonzero(core)
    some = rank[ends] > rank[starts]
    first, last = at[rank[starts[some]]], at[rank[ends[some]] - 1] + 1
    doc = np.searchsorted(offsets, first, "right") - 1
    low = lowered(data)
    word = hash_spans(low, first, last)
    number = DIGIT[data[first]]
    # A capital letter, in ASCII or among the two-byte Latin letters from À to Þ.
    after = np.append(data, [0, 0])
    capital = CAPITAL[data[first]] & SMALL[after[first + 1]] | (data[first] == 0xC3) & (after[first + 1] >= 0x80) & (after[first + 1] <= 0x9E)
    follows = np.zeros(len(first), bool)  # a word of the same sentence stands in front
    breaks = np.concatenate(([0], np.cumsum(data == 10, dtype=np.int64)))
    follows[1:] = (doc[1:] == doc[:-1]) & ~STOP[after[last[:-1]]] & (breaks[first[1:]] == breaks[last[:-1]])
    name = capital & follows & ~number
    unit = np.zeros(len(first), bool)
    unit[1:] = number[:-1] & (doc[1:] == doc[:-1]) & np.isin(word[1:], np.array([hash_word(u) for u in UNITS], U64))
    canonical = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, word)))
    return doc, canonical, np.where(canonical == word, U64(0), word)


def window_hashes(doc: np.ndarray, canonical: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows of ``size`` words with enough literal words."""
    n = len(doc) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    literal = np.concatenate(([0], np.cumsum(slot == 0)))
    inside = (doc[size - 1 :] == doc[:n]) & (literal[size:] - literal[:n] >= min(LITERALS, size - 1))
    begin = np.flatnonzero(inside)
    return begin, hash_runs(canonical, size, size)[begin]


def hash_runs(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(words) - size + 1
    total = np.full(n, seed, U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * U64(0x9E3779B97F4A7C15) + mix(words[k : k + n])
    return mix(total)


def real_words(texts: pa.Array, sentences: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, begins) of the words of a piece of texts, without placeholders, case and
    punctuation. Words of punctuation only do not count. ``begins`` marks the words that begin
    a sentence or line, where ``sentences`` are asked for."""
    low = pc.utf8_lower(texts)
    for a, b in SAME.items():
        low = pc.replace_substring(low, a, b)
    if sentences:
        low = pc.replace_substring_regex(low, SENTENCE_END, "\n")
    data, offsets = raw_bytes(pc.replace_substring_regex(low, PUNCTUATION, ""))
    starts, ends = word_spans(data, offsets)
    doc = np.searchsorted(offsets, starts, "right") - 1
    begins = np.ones(len(doc) + 1, bool)
    if sentences and len(doc):
        breaks = np.flatnonzero((data >= 10) & (data <= 13))
        begins[1:-1] = (doc[1:] != doc[:-1]) | (np.searchsorted(breaks, starts[1:]) > np.searchsorted(breaks, ends[:-1]))
    return doc, hash_spans(data, starts, ends), begins


def exact_hashes(doc: np.ndarray, word: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows of ``size`` real words, below SHORTEST those that
    begin and end with a sentence."""
    n = len(doc) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    inside = doc[size - 1 :] == doc[:n]
    if size < SHORTEST:
        inside &= begins[:n] & begins[size:]
    begin = np.flatnonzero(inside)
    return begin, hash_runs(word, size, EXACT + size)[begin]


def first_ones(begin: np.ndarray, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The places of the first of equal hashes of each text."""
    order = np.lexsort((begin, hashes, doc[begin]))
    d, h = doc[begin][order], hashes[order]
    return np.sort(order[np.concatenate(([True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])))]) if len(order) else order


def hits_batch(ids: pa.Array, begin: np.ndarray, doc: np.ndarray, word_at: np.ndarray, hashes: np.ndarray, slot: np.ndarray | None, size: int) -> pa.RecordBatch:
    """Windows as rows; those of real words have no slots (None)."""
    width = 0 if slot is None else size
    slots = np.lib.stride_tricks.sliding_window_view(slot, size)[begin] if width and len(begin) else np.zeros((0, size), U64)
    ends = np.arange(len(begin) + 1, dtype=np.int32) * np.int32(width)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(slots.ravel().view(np.int64)))
    same = [pa.array(np.full(len(begin), x)) for x in (np.int32(size), slot is None)]
    return pa.record_batch(
        [ids.take(pa.array(doc[begin])), pa.array(word_at[begin], pa.int64()), pa.array(hashes.view(np.int64)), lists, *same],
        names=["id", "at", "hash", "slots", "size", "exact"],
    )


def places(doc: np.ndarray) -> np.ndarray:
    """The number of each word within its text."""
    first = np.searchsorted(doc, doc)
    return np.arange(len(doc)) - first


WINDOWS = "id bigint, at bigint, hash bigint, slots array<bigint>, size int, exact boolean"


def item_windows(items: DataFrame, item_id: str, text: str, nameless: bool = True) -> DataFrame:
    """Windows of benchmark items; an item of fewer words than a window is one window.
    ``nameless`` items, those without id, are known by a hash of their text."""

    def run(batches):
        for batch in batches:
            start_id = batch.column(0).cast(pa.int64())
            for start, piece in pieces(plain(batch.column(1))):
                ids = start_id.slice(start, len(piece))
                doc, canonical, slot = templates(piece)
                at = places(doc)
                sizes = np.bincount(doc, minlength=len(piece))
                for size in range(SHORTEST, WINDOW + 1):
                    begin, hashes = window_hashes(doc, canonical, slot, size)
                    if size < WINDOW:
                        whole = sizes[doc[begin]] == size
                        begin, hashes = begin[whole], hashes[whole]
                    yield hits_batch(ids, begin, doc, at, hashes, slot, size)
                doc, word, _ = real_words(piece)
                at = places(doc)
                whole_item = np.ones(len(doc) + 1, bool)
                sizes = np.bincount(doc, minlength=len(piece))
                for size in range(1, WINDOW + 1):
                    begin, hashes = exact_hashes(doc, word, whole_item, size)
                    if size < WINDOW:
                        whole = sizes[doc[begin]] == size
                        begin, hashes = begin[whole], hashes[whole]
                    yield hits_batch(ids, begin, doc, at, hashes, None, size)

    key = F.col(item_id).cast("bigint")
    if nameless:
        key = F.coalesce(key, F.xxhash64(F.col(text)))
    return items.select(key.alias("id"), text).where("id is not null").mapInArrow(run, WINDOWS)


@lru_cache(maxsize=2)
def marks(folder: str) -> np.ndarray:
    """For the leading bits of a hash whether any stored hash has them: most windows need no
    search. Built once per worker."""
    out = np.zeros(1 << MARK_BITS, bool)
    for name in listed(folder):
        out[(read_arrays(f"{folder}/{name}")["key"] >> U64(64 - MARK_BITS)).astype(np.int64)] = True
    return out


def is_item_window(hashes: np.ndarray, folder: str, bits: int) -> np.ndarray:
    """The places of the hashes that are stored."""
    some = np.flatnonzero(marks(folder)[(hashes >> U64(64 - MARK_BITS)).astype(np.int64)])
    return some[find(folder, bits, hashes[some], [])["found"]]


def document_windows(documents: DataFrame, folder: str, bits: int, sizes: list[int], exact_sizes: list[int]) -> DataFrame:
    """Windows of the documents (id, text) that occur in an item."""

    def run(batches):
        for batch in batches:
            all_ids = batch.column(0)
            for start, piece in pieces(plain(batch.column(1)), PIECE):
                ids = all_ids.slice(start, len(piece))
                doc, canonical, slot = templates(piece)
                for size in sizes:
                    begin, hashes = window_hashes(doc, canonical, slot, size)
                    known = is_item_window(hashes, folder, bits)
                    if len(known):
                        yield hits_batch(ids, begin[known], doc, places(doc), hashes[known], slot, size)
                doc, word, begins = real_words(piece, sentences=any(size < SHORTEST for size in exact_sizes))
                for size in exact_sizes:
                    begin, hashes = exact_hashes(doc, word, begins, size)
                    # Of equal windows that are whole items the first one of a text is enough.
                    known = is_item_window(hashes, folder, bits)
                    if size < WINDOW:
                        known = known[first_ones(begin[known], hashes[known], doc)]
                    if len(known):
                        yield hits_batch(ids, begin[known], doc, places(doc), hashes[known], None, size)
            release()

    return documents.mapInArrow(run, WINDOWS)


def matches(documents: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", nameless: bool = True) -> DataFrame:
    """(id, item, windows, reworded) for each document and item it contains, by windows of
    templates or of real words.

    ``documents`` has id and text. ``reworded`` says that some slot has another value.
    """
    spark = documents.sparkSession
    items = item_windows(benchmark, item_id, item_text, nameless).withColumnsRenamed({"id": "item", "at": "item_at", "slots": "item_slots"})
    folder, bits = shared_path(spark, "benchmark-windows"), shard_bits(spark)
    known = items.groupBy(F.col("hash").alias("key")).agg(F.max("size").alias("size"))
    write_sorted(known, folder, bits)
    kinds = items.select("exact", "size").distinct().collect()  # WINDOW of either kind at most
    sizes, exact_sizes = (sorted(r["size"] for r in kinds if r["exact"] == exact) for exact in (False, True))
    needed = items.groupBy("item", "exact").agg(F.count_distinct("item_at").alias("all"))
    needed = needed.withColumn("needed", F.least("all", F.lit(MATCHES)))
    hits = document_windows(documents, folder, bits, sizes, exact_sizes).drop("size", "exact").distinct().join(items, "hash")
    hits = hits.withColumn("shift", F.col("at") - F.col("item_at"))
    run = ["id", "item", "exact", "shift"]
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != 0)
    # One row per slot value of the item, and one with null for windows without slots.
    slots = hits.select(*run, "item_at", F.explode_outer(pairs).alias("p"))
    by_value = slots.groupBy(*run, "p.item_slots").agg(F.min("p.slots").alias("lo"), F.max("p.slots").alias("hi"))
    odd = by_value.groupBy(*run).agg(
        F.coalesce(F.bool_or(F.col("lo") != F.col("hi")), F.lit(False)).alias("odd"),
        F.coalesce(F.bool_or(F.col("lo") != F.col("item_slots")), F.lit(False)).alias("reworded"),
    )
    counts = hits.groupBy(*run).agg(F.count_distinct("item_at").alias("windows"))
    runs = counts.join(odd, run).join(needed, ["item", "exact"]).where("windows >= needed")
    # A run whose slots do not agree is no match, but tells that slots have other values. Real
    # words tell that nothing is reworded only if they are the whole item.
    reworded = F.when(~F.col("exact") | (F.col("windows") == F.col("all")), F.col("odd") | F.col("reworded"))
    return runs.groupBy("id", "item").agg(
        F.max(F.when(~F.col("odd"), F.col("windows"))).alias("windows"), F.coalesce(F.bool_and(reworded), F.lit(False)).alias("reworded")
    ).where("windows is not null")


def row_key(documents: DataFrame) -> Column:
    """The doc_id; rows without one are known by their text."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text")))


def contamination(documents: DataFrame, benchmark: DataFrame, nameless: bool = True) -> DataFrame:
    """One row per document: doc_id, contaminated, items (ids of the items found, sorted),
    windows (of all of them) and reworded (an item has other parameters).

    Rows that share an id are one document, whatever their texts. Items of fewer than five
    words are found where they are a whole sentence or line, and windows with few literal words
    by their real words only. Items without a word are in no document. Items without id have a
    hash of their text as id; they are left out if ``nameless`` is not set. Null
    texts are empty. Needs doc_id and text; other columns are ignored.
    """
    keyed = documents.select("doc_id", row_key(documents).alias("id"), "text")
    found = matches(keyed.select("id", "text"), benchmark, nameless=nameless).groupBy("id").agg(
        F.sort_array(F.collect_list("item")).alias("items"), F.sum("windows").alias("windows"), F.bool_or("reworded").alias("reworded")
    )
    return keyed.select("doc_id", "id").join(found, "id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("windows", F.lit(0)).alias("windows"), F.coalesce("reworded", F.lit(False)).alias("reworded"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, nameless: bool = True) -> DataFrame:
    """The rows without benchmark items; all columns stay."""
    key = row_key(documents)
    found = matches(documents.select(key.alias("id"), "text"), benchmark, nameless=nameless).select("id")
    folder, bits = id_set(found, "contaminated")
    return documents.where(~in_set(key, folder, bits))
