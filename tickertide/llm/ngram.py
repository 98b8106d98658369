"""Interpolated modified Kneser-Ney language model.

N-grams are counted in Spark and stored as sorted hash arrays in shared files, which the
workers that score texts map into memory.

* Counting: each task counts the n-grams of a piece of texts and packs them into blocks by
  shard; one task per shard adds the blocks up and writes them. A shard holds the n-grams of
  a range of contexts, so context sums are local. Contexts made of frequent words only (each
  over a thousandth of all words) are dealt over all shards by the whole n-gram, and their
  sums are added up afterwards, so no context makes a shard large.
* Lower orders count the different words that stand before an n-gram, so each merge task
  hands its distinct n-grams on, without their first word, to the shards of the next order.
* Discounts come from the counts of n-grams seen once to four times and are applied when a
  text is scored; the files hold counts.
* Disk: blocks list their words once and are compressed; numbers take as few bytes as they
  need, and contexts with one n-gram, seen once, take twelve bytes together with it.

Words and n-grams are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.shared import (
    U64, bits_for, find, listed, read_arrays, shards, shared_path, write_arrays, write_sorted,
)
from tickertide.llm.words import hashed_words, join_hashes, pieces, plain, runs
from tickertide.session import cut_lineage

# Tokens besides words: where a text begins (a context only) and its end.
START, END = U64(0x5354415254), U64(0x454E44)
# A word with more than 1/HOT_SHARE of all tokens is frequent, so there are fewer than that.
HOT_SHARE = 1000
SAMPLE = 64  # frequent words are taken from one text in so many
COUNT_BYTES = 12 << 20  # text bytes counted at once
SCORE_BYTES = 8 << 20  # text bytes scored at once

BLOCK = "shard int, block binary"
SCORE = "n_tokens bigint, n_known bigint, base_score double, score double"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts with START before and END after each, and tokens per text
    without START."""
    words, counts = [], []
    for _, piece in pieces(texts):
        h, n = hashed_words(piece)
        words.append(h)
        counts.append(n)
    n = np.concatenate([*counts, np.zeros(0, np.int64)])
    h = np.concatenate([*words, np.zeros(0, U64)])
    out = np.empty(len(h) + 2 * len(n), U64)
    ends = np.cumsum(n + 2) - 1
    out[ends - n - 1] = START
    out[ends] = END
    inner = np.ones(len(out), bool)
    inner[ends] = inner[ends - n - 1] = False
    out[inner] = h
    return out, n + 1


def planes(column: np.ndarray, width: int) -> bytes:
    """All lowest bytes first, then all second ones: high bytes are mostly zeros."""
    return column.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def narrow(column: np.ndarray) -> np.ndarray:
    """In as few bytes as the numbers need."""
    most = column.max() if len(column) else 0
    kind = next((k for k in (np.uint8, np.uint16, np.uint32) if most <= np.iinfo(k).max), np.int64)
    return column.astype(kind)


def pack(words: list[np.ndarray], numbers: list[np.ndarray]) -> bytes:
    """Rows as one block: its words once, frequent ones first, then the rows in the order of
    their places in that list, as differences where the words before are the same."""
    codes, values = pd.factorize(np.concatenate(words))
    by = np.argsort(-np.bincount(codes), kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    columns = np.split(rank[codes], len(words))
    order = np.lexsort(columns[::-1])
    parts, new = [], np.zeros(len(order), bool)
    new[:1] = True
    for c in (c[order] for c in columns):
        parts.append(np.where(new, c, np.diff(c, prepend=0)))
        new = new | (np.diff(c, prepend=0) != 0)
    parts += [n[order] for n in numbers]
    widths = [narrow(x).itemsize for x in parts]
    body = b"".join([values[by].tobytes(), *[planes(x, k) for x, k in zip(parts, widths)]])
    head = np.array([len(body), len(order), len(values), len(words), len(numbers), *widths], U64)
    return head.tobytes() + pa.Codec("zstd").compress(body, asbytes=True)


def unpack(block: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    size, n, n_values, n_words, n_numbers = np.frombuffer(block, U64, 5).astype(int)
    widths = np.frombuffer(block, U64, n_words + n_numbers, 40).astype(int).tolist()
    body = pa.Codec("zstd").decompress(block[40 + 8 * len(widths) :], int(size), asbytes=True)
    values, place, parts = np.frombuffer(body, U64, n_values), 8 * n_values, []
    for width in widths:
        part = np.frombuffer(body, np.uint8, n * width, place).reshape(width, n).T
        parts.append(np.ascontiguousarray(part).view(f"<u{width}").ravel().astype(np.int64))
        place += n * width
    words, new = [], np.zeros(n, bool)
    new[:1] = True
    for part in parts[:n_words]:
        at, sums = np.flatnonzero(new), np.cumsum(part)
        base = np.repeat(sums[at] - part[at], np.diff(np.append(at, n)))
        code = sums - base
        words.append(values[code])
        new = new | (np.diff(code, prepend=0) != 0)
    return words, parts[n_words:]


def deal(words: list[np.ndarray], numbers: list[np.ndarray], hot: np.ndarray, bits: int) -> pa.RecordBatch:
    """Blocks of n-grams for the tasks that own them, one per shard."""
    shard = shards(words[0], bits) if len(words) == 1 else gram_shards(words, hot, bits)
    order = np.argsort(shard.astype(np.uint16 if bits <= 16 else np.uint32), kind="stable")
    shard = shard[order]
    words, numbers = [w[order] for w in words], [n[order] for n in numbers]
    at = runs(shard).tolist()
    packed = [pack([w[a:b] for w in words], [n[a:b] for n in numbers]) for a, b in zip(at, [*at[1:], len(shard)])]
    return pa.record_batch([pa.array(shard[at], pa.int32()), pa.array(packed, pa.binary())], names=["shard", "block"])


def merged(table: pa.Table) -> tuple[int, list[np.ndarray], list[np.ndarray]]:
    """Shard, distinct rows of its blocks by hash, and the sums of their numbers."""
    parts = [unpack(b.as_py()) for b in table["block"]]
    words, numbers = ([np.concatenate(c) for c in zip(*[p[i] for p in parts])] for i in (0, 1))
    return table["shard"][0].as_py(), *added_up(words, numbers)


def added_up(words: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    key = join_hashes(*words)
    order = np.argsort(key)
    at = runs(key[order])
    return [w[order[at]] for w in words], [np.add.reduceat(n[order], at) for n in numbers]


def is_hot(words: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    out = np.ones(len(words[0]), bool)
    for w in words:
        out &= np.isin(w, hot)
    return out


def gram_shards(words: list[np.ndarray], hot: np.ndarray, bits: int) -> np.ndarray:
    """By context; contexts of frequent words only, by the whole n-gram."""
    by_context = shards(context_key(words[:-1]), bits)
    return np.where(is_hot(words[:-1], hot), shards(join_hashes(*words), bits), by_context)


def follower(grams: np.ndarray) -> np.ndarray:
    """Tells the n-grams of one context apart."""
    return grams.astype(np.uint32)


def context_key(words: list[np.ndarray]) -> np.ndarray:
    return words[0] if len(words) == 1 else join_hashes(*words)


def count_grams(order: int, hot: np.ndarray, bits: int):
    """Counts the n-grams of texts, a piece of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, piece in pieces(plain(batch.column(0)), COUNT_BYTES):
                hashes, sizes = tokens(piece)
                codes, words = pd.factorize(hashes)
                rank = np.argsort(words)
                place = np.empty(len(words), np.int64)
                place[rank] = np.arange(len(words))
                words, codes = words[rank], place[codes]
                # START, words, END of each text; with order - 2 more STARTs in front.
                first = np.zeros(len(codes), np.int64)
                begins = np.cumsum(sizes + 1) - sizes - 1
                first[begins] = begins
                first = np.maximum.accumulate(first)
                spot = np.delete(np.arange(len(codes)), begins)
                columns = [codes[np.maximum(spot - k, first[spot])] for k in range(order - 1, -1, -1)]
                columns, counts = distinct(columns, len(words))
                yield deal([words[c] for c in columns], [counts], hot, bits)

    return run


def distinct(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of numbers below ``size``, and how often each occurs."""
    if size ** len(columns) >= 1 << 63:
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        for c in columns:
            new |= np.concatenate(([True], c[order][1:] != c[order][:-1]))
        at = np.flatnonzero(new)
        return [c[order[at]] for c in columns], np.diff(np.append(at, len(order)))
    row = columns[0]
    for c in columns[1:]:
        row = row * size + c
    row = np.sort(row)
    at = runs(row)
    row, counts = row[at], np.diff(np.append(at, len(row)))
    out = []
    for _ in columns:
        row, c = np.divmod(row, size)
        out.append(c)
    return out[::-1], counts


def count_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64)


def merge_grams(folder: str, order: int, hot: np.ndarray, bits: int):
    """Writes the n-grams of a shard and the sums of their contexts; hands the distinct
    n-grams without their first word on to the next lower order.

    Most contexts of a higher order are followed by one word, once. These stand apart, with
    32 bits of their n-gram, and neither sums nor that n-gram are stored.

    Numbers of an n-gram are how many different words stand before it and how often it
    occurs; in the highest order, only the latter.
    """

    def run(table: pa.Table) -> pa.Table:
        shard, words, numbers = merged(table)
        counts, often = numbers[0], numbers[-1]
        key = join_hashes(*words)  # sorted
        context = context_key(words[:-1])
        by = np.argsort(context)
        at = runs(context[by])
        total = np.add.reduceat(counts[by], at)
        shared = is_hot([w[by[at]] for w in words[:-1]], hot)
        lone = (total == 1) & ~shared
        alone = np.zeros(len(key), bool)
        alone[by[at[lone]]] = True
        write_arrays(f"{folder}/lone{order}/{shard}", {"key": context[by[at[lone]]], "follower": follower(key[by[at[lone]]])})
        many = counts > 1
        write_arrays(f"{folder}/once{order}/{shard}", {"key": key[~many & ~alone]})
        write_arrays(f"{folder}/more{order}/{shard}", {"key": key[many], "count": narrow(counts[many])})
        sums = {"total": total}
        for k in (1, 2, 3):
            seen = counts == k if k < 3 else counts >= 3
            sums[f"n{k}"] = np.add.reduceat(seen[by].astype(np.int64), at)
        sums = {n: narrow(x[~lone]) for n, x in sums.items()}
        write_arrays(f"{folder}/context{order}/{shard}", {"key": context[by[at[~lone]]], **sums, "shared": shared[~lone].astype(np.int8)})
        write_arrays(f"{folder}/seen{order}/{shard}", {"n": count_of_counts(counts)})
        return pa.Table.from_batches([deal(*added_up(words[1:], [np.ones(len(key), np.int64), often]), hot, bits)])

    return run


def merge_words(folder: str):
    """Writes how often each word of a shard occurs and how many different words stand
    before it."""

    def run(table: pa.Table) -> pa.Table:
        shard, (words,), (before, often) = merged(table)
        write_arrays(f"{folder}/words/{shard}", {"key": words, "count": narrow(often), "before": narrow(before)})
        write_arrays(f"{folder}/seen1/{shard}", {"n": np.append(count_of_counts(before), [before.sum(), (before > 2).sum()])})
        return pa.table({"n": often})

    return run


def read_shared(files: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                arrays = read_arrays(files[i])
                keep = arrays["shared"] > 0
                yield pa.record_batch([pa.array(arrays[n][keep].astype(np.int64 if n != "key" else U64).view(np.int64)) for n in names], names=names)

    return run


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more, from the number of
    n-grams seen one to four times. Where one of these is 0, half of the count but 1 at
    most; each stays above 0 and below the count, so that every text has a probability."""
    if min(n) == 0:
        return [0.5, 0.75, 1.0]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3))]


@dataclass
class Model:
    """Where the arrays are, and the few numbers that all texts share."""

    folder: str
    bits: int
    order: int
    hot: np.ndarray
    train_tokens: int
    words: int
    discounts: dict[int, list[float]]
    endings: list[int]  # distinct n-grams of order 2; words that end 1, 2, more of them

    def word_probability(self, words: np.ndarray) -> np.ndarray:
        total, *n = self.endings
        lowest = 1 / (self.words + 1)
        if not total:
            return np.full(len(words), lowest)
        c = find(f"{self.folder}/words", self.bits, words, ["before"])["before"]
        d = np.array([0.0, *self.discounts[1]])
        left = sum(a * b for a, b in zip(self.discounts[1], n)) / total
        return (c - d[np.minimum(c, 3)]) / total + left * lowest

    def contexts(self, order: int, words: list[np.ndarray]) -> dict[str, np.ndarray]:
        names = ["total", "n1", "n2", "n3"]
        key = context_key(words)
        out = find(f"{self.folder}/context{order}", self.bits, key, names)
        lone = find(f"{self.folder}/lone{order}", self.bits, key, ["follower"])
        out = {n: out[n].astype(np.int64) for n in names} | {"lone": lone["found"], "follower": lone["follower"]}
        out["total"][lone["found"]] = out["n1"][lone["found"]] = 1
        hot = np.flatnonzero(is_hot(words, self.hot))
        if len(hot):
            sums = find(f"{self.folder}/shared{order}", 1, key[hot], names)
            for n in names:
                out[n][hot] = sums[n]
        return out

    def probability(self, words: list[np.ndarray]) -> np.ndarray:
        """Of the last word after the others, for rows of word hashes."""
        if len(words) == 1:
            return self.word_probability(words[0])
        order = len(words)
        codes, lower = distinct_rows(words[1:])
        below = self.probability(lower)[codes]
        codes, context = distinct_rows(words[:-1])
        sums = self.contexts(order, context)
        key, where = join_hashes(*words), gram_shards(words, self.hot, self.bits)
        once = find(f"{self.folder}/once{order}", self.bits, key, [], where)["found"]
        only = sums["lone"][codes] & (sums["follower"][codes] == follower(key))
        count = find(f"{self.folder}/more{order}", self.bits, key, ["count"], where)["count"] + (once | only).astype(np.int64)
        d = self.discounts[order]
        total = sums["total"].astype(np.float64)
        left = sum(d[k - 1] * sums[f"n{k}"] for k in (1, 2, 3))
        known = total > 0
        total[~known] = 1
        left = np.where(known, left / total, 1.0)[codes]
        seen = (count - np.array([0.0, *d])[np.minimum(count, 3)]) / total[codes]
        return seen + left * below

    def score(self, texts: pa.Array) -> pa.Array:
        """(n_tokens, n_known, base_score, score) of each text."""
        out = []
        for _, piece in pieces(texts, SCORE_BYTES):
            hashes, sizes = tokens(piece)
            codes, words = pd.factorize(hashes)
            counts = find(f"{self.folder}/words", self.bits, words, ["count"])["count"].astype(np.int64)
            begins = np.cumsum(sizes + 1) - sizes - 1
            first = np.zeros(len(codes), np.int64)
            first[begins] = begins
            first = np.maximum.accumulate(first)
            spot = np.delete(np.arange(len(codes)), begins)
            columns = [codes[np.maximum(spot - k, first[spot])] for k in range(self.order - 1, -1, -1)]
            rows, grams = number_rows(columns, len(words))
            chance = np.log10(self.probability([words[g] for g in grams]))[rows]
            c = counts[codes[spot]]
            base = np.log10((c + 1) / (self.train_tokens + self.words + 1))
            at = np.cumsum(sizes) - sizes
            out.append([sizes, np.add.reduceat((c > 0).astype(np.int64), at), np.add.reduceat(base, at), np.add.reduceat(chance, at)])
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 4
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["n_tokens", "n_known", "base_score", "score"]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def number_rows(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of each row among the distinct rows, and those."""
    if size ** len(columns) >= 1 << 63:
        rows, key = pd.factorize(join_hashes(*[c.astype(U64) for c in columns]))
    else:
        row = columns[0]
        for c in columns[1:]:
            row = row * size + c
        rows, key = pd.factorize(row)
    at = np.empty(len(key), np.int64)
    at[rows] = np.arange(len(rows))
    return rows, [c[at] for c in columns]


def distinct_rows(words: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    rows, key = pd.factorize(context_key(words))
    at = np.empty(len(key), np.int64)
    at[rows] = np.arange(len(rows))
    return rows, [w[at] for w in words]


def fit(texts: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count a model from the texts of a column; a null is an empty text.

    ``order`` is 2 or 3. The files stay in the shared folder as long as the model is used.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = texts.sparkSession
    bits = bits_for(texts)
    folder = shared_path(spark, "ngrams")
    texts = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    hot = frequent_words(texts)

    step = texts.mapInArrow(count_grams(order, hot, bits), BLOCK)
    for k in range(order, 1, -1):
        step = step.groupBy("shard").applyInArrow(merge_grams(folder, k, hot, bits), BLOCK)
    words = step.groupBy("shard").applyInArrow(merge_words(folder), "n bigint")
    total, n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    rates, endings = {}, [0, 0, 0, 0]
    for k in range(1, order + 1):
        files = sorted(f"{folder}/seen{k}/{x}" for x in listed(f"{folder}/seen{k}"))
        n = np.zeros(6, np.int64)
        for f in files:  # four numbers from each shard
            part = read_arrays(f)["n"]
            n[: len(part)] += part
        rates[k] = discounts(n[:4].tolist())
        if k == 1:
            endings = [int(n[4]), int(n[0]), int(n[1]), int(n[5])]
        else:
            names = ["key", "total", "n1", "n2", "n3"]
            files = sorted(f"{folder}/context{k}/{x}" for x in listed(f"{folder}/context{k}"))
            rows = spark.range(0, len(files), 1, max(1, min(len(files), 1 << bits))).mapInArrow(
                read_shared(files, names), ", ".join(f"{n} bigint" for n in names)
            )
            write_sorted(rows.groupBy("key").agg(*[F.sum(n).alias(n) for n in names[1:]]), f"{folder}/shared{k}", 1)
    return Model(folder, bits, order, hot, total, n_words, rates, endings)


def frequent_words(texts: DataFrame) -> np.ndarray:
    """Words with more than 1/HOT_SHARE of the tokens of a sample of the texts, sorted.

    They say only which contexts are dealt over all shards, not what is counted.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, piece in pieces(plain(batch.column(0))):
                words, counts = np.unique(tokens(piece)[0], return_counts=True)
                yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") * HOT_SHARE > total).select("word").collect()  # fewer than HOT_SHARE
    return np.sort(np.array([r.word for r in rows], np.int64).view(U64))


def score_column(model: Model, text: Column) -> Column:
    """A struct of n_tokens, n_known, base_score and score of a text."""

    @F.arrow_udf(SCORE)
    def scored(texts: pa.Array) -> pa.Array:
        return model.score(plain(texts))

    return scored(text)


def score_texts(documents: DataFrame, held_out: Column, order: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows that are not held out and score all rows.

    Returns the key, held_out, n_tokens (words and one end), n_known (tokens that occur in
    the training texts), train_tokens, base_score (add-one unigram) and score, both log10.
    Null texts count as empty, a null ``held_out`` as false; repeated rows are scored and
    learnt as often as they stand there; other columns are ignored. Without training texts
    every token has the probability one over the words known plus one, which is 1.
    """
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")), "text", order)
    scored = rows.select("key", "held_out", score_column(model, F.col("text")).alias("s"))
    return scored.select(
        F.col("key").alias(key), "held_out", "s.n_tokens", "s.n_known",
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"), "s.base_score", "s.score",
    )
