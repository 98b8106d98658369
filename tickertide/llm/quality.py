"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a text is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

which is every pairwise interaction <v_i, v_j> x_i x_j in time linear in the features.
Features are the distinct words of the text, hashed, and one feature per structure statistic
that says in which range its value lies; the length the table states is one more of these.

The model is fitted on a bounded sample of labelled rows (``PER_CLASS`` of either label, those
of the smallest hash), in one task whose input that bounds; the classes are weighted as
frequent as they are among all labels. It is a few MB of numbers. Scoring is a function of a
row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.words import U64, hash_spans, lowered, pieces, plain, raw_bytes, runs, word_spans, words_per_text

HASHED = 1 << 16  # buckets of words
RANGES = 24  # ranges of a statistic
FACTORS = 8
PER_CLASS = 4000  # labelled rows of each class that are learnt from, at most
EPOCHS, BATCH, RATE, RIDGE = 6, 50, 0.08, 1e-5

STATISTICS = (
    "words", "word length", "distinct words", "upper-case words", "words with a digit in front", "sentence ends",
    "words that end in a symbol", "single symbols", "long words", "words per line", "stated length",
)
FEATURES = HASHED + RANGES * len(STATISTICS)


def kind_of_byte(test) -> np.ndarray:
    return np.array([test(chr(i)) if i < 128 else False for i in range(256)])


UPPER = kind_of_byte(str.isupper)
DIGIT = kind_of_byte(str.isdigit)
END = kind_of_byte(lambda c: c in ".!?")
SYMBOL = kind_of_byte(lambda c: not c.isalnum() and c not in ".,;:!?'\")(")


def share_range(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The range of a share: fine near 0, coarse near 1; the last one is for nothing to share."""
    share = part / np.maximum(whole, 1)
    return np.where(whole > 0, np.round(np.sqrt(share) * (RANGES - 2)).astype(np.int64), RANGES - 1)


def size_range(value: np.ndarray) -> np.ndarray:
    """The range of a size: powers of two; 0 is for 0."""
    return np.where(value > 0, np.minimum(1 + np.log2(np.maximum(value, 1)).astype(np.int64), RANGES - 1), 0)


def features(texts: pa.Array, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of a piece of texts, in order of text."""
    data, offsets = raw_bytes(texts)
    starts, ends = word_spans(data, offsets)
    n, counts = len(texts), words_per_text(starts, offsets)
    doc = np.repeat(np.arange(n), counts)
    hashes = hash_spans(lowered(data), starts, ends)
    key = np.sort(doc * HASHED + (hashes % U64(HASHED)).astype(np.int64))
    key = key[runs(key)]
    word_doc, bucket = np.divmod(key, HASHED)
    distinct = np.bincount(word_doc, minlength=n)

    def total(of_word: np.ndarray) -> np.ndarray:
        return np.bincount(doc, of_word, n)

    size = ends - starts
    first, last = data[starts], data[ends - 1]
    lines = np.diff(np.searchsorted(np.flatnonzero(data == 10), offsets)) + 1
    ranges = [
        size_range(counts),
        size_range(2 * total(size) / np.maximum(counts, 1)),
        share_range(distinct, counts),
        share_range(total(UPPER[first]), counts),
        share_range(total(DIGIT[first]), counts),
        share_range(total(END[last]), counts),
        share_range(total(SYMBOL[last] & (size > 1)), counts),
        share_range(total(SYMBOL[last] & (size == 1)), counts),
        share_range(total(size > 14), counts),
        size_range(2 * counts / lines),
        np.where(np.isnan(lengths), RANGES - 1, np.minimum(size_range(np.nan_to_num(lengths)), RANGES - 2)),
    ]
    fixed = np.stack([HASHED + RANGES * i + r for i, r in enumerate(ranges)], axis=1)
    all_doc = np.concatenate([word_doc, np.repeat(np.arange(n), len(ranges))])
    feature = np.concatenate([bucket, fixed.ravel()])
    value = np.concatenate([1 / np.sqrt(np.maximum(distinct, 1))[word_doc], np.full(fixed.size, 0.5)])
    order = np.argsort(all_doc, kind="stable")
    return all_doc[order], feature[order], value[order]


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # by feature
    factors: np.ndarray  # by feature and factor

    def margins(self, doc_starts: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        linear = np.add.reduceat(self.weights[feature] * value, doc_starts)
        vx = self.factors[feature] * value[:, None].astype(np.float32)
        summed = np.add.reduceat(vx, doc_starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), doc_starts)
        return self.bias + linear + 0.5 * ((summed * summed).sum(axis=1) - squares)

    def score(self, texts: pa.Array, lengths: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        stated = lengths.cast(pa.float64()).to_numpy(zero_copy_only=False)
        for start, piece in pieces(texts):
            doc, feature, value = features(piece, stated[start : start + len(piece)])
            out.append(1 / (1 + np.exp(-np.clip(self.margins(runs(doc), feature, value), -30, 30).astype(np.float64))))
        return pa.array(np.concatenate(out))


def constant(share: float) -> Machine:
    """The machine that gives every text one score."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Machine(float(np.log(share / (1 - share))), np.zeros(FEATURES), np.zeros((FEATURES, FACTORS), np.float32))


def learn(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, importance: np.ndarray) -> Machine:
    """Gradient descent with a step for each parameter, over rows in a fixed random order."""
    random = np.random.default_rng(7)
    share = float((labels * importance).sum() / importance.sum())
    m = constant(share)
    m.factors = random.normal(0, 0.02, (FEATURES, FACTORS)).astype(np.float32)
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-3), np.full((FEATURES, FACTORS), 1e-3, np.float32), 1e-3
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            feature = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            sizes = np.array([len(rows[i][0]) for i in batch])
            starts = np.cumsum(sizes) - sizes
            error = (1 / (1 + np.exp(-np.clip(m.margins(starts, feature, value), -30, 30))) - labels[batch]) * importance[batch]
            vx = m.factors[feature] * value[:, None].astype(np.float32)
            summed = np.repeat(np.add.reduceat(vx, starts, axis=0), sizes, axis=0)
            of_row = np.repeat(error, sizes)
            slope = of_row * value
            used, place = np.unique(feature, return_inverse=True)
            grad_w = np.bincount(place, slope) + RIDGE * m.weights[used]
            grad_v = np.stack([np.bincount(place, slope * (summed - vx)[:, f]) for f in range(FACTORS)], axis=1) + RIDGE * m.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            m.weights[used] -= RATE * grad_w / np.sqrt(seen_w[used])
            m.factors[used] -= (RATE * grad_v / np.sqrt(seen_v[used])).astype(np.float32)
            seen_b += error.sum() ** 2
            m.bias -= RATE * float(error.sum()) / np.sqrt(seen_b)
    return m


def length_column(documents: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in documents.columns else F.lit(None).cast("double")


def fit(documents: DataFrame, labels: DataFrame, learnable: Column) -> Machine:
    """Fit on the labelled documents for which ``learnable`` (of their doc_id) holds.

    Rows without a label count as unlabelled, and so do documents with two different
    labels. With labels of one kind only, or none, all texts score the share of label 1 or
    one half.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(learnable)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where("quality = other").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return constant(0.5 if not counts else float(next(iter(counts))))
    chosen = [known.where(F.col("_label") == k).orderBy(F.xxhash64("_id"), "_id").limit(PER_CLASS) for k in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * PER_CLASS ids
    texts = documents.select("doc_id", "text", length_column(documents).alias("length"))
    rows = texts.join(sample, texts["doc_id"] == sample["_id"])

    def extract(batches):
        for batch in batches:
            data = plain(batch.column(1))
            stated = batch.column(2).to_numpy(zero_copy_only=False)
            for start, piece in pieces(data):
                doc, feature, value = features(piece, stated[start : start + len(piece)])
                at = [*runs(doc).tolist(), len(doc)]
                spans = list(zip(at[:-1], at[1:]))
                yield pa.record_batch([
                    batch.column(0).slice(start, len(piece)).cast(pa.int64()), batch.column(3).slice(start, len(piece)).cast(pa.int32()),
                    pa.array([feature[a:b].astype(np.int32).tobytes() for a, b in spans], pa.binary()),
                    pa.array([value[a:b].astype(np.float32).tobytes() for a, b in spans], pa.binary()),
                ], names=["id", "label", "feature", "value"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("feature", "ascending")])
        y = table["label"].to_numpy().astype(np.float64)
        read = [(np.frombuffer(a.as_py(), np.int32), np.frombuffer(b.as_py(), np.float32).astype(np.float64)) for a, b in zip(table["feature"], table["value"])]
        weight = np.where(y == 1, counts[1] / max((y == 1).sum(), 1), counts[0] / max((y == 0).sum(), 1))
        m = learn(read, y, weight / weight.mean())
        return pa.table({"bias": [m.bias], "weights": [m.weights.tobytes()], "factors": [m.factors.tobytes()]})

    marked = rows.select("doc_id", "text", "length", "_label").mapInArrow(extract, "id bigint, label int, feature binary, value binary")
    fitted = marked.groupBy(F.lit(0).alias("all")).applyInArrow(train, "bias double, weights binary, factors binary").collect()
    if not fitted:
        return constant(0.5)
    bias, weights, factors = fitted[0]
    return Machine(bias, np.frombuffer(weights), np.frombuffer(factors, np.float32).reshape(FEATURES, FACTORS))


def score_column(machine: Machine, text: Column, length: Column) -> Column:
    """The score of a text, 0 to 1; null and empty texts are scored by their structure."""
    shared = machine

    @F.arrow_udf("double")
    def score(texts: pa.Array, lengths: pa.Array) -> pa.Array:
        return shared.score(plain(texts), lengths)

    return score(text, length)


def learnable_id() -> Column:
    """Two thirds of the ids; the others are held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 != 1, F.lit(True))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row; rows without doc_id are scored too.

    Of the documents' columns only text and, if there is one, n_chars are features.
    """
    machine = fit(documents, labels, learnable_id())
    rows = documents.select("doc_id", (~learnable_id()).alias("held_out"), score_column(machine, F.col("text"), length_column(documents)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows that score at least ``least``; all columns stay."""
    machine = fit(documents, labels, learnable_id())
    return documents.where(score_column(machine, F.col("text"), length_column(documents)) >= least)
