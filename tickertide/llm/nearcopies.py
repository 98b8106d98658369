"""Near copies by ProbMinHash.

A text is a set of five-word shingles weighted by how often they occur. The similarity of
two texts is the probability Jaccard similarity of the weighted sets, which does not change
when all weights of a text are multiplied; without repeated shingles it is the common
Jaccard similarity.

* Signatures: each shingle is a Poisson process whose rate is its weight. Its points arrive
  in order, each at a random register, and a register keeps the shingle of its first point.
  Two texts agree in a register with the probability of their similarity. A process stops at
  the first point that comes later than the first points of all registers, so a shingle of
  a long text costs little more than one point.
* Banding: texts that agree in all ``ROWS`` registers of one of ``BANDS`` bands share a
  bucket. Texts with the same shingles are one node beforehand. Each text is compared with
  the smallest of the texts that come first in its buckets, which joins most groups.
* Buckets that are not one component then are compared among all members with different
  components, in blocks of bounded size; only links leave a block, at most one for each
  member.
* All comparisons are of whole weighted shingles; classes are the connected components of
  the links.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.components import components
from tickertide.llm.mixing import stored
from tickertide.llm.shared import U64, find, shard_bits, shared_path, write_sorted
from tickertide.llm.words import hashed_words, join_hashes, mix, pieces, plain, release, runs

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 7, 32
REGISTERS = ROWS * BANDS
BLOCK = 512  # members compared at once
PIECE = 1 << 19  # text bytes worked on at once; each takes some 50 bytes of arrays meanwhile
SIGNED = "shingles bigint, print0 bigint, print1 bigint, bands array<bigint>"


def weighted_shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of a piece of texts, not sorted.

    A text of fewer than five words is one shingle; a text without words has none.
    """
    words, counts = hashed_words(texts)
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    # How many words of its text stand behind each word.
    behind = np.repeat(np.cumsum(counts), counts) - np.arange(1, len(words) + 1)
    start = behind >= size - 1
    first = np.cumsum(counts) - counts
    start[first[counts > 0]] = True
    at = np.flatnonzero(start)
    doc, behind, shingle = doc[at], behind[at], words[at]
    for k in range(1, size):
        # Beyond the end of a short text stands 0.
        shingle = join_hashes(shingle, np.where(behind >= k, words[np.minimum(at + k, len(words) - 1)], U64(0)))
    key = join_hashes(shingle, doc.astype(U64))
    order = np.argsort(key)
    at = runs(key[order])
    return doc[order[at]], shingle[order[at]], np.diff(np.append(at, len(order)))


def signatures(texts: int, doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """(texts, registers) shingles of the first arrivals; 0 in texts without shingles."""
    times = np.full(texts * registers, np.inf)
    owner = np.zeros(texts * registers, U64)
    latest = np.full(texts, np.inf)
    arrival = np.zeros(len(doc))
    rate = weight.astype(np.float64)
    state = mix(shingle)
    own = shingle
    while len(doc):
        state = mix(state)
        arrival = arrival - np.log(((state >> U64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        live = arrival < latest[doc]
        doc, own, state, rate, arrival = doc[live], own[live], state[live], rate[live], arrival[live]
        register = doc * registers + (mix(state ^ U64(0x5BF03635)) % U64(registers)).astype(np.int64)
        better = np.flatnonzero(arrival < times[register])
        if len(better):
            better = better[np.argsort(-arrival[better])]  # the earliest is written last
            times[register[better]] = arrival[better]
            owner[register[better]] = own[better]
            touched = np.unique(doc[better])
            latest[touched] = times.reshape(texts, registers)[touched].max(axis=1)
    return owner.reshape(texts, registers)


def prints(texts: int, doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that are the same for the same weighted shingles."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (U64(0x51ED27), U64(0xB5297A4D)):
            total = np.zeros(texts, U64)
            np.add.at(total, doc, mix(mix(shingle + salt) + weight.astype(U64)))
            out.append(total.view(np.int64))
    return out[0], out[1]


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(texts, BANDS) bucket keys."""
    keys = [
        join_hashes(np.full(len(signature), b, U64), *signature[:, b * ROWS : (b + 1) * ROWS].T) for b in range(BANDS)
    ]
    return np.stack(keys, axis=1)


def signed(text: Column) -> Column:
    @F.arrow_udf(SIGNED)
    def sign(texts: pa.Array) -> pa.Array:
        out = []
        for _, piece in pieces(plain(texts), PIECE):
            doc, shingle, weight = weighted_shingles(piece)
            n = len(piece)
            keys = band_keys(signatures(n, doc, shingle, weight))
            out.append([np.bincount(doc, weight, n).astype(np.int64), *prints(n, doc, shingle, weight), keys.reshape(-1).view(np.int64)])
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        offsets = np.arange(0, len(columns[3]) + 1, BANDS, dtype=np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(columns[3]))
        release()
        return pa.StructArray.from_arrays([*[pa.array(c) for c in columns[:3]], bands], ["shingles", "print0", "print1", "bands"])

    return sign(text)


def payload(ids: Column, text: Column, folder: str, bits: int) -> Column:
    """For ids of a set, all shingles of the text, sorted, each as often as it occurs; null for
    others. One function, so that a task needs one Python worker."""

    @F.arrow_udf("binary")
    def pack(values: pa.Array, texts: pa.Array) -> pa.Array:
        wanted = np.flatnonzero(ids_in_set(values, folder, bits))
        shingles = []
        for _, piece in pieces(plain(texts.take(pa.array(wanted))), PIECE):
            doc, shingle, weight = weighted_shingles(piece)
            order = np.lexsort((shingle, doc))
            repeated = np.repeat(shingle[order], weight[order])
            ends = np.cumsum(np.bincount(doc, weight, len(piece)).astype(np.int64))
            shingles += [repeated[(ends[i - 1] if i else 0) : end].tobytes() for i, end in enumerate(ends)]
        place = np.full(len(values), -1, np.int64)
        place[wanted] = np.arange(len(wanted))
        release()
        return pa.array(shingles, pa.binary()).take(pa.array(place, mask=place < 0))

    return pack(ids, text)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Probability Jaccard similarity of two sorted arrays of shingles with repeats.

    A common shingle d counts 1 / sum over all d' of max(a'/a, b'/b), where a, b are the
    weights of d and a', b' those of d'. The left ratio is the larger one where a'/b' is at
    least a/b, so sums in order of that quotient give all of them.
    """
    if not len(a) or not len(b):
        return 0.0
    if not (a[1:] == a[:-1]).any() and not (b[1:] == b[:-1]).any():
        both = np.concatenate((a, b))
        both.sort()
        n = np.count_nonzero(both[1:] == both[:-1])
        return n / (len(both) - n)
    (ka, wa), (kb, wb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    common, at, bt = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = wa[at].astype(np.float64), wb[bt].astype(np.float64)
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    alone_a, alone_b = len(a) - x.sum(), len(b) - y.sum()  # weights of shingles in one text only
    from_here = x.sum() - np.cumsum(x) + x + alone_a
    before = np.cumsum(y) - y + alone_b
    return float((1 / (from_here / x + before / y)).sum())


def similar(a: Column, b: Column) -> Column:
    @F.arrow_udf("double")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        out = [similarity(np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)) for x, y in zip(left, right)]
        return pa.array(out, pa.float64())

    return compare(a, b)


def spread(ids: Column) -> Column:
    """A bijection on ids, so that shards of a range of it are even."""

    @F.arrow_udf("bigint")
    def mixed(values: pa.Array) -> pa.Array:
        return pa.array(mix(values.to_numpy(zero_copy_only=False).view(U64)).view(np.int64))

    return mixed(ids)


def id_set(ids: DataFrame, name: str) -> tuple[str, int]:
    """Distinct ids (column ``id``) as sorted arrays in shared files."""
    spark = ids.sparkSession
    folder, bits = shared_path(spark, name), shard_bits(spark)
    write_sorted(ids.where("id is not null").distinct().select(spread(F.col("id")).alias("key")), folder, bits)
    return folder, bits


def in_set(ids: Column, folder: str, bits: int) -> Column:
    """Whether an id is in the set; a null is not."""

    @F.arrow_udf("boolean")
    def known(values: pa.Array) -> pa.Array:
        return pa.array(ids_in_set(values, folder, bits))

    return known(ids)


def ids_in_set(values: pa.Array, folder: str, bits: int) -> np.ndarray:
    some = np.asarray(values.is_valid())
    keys = mix(pa.compute.fill_null(values, 0).to_numpy(zero_copy_only=False).view(U64))
    return find(folder, bits, keys, [])["found"] & some


class Block:
    """Members of a bucket with their shingles as numbers of one list."""

    def __init__(self, texts: list[bytes]):
        shingles = [np.frombuffer(t, U64) for t in texts]
        sizes = np.array([len(x) for x in shingles])
        numbers = np.unique(np.concatenate(shingles), return_inverse=True)[1]
        doc = np.repeat(np.arange(len(texts)), sizes)
        key, self.weight = np.unique(doc * (numbers.max() + 1) + numbers, return_counts=True)
        self.doc, self.number = np.divmod(key, numbers.max() + 1)
        self.begin = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.size, self.total = len(texts), sizes
        self.repeats = np.diff(self.begin) < sizes
        self.mark = np.zeros(numbers.max() + 1)
        self.shingles = shingles

    def similar_to(self, i: int, least: float) -> np.ndarray:
        """Which members are at least so similar to member i.

        The common part of either text bounds the similarity from above; without repeated
        shingles it gives the similarity.
        """
        own = slice(self.begin[i], self.begin[i + 1])
        self.mark[self.number[own]] = self.weight[own]
        here = self.mark[self.number]
        self.mark[self.number[own]] = 0
        common = here > 0
        mine = np.bincount(self.doc, here, self.size)
        theirs = np.bincount(self.doc, self.weight * common, self.size)
        out = (mine >= least * self.total[i] - 1e-9) & (theirs >= least * self.total - 1e-9)
        out[i] = False
        for j in np.flatnonzero(out):
            if self.repeats[i] or self.repeats[j]:
                out[j] = similarity(self.shingles[i], self.shingles[j]) >= least
            else:
                out[j] = mine[j] / (self.total[i] + self.total[j] - mine[j]) >= least
        return out


def block_links(rep: np.ndarray, label: np.ndarray, side: np.ndarray, texts: list[bytes], least: float) -> list[tuple]:
    """Links between members of two blocks of a bucket, as many as join their labels."""
    block = Block(texts)
    group = np.unique(label, return_inverse=True)[1]
    links = []
    for i in np.flatnonzero(side != 2):  # 0: a block with itself
        apart = (group != group[i]) & (side != 1)
        if not apart.any():
            continue
        for j in np.flatnonzero(apart & block.similar_to(i, least)):
            if group[i] != group[j]:
                links.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                group[group == group[j]] = group[i]
    return links


def compare_blocks(least: float):
    """Reads members sorted by bucket and pair of blocks; one pair of blocks is in memory at
    a time, besides the batch."""
    names = ("key", "i", "j", "rep", "label", "side", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def compared(table: pa.Table, at: list[int]) -> pa.RecordBatch:
            columns = {n: table[n].combine_chunks() for n in names}
            rep, label, side = (columns[n].to_numpy() for n in ("rep", "label", "side"))
            links = []
            for x, y in zip(at, at[1:]):
                texts = columns["shingles"].slice(x, y - x).to_pylist()
                links += block_links(rep[x:y], label[x:y], side[x:y], texts, least)
            a, b = zip(*links) if links else ((), ())
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key, i, j = (table[n].to_numpy() for n in ("key", "i", "j"))
            new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            at = [0, *(np.flatnonzero(new) + 1).tolist()]
            if len(at) > 1:
                yield compared(table, at)
            held = table.slice(at[-1])
        if held is not None:
            yield compared(held, [0, held.num_rows])
        held = None
        release()

    return run


def with_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    found = members.join(labels, members["rep"] == labels["node"], "left")
    return found.select(*members.columns, F.coalesce("label", "rep").alias("label"))


def open_bucket_links(members: DataFrame, labels: DataFrame, payloads: DataFrame, least: float) -> DataFrame:
    """Links between members (key, rep) of buckets that are not one component yet.

    A bucket of two is a pair like any other. The members of a larger one are dealt to
    blocks, and each pair of blocks is compared in one task, which returns links only.
    """
    labelled = stored(with_labels(members, labels), "near-open")
    state = labelled.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"),
        F.min("rep").alias("a"), F.max("rep").alias("b"),
    ).where("lo != hi")
    pairs = verified(state.where("n = 2").select("a", "b").distinct(), payloads)
    wanted = state.where("n > 2").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = labelled.join(wanted, "key").join(payloads, "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "rep", "label", "shingles")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = rows.mapInArrow(compare_blocks(least), "a bigint, b bigint")
    return found.unionByName(pairs.where(F.col("s") >= least).select("a", "b")).distinct()


def verified(pairs: DataFrame, payloads: DataFrame) -> DataFrame:
    """Pairs (a, b) with their exact similarity ``s``."""
    one = payloads.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    two = payloads.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", similar(F.col("x"), F.col("y")).alias("s"))


def near_copies(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of each row: the smallest doc_id of its group of near copies.

    Rows without doc_id have no class and belong to no group; texts without words, null ones
    included, are a class of their own each. Texts with the same weighted shingles are near
    copies. Rows that share an id share a class, whatever their texts. Other columns are
    ignored.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    marked = rows.select("doc_id", signed(F.col("text")).alias("s")).select("doc_id", "s.*")
    marked = stored(marked, "near-signatures")
    grouped = marked.where("doc_id is not null and shingles > 0")
    nodes = grouped.groupBy("print0", "print1").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"))
    nodes = stored(nodes, "near-nodes")
    members = nodes.select("rep", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead != last").select("key", "lead")
    members = stored(members.join(buckets, "key"), "near-members")
    # One candidate per text: the smallest of the texts that lead its buckets.
    pairs = members.groupBy("rep").agg(F.min("lead").alias("a")).where("a != rep").select("a", F.col("rep").alias("b"))

    folder, bits = id_set(members.select(F.col("rep").alias("id")).distinct(), "near-ids")
    packed = rows.select(F.col("doc_id").alias("rep"), payload(F.col("doc_id"), F.col("text"), folder, bits).alias("shingles"))
    payloads = stored(packed.where("length(shingles) > 0"), "near-payloads")

    links = stored(verified(pairs, payloads).where(F.col("s") >= least).select("a", "b").distinct(), "near-links")
    labels = components(links)
    more = stored(open_bucket_links(members.select("key", "rep").distinct(), labels, payloads, least), "near-late")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    classes = nodes.join(labels, nodes["rep"] == labels["node"], "left").select(
        "print0", "print1", F.coalesce("label", "rep").alias("class_id")
    )
    found = grouped.select("doc_id", "print0", "print1").join(stored(classes, "near-classes"), ["print0", "print1"]).select("doc_id", "class_id")
    alone = marked.where("doc_id is null or shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"))
    return found.unionByName(alone)


def drop_near_copies(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The row with the smallest doc_id of each group of near copies; all columns stay."""
    classes = near_copies(documents, least)
    folder, bits = id_set(classes.where("doc_id != class_id").select(F.col("doc_id").alias("id")), "near-dropped")
    return documents.where(~in_set(F.col("doc_id").cast("bigint"), folder, bits))
