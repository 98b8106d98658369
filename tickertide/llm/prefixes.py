"""The prefix trie of conversations.

A turn is known by a 128-bit hash of its role and text, a prefix by the exclusive or of the
hashes of its turns, each mixed with its place. Texts are read once and never shuffled.

1. Turns are dealt by range of conversation and turn, so a conversation with a third of all
   turns is cut into parts. Places and prefixes are counted within parts; one row a part says
   what stands before it.
2. A count-min sketch counts the digests of all prefixes. Its estimates are never too small:
   one means that a single conversation has the prefix, and so all longer ones. Nodes below
   such a prefix are emitted where they lie.
3. The other prefixes, those whose parent may be shared, are grouped exactly.

Sums over subtrees need no walk through the trie. Each node is owned by its smallest member.
The nodes a conversation owns are the end of its path, so the characters below a node, all
nodes counted once, are the sum of what its members own; the owner alone also owns nodes
above. Leaves below a node are its members that own a childless node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.shared import U64, bits_for, listed, read_arrays, runs_of, shared_path, write_arrays
from tickertide.llm.words import join_hashes, mix

SKETCH_ROWS = 3
CELLS_PER_PREFIX = 2  # in each row of the sketch
CHUNK_BITS = 22  # cells of a file of the sketch
FULL = 255  # what a cell counts to
BLOCK = 100  # conversations that take their first turns from the first of them
MOST_TAKEN = 5
PIECE_IDS = 50_000  # ids joined to one string on their way to a hash

NO_ENDS = hashlib.sha256(b"").hexdigest()


def parts_for(rows: DataFrame) -> int:
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << bits_for(rows))


def written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def number_turns(conversations: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(conv, part, local, t1, t2, chars) for each turn, and (conv, part, before, n_turns) for
    each part of a conversation: the turn's place is ``before + local``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(7), text, role).alias("t2"), F.length(text).cast("bigint").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    dealt = turns.repartitionByRange(parts_for(conversations), F.col("conv"), *order).withColumn("part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    turns = written(dealt.select("conv", "part", local.cast("bigint").alias("local"), "t1", "t2", "chars"), f"{folder}/turns")
    sizes = turns.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    extents = sizes.select(
        "conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("conv")).alias("n_turns")
    )
    return turns, written(extents, f"{folder}/extents")


def as_they_are(turns: DataFrame, extents: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Sequences (conv, part, i, length, t1, t2, chars) and lengths (conv, length)."""
    rows = turns.join(extents, ["conv", "part"])
    sequences = rows.select("conv", "part", (F.col("local") + F.col("before")).alias("i"), F.col("n_turns").alias("length"), "t1", "t2", "chars")
    return sequences, extents.where("before = 0").select("conv", F.col("n_turns").alias("length"))


def with_heads_of_block(turns: DataFrame, extents: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """As ``as_they_are``, but each conversation c begins with the first h turns of
    conversation c - c % 100 instead of its own; h is crc32 of the decimal c, modulo 6."""
    taken = F.crc32(F.col("conv").cast("string")) % (MOST_TAKEN + 1)
    first = turns.where((F.col("conv") % BLOCK == 0) & (F.col("local") <= MOST_TAKEN)).join(extents, ["conv", "part"])
    first = first.withColumn("place", F.col("local") + F.col("before")).where(F.col("place") <= MOST_TAKEN)
    heads = first.groupBy(F.col("conv").alias("donor")).agg(F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "chars"))).alias("head"))
    convs = extents.where("before = 0").select("conv", "part", "n_turns", taken.alias("h"), (F.col("conv") - F.col("conv") % BLOCK).alias("donor"))
    head = F.coalesce("head", F.array().cast("array<struct<place:bigint,t1:bigint,t2:bigint,chars:bigint>>"))
    convs = convs.join(heads, "donor", "left").withColumn("head", F.slice(head, F.lit(1), F.col("h").cast("int")))
    convs = convs.withColumn("kept", F.size("head").cast("bigint"))
    length = F.col("kept") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    convs = written(convs.select("conv", "part", "h", "kept", "head", length.alias("length")), f"{folder}/convs")
    place = F.col("local") + F.col("before")
    extents = extents.select("conv", "part", "before").join(convs.select("conv", "h", "kept", "length"), "conv")
    own = turns.join(extents, ["conv", "part"]).where(place > F.col("h"))
    own = own.select("conv", "part", (place - F.col("h") + F.col("kept")).alias("i"), "length", "t1", "t2", "chars")
    given = convs.select("conv", "part", "length", F.explode("head").alias("x"))
    given = given.select("conv", "part", F.col("x.place").alias("i"), "length", "x.t1", "x.t2", "x.chars")
    return own.unionByName(given), convs.select("conv", "length")


def digest_prefixes(sequences: DataFrame) -> DataFrame:
    """(conv, i, length, d1, d2, p1, p2, chars, cum, total): the digests of each prefix and
    of the one before it, characters of its last turn, of the prefix and of the whole."""
    mixed = sequences.withColumns({"m1": F.xxhash64("i", "t1", "t2"), "m2": F.xxhash64("t2", "t1", "i")})
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = mixed.groupBy("conv", "part").agg(F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"), F.sum("chars").alias("c"))
    sums = sums.select(
        "conv", "part", F.sum("c").over(Window.partitionBy("conv")).alias("total"),
        *[F.coalesce(f(x).over(earlier), F.lit(0)).alias(name) for name, f, x in (("b1", F.bit_xor, "x1"), ("b2", F.bit_xor, "x2"), ("b", F.sum, "c"))],
    )
    running = Window.partitionBy("conv", "part").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = mixed.select("*", F.bit_xor("m1").over(running).alias("r1"), F.bit_xor("m2").over(running).alias("r2"), F.sum("chars").over(running).alias("r"))
    rows = rows.join(sums, ["conv", "part"])
    rows = rows.withColumns({"d1": F.col("r1").bitwiseXOR(F.col("b1")), "d2": F.col("r2").bitwiseXOR(F.col("b2")), "cum": F.col("r") + F.col("b")})
    return rows.select(
        "conv", "i", "length", "d1", "d2", F.col("d1").bitwiseXOR(F.col("m1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("m2")).alias("p2"),
        "chars", "cum", "total",
    )


def cells_of(d1: np.ndarray, d2: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each digest in each row of the sketch; rows lie one behind the other."""
    mask = U64((1 << bits) - 1)
    keys = [mix(join_hashes(d1.view(U64), d2.view(U64)) + U64(r << 8 | r)) for r in range(SKETCH_ROWS)]
    return [(k & mask).astype(np.int64) + (r << bits) for r, k in enumerate(keys)]


def count_cells(bits: int, chunk_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = (batch.column(c).to_numpy() for c in (0, 1))
            cells, counts = np.unique(np.concatenate(cells_of(d1, d2, bits)), return_counts=True)
            chunk = cells >> chunk_bits
            begins = runs_of(chunk)
            pieces = list(zip(begins, [*begins[1:], len(cells)]))
            yield pa.record_batch([
                pa.array(chunk[begins], pa.int64()),
                pa.array([(cells[a:b] & ((1 << chunk_bits) - 1)).astype(np.uint32).tobytes() for a, b in pieces], pa.binary()),
                pa.array([np.minimum(counts[a:b], FULL).astype(np.uint8).tobytes() for a, b in pieces], pa.binary()),
            ], names=["chunk", "cells", "counts"])

    return run


def build_sketch(prefixes: DataFrame, folder: str, bits: int, chunk_bits: int = CHUNK_BITS) -> None:
    """Count the digests of prefixes into files of cells."""

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << min(chunk_bits, bits + SKETCH_ROWS), np.uint16)
        for batch in batches:
            for cells, counts in zip(batch.column("cells").to_pylist(), batch.column("counts").to_pylist()):
                at = np.frombuffer(cells, np.uint32)
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), FULL)
        write_arrays(f"{folder}/{key[0].as_py()}", {"n": total.astype(np.uint8)})
        yield pa.record_batch([pa.array([1], pa.int64())], names=["n"])

    counted = prefixes.select("d1", "d2").mapInArrow(count_cells(bits, chunk_bits), "chunk bigint, cells binary, counts binary")
    counted.groupBy("chunk").applyInArrow(merge, "n bigint").agg(F.sum("n")).collect()


def single(folder: str, bits: int, d1: Column, d2: Column, chunk_bits: int = CHUNK_BITS) -> Column:
    """True where the sketch proves that a prefix is in one conversation only."""

    @F.arrow_udf("boolean")
    def proven(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), bool)
        for cells in cells_of(a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False), bits):
            order = np.argsort(cells)
            chunk = cells[order] >> chunk_bits
            begins = runs_of(chunk)
            for begin, end in zip(begins, [*begins[1:], len(cells)]):
                name = str(int(chunk[begin]))
                if name in listed(folder):
                    rows = order[begin:end]
                    out[rows] |= read_arrays(f"{folder}/{name}")["n"][cells[rows] & ((1 << chunk_bits) - 1)] == 1
        return pa.array(out)

    return proven(d1, d2)


def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (d1, d2, conv) as strings of ids, joined by commas, of one node each."""
    for batch in batches:
        d1, d2, conv = (c.to_numpy() for c in batch.columns)
        change = np.flatnonzero((d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])) + 1
        begins = sorted({0, *change.tolist(), *range(0, len(conv), PIECE_IDS)}) if len(conv) else []
        rows = [(int(d1[a]), int(d2[a]), int(conv[a]), ",".join(map(str, conv[a:b].tolist()))) for a, b in zip(begins, [*begins[1:], len(conv)])]
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["d1", "d2", "first", "ids"])


def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's strings, which come in order; only one string is held."""
    node, state = None, None

    def result() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([state.hexdigest()])], names=["d1", "d2", "sha"])

    for batch in batches:
        for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
            if (d1, d2) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                yield result()
            node, state = (d1, d2), hashlib.sha256(ids.encode())
    if node is not None:
        yield result()


def hashes_of_ends(ends: DataFrame, parts: int) -> DataFrame:
    """(d1, d2, sha) of the ids of conversations that end at each node.

    A hash is taken of bytes in order, so one task reads the strings of a node, but no more
    than one at a time; other tasks sort and join the ids."""
    pieces = ends.repartitionByRange(parts, "d1", "d2", "conv").sortWithinPartitions("d1", "d2", "conv")
    pieces = pieces.mapInArrow(join_ids, "d1 bigint, d2 bigint, first bigint, ids string")
    ordered = pieces.repartition(parts, "d1", "d2").sortWithinPartitions("d1", "d2", "first")
    return ordered.mapInArrow(hash_ids, "d1 bigint, d2 bigint, sha string")


def trie_nodes(sequences: DataFrame, lengths: DataFrame, folder: str, sketch_bits: int | None = None) -> DataFrame:
    """The nodes of the trie of sequences; ``lengths`` also has the conversations without turns."""
    prefixes = written(digest_prefixes(sequences), f"{folder}/prefixes")
    bits = max(10, (CELLS_PER_PREFIX * prefixes.count()).bit_length()) if sketch_bits is None else sketch_bits
    build_sketch(prefixes, f"{folder}/sketch", bits)
    alone = single(f"{folder}/sketch", bits, F.col("d1"), F.col("d2"))
    tail = (F.col("i") > 1) & single(f"{folder}/sketch", bits, F.col("p1"), F.col("p2"))
    prefixes.withColumns({"alone": alone, "tail": tail}).write.partitionBy("tail").parquet(f"{folder}/marked")
    kind = "conv bigint, i bigint, length bigint, d1 bigint, d2 bigint, p1 bigint, p2 bigint, chars bigint, cum bigint, total bigint, alone boolean, tail boolean"
    marked = sequences.sparkSession.read.schema(kind).parquet(f"{folder}/marked")
    end = F.col("i") == F.col("length")
    tails, shared = marked.where("tail"), marked.where("not tail").drop("tail")
    no = F.lit(0).cast("bigint")
    root = dict(i=no, d1=no, d2=no, p1=F.lit(None).cast("bigint"), p2=F.lit(None).cast("bigint"), chars=no, cum=no, alone=F.lit(False))
    roots = shared.where("i = 1").withColumns(root).unionByName(lengths.where("length = 0").withColumns({**root, "total": no}))
    shared = shared.unionByName(roots)

    nodes = shared.groupBy("d1", "d2").agg(
        F.max("i").alias("depth"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.count("*").alias("n_convs"), F.min("conv").alias("owner"),
        F.count_if(end).alias("n_ends"), F.max(F.when(end, F.col("conv"))).alias("end_id"), F.max(F.col("cum") - F.col("chars")).alias("before"),
        F.max("alone").alias("alone"), F.max((F.col("i") < F.col("length")).cast("bigint")).alias("goes_on"),
    )
    nodes = written(nodes, f"{folder}/nodes")
    owners = nodes.groupBy(F.col("owner").alias("conv")).agg(F.min("before").alias("above"), F.max((F.col("n_ends") == F.col("n_convs")).cast("bigint")).alias("leaf"))
    in_tails = tails.where(end).select("conv", F.lit(None).cast("bigint").alias("above"), F.lit(1).cast("bigint").alias("leaf"))
    owned = owners.unionByName(in_tails).groupBy("conv").agg(F.min("above").alias("above"), F.max("leaf").alias("leaf"))
    members = shared.select("d1", "d2", "conv", "total").join(owned, "conv", "left")
    sums = members.groupBy("d1", "d2").agg(
        F.sum("total").alias("total"), F.sum(F.coalesce(F.col("total") - F.col("above"), F.lit(0))).alias("owned"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.min_by("above", "conv").alias("above"),
    )
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("children"))
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("owner").alias("parent"))
    ends = hashes_of_ends(shared.where(end & ~F.col("alone")).select("d1", "d2", "conv"), parts_for(prefixes))
    full = nodes.join(sums, ["d1", "d2"]).join(children, ["d1", "d2"], "left").join(ends, ["d1", "d2"], "left").join(parents, ["p1", "p2"], "left")
    below = F.col("total") - F.col("n_convs") * F.col("before")
    once = F.col("owned") - (F.col("before") - F.col("above"))
    # A parent outside the grouped prefixes is in one conversation only, the node's own.
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "owner"))
    n_children = F.when(F.col("alone"), F.col("goes_on")).otherwise(F.coalesce("children", F.lit(0)))
    sha = F.when(F.col("n_ends") == 0, F.lit(NO_ENDS)).otherwise(F.coalesce("sha", F.sha2(F.col("end_id").cast("string"), 256)))
    grouped = full.select(
        F.col("owner").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", n_children.alias("n_children"), "n_leaves",
        (below - once).alias("saved_tokens"), sha.alias("ends_sha256"),
    )
    own_sha = F.when(end, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(NO_ENDS))
    one = F.lit(1).cast("bigint")
    local = tails.select(
        F.col("conv").alias("conv_id"), F.col("i").alias("depth"), F.col("conv").alias("parent_conv_id"), one.alias("n_convs"),
        (~end).cast("bigint").alias("n_children"), one.alias("n_leaves"), no.alias("saved_tokens"), own_sha.alias("ends_sha256"),
    )
    return grouped.unionByName(local)


def prefix_trie(conversations: DataFrame, rebuild=as_they_are, sketch_bits: int | None = None) -> DataFrame:
    """One row for each different sequence of first turns (role, text), the root included.

    conv_id is the smallest conversation that begins so, depth the number of turns,
    parent_conv_id the conv_id of the sequence one turn shorter. n_convs counts the
    conversations, n_children the sequences one turn longer, n_leaves those in the subtree
    that none continues. saved_tokens adds up, over the subtree, (n_convs - 1) times the
    characters of the last text. ends_sha256 is the hash of the ids of conversations that
    end here, ascending, joined by commas.

    Turns are ordered by turn, null first, equal ones by a hash of their content. Null roles
    and texts count as empty; rows without conv_id belong to no conversation and are left
    out, and without conversations there is no root. Rows that repeat are further turns.
    Needs conv_id, turn, role and text; other columns are ignored.
    ``rebuild`` says what a conversation is made of, ``sketch_bits`` the cells of a row of
    the sketch; a smaller one sends more prefixes to the grouping and changes no result.
    """
    folder = shared_path(conversations.sparkSession, "prefixes")
    turns, extents = number_turns(conversations, folder)
    sequences, lengths = rebuild(turns, extents, folder)
    return trie_nodes(sequences, lengths, folder, sketch_bits)
