"""Mixing sources to target weights.

Documents are dealt by hash into a fixed number of blocks per source, and blocks are the
unit of the mix. A source is taken as often as its target says: whole passes over all of its
blocks, then a pass over the first blocks of a random order up to the target, the last of
them cut at the document nearest to it. A tree of multivariate hypergeometric draws splits
the block quotas of all sources among the output shards: each node hands half of its units
to either child, and how many come from each source is drawn exactly as if the units had
been shuffled. Each shard then takes its own stretch of each source's permuted units, and
its rows are shuffled within the shard.

Everything is DataFrame or SQL work. Beyond the pass over the documents, tables have at most
``BLOCKS`` rows per source and pass, whatever the size of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.session import scratch_path

BLOCKS = 1024  # blocks of a source
SHARDS = 64  # output shards, a power of two
WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # words of the mix, as a multiple of all words
MOST = 2  # targets stop at so many times their source's size
# A table of at most so many rows of a few numbers (some 20 MB) is broadcast.
BROADCAST_ROWS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def uniform_bits(*parts: Column | str) -> Column:
    """60 random bits that depend on the parts only."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def with_block(documents: DataFrame, seed: str) -> DataFrame:
    """Add ``_size``, ``_h`` (the place in the order of its block) and ``_block``."""
    h = uniform_bits(seed, F.col("doc_id"))
    return documents.select("*", word_count(F.col("text")).alias("_size"), h.alias("_h")).withColumn("_block", (F.col("_h") % BLOCKS).cast("int"))


def source_targets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, place, size, target) of each source.

    Targets share ``share`` times all words by weight. A target that would pass ``most``
    times its source's size stops there and the rest is shared again; that ends with targets
    min(cap, level * weight), whose level follows from the caps in order of cap / weight.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))  # one row per source
    sources = (
        sizes.groupBy("source").agg(F.sum("size").alias("size"))
        .withColumn("place", F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("size") * most)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    by_ratio = everything.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # The level if all sources before this one stop at their cap and the others do not.
    left = F.sum("size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = sources.withColumn("level", left / weights)
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))
    level = F.coalesce(F.min(fits).over(everything)["level"], F.lit(0.0))
    return levels.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).select(
        "source", "place", "size", "target"
    )


def draw_plan(sizes: DataFrame, seed: str, **limits: float) -> tuple[DataFrame, DataFrame]:
    """What is taken: (place, block, pass, cut) units, and the sources with their targets.

    ``sizes`` has source, size, h and block of each document. A unit takes the documents of
    its block with h up to ``cut``.
    """
    whole = (1 << 62) - 1
    sources = source_targets(sizes, **limits)
    # Whole passes over the source, and the words that remain.
    passes = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("int")
    sources = sources.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("size"))
    keyed = sources.select(F.col("source").alias("_source"), "place", "passes", "rest")
    blocks = sizes.groupBy("source", "block").agg(F.sum("size").alias("words"))
    blocks = blocks.join(keyed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    order = Window.partitionBy("place").orderBy(uniform_bits(seed, "order", F.col("place"), F.col("block")), "block")
    blocks = blocks.withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    last = (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    ends = blocks.where(last).select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "place", (F.col("rest") - F.col("before")).alias("left")
    )
    inside = sizes.join(ends, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    upto = Window.partitionBy("place").orderBy("h").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("miss", F.abs(F.sum("size").over(upto) - F.col("left")))
    cuts = inside.groupBy("place").agg(F.min(F.struct("miss", "h")).alias("best"), F.min("left").alias("left"))
    cuts = cuts.select("place", F.when(F.col("best.miss") < F.col("left"), F.col("best.h")).otherwise(-1).alias("last_cut"))
    taken = F.concat(
        F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest("passes", F.lit(1))), lambda i: i <= F.col("passes")),
            lambda i: F.struct(i.alias("pass"), F.lit(whole).alias("cut")),
        ),
        F.when(F.col("before") + F.col("words") <= F.col("rest"), F.array(F.struct(F.lit(0).alias("pass"), F.lit(whole).alias("cut"))))
        .when(last, F.array(F.struct(F.lit(0).alias("pass"), F.coalesce("last_cut", F.lit(-1)).cast("bigint").alias("cut"))))
        .otherwise(F.array().cast("array<struct<pass:int,cut:bigint>>")),
    )
    units = blocks.join(cuts, "place", "left").select("source", "place", "block", F.explode(taken).alias("unit"))
    units = units.select("source", "place", "block", "unit.pass", "unit.cut").where(F.col("cut") >= 0)
    return units, sources


def ln_factorial(x: str) -> str:
    """ln x! as SQL: Stirling's series at x + 8, good to ten digits."""
    z = f"({x} + 9D)"
    product = " * ".join(f"({x} + {i}D)" for i in range(1, 9))
    return (
        f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1D / (12D * {z})"
        f" - 1D / (360D * power({z}, 3)) + 1D / (1260D * power({z}, 5)) - ln({product}))"
    )


def ln_choose(n: str, k: str) -> str:
    return f"({ln_factorial(n)} - {ln_factorial(k)} - {ln_factorial(f'({n} - {k})')})"


def hypergeometric(total: str, good: str, draws: str, chance: str) -> str:
    """SQL for how many of ``good`` among ``total`` units are in ``draws`` of them.

    The chance in [0, 1) is looked up in the cumulated distribution, from twelve standard
    deviations below the mean to twelve above.
    """
    mean = f"({draws} * {good} / {total})"
    spread = f"(12D * sqrt(greatest({mean} * (1D - {good} / {total}), 0D)) + 2D)"
    low = f"greatest({draws} - ({total} - {good}), floor({mean} - {spread}), 0D)"
    high = f"least({draws}, {good}, ceil({mean} + {spread}))"
    first = f"exp({ln_choose(good, 's.lo')} + {ln_choose(f'({total} - {good})', f'({draws} - s.lo)')} - {ln_choose(total, draws)})"
    step = (
        "named_struct('p', a.p * ({K} - k) * ({n} - k) / ((k + 1D) * ({N} - {K} - {n} + k + 1D)), 'c', a.c + a.p,"
        " 'x', if(a.x < 0D and a.c + a.p > {u}, k, a.x))"
    ).format(K=good, n=draws, N=total, u=chance)
    found = (
        "aggregate(transform(sequence(cast(s.lo as bigint), cast(s.hi as bigint)), i -> cast(i as double)),"
        f" named_struct('p', {first}, 'c', 0D, 'x', -1D), (a, k) -> {step}, a -> if(a.x < 0D, s.hi, a.x))"
    )
    ends = f"array(named_struct('lo', cast({low} as double), 'hi', cast({high} as double)))"
    return f"if({total} <= 0D, 0D, element_at(transform({ends}, s -> {found}), 1))"


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """(shard, place, quota) from (place, quota): each shard's units of each source.

    All sources of a tree node are drawn in one row, one after the other, as the draw of
    each depends on those before it.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards is a power of two")
    nodes = quotas.groupBy().agg(
        F.lit(0).alias("node"),
        F.sort_array(F.collect_list(F.struct("place", F.col("quota").cast("double").alias("quota")))).alias("quotas"),
    )
    chance = f"(conv(substr(md5(concat_ws('|', '{seed}', depth, node, q.place)), 1, 13), 16, 10) / 4503599627370496D)"
    draw = hypergeometric("st.total", "q.quota", "st.draws", chance)
    fold = f"""aggregate(quotas,
        named_struct('total', aggregate(quotas, 0D, (t, q) -> t + q.quota),
            'draws', cast(floor((aggregate(quotas, 0D, (t, q) -> t + q.quota) + node % 2) / 2D) as double),
            'out', cast(array() as array<struct<place:int,quota:double,left:double>>)),
        (st, q) -> element_at(transform(array({draw}), x -> named_struct('total', st.total - q.quota, 'draws', st.draws - x,
            'out', concat(st.out, array(named_struct('place', q.place, 'quota', q.quota, 'left', x))))), 1),
        st -> st.out)"""
    for depth in range(shards.bit_length() - 1):
        drawn = nodes.withColumn("depth", F.lit(depth)).withColumn("drawn", F.expr(fold))
        halves = drawn.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        nodes = halves.select(
            (F.col("node") * 2 + F.col("side")).alias("node"),
            F.expr("transform(drawn, d -> named_struct('place', d.place, 'quota', if(side = 0, d.left, d.quota - d.left)))").alias("quotas"),
        )
    leaves = nodes.select(F.col("node").alias("shard"), F.explode("quotas").alias("q"))
    return leaves.select("shard", "q.place", F.col("q.quota").cast("bigint").alias("quota"))


def assign_shards(units: DataFrame, shards: int, seed: str) -> DataFrame:
    """Add ``shard`` to the units: a stretch of each source's permuted units per shard."""
    quotas = split_quotas(units.groupBy("place").agg(F.count("*").alias("quota")), shards, seed)
    upto = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = quotas.withColumn("end", F.sum("quota").over(upto)).where(F.col("quota") > 0)
    stretch = F.explode(F.sequence(F.col("end") - F.col("quota") + 1, F.col("end")))
    owners = ends.select("place", "shard", stretch.alias("rank"))
    order = Window.partitionBy("place").orderBy(uniform_bits(seed, "units", F.col("place"), F.col("block"), F.col("pass")), "block", "pass")
    return units.withColumn("rank", F.row_number().over(order).cast("bigint")).join(owners, ["place", "rank"]).drop("rank")


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def plan(documents: DataFrame, shards: int = SHARDS, seed: str = "mix", **limits: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes of the documents, units with their shard, sources with their target)."""
    sizes = stored(
        with_block(documents.select("doc_id", "source", "text"), seed).select(
            "doc_id", "source", F.col("_size").alias("size"), F.col("_h").alias("h"), F.col("_block").alias("block")
        ),
        "mix-sizes",
    )
    units, sources = draw_plan(sizes, seed, **limits)
    return sizes, stored(assign_shards(units, shards, seed), "mix-units"), sources


def small(df: DataFrame) -> DataFrame:
    """Broadcast if its size is known to be small, else joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def block_passes(units: DataFrame) -> DataFrame:
    """Per block what is taken of it, at most one entry per pass."""
    passes = F.sort_array(F.collect_list(F.struct("pass", "cut", "shard")))
    return units.groupBy(F.col("source").alias("_s"), F.col("block").alias("_b")).agg(passes.alias("_passes"))


def taken_words(documents: DataFrame, shards: int = SHARDS, seed: str = "mix", **limits: float) -> DataFrame:
    """Per document what the mix takes of it: doc_id, size, source_size, target, taken.

    Null sources are a source of their own, the last one; null and empty texts have size 0.
    Rows with the same doc_id in a source are taken alike. Each source's taken words miss its
    target by at most half of the document at the cut. Other columns are ignored.
    """
    sizes, units, sources = plan(documents, shards, seed, **limits)
    wanted = small(block_passes(units))
    rows = sizes.join(wanted, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    copies = F.coalesce(F.size(F.filter("_passes", lambda p: F.col("h") <= p["cut"])), F.lit(0))
    copies = F.when(F.col("_passes").isNull(), 0).otherwise(copies)
    targets = small(sources.select(F.col("source").alias("_t"), F.col("size").alias("source_size"), "target"))
    return rows.join(targets, F.col("source").eqNullSafe(F.col("_t")), "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("bigint").alias("taken")
    )


def mix(documents: DataFrame, shards: int = SHARDS, seed: str = "mix", **limits: float) -> DataFrame:
    """The mixed corpus: the rows of the documents as often as they are taken, with ``pass``
    and ``shard``; the rows of a shard stand together in random order.

    Needs doc_id, source and text; other columns travel along.
    """
    _, units, _ = plan(documents, shards, seed, **limits)
    names = documents.columns
    rows = with_block(documents.select(F.struct("*").alias("_row"), "doc_id", "source", "text"), seed)
    rows = rows.join(small(block_passes(units)), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    rows = rows.select("_row", "doc_id", F.explode(F.filter("_passes", lambda p: F.col("_h") <= p["cut"])).alias("_p"))
    rows = rows.withColumn("_order", uniform_bits(seed, "rows", F.col("_p.shard"), F.col("_p.pass"), F.col("doc_id")))
    rows = rows.withColumn("_shard", F.col("_p.shard")).repartition("_shard").sortWithinPartitions("_shard", "_order")
    added = [(n, c) for n, c in (("pass", "_p.pass"), ("shard", "_p.shard")) if n not in names]
    return rows.select("_row.*", *[F.col(c).alias(n) for n, c in added])
