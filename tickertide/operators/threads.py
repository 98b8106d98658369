"""Comment trees and discussion threads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.operators.dedup import first_rows
from tickertide.operators.running import running_sums
from tickertide.operators.skew import skew_join
from tickertide.session import cut_lineage, written


def comment_depth(messages: DataFrame) -> DataFrame:
    """Comments with ``depth`` and ``thread_id`` (the post).

    ``message_id`` is unique. A comment whose parent is no comment has depth 0. Each round
    doubles the distance every comment has looked up the tree, so the number of joins
    grows with the log of the depth. A comment with very many replies is a hot key of the
    join, which ``skew_join`` spreads. Comments whose parents form a circle have neither
    depth nor thread.
    """
    comments = cut_lineage(
        messages.where(F.col("message_type") == V.COMMENT).select(
            "message_id", "parent_id", "created_at"
        )
    )
    parents = comments.select(F.col("message_id").alias("parent_id"), F.lit(True).alias("nested"))
    start = skew_join(comments, parents, "parent_id", F.xxhash64("message_id"), "left")
    nested = F.coalesce(F.col("nested"), F.lit(False))
    state = written(
        start.select(
            "message_id", "parent_id", "created_at",
            # "at": the comment looked up to so far; null once the top is known.
            F.when(nested, F.col("parent_id")).alias("at"),
            F.when(nested, 1).otherwise(0).alias("depth"),
            F.when(~nested, F.col("parent_id")).alias("thread_id"),
        ),
        "paths",
    )
    # Every path is walked once the steps are as long as there are comments.
    rounds = comments.count().bit_length()
    while not (waiting := state.where(F.col("at").isNotNull())).isEmpty():
        if rounds == 0:
            circle = waiting.select(*[
                F.lit(None).cast(kind).alias(c) if c in ("depth", "thread_id", "at") else F.col(c)
                for c, kind in waiting.dtypes
            ])
            state = state.where(F.col("at").isNull()).unionByName(circle)
            break
        rounds -= 1
        above = state.select(
            F.col("message_id").alias("at"),
            F.col("at").alias("next_at"),
            F.col("depth").alias("more"),
            F.col("thread_id").alias("next_thread"),
        )
        moved = skew_join(waiting, above, "at", F.xxhash64("message_id")).select(
            "message_id", "parent_id", "created_at",
            F.col("next_at").alias("at"),
            (F.col("depth") + F.col("more")).alias("depth"),
            F.col("next_thread").alias("thread_id"),
        )
        # A checkpoint would hand on the guessed size of the join, which is squared each round.
        state = written(state.where(F.col("at").isNull()).unionByName(moved), "paths")
    return state.drop("at")


def thread_places(threaded: DataFrame) -> DataFrame:
    """Comments of ``comment_depth``, whole threads of them, with ``place``: their number in
    their thread, from 1, depth first and replies to one message by time and id.

    A comment stands after its parent, the earlier replies to that and all below those. So
    the sizes of the trees below all comments are counted, summed over earlier replies, and
    these sums added up along the way to the top. Both walks double their step each round;
    rows stay as wide as they are, and a thread or a message with very many replies is
    spread over all tasks. Comments in or below a circle have no place.
    """
    up = F.when(F.col("depth") > 0, F.col("parent_id"))
    # Tables rather than checkpoints, as in ``comment_depth``: they tell their size.
    tree = written(threaded.withColumn("_up", up), "threads")
    known = tree.where(F.col("depth").isNotNull())
    rounds = (known.agg(F.max("depth")).first()[0] or 0).bit_length()
    sizes = known.select("message_id", "_up", F.lit(1).cast("bigint").alias("size"))
    for _ in range(rounds):
        below = sizes.where(F.col("_up").isNotNull()).groupBy(F.col("_up").alias("message_id")).agg(F.sum("size").alias("below"))
        grown = sizes.join(below, "message_id", "left").withColumn("size", F.col("size") + F.coalesce("below", F.lit(0)))
        sizes = written(stepped(grown.drop("below"), sizes.select("message_id", "_up")), "sizes")
    family = known.join(sizes.select("message_id", "size"), "message_id").select("message_id", "parent_id", "created_at", "_up", "size")
    earlier = running_sums(family, "parent_id", ["created_at", "message_id"], "size", "earlier")
    places = written(earlier.select("message_id", "_up", (F.col("earlier") + 1).alias("place")), "places")
    for _ in range(rounds):
        above = places.select("message_id", "_up", F.col("place").alias("above"))
        moved = stepped(places, above).withColumn("place", F.col("place") + F.coalesce("above", F.lit(0)))
        places = written(moved.drop("above"), "places")
    return tree.drop("_up").join(places.select("message_id", "place"), "message_id", "left")


def stepped(rows: DataFrame, above: DataFrame) -> DataFrame:
    """Rows with the ``_up`` of the comment they look up to, and what else ``above`` has of it."""
    nexts = above.withColumnsRenamed({"_up": "_next", "message_id": "_up"})
    found = skew_join(rows, nexts, "_up", F.xxhash64("message_id"), "left")
    return found.drop("_up").withColumnRenamed("_next", "_up")


def flatten_threads(messages: DataFrame, limit: int | None = None) -> DataFrame:
    """Comments with their ``place`` in their thread, depth first, at most ``limit`` per thread."""
    placed = thread_places(comment_depth(messages))
    return placed if limit is None else placed.where(F.col("place") <= limit)


def daily_thread_pick(
    messages: DataFrame, now: datetime | Column | None = None, forum: str = V.FORUMS[0]
) -> DataFrame:
    """The newest discussion thread of the kind that ``now`` asks for, one row at most."""
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    wanted = F.when(F.weekday(moment) >= 5, "weekend discussion thread").otherwise(
        "daily discussion thread"
    )
    threads = messages.where(
        (F.col("message_type") == V.POST)
        & (F.col("subreddit") == forum)
        & F.contains(F.lower("title"), wanted)
    )
    return threads.orderBy(F.desc("created_at"), "message_id").limit(1)


def new_thread_comments(
    comments: DataFrame, last_discussion_id: Column, last_check: Column
) -> DataFrame:
    """Of the known thread the comments after the last check, of others all comments."""
    known = (F.col("thread_id") == last_discussion_id) & last_check.isNotNull()
    return comments.where(~F.coalesce(known, F.lit(False)) | (F.col("timestamp") > last_check))


def in_threads(threaded: DataFrame, threads: DataFrame, most: int) -> DataFrame:
    """(thread_id, message_id, place) of the first ``most`` comments, depth first, below each
    post of ``threads`` (thread_id); ``threaded`` comes from ``comment_depth``."""
    kept = threaded.join(threads.select("thread_id").distinct(), "thread_id", "left_semi")
    return thread_places(kept).where(F.col("place") <= most).select("thread_id", "message_id", "place")


def thread_limit(
    messages: DataFrame,
    limit: int,
    forums: tuple[str, ...] = V.FORUMS,
    posts_per_forum: int | None = None,
    comments_per_post: int | None = None,
    discussion: DataFrame | None = None,
) -> DataFrame:
    """Posts of the forums first, then comments post by post, ``limit`` messages in all.

    A post gives at most ``comments_per_post`` comments. Posts count towards the limit but
    are all kept, at most ``posts_per_forum`` of each forum. While the limit is not reached,
    the thread of ``discussion`` (from ``daily_thread_pick``) follows, unless it is among
    the posts. Returns thread_id, message_id and place, 0 for the post.
    """
    wanted = messages.where(
        (F.col("message_type") == V.POST) & F.col("subreddit").isin(list(forums))
    ).select("message_id", "subreddit", "created_at")
    newest = [F.desc("created_at"), F.asc("message_id")]
    most = limit if posts_per_forum is None else min(posts_per_forum, limit)
    posts = cut_lineage(first_rows(wanted, ["subreddit"], newest, most))
    most = limit if comments_per_post is None else min(comments_per_post, limit)
    threaded = comment_depth(messages)
    taken = cut_lineage(in_threads(threaded, posts.select(F.col("message_id").alias("thread_id")), most))
    given = taken.groupBy("thread_id").agg(F.count("*").alias("given"))
    queue = posts.join(given, posts["message_id"] == given["thread_id"], "left").select(
        "message_id", "subreddit", "created_at", F.coalesce("given", F.lit(0)).alias("given")
    )
    # Forums are counted one by one, and what earlier forums give is added: one row each.
    place = F.array_position(F.array(*[F.lit(f) for f in forums]), F.col("subreddit"))
    totals = queue.groupBy(place.alias("forum")).agg(F.sum("given").alias("sum"), F.count("*").alias("n")).collect()
    n_posts = sum(r.n for r in totals)
    earlier = F.lit(0)
    for r in totals:
        earlier = earlier + F.when(place > r.forum, r["sum"]).otherwise(0)
    inside = Window.partitionBy("subreddit").orderBy(*newest).rowsBetween(Window.unboundedPreceding, -1)
    quota = queue.select(
        F.col("message_id").alias("thread_id"),
        (earlier + F.coalesce(F.sum("given").over(inside), F.lit(0))).alias("before"),
    )
    comments = taken.join(quota, "thread_id").where(F.col("before") + F.col("place") <= limit - n_posts)
    heads = posts.select(F.col("message_id").alias("thread_id"), "message_id", F.lit(0).cast("bigint").alias("place"))
    rows = heads.unionByName(comments.select("thread_id", "message_id", "place"))
    if discussion is None:
        return rows
    rest = limit - n_posts - min(sum(r["sum"] for r in totals), max(0, limit - n_posts))
    thread = discussion.select(F.col("message_id").alias("thread_id")).join(
        posts.select(F.col("message_id").alias("thread_id")), "thread_id", "left_anti"
    )
    tail = thread.select("thread_id", F.col("thread_id").alias("message_id"), F.lit(0).cast("bigint").alias("place"))
    if rest > 1:
        tail = tail.unionByName(in_threads(threaded, thread, rest - 1))
    return rows.unionByName(tail) if rest > 0 else rows
