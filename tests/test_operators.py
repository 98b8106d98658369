"""Operators on small tables with the cases that are easy to get wrong."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide import vocab as V
from tickertide.functions import values as T
from tickertide.operators import clean as C
from tickertide.operators import dedup as D
from tickertide.operators import mentions as M
from tickertide.operators import merge
from tickertide.operators import skew
from tickertide.operators import summaries as G
from tickertide.operators import threads
from tickertide.operators import universe as U
from tickertide.operators.running import running_sums
from tickertide.registry import derived
from tickertide.sources import messages as S
from tickertide.sources import prices as P
from tickertide.sources import tables
from tickertide.sources.listing import listing_scan


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def at(day, hour=0, minute=0, second=0):
    return datetime(2024, 1, day, hour, minute, second)


# -- cleaning --


def test_valid_and_deleted(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("[deleted]",)], "content string")
    assert rows(C.valid_content(df)) == [("a",)]
    assert rows(C.drop_deleted(df)) == [("a",), ("",), (None,)]
    assert rows(C.deleted_only(df)) == [("[deleted]",)]


def test_watermark_is_cut_to_seconds(spark):
    df = spark.createDataFrame([(at(1, 0, 0, 5),), (at(1, 0, 0, 6),)], "created_at timestamp")
    late = datetime(2024, 1, 1, 0, 0, 5, 900000)
    assert rows(C.since_watermark(df, late)) == [(at(1, 0, 0, 6),)]
    assert C.since_watermark(df, None).count() == 2


def test_full_text(spark):
    df = spark.createDataFrame(
        [("T", "c"), ("", "c"), (None, "c"), (None, " \t "), ("T", None)], "title string, content string"
    )
    assert [r.text for r in C.with_full_text(df).collect()] == ["T c", "c", "c"]


def test_normalize_types(spark):
    df = spark.createDataFrame(
        [("d1", "m1", 1700000000.5, "2024-01-02T03:04:05+01:00", None),
         ("d2", "m2", None, "tomorrow", "news"), ("d3", "m3", 0.0, "2024-01-02", None)],
        "document_id string, id string, timestamp double, created_at string, source string",
    )
    got = C.normalize_message(df).select(
        "message_id", "timestamp", "created_at", "source", "depth", "content"
    )
    assert rows(got, "message_id") == [
        ("m1", datetime(2023, 11, 14, 22, 13, 20, 500000), datetime(2024, 1, 2, 2, 4, 5), "reddit", None, None),
        ("m2", None, None, "news", None, None),
        ("m3", datetime(1970, 1, 1), datetime(2024, 1, 2), "reddit", None, None),
    ]
    assert C.normalize_message(df, source=None).where("source is null").count() == 2
    names = [f.split()[0] for f in schemas.RAW_MESSAGES.split(", ")]
    assert C.normalize_message(df).columns == names


def test_comments_count_and_feed(spark):
    df = spark.createDataFrame(
        [("a", V.POST, 3, 5, at(1)), ("b", V.ARTICLE, 9, 7, at(2)), ("c", V.POST, 20, 1, at(3))],
        "message_id string, message_type string, num_comments int, score int, created_at timestamp",
    )
    assert rows(C.comments_count(df).select("message_id", "comments_count"), "message_id") == [
        ("a", 3), ("b", 0), ("c", 20)]
    assert [r.message_id for r in C.feed(df, "new").collect()] == ["c", "a"]
    assert [r.message_id for r in C.feed(df, "top").collect()] == ["a", "c"]
    assert [r.message_id for r in C.posts_by_activity(df, 10).collect()] == ["c"]


# -- dedup --


def test_dedup_null_ids_and_ties(spark):
    df = spark.createDataFrame(
        [("a", at(1), 1), ("a", at(1), 2), (None, at(1), 3), (None, at(2), 4)],
        "message_id string, ingestion_timestamp timestamp, event_id int",
    )
    assert rows(D.dedup_by_ingestion(df).select("event_id"), "event_id") == [(2,), (4,)]


def test_dedup_shrinks_copies_before_the_exchange(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("message_id"), F.current_timestamp().alias("ingestion_timestamp"), "id"
    )
    plan = D.dedup_by_ingestion(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange"):]
    assert D.dedup_by_ingestion(df).count() == 3


def test_dedup_by_id_leaves_texts_where_they_are(spark):
    df = spark.range(1000).select(
        (F.col("id") % 300).cast("string").alias("message_id"), F.timestamp_seconds(F.col("id") % 7).alias("created_at"),
        F.timestamp_seconds(F.col("id") % 3).alias("timestamp"), F.repeat(F.lit("text"), F.col("id").cast("int")).alias("content"),
        "id", F.col("id").alias("event_id"),
    )
    plain = D.dedup_by_event_time(df).collect()
    by_id = D.dedup_by_event_time(df, row_id="id")
    assert sorted(by_id.collect()) == sorted(plain)
    plan = D.dedup_by_event_time(df, row_id="id")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("Window ["):]
    fetched = D.dedup_by_event_time(df, row_id="id", fetch=lambda ids: df.join(ids, "id", "left_semi").where("id > 900"))
    assert sorted(fetched.collect()) == sorted(r for r in plain if r.id > 900)


def test_messages_are_not_written_to_be_read(spark, sf_dir):
    from tickertide.registry.base import clean

    assert {f.rsplit("/", 2)[-1] for f in clean(spark, sf_dir).inputFiles()} <= {"events.parquet", "documents.parquet"}


def test_scan_messages_limit(spark):
    df = spark.createDataFrame(
        [(f"m{i}", "text", "u", at(1 + i), "f", None, "url", i, V.POST, at(1)) for i in range(5)],
        "message_id string, content string, author string, created_at timestamp, subreddit string, "
        "title string, url string, score int, message_type string, timestamp timestamp",
    )
    assert [r.message_id for r in S.scan_messages(df, at(2), limit=2).collect()] == ["m4", "m3"]


# -- skew --


def test_skew_join_equals_join(spark):
    left = spark.range(20000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 1000 == 1, None)
        .otherwise(F.col("id") % 5000).alias("k"),
    )
    right = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how).select("n", "k", "v")
        spread = skew.skew_join(left, right, "k", F.xxhash64("n"), how).select("n", "k", "v")
        assert rows(plain, "n") == rows(spread, "n")
        by_partition = skew.skew_join(left, right, "k", how=how).select("n", "k", "v")
        assert rows(plain, "n") == rows(by_partition, "n")
    assert rows(skew.hot_keys(left, "k")) == [(7,)]
    semi = skew.skew_semi_join(left, right, ["k"])
    assert rows(semi.select("n"), "n") == rows(left.join(right, "k", "left_semi").select("n"), "n")


def test_large_universe_join_equals_inline(spark):
    texts = spark.createDataFrame(
        [("a", "AAPL and TSLA, aapl GME " + "the " * 50), ("b", "nothing"), ("c", "GME " * 30), (None, "TSLA")],
        "message_id string, text string",
    )
    universe = spark.createDataFrame([("AAPL",), ("TSLA",), ("GME",), ("THE",), ("AAPL",)], "ticker string")
    inline = M.with_tickers(texts, universe)
    large = M.with_tickers(texts, universe, inline=1)
    assert rows(inline, "text") == rows(large.select(*inline.columns), "text")
    assert rows(M.with_tickers(texts, universe, inline=1, max_tickers=2)
                .select("tickers"), "tickers") == [([],), (["AAPL", "TSLA"],), (["GME"],), (["TSLA"],)]


def test_whole_texts(spark):
    """Neither length nor number of tickers cuts a message, for a universe of any size."""
    names = [f"{a}{b}Q" for a in "ABC" for b in "WXYZ"][:11]
    text = "lower case words " * 300 + " ".join(names)
    message = spark.createDataFrame(
        [(None, text), ("m", text)], "message_id string, content string"
    ).select(
        "message_id", "content", F.lit(None).cast("string").alias("title"), F.lit(0).alias("score"),
        *[F.lit("x").alias(c) for c in ("author", "subreddit", "url", "message_type")],
        F.current_timestamp().alias("created_at"),
    )
    universe = spark.createDataFrame([(n,) for n in names], "ticker string")
    for given in (universe, names):
        found = M.find_mentions(message, given).collect()
        assert sorted(r.ticker for r in found if r.message_id is None) == sorted(names)
        assert len(found) == 22
    large = M.with_tickers(C.with_full_text(message), universe, inline=1).select("message_id", "tickers")
    assert all(r.tickers == names for r in large.collect())
    short = M.find_mentions(message, names, limits=V.SHORT_TEXT)
    assert short.count() == 0


def test_every_document_is_read(spark):
    """No document is deleted or repeated in all of its messages."""
    for sf in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{sf}"
        documents = derived.table(spark, folder, "documents").select("doc_id")
        raw = derived.raw_messages(spark, folder)
        n = documents.count()
        for table in (raw, S.scan_messages(raw).join(raw.select("message_id", "event_id"), "message_id")):
            # A message of a document carries its text, which is longer than a phrase.
            whole = table.where("length(content) > 200").select((F.col("event_id") % n).alias("doc_id"))
            shortest = derived.table(spark, folder, "documents").where("length(text) > 200").select("doc_id")
            assert shortest.join(whole, "doc_id", "left_anti").count() == 0


def test_rows_without_key_are_known_by_contents(spark):
    stored = spark.createDataFrame([("a", "X", 1), (None, "X", 2)], "message_id string, ticker string, n int")
    batch = spark.createDataFrame(
        [("a", "X", 9), (None, "X", 2), (None, "X", 3), (None, "X", 3), ("b", "X", 4)], "message_id string, ticker string, n int"
    )
    added = merge.new_rows(batch, stored, ["message_id", "ticker"])
    assert sorted(r.n for r in added.collect()) == [3, 4]


def test_field_merge_of_repeated_keys(spark):
    stored = spark.createDataFrame([("a", "t"), ("a", "s"), (None, "n")], "id string, title string")
    batch = spark.createDataFrame(
        [("a", "new", 1, None), ("a", None, 3, "f"), ("a", "older", 0, "g"), (None, "k", 5, "h")],
        "id string, title string, created_at int, forum string",
    )
    got = merge.field_merge_upsert(stored, batch, "id").select("id", "title", "forum")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", "new", "f"), ("a", "new", "f"), (None, "n", None), (None, "k", "h")], key=str
    )


# -- universe, listing, prices --


def test_volume_universe_filters_after_the_cut(spark):
    prices = spark.createDataFrame(
        [("BRK.B", 100), ("AA", 50), ("BB", 10), ("CC", 5)], "ticker string, volume int")
    assert [r.ticker for r in U.volume_universe(prices, 2).collect()] == ["AA"]


def test_require_rows(spark):
    empty = spark.createDataFrame([], "ticker string")
    with pytest.raises(ValueError):
        U.require_rows(U.listing_symbols(empty))


def test_listing_files(spark, tmp_path):
    one, two = tmp_path / "one.txt", tmp_path / "two.txt"
    one.write_text("Symbol|Security Name|Test Issue|ETF\nAAPL|Apple Inc. |N|N\nZAZZT|Test|Y|N\nBAD.X|x|N|N\n"
                   "File Creation Time: 0101|||\n")
    two.write_text("ACT Symbol|Security Name|Test Issue\nGME|GameStop|N\ntoo|lower|N\n")
    got = listing_scan(spark, {"NASDAQ": str(one), "NYSE": str(two)}).drop("last_updated")
    assert rows(got, "ticker") == [("AAPL", "NASDAQ", "Apple Inc."), ("GME", "NYSE", "GameStop")]
    path = str(tmp_path / "table")
    files = {"NASDAQ": str(one)}
    assert tables.ensure_listing_table(spark, path, files) is False
    assert tables.ensure_listing_table(spark, path, files) is True


def test_price_long(spark):
    wide = spark.createDataFrame(
        [("2024-01-02", 1.0, None, 5), ("2024-01-03", None, 2.0, None)],
        "Date string, `Open|A` double, `Adj Close|B` double, `Volume|A` int",
    )
    assert rows(P.price_cast(P.price_long(wide)), "Date", "Ticker") == [
        (date(2024, 1, 2), "A", 1.0, None, None, None, None, 5),
        (date(2024, 1, 3), "B", None, None, None, None, 2.0, None),
    ]
    single = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 9)],
        "Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume int",
    )
    assert rows(P.price_long(single, "A")) == [("2024-01-02", "A", 1.0, 2.0, 0.5, 1.5, 1.4, 9)]
    assert P.price_long(single.drop("Open"), "A").count() == 0


# -- upserts --


def test_append_and_replace_are_idempotent(spark):
    stored = spark.createDataFrame([("a", "X", 1), ("b", "Y", 2)], "message_id string, ticker string, n int")
    batch = spark.createDataFrame(
        [("a_b", "X", 3), ("b", "Y", 9), ("b", "Z", 4), ("b", "Z", 4), (None, "Q", 5)],
        "message_id string, ticker string, n int",
    )
    keys = ["message_id", "ticker"]
    assert sorted(r.n for r in merge.new_rows(batch, stored, keys).collect()) == [3, 4, 5]
    assert [r.n for r in merge.existing_rows(batch, stored, keys).collect()] == [9]
    known = batch.where("message_id is not null")
    once = merge.replace_upsert(stored, known, keys)
    twice = merge.replace_upsert(once, known, keys)
    assert rows(once, *keys) == rows(twice, *keys) == [("a", "X", 1), ("a_b", "X", 3), ("b", "Y", 9), ("b", "Z", 4)]
    assert merge.key_exists(stored, message_id="a", ticker="X")
    assert not merge.key_exists(stored, message_id="a", ticker="Y")


def raw_frame(spark, data):
    base = spark.createDataFrame([], schemas.RAW_MESSAGES)
    names = ["document_id", "message_id", "content", "score", "submission_id", "ingestion_timestamp"]
    part = spark.createDataFrame(
        data, "document_id string, message_id string, content string, score bigint, submission_id string, "
        "ingestion_timestamp timestamp")
    return base.unionByName(part, allowMissingColumns=True), names


def test_raw_upsert_keeps_ids(spark):
    stored, names = raw_frame(spark, [("d1", "m1", "old", 1, "s1", at(1)), ("d1b", "m1", "copy", 2, "s1", at(1)),
                                      ("d2", "m2", "stay", 3, None, at(1))])
    batch, _ = raw_frame(spark, [("d9", "m1", None, 7, "s9", at(3)), ("d8", "m1", "older", 6, "s8", at(2)),
                                 ("d3", "m3", "new", 4, "s3", at(3)), ("d4", None, "no id", 5, None, at(3)),
                                 ("d5", None, "no id", 6, None, at(3))])
    got = merge.raw_upsert(stored, batch).select(*names)
    assert rows(got, "document_id") == [
        ("d1", "m1", None, 7, "s1", at(3)), ("d1b", "m1", None, 7, "s1", at(3)),
        ("d2", "m2", "stay", 3, None, at(1)), ("d3", "m3", "new", 4, "s3", at(3)),
        ("d4", None, "no id", 5, None, at(3)), ("d5", None, "no id", 6, None, at(3)),
    ]
    assert rows(merge.affected_rows(stored, batch)) == [(2, 3)]
    merged, counts = tables.merge_staged(stored, batch)
    assert merged.count() == 6 and rows(counts) == [(2, 3)]
    assert [r.document_id for r in merge.staging_ack(batch, batch.where("score > 4")).collect()] == ["d3"]


def test_raw_upsert_by_id_gives_the_same_rows(spark):
    from tickertide.session import written

    stored, names = raw_frame(spark, [("d1", "m1", "old", 1, "s1", at(1)), ("d1b", "m1", "copy", 2, "s1", at(1)),
                                      ("d2", "m2", "stay", 3, None, at(1)), ("d0", None, "no id", 3, None, at(1))])
    batch, _ = raw_frame(spark, [("d9", "m1", None, 7, "s9", at(3)), ("d8", "m1", "older", 6, "s8", at(2)),
                                 ("d3", "m3", "new", 4, "s3", at(3)), ("d3", "m3", "older", 4, "s3", at(2)),
                                 ("d4", None, "no id", 5, None, at(3)), ("d4", None, "no id", 5, None, at(3))])
    plain = rows(merge.raw_upsert(stored, batch).select(*names), "document_id", "score")
    numbered = written(batch.withColumn("n", F.monotonically_increasing_id()), "numbered")
    views = {"fetch_stored": lambda ids: stored.withColumn("n", F.xxhash64("document_id")).join(ids, "n", "left_semi"),
             "fetch_batch": lambda ids: numbered.join(ids, "n")}
    assert numbered.select("n").distinct().count() == 6
    got = merge.raw_upsert(stored, numbered, row_id="n")
    assert rows(got.select(*names), "document_id", "score") == plain
    viewed = merge.raw_upsert(stored.withColumn("n", F.xxhash64("document_id")), numbered, row_id="n", **views)
    assert rows(viewed.select(*names), "document_id", "score") == plain
    # What meets no stored row does not move.
    empty = spark.createDataFrame([], schemas.RAW_MESSAGES)
    plan = merge.raw_upsert(empty, numbered, row_id="n")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and merge.raw_upsert(empty, numbered, row_id="n").count() == 4


def test_dropped_rows_are_taken_out_in_place(spark):
    """Few dropped keys are broadcast; with more, a hot key is spread. The rows are the same."""
    df = spark.range(0, 3000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit("text").alias("content"))
    dropped = spark.range(0, 1500).select(F.col("id").alias("k"))
    few, many = (D.without_rows(df, dropped, "k", most) for most in (1500, 1499))
    assert rows(few, "id") == rows(many, "id") and few.count() == 2000
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_rows_that_meet_no_dropped_key_stay(spark):
    """With more keys than are broadcast their bits are: only rows that may meet one move."""
    df = spark.range(0, 3000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit("text").alias("content"))
    many = D.without_rows(df, spark.range(0, 1500).select(F.col("id").alias("k")), "k", 1499)
    assert many.count() == 2000 and many.where("k is null").count() == 1000
    assert "bitmap_construct_agg" in many._jdf.queryExecution().optimizedPlan().toString()


def test_upsert_leaves_texts_that_nobody_reads(spark):
    from tickertide.session import written

    stored, _ = raw_frame(spark, [("d1", "m1", "old", 1, "s1", at(1))])
    batch, _ = raw_frame(spark, [("d2", "m1", "new", 2, "s2", at(2)), ("d3", None, "no id", 3, None, at(2))])
    batch = written(batch, "upserted")
    merged = merge.raw_upsert(stored, batch).select("message_id", "score")
    assert sorted(r.score for r in merged.collect()) == [2, 3]
    scans = [x for x in merged._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x and "upserted" in x]
    assert scans and not any("content" in x for x in scans)


def test_numbered_rows_stay_where_they_are(spark):
    """Any number of ids is broadcast a bit each; with too many bitmaps both are joined."""
    from tickertide.session import written

    df = written(spark.range(0, 200_000, 1, 3).select("id", F.monotonically_increasing_id().alias("n")), "rows")
    ids = df.where("id % 7 = 0 or id between 32760 and 32780").select("n")
    few, many = D.numbered_rows(df, ids, "n"), D.numbered_rows(df, ids, "n", most=1)
    wanted = sorted(i for i in range(200_000) if i % 7 == 0 or 32760 <= i <= 32780)
    for got in (few, many):
        assert sorted(r.id for r in got.collect()) == wanted and got.columns == df.columns
    assert D.numbered_rows(df, ids.limit(0), "n").count() == 0
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_texts_get_the_tasks_asked_for(spark, sf_dir):
    from tickertide.registry.base import clean

    rows_ = clean(spark, sf_dir)
    assert rows_.rdd.getNumPartitions() >= 24  # the ids alone would be one task
    assert rows_.count() > 0


def test_field_merge(spark):
    stored = spark.createDataFrame([("a", "t", 1)], "id string, title string, score int")
    batch = spark.createDataFrame([("a", None, "f"), ("b", "u", None)], "id string, title string, forum string")
    assert rows(merge.field_merge_upsert(stored, batch, "id"), "id") == [
        ("a", "t", 1, "f"), ("b", "u", None, None)]


def test_save_records(spark):
    class Record:
        def __init__(self):
            self.step, self.last_run, self.updated_at = "a", at(1), None

    kept = tables.save_records(
        spark, [Record(), {"step": "b", "last_run": None, "updated_at": at(2)}], schemas.RUN_STATE)
    assert kept.where("etl_timestamp is not null").count() == 2
    with pytest.raises(TypeError):
        tables.save_records(spark, [3], schemas.RUN_STATE)
    stamped = spark.createDataFrame([("a", at(1)), ("b", None)], "k string, etl_timestamp timestamp")
    assert rows(tables.save_records(spark, stamped).where("k = 'a'")) == [("a", at(1))]


def test_create_tables(spark, tmp_path):
    root = str(tmp_path / "db")
    assert sorted(tables.create_tables(spark, root)) == sorted(schemas.TABLES)
    assert tables.create_tables(spark, root) == []
    for name in schemas.TABLES:
        table = tables.read_table(spark, root, name)
        assert table.columns == [*schemas.columns(name), "event_date"] and table.count() == 0
    assert tables.create_like(table).schema == table.schema


# -- summaries --


def mention_frame(spark, data):
    return spark.createDataFrame(
        [(f"m{i}", *r) for i, r in enumerate(data)],
        "message_id string, ticker string, created_at timestamp, subreddit string, sentiment_compound double, "
        "confidence double, signals array<string>, context string",
    )


def test_summary_edges(spark):
    df = mention_frame(spark, [
        ("A", at(7, 23, 59), "f", 0.5, 0.0, ["BUY", "PT:5.0"], "c0"),
        ("A", at(7, 0, 0), None, -0.25, 0.0, ["PT:5.0", "SELL"], "c1"),
        ("A", at(8, 0, 0), "g", 1.0, 0.7, [], "c2"),
        ("B", at(8, 1, 0), "g", 1.0, 0.9, ["HOLD", "OPTIONS", "PT:oops"], "c3"),
        ("B", at(8, 1, 1), "g", -1.0, None, None, "c4"),
    ])
    daily = {(r.ticker, r.date): r for r in G.daily_summary(df).collect()}
    first = daily["A", date(2024, 1, 7)]
    assert (first.mention_count, first.avg_sentiment, first.weighted_sentiment) == (2, 0.125, 0.125)
    assert first.price_targets == {"5.0": 2} and first.subreddits == {"f": 1}
    assert first.high_conf_sentiment is None
    assert daily["A", date(2024, 1, 8)].high_conf_sentiment is None  # 0.7 is not above 0.7
    other = daily["B", date(2024, 1, 8)]
    assert (other.avg_sentiment, other.weighted_sentiment, other.avg_confidence) == (0.0, 1.0, 0.9)
    assert (other.hold_signals, other.options_signals, other.price_targets) == (1, 1, {})
    assert [c.context for c in other.top_contexts] == ["c3", "c4"]
    weekly = {(r.ticker, r.week_start): r for r in G.weekly_summary(df).collect()}
    assert weekly["A", at(1)].daily_breakdown == {"2024-01-07": 2}
    assert weekly["A", at(8)].daily_breakdown == {"2024-01-08": 1}
    hourly = G.hourly_summary(df)
    assert sorted(hourly.columns) == sorted(schemas.columns("stock_hourly_summary"))
    for name, grain in G.GRAINS.items():
        assert set(G.summarize(df, grain).columns) == set(schemas.columns(f"stock_{name}_summary"))


def test_accumulate_equals_one_run(spark):
    data = [("A" if i % 3 else "B", at(1 + i % 9, i % 24), f"f{i % 4}", round((i % 7) / 7 - 0.4, 3),
             round((i % 11) / 11, 2), ["BUY", f"PT:{i % 5 + 1}.0"] if i % 2 else ["NEWS"], f"c{i}") for i in range(300)]
    df = mention_frame(spark, data)
    early, late = df.where("created_at < '2024-01-05 12:00:00'"), df.where("created_at >= '2024-01-05 12:00:00'")
    for grain in G.GRAINS.values():
        total = G.accumulate(
            G.summarize(early, grain, True), G.summarize(late, grain, True), grain).drop("etl_timestamp")
        whole = G.summarize(df, grain, True).select(*total.columns)
        drop = ["top_contexts"]
        assert rows(total.drop(*drop), *grain.keys) == rows(whole.drop(*drop), *grain.keys)
        if grain.contexts:
            def shown(d):
                return [[c.confidence for c in r.top_contexts] for r in d.orderBy(*grain.keys).collect()]
            assert shown(total) == shown(whole)


def test_hourly_accumulate_adds_up_hours_of_both_batches(spark, monkeypatch):
    from tickertide.registry import mention_queries as Q
    from tickertide.registry.base import QUERIES

    times = [datetime(2024, 1, 15, 11, 10), datetime(2024, 1, 15, 11, 50), datetime(2024, 1, 15, 12, 29),
             datetime(2024, 1, 15, 12, 30), datetime(2024, 1, 16, 3, 59), None]
    df = mention_frame(spark, [("A", t, "f", 0.5 + i / 10, 0.5, ["BUY"], f"c{i}") for i, t in enumerate(times)])
    sides, accumulate = [], G.accumulate
    monkeypatch.setattr(Q, "stored_mentions", lambda *_: df)
    monkeypatch.setattr(G, "accumulate", lambda a, b, g: sides.append((a, b)) or accumulate(a, b, g))
    got = QUERIES["hourly_accumulate"](spark, "")
    [(early, late)] = sides
    assert rows(early.join(late, ["ticker", "hour_start"]).select("hour_start"), "hour_start") == [
        (datetime(2024, 1, 15, 11),), (datetime(2024, 1, 15, 12),)]
    whole = G.summarize(df, G.HOURLY).withColumn("hour_start", F.col("hour_start").cast("string")).select(*got.columns)
    assert rows(got, "hour_start") == rows(whole, "hour_start") and got.count() == 4


def test_summary_plan_combines_before_the_exchange(spark):
    df = mention_frame(spark, [("A", at(7), "f", 0.5, 0.1, ["BUY"], "c")])
    plan = G.hourly_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Join" not in plan and "Window" not in plan


# -- threads --


def test_comment_depth_shapes(spark):
    data = [("p", None, V.POST)] + [("c0", "p", V.COMMENT)]
    data += [(f"c{i}", f"c{i - 1}", V.COMMENT) for i in range(1, 40)]      # one long chain
    data += [(f"h{i}", "c3", V.COMMENT) for i in range(3000)]              # a hot parent
    data += [("o", "gone", V.COMMENT), ("n", None, V.COMMENT), ("on", "o", V.COMMENT)]
    df = spark.createDataFrame(
        [(m, p, k, at(1), "f", None) for m, p, k in data],
        "message_id string, parent_id string, message_type string, created_at timestamp, subreddit string, title string")
    depth = {r.message_id: (r.depth, r.thread_id) for r in threads.comment_depth(df).collect()}
    assert depth["c0"] == (0, "p") and depth["c39"] == (39, "p")
    assert all(depth[f"h{i}"] == (4, "p") for i in range(3000))
    assert depth["o"] == (0, "gone") and depth["on"] == (1, "gone") and depth["n"] == (0, None)
    assert len(depth) == len(data) - 1
    assert threads.flatten_threads(df.limit(0)).count() == 0
    few = threads.flatten_threads(df, 4).where("thread_id = 'p'").orderBy("place")
    assert [r.message_id for r in few.collect()] == ["c0", "c1", "c2", "c3"]


def plain_places(data):
    """Places by walking the replies of each thread, depth first."""
    ids, below, out = {m for m, _, _ in data}, {}, {}
    for m, p, t in sorted(data, key=lambda x: (x[2], x[0])):
        below.setdefault(p, []).append(m)
    for top in below.keys() - ids:
        stack, place = below[top][::-1], 0
        while stack:
            m = stack.pop()
            place += 1
            out[m] = (top, place)
            stack += below.get(m, [])[::-1]
    return out


def comments(spark, data):
    return spark.createDataFrame(
        [(m, p, V.COMMENT, t) for m, p, t in data],
        "message_id string, parent_id string, message_type string, created_at timestamp")


@pytest.mark.parametrize("seed", [1])
def test_places_of_random_threads(spark, seed):
    some = random.Random(seed)
    data = []
    for i in range(600):
        kind = some.random()
        parent = f"p{some.randrange(3)}" if kind < 0.1 else f"p{i}x" if kind < 0.12 else "c0" if kind < 0.4 else f"c{some.randrange(max(1, i - 9), i + 1) - 1 if i else 0}"
        data.append((f"c{i}", "p0" if i == 0 else parent, at(1, some.randrange(5))))
    got = {r.message_id: (r.thread_id, r.place) for r in threads.flatten_threads(comments(spark, data)).collect()}
    assert got == plain_places(data)


def test_places_on_a_long_chain(spark):
    n = 200
    ids = spark.range(n).select(
        F.concat(F.lit("c"), "id").alias("message_id"),
        F.when(F.col("id") == 0, "p").otherwise(F.concat(F.lit("c"), F.col("id") - 1)).alias("parent_id"),
        F.lit(V.COMMENT).alias("message_type"), F.lit(at(1)).alias("created_at"))
    got = threads.flatten_threads(ids)
    assert "path" not in got.columns
    odd = got.where((F.concat(F.lit("c"), F.col("place") - 1) != F.col("message_id")) | (F.col("thread_id") != "p"))
    assert got.count() == n and odd.count() == 0


def test_depth_of_a_chain_keeps_the_guessed_size_small(spark):
    ids = spark.range(40).select(
        F.concat(F.lit("c"), "id").alias("message_id"),
        F.when(F.col("id") == 0, "p").otherwise(F.concat(F.lit("c"), F.col("id") - 1)).alias("parent_id"),
        F.lit(V.COMMENT).alias("message_type"), F.lit(at(1)).alias("created_at"))
    got = threads.comment_depth(ids)
    size = got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(size).bit_length() < 64
    assert got.agg(F.max("depth")).first()[0] == 39


def test_running_sums_of_a_group_over_many_ranges(spark):
    rows = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") % 11).alias("v"))
    want, sums = {}, {}
    for i, g, v in sorted(tuple(r) for r in rows.collect()):
        want[i] = sums.get(g, 0)
        sums[g] = want[i] + v
    got = running_sums(rows, "g", ["id"], "v", "s").collect()
    assert {r.id: r.s for r in got} == want and len(got) == 5000
    assert running_sums(rows.limit(0), "g", ["id"], "v", "s").count() == 0


def test_thread_limit_counts(spark):
    data = [("p1", None, V.POST, "stocks", 2), ("p2", None, V.POST, "stocks", 1), ("px", None, V.POST, "other", 1)]
    data += [(f"a{i}", "p1", V.COMMENT, "stocks", 3 + i) for i in range(4)]
    data += [(f"b{i}", "p2", V.COMMENT, "stocks", 3 + i) for i in range(4)]
    df = spark.createDataFrame(
        [(m, p, k, s, at(1, h)) for m, p, k, s, h in data],
        "message_id string, parent_id string, message_type string, subreddit string, created_at timestamp")

    def taken(limit, per_post):
        got = threads.thread_limit(df, limit, comments_per_post=per_post)
        return sorted(r.message_id for r in got.collect())

    assert taken(100, 1000) == ["a0", "a1", "a2", "a3", "b0", "b1", "b2", "b3", "p1", "p2"]
    assert taken(7, 1000) == ["a0", "a1", "a2", "a3", "b0", "p1", "p2"]
    assert taken(7, 2) == ["a0", "a1", "b0", "b1", "p1", "p2"]
    assert taken(2, 2) == ["p1", "p2"]


def test_circles_of_parents_end(spark):
    data = [("x", "y"), ("y", "x"), ("z", "x"), ("a", "p"), ("b", "a"), ("self", "self")]
    df = spark.createDataFrame([(m, p, V.COMMENT, at(1)) for m, p in data],
                               "message_id string, parent_id string, message_type string, created_at timestamp")
    got = {r.message_id: (r.depth, r.thread_id) for r in threads.comment_depth(df).collect()}
    assert got == {"x": (None, None), "y": (None, None), "z": (None, None), "self": (None, None), "a": (0, "p"), "b": (1, "p")}


def test_thread_pick_and_new_comments(spark):
    df = spark.createDataFrame(
        [("d", "Daily Discussion Thread 1", at(5)), ("e", "your DAILY discussion thread", at(6)),
         ("w", "Weekend Discussion Thread", at(4)), ("x", "Other", at(9))],
        "message_id string, title string, created_at timestamp",
    ).withColumns({"message_type": F.lit(V.POST), "subreddit": F.lit("wallstreetbets")})
    assert [r.message_id for r in threads.daily_thread_pick(df, at(5)).collect()] == ["e"]   # Friday
    assert [r.message_id for r in threads.daily_thread_pick(df, at(6)).collect()] == ["w"]   # Saturday
    comments = spark.createDataFrame(
        [("a", "t1", at(1)), ("b", "t1", at(3)), ("c", "t2", at(1))],
        "message_id string, thread_id string, timestamp timestamp")

    def fresh(thread, check):
        got = threads.new_thread_comments(
            comments, F.lit(thread).cast("string"), F.lit(check).cast("timestamp"))
        return sorted(r.message_id for r in got.collect())

    assert fresh("t1", at(2)) == ["b", "c"]
    assert fresh("t1", None) == ["a", "b", "c"]
    assert fresh(None, at(2)) == ["a", "b", "c"]


# -- values --


def test_times_and_json(spark):
    df = spark.createDataFrame(
        [("2024-03-10T23:30:00+05:00", '{"a": 1}', '{"a": 2, "l": [1], "d": {"x": 1}}', '{"a": 3, "l": [2], "d": {"x": 4, "y": 1}}'),
         ("2024-03-10T23:30:00", "", None, '{"b": 1}'), ("x", "{bad", '{"b": 1}', None)],
        "t string, j string, l string, r string",
    )
    default = T.no_counts()
    got = df.select(
        T.wall_clock(F.col("t")).alias("w"), T.json_or(F.col("j"), "map<string,bigint>", default).alias("j"),
        T.merge_json("l", "r").alias("m"))
    assert rows(got) == [
        (datetime(2024, 3, 10, 23, 30), {"a": 1}, '{"a": 5, "l": [1, 2], "d": {"x": 5, "y": 1}}'),
        (datetime(2024, 3, 10, 23, 30), {}, '{"b": 1}'), (None, {}, '{"b": 1}'),
    ]
    counts = spark.createDataFrame(
        [({"a": 1}, {"a": 2, "b": 5}), (None, {"a": 1}), (None, None)], "x map<string,bigint>, y map<string,bigint>")
    assert [r[0] for r in counts.select(T.merge_counts(F.col("x"), F.col("y"))).collect()] == [
        {"a": 3, "b": 5}, {"a": 1}, {}]
    whole = spark.createDataFrame([(at(1),), (datetime(2024, 1, 1, 0, 0, 0, 500000),)], "t timestamp")
    assert [r[0] for r in whole.select(T.format_iso(F.col("t"))).collect()] == [
        "2024-01-01T00:00:00", "2024-01-01T00:00:00.500000"]


# -- skew in upserts --


def test_hot_key_is_spread_in_raw_upsert(spark):
    """A third of the stored rows share one id, yet no task gets a third of the rows."""
    base = spark.createDataFrame([], schemas.RAW_MESSAGES)
    stored = base.unionByName(
        spark.range(0, 30000, 1, 64).select(
            F.concat(F.lit("d"), "id").alias("document_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), "id")).alias("message_id"),
        ), allowMissingColumns=True)
    batch = base.unionByName(
        spark.createDataFrame([("x", "hot", "new"), ("y", "m1", "new")],
                              "document_id string, message_id string, content string"),
        allowMissingColumns=True)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        # Also where the stored rows lie together by the key.
        for rows_ in (stored, stored.repartition(16, "message_id")):
            merged = merge.raw_upsert(rows_, batch)
            assert merged.where("content = 'new'").count() == 10001
            sizes = merged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
            assert sizes.agg(F.max("n")).head()[0] < 7500
            assert merged.count() == 30000
    finally:
        for key in settings:
            spark.conf.unset(key)
