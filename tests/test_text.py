"""The text rules at their edges and against plain statements of the rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions import scoring as S
from tickertide.functions import text as X

UNIVERSE = ["AAPL", "TSLA", "GME", "SPY", "F", "IT", "CEO", "ABC", "GG"]


def column(spark, texts, build):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


def random_texts(n, seed, alphabet):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


PIECES = [
    "AAPL", "aapl", "Tsla", "GME", "$", "5", "10.5", "%", " ", " ", ".", "+", "-", "7", "2024",
    "é", "ß", "_", "🚀", "٣", "a", "Z", " ", "\n", "buy", "moon", "hold", "P/E", "long term",
    "́", "0", ",", "12000", "0.5", "İ", "ſell", "K",
]


def pieces(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_tickers_edges(spark):
    texts = [
        "AAPL2 and $tsla, x$GME",      # a digit may follow; a dollar sign ends a word
        "AAPLX AAPLES xAAPL _AAPL éAAPL",  # part of other words
        "F is one letter; IT and CEO are words",
        "", None, "spy SPY Spy gme",
    ]
    assert column(spark, texts, lambda t: X.extract_tickers(t, UNIVERSE)) == [
        ["AAPL", "TSLA", "GME"], [], [], [], None, ["SPY", "GME"],
    ]


def test_ticker_limits(spark):
    names = ["AB" + chr(65 + i) for i in range(12)]
    many = " ".join(names)
    late = "x " * 1000 + "AAPL"
    edge = "x " * 998 + "AAPLE"  # the cut leaves AAPL
    assert column(spark, [many], lambda t: X.extract_tickers(t, names, 10)) == [names[:10]]
    assert column(spark, [many], lambda t: X.extract_tickers(t, names)) == [names]
    assert column(spark, [late, edge], lambda t: X.extract_tickers(t, UNIVERSE, 10, 2000)) == [[], ["AAPL"]]
    assert column(spark, [late], lambda t: X.extract_tickers(t, UNIVERSE)) == [["AAPL"]]


def test_tickers_property(spark):
    texts = pieces(1500, 1) + random_texts(1500, 2, "AbGME $é_5٣́.")
    got = column(spark, texts, lambda t: X.candidate_words(t, None))
    for text, words in zip(texts, got):
        runs = re.finditer(r"\w+", text)
        lead = (re.match(r"[A-Za-z]*", run.group()).group() for run in runs)
        assert words == [w.upper() for w in lead if 2 <= len(w) <= 5], text


def expected_price(text):
    percent = re.search(r"[+-]?[0-9]+(?:\.[0-9]+)?\s?%", text)
    taken = set(range(*percent.span())) if percent else set()
    numbers = re.finditer(r"\$?([0-9]+(?:\.[0-9]+)?)\$?", text)
    fitting = (
        float(m[1]) for m in numbers
        if taken.isdisjoint(range(*m.span())) and 1 <= float(m[1]) <= 10000
    )
    return next(fitting, None)


def test_price_and_change_property(spark):
    texts = pieces(2500, 3) + random_texts(2500, 4, "0123456789.%$ +-a🚀")
    changes = column(spark, texts, X.percent_change)
    prices = column(spark, texts, X.price_target)
    shown = column(spark, texts, lambda t: X.float_text(X.percent_change(t)))
    for text, change, price, label in zip(texts, changes, prices, shown):
        found = re.search(r"([+-]?[0-9]+(?:\.[0-9]+)?)\s?%", text)
        assert change == (float(found[1]) if found else None), text
        assert label == (str(float(found[1])) if found else None), text
        assert price == expected_price(text), text


def test_signal_examples(spark):
    texts = [
        "Let's test SPY to 50.12 just to see", "5% then 10%", "long term calls", "a🚀b", "a 🚀 b",
        "the P/E is high, EPS too", "iron condor", "supports", "puts", "margin call", "BUY buying",
        "10000 10000.5 0.99", "12345678.25%",
    ]
    assert column(spark, texts, X.extract_signals) == [
        ["PT:50.12"], ["CHANGE:5.0", "PT:10.0"], ["BUY", "HOLD"], ["BUY"], [],
        ["EARNINGS"], ["OPTIONS"], [], ["SELL"], ["SELL", "OPTIONS"], ["BUY"],
        ["PT:10000.0"], ["CHANGE:12345678.25"],
    ]


def test_signal_words_property(spark):
    texts = pieces(1500, 5)
    terms = V.BUY_TERMS
    got = column(spark, texts, lambda t: X.let(X.words_and_text(t), lambda p: X.has_term(p, terms)))
    sells = column(spark, texts, lambda t: X.let(X.words_and_text(t), lambda p: X.has_term(p, V.SELL_TERMS)))
    for text, buy, sell in zip(texts, got, sells):
        assert buy == any(re.search(rf"(?i)\b{re.escape(t)}\b", text) for t in terms), text
        assert sell == any(re.search(rf"(?i)\b{re.escape(t)}\b", text) for t in V.SELL_TERMS), text


def test_float_text(spark):
    values = [5.0, 250.5, 1e7, 123456789.125, 1e15, 1e16, 1.5e22, 0.001, 0.0005, 1e-4, 5e-5, 1.25e-7, -3.0, -1e8]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.t for r in rows.select("i", X.float_text(F.col("v")).alias("t")).orderBy("i").collect()]
    assert got == [repr(v) for v in values]


def expected_context(text, ticker, window, matches, head):
    if len(text) <= 3 * window:
        return text
    spots = list(re.finditer(rf"\b(?:{ticker}|\${ticker})\b", text))[:matches]
    if spots:
        return " ".join(text[max(0, m.start() - window):m.end() + window] for m in spots)
    return text[:head] if ticker in text else ""


@pytest.mark.parametrize("window", [3, 10])
def test_context_property(spark, window):
    rng = random.Random(window)
    parts = ["GG", "GG", "g", "$", "x$GG", "GGG", " ", "é", "🚀", "_", "-", "GG2", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(5, 40))) for _ in range(3000)]
    for matches, head in ((None, None), (3, 2 * window)):
        got = column(spark, texts, lambda t: X.ticker_context(t, F.lit("GG"), window, matches, head))
        for text, context in zip(texts, got):
            assert context == expected_context(text, "GG", window, matches, head), text


def test_long_texts(spark):
    """Texts of megabytes with matches everywhere end in seconds."""
    numbers = "20000 0.5 " * 200_000 + "1.2.5% 7 " + "3% " * 100_000
    digits = "9" * 200_000 + " 15"
    tickers = "GG 🚀 xGG " * 100_000 + "é$GG"
    assert column(spark, [numbers, digits], X.price_target) == [7.0, 15.0]
    assert column(spark, [numbers, digits], X.percent_change) == [2.5, None]
    got = column(spark, [tickers], lambda t: X.ticker_context(t, F.lit("GG"), 20))
    assert got == [expected_context(tickers, "GG", 20, None, None)]


@pytest.mark.parametrize("window", [1, 4])
def test_context_of_one_letter(spark, window):
    texts = ["".join(random.Random(i).choice(["F", "FF", "$F", " ", "x", "é", "🚀"]) for _ in range(25)) for i in range(500)]
    got = column(spark, texts, lambda t: X.ticker_context(t, F.lit("F"), window))
    assert got == [expected_context(t, "F", window, None, None) for t in texts]


def test_mention_context_fallback(spark):
    text = "aapl " + "word " * 200
    assert column(spark, [text], lambda t: X.mention_context(t, F.lit("AAPL"))) == [text]
    assert column(spark, [text], lambda t: X.mention_context(t, F.lit("AAPL"), V.SHORT_TEXT)) == [text[:500]]


def test_keyword_sentiment(spark):
    texts = ["support", "UP and down", "Sell", "sideways", None]
    assert column(spark, texts, X.keyword_sentiment) == [1, 1, -1, 0, 0]


def test_lexicon_scores(spark):
    texts = ["to the moon", "buy buy sell", "nothing", "moon, then to the moon; dump"]
    got = [(round(s.positive, 4), round(s.negative, 4), s.neutral) for s in column(spark, texts, S.text_scores)]
    assert got == [(1.0, 0.0, 0.0), (0.5, 0.5, 0.0), (0.0, 0.0, 1.0), (0.6667, 0.3333, 0.0)]


def test_confidence(spark):
    rows = spark.createDataFrame(
        [(1.0, 0.0), (0.5, None), (-0.5, -50.0), (0.0, 1e9), (1.0, float("nan")), (0.0, 1.0)],
        "c double, s double",
    )
    got = [r.v for r in rows.select(S.confidence(F.col("c"), F.col("s")).alias("v")).collect()]
    assert got == [0.7, 0.35, 0.47, 0.3, 0.7, 0.02]


def test_compound_from_top_label(spark):
    rows = spark.createDataFrame(
        [([("POSITIVE", 0.9), ("NEGATIVE", 0.1)],), ([("NEGATIVE", 0.8764), ("POSITIVE", 0.2)],),
         ([("NEUTRAL", 0.9), ("POSITIVE", 0.1)],), ([("POSITIVE", 0.0)],), ([],)],
        "l array<struct<label:string,score:double>>",
    )
    got = [r.v for r in rows.select(S.compound_from_top_label(F.col("l")).alias("v")).collect()]
    assert got == [0.9, -0.876, 0.0, 0.0, 0.0]


def test_few_gaps_give_the_same_context(spark, monkeypatch):
    """Windows that few gaps fill, and windows that only all gaps fill, as if all were joined."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(["AB", "AB ", "$AB", "é", "x ", "word " * rng.randint(1, 9)]) for _ in range(120)) for _ in range(60)]
    few = column(spark, texts, lambda t: X.ticker_context(t, F.lit("AB"), 30))
    monkeypatch.setattr(X, "FEW_GAPS", ())
    assert few == column(spark, texts, lambda t: X.ticker_context(t, F.lit("AB"), 30))


def test_words_of_mentions_are_looked_for_once(spark):
    """Sentiment and signals share them, as one column."""
    from tickertide.operators.mentions import find_mentions

    names = "message_id string, content string, title string, author string, created_at timestamp, subreddit string, url string, score bigint, message_type string"
    rows = find_mentions(spark.createDataFrame([("m1", "buy AAPL, buying calls, no buyer", None, None, None, None, None, 1, None)], names), ["AAPL"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(X._whole_words(tuple(t for group in V.TERM_GROUPS for t in group))) == 1
    assert [(r.sentiment_positive, r.signals) for r in rows.collect()] == [(1.0, ["BUY"])]


def test_words_that_begin_like_no_ticker_are_passed_over(spark):
    texts = ["Amd aMd, amazing AMAZE! am_d xamd am é amd 9am am9 brk ax"]
    got = column(spark, texts, lambda t: X.candidate_words(t, None, ["AM", "BR"]))
    every = column(spark, texts, lambda t: X.candidate_words(t, None))
    assert got == [[w for w in found if w[:2] in ("AM", "BR")] for found in every] and "AMAZE" in got[0]
    assert column(spark, texts, lambda t: X.candidate_words(t, None, [])) == [[]]
