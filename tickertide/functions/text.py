"""Text rules as Column functions: tickers, context, signals, price and percent.

Word boundaries are written out with ``WORD_CHAR`` rather than ``\\b``/``\\w`` so that
the result does not depend on the Java version.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickertide import vocab as V

_NOT_AFTER_WORD = f"(?<!{V.WORD_CHAR})"
_NOT_BEFORE_WORD = f"(?!{V.WORD_CHAR})"
_TICKER_WORD = f"{_NOT_AFTER_WORD}([A-Za-z]{{2,5}}+)(?![A-Za-z])"
# A run of digits is tried from its beginning only, so that long runs cost no more than others.
_PERCENT = rf"([+-]?(?<![0-9])[0-9]++(?:\.[0-9]++)?){V.SPACE_CHAR}?%"
_PERCENT_START = rf"([+-]?(?<![0-9])[0-9])[0-9]*+(?:\.[0-9]++)?{V.SPACE_CHAR}?%"
_PRICE = r"\$?[0-9]+(?:\.[0-9]+)?\$?"
_NUMBER = r"[0-9]+(?:\.[0-9]+)?"
# Gaps beside a mention that are joined first.
FEW_GAPS = (3, 12)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row however often it is used."""
    return F.transform(F.array(value), body)[0]


def fold_case(text: Column) -> Column:
    """Lower case, with the four non-ASCII letters that equal i, k or s in any-case search."""
    letters = "\u0130\u0131\u017f\u212a"
    special = F.lit(False)
    for letter in letters:
        special = special | text.contains(letter)
    # translate reads letter by letter, so it is kept to the few texts that need it.
    return F.lower(F.when(special, F.translate(text, letters, "iisk")).otherwise(text))


def _single(terms: Iterable[str]) -> Column:
    return F.array(*[F.lit(t.lower()) for t in terms if t.isalpha()])


@cache
def _whole_words(terms: tuple[str, ...]) -> str:
    """A pattern of the terms that are one word, in lower case, where no word character touches them."""
    single = sorted({t.lower() for t in terms if t.isalpha()})
    return f"{_begins(single)}{_NOT_AFTER_WORD}{_one_of(single)}{_NOT_BEFORE_WORD}"


def _begins(words: Iterable[str]) -> str:
    """A look ahead at the first two letters of the words, so that other places cost little."""
    words = tuple(words)
    second = "".join(sorted({w[1] for w in words if len(w) > 1}))
    if not words or any(len(w) < 2 for w in words):
        return ""
    return f"(?=[{''.join(sorted({w[0] for w in words}))}][{second}])"


def words_and_text(text: Column) -> Column:
    """Struct of the folded text and the trading terms among its whole words, repeated as there."""
    terms = tuple(t for group in V.TERM_GROUPS for t in group)
    return let(
        fold_case(text),
        lambda t: F.struct(
            t.alias("text"),
            F.regexp_extract_all(t, F.lit(_whole_words(terms)), F.lit(0)).alias("words"),
        ),
    )


def _phrase_found(folded: Column, phrase: str) -> Column:
    # The regex runs only where the plain substring occurs.
    phrase = phrase.lower()
    return folded.contains(phrase) & folded.rlike(f"{_NOT_AFTER_WORD}{phrase}{_NOT_BEFORE_WORD}")


def _emoji_found(folded: Column, emoji: str) -> Column:
    # An emoji is no word character, so its word boundaries need word characters around it.
    return folded.contains(emoji) & folded.rlike(f"(?<={V.WORD_CHAR}){emoji}(?={V.WORD_CHAR})")


def _rare_terms(folded: Column, terms: Iterable[str], emoji: Iterable[str] = ()) -> list[Column]:
    phrases = [_phrase_found(folded, t) for t in terms if not t.isalpha()]
    return phrases + [_emoji_found(folded, e) for e in emoji]


def has_term(parts: Column, terms: Iterable[str], emoji: Iterable[str] = ()) -> Column:
    """True if one of the terms, all from ``vocab``, is in ``words_and_text``."""
    terms = tuple(terms)
    found = F.arrays_overlap(parts["words"], _single(terms))
    for rare in _rare_terms(parts["text"], terms, emoji):
        found = found | rare
    return found


def count_terms(parts: Column, terms: Iterable[str], emoji: Iterable[str] = ()) -> Column:
    """Number of the terms that occur as whole words."""
    terms = tuple(terms)
    number = F.size(F.array_intersect(parts["words"], _single(terms)))
    for rare in _rare_terms(parts["text"], terms, emoji):
        number = number + rare.cast("int")
    return number


def has_visible_text(text: Column) -> Column:
    """True unless the text is null, empty or white space."""
    return F.coalesce(text.rlike(V.SPACE_CHAR.replace("[", "[^", 1)), F.lit(False))


def full_text(title: Column, content: Column) -> Column:
    """Title and content of a post, content alone without a title."""
    return F.when(F.length(title) > 0, F.concat(title, F.lit(" "), content)).otherwise(content)


def candidate_words(text: Column, max_chars: int | None = None, begins: Iterable[str] | None = None) -> Column:
    """Upper-cased words of 2-5 letters in text order, of the whole text or its beginning.

    ``begins`` are the first two letters, upper case, that the words may have; any without."""
    searched = F.substring(text, 1, max_chars) if max_chars else text
    words = F.regexp_extract_all(searched, F.lit(f"{_one_of_pairs(begins)}{_TICKER_WORD}"), F.lit(1))
    return F.transform(words, F.upper)


def _one_of_pairs(pairs: Iterable[str] | None) -> str:
    """Looks ahead at the first two letters in any case: at each of them, then at both where a
    word begins. The alphabet bounds their length."""
    if pairs is None:
        return ""
    seconds: dict[str, list[str]] = {}
    pairs = sorted(set(pairs))
    for pair in pairs:
        seconds.setdefault(pair[0], []).append(f"{pair[1]}{pair[1].lower()}")
    parts = [f"[{first}{first.lower()}][{''.join(rest)}]" for first, rest in seconds.items()]
    either = _begins([*pairs, *[pair.lower() for pair in pairs]])
    return f"{either}{_NOT_AFTER_WORD}(?={'|'.join(parts)})" if parts else "(?!)"


def excluded_words() -> list[str]:
    """Stopwords and non-ticker words, upper case."""
    return sorted({w.upper() for w in V.STOPWORDS} | set(V.NON_TICKER_WORDS))


def extract_tickers(
    text: Column,
    universe: Iterable[str],
    max_tickers: int | None = None,
    max_chars: int | None = None,
) -> Column:
    """Distinct tickers of ``universe`` in first-occurrence order.

    ``universe`` is a short list of symbols; for one of unknown size use
    ``operators.mentions.find_mentions``, which can join instead.
    """
    allowed = sorted({t for t in universe if re.fullmatch("[A-Z]{2,5}", t)} - set(excluded_words()))
    searched = F.substring(text, 1, max_chars) if max_chars else text
    # Only the tickers leave the search, not every word of the text.
    begins = _begins([*allowed, *[t.lower() for t in allowed]])
    pattern = f"{begins}{_NOT_AFTER_WORD}((?i:{_one_of(allowed)}))(?![A-Za-z])" if allowed else "(?!)()"
    words = F.regexp_extract_all(searched, F.lit(pattern), F.lit(1))
    found = F.array_distinct(F.transform(words, F.upper))
    return F.slice(found, 1, max_tickers) if max_tickers else found


def _one_of(words: Iterable[str]) -> str:
    """A pattern of the words that tries each letter once, however many words begin with it."""
    rests: dict[str, list[str]] = {}
    for word in words:
        rests.setdefault(word[:1], []).append(word[1:])
    parts = [first + _one_of(rest) for first, rest in rests.items() if first]
    if not parts:
        return ""
    body = parts[0] if len(parts) == 1 and "" not in rests else f"(?:{'|'.join(parts)})"
    return f"{body}?" if "" in rests else body


def ticker_context(
    text: Column,
    ticker: Column,
    window: int = V.CONTEXT_WINDOW,
    matches: int | None = None,
    head: int | None = None,
    otherwise: Column | None = None,
) -> Column:
    """Text around the exact mentions of ``ticker``, of all or of the first ``matches``.

    Short texts are their own context. A text that holds the ticker only inside other
    words gives itself or its first ``head`` characters, one that does not hold it gives
    ``otherwise`` or nothing.

    The text is cut at the plain ticker; a cut is a mention if no word character touches
    it. Only the ends of the gaps next to a mention are put together again, so no position
    is counted and the time grows with the text, not with its square. A few gaps fill the
    window as a rule; where they do not, all that can lie in it are joined.
    """
    reach = max(window + 1, 2)  # with a dollar sign in front
    # No more gaps than these lie within the window.
    near = (F.lit(window) / F.greatest(F.length(ticker), F.lit(1))).cast("int") + 2

    def joined(gaps: Callable[[Column], Column], steps: tuple[int, ...]) -> Column:
        if not steps:
            return F.call_function("array_join", gaps(near), ticker)
        few = F.call_function("array_join", gaps(F.least(F.lit(steps[0]), near)), ticker)
        return let(few, lambda t: F.when(F.length(t) > window, t).otherwise(joined(gaps, steps[1:])))

    def around(ends: Column) -> Column:
        starts, tails = ends["starts"], ends["tails"]
        last = F.size(tails) - 1

        def spot(tail: Column, i: Column) -> Column:
            after = F.get(starts, i + 1)
            # An empty gap inside the text stands between two tickers, so it is a word's.
            left = F.when(tail == "", i > 0).otherwise(F.right(tail, F.lit(1)).rlike(V.WORD_CHAR))
            right = F.when(after == "", i + 1 < last).otherwise(F.left(after, F.lit(1)).rlike(V.WORD_CHAR))
            return F.when((i < last) & ~left & ~right, i)

        def part(i: Column) -> Column:
            tail = F.get(tails, i)
            # "x$ABC": a dollar sign after a word character belongs to the mention.
            dollar = tail.rlike(rf"{V.WORD_CHAR}\$\z") | ((tail == "$") & (i > 0))

            def gaps_before(n: Column) -> Column:
                first = F.greatest(i + 2 - n, F.lit(1))
                return F.slice(tails, first, i + 2 - first)

            before = joined(gaps_before, FEW_GAPS)
            behind = joined(lambda n: F.slice(starts, i + 2, n), FEW_GAPS)
            return F.concat(
                F.right(before, window + dollar.cast("int")), ticker, F.left(behind, F.lit(window))
            )

        spots = F.array_compact(F.transform(tails, spot))
        parts = F.transform(F.slice(spots, 1, matches) if matches else spots, part)
        return F.when(F.size(parts) > 0, F.array_join(parts, " "))

    gaps = F.split(text, F.concat(F.lit(r"\Q"), ticker, F.lit(r"\E")))
    ends = let(gaps, lambda g: F.struct(
        F.transform(g, lambda gap: F.left(gap, F.lit(window + 1))).alias("starts"),
        F.transform(g, lambda gap: F.right(gap, F.lit(reach))).alias("tails"),
    ))
    return F.when(F.length(text) <= 3 * window, text).otherwise(
        F.coalesce(
            F.when(text.contains(ticker), let(ends, around)),
            F.when(text.contains(ticker), F.substring(text, 1, head) if head else text),
            F.lit("") if otherwise is None else otherwise,
        )
    )


def mention_context(
    text: Column, ticker: Column, limits: V.TextLimits = V.WHOLE_TEXT, window: int = V.CONTEXT_WINDOW
) -> Column:
    """``ticker_context``, or the text or its beginning where that is empty."""
    otherwise = F.substring(text, 1, limits.fallback) if limits.fallback else text
    return ticker_context(text, ticker, window, limits.matches, limits.head, otherwise)


def percent_change(text: Column) -> Column:
    """First percentage in the text as a double, null if none."""
    return F.regexp_extract(text, _PERCENT, 1).try_cast("double")


def price_target(text: Column) -> Column:
    """First number in 1..10000 that does not touch the first percentage.

    The text is cut at that percentage. Its first digit is left to the part before it, where
    it is the last number, or the end of one that runs into the percentage: either is dropped.
    """

    def prices(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(_PRICE), F.lit(0))

    def beside(parts: Column) -> Column:
        before = prices(F.concat(parts[0], F.regexp_extract(text, _PERCENT_START, 1)))
        apart = F.concat(
            let(before, lambda found: F.slice(found, 1, F.size(found) - 1)), prices(F.get(parts, F.lit(1)))
        )
        return F.when(F.size(parts) > 1, apart).otherwise(prices(text))

    found = F.when(text.contains("%"), let(F.split(text, F.lit(_PERCENT), 2), beside)).otherwise(prices(text))
    values = F.transform(found, lambda p: F.regexp_extract(p, _NUMBER, 0).cast("double"))
    return F.get(F.filter(values, lambda v: v.between(1, 10000)), F.lit(0))


def float_text(value: Column) -> Column:
    """Shortest decimal text: plain digits from 1e-4 up to 1e16, exponent form outside."""

    def spelled(text: Column) -> Column:
        size = F.abs(text.cast("double"))
        plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", "")
        plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
        mantissa = F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
        power = F.regexp_extract(text, r"E-?([0-9]+)$", 1)
        power = F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power)
        sign = F.when(text.contains("E-"), "e-").otherwise("e+")
        return (
            F.when(~text.contains("E"), text)
            .when((size >= 1e-4) & (size < 1e16), plain)
            .otherwise(F.concat(mantissa, sign, power))
        )

    return let(value.cast("string"), spelled)


def extract_signals(text: Column, parts: Column | None = None) -> Column:
    """Ordered tags BUY SELL HOLD CHANGE:v PT:v EARNINGS NEWS TECHNICAL OPTIONS.

    ``parts`` is ``words_and_text(text)`` where that is known.
    """

    def tags(parts: Column) -> Column:
        def tag(name: str, terms: Iterable[str], emoji: Iterable[str] = ()) -> Column:
            return F.when(has_term(parts, terms, emoji), F.lit(name))

        return F.array(
            tag("BUY", V.BUY_TERMS, V.BUY_EMOJI),
            tag("SELL", V.SELL_TERMS),
            tag("HOLD", V.HOLD_TERMS),
            F.when(text.contains("%"), F.concat(F.lit("CHANGE:"), float_text(percent_change(text)))),
            F.concat(F.lit("PT:"), float_text(price_target(text))),
            tag("EARNINGS", V.EARNINGS_TERMS),
            tag("NEWS", V.NEWS_TERMS),
            tag("TECHNICAL", V.TECHNICAL_TERMS),
            tag("OPTIONS", V.OPTIONS_TERMS),
        )

    return F.array_compact(let(words_and_text(text) if parts is None else parts, tags))


def signal_prices(signals: Column) -> Column:
    """Texts of the prices in all ``PT:`` tags."""
    return F.transform(F.filter(signals, lambda s: s.startswith("PT:")), lambda s: F.substr(s, F.lit(4)))


def lexicon_hits(text: Column, parts: Column | None = None) -> Column:
    """Struct (buys, sells): numbers of distinct buy and sell terms in the text.

    ``parts`` is ``words_and_text(text)`` where that is known.
    """
    return let(
        words_and_text(text) if parts is None else parts,
        lambda parts: F.struct(
            count_terms(parts, V.BUY_TERMS, V.BUY_EMOJI).alias("buys"),
            count_terms(parts, V.SELL_TERMS).alias("sells"),
        ),
    )


def keyword_sentiment(text: Column) -> Column:
    """+1, -1 or 0 by substring in any case; positive parts win."""

    def any_of(parts: Iterable[str]) -> Column:
        return text.rlike("(?i)" + "|".join(parts))

    return F.when(any_of(V.POSITIVE_PARTS), 1).when(any_of(V.NEGATIVE_PARTS), -1).otherwise(0)
