"""SQL for the checks: shared table expressions, put together as needed."""

from __future__ import annotations

from tickertide import vocab as V
from tickertide.registry import derived

W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
PERCENT = rf"([+-]?[0-9]+(?:\.[0-9]+)?){SPACE}?%"
PRICE = r"\$?[0-9]+(?:\.[0-9]+)?\$?"
VALID = "content is not null and length(content) > 0 and content <> '[deleted]'"
FOLD = "lower(translate({0}, 'İıſ' || chr(8490), 'iisk'))"


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def term_found(folded: str, term: str) -> str:
    return rf"regexp_matches({folded}, '(?:^|{NOT_W}){term.lower()}(?:$|{NOT_W})')"


def any_term(folded: str, terms, emoji=()) -> str:
    body = "|".join(t.lower() for t in terms)
    found = rf"regexp_matches({folded}, '(?:^|{NOT_W})(?:{body})(?:$|{NOT_W})')"
    if emoji:
        found += rf" or regexp_matches({folded}, '{W}(?:{'|'.join(emoji)}){W}')"
    return f"({found})"


def count_terms(folded: str, terms, emoji=()) -> str:
    parts = [f"cast({term_found(folded, t)} as int)" for t in terms]
    parts += [rf"cast(regexp_matches({folded}, '{W}{e}{W}') as int)" for e in emoji]
    return "(" + " + ".join(parts) + ")"


def change(text: str) -> str:
    return f"cast(cast(nullif(regexp_extract({text}, '{PERCENT}', 1), '') as double) as varchar)"


def price_expr(text: str) -> str:
    """First number in 1..10000 outside the first percentage, with positions from the
    lengths of the gaps and numbers before it."""
    number = r"regexp_extract(ms[i], '[0-9]+(?:\.[0-9]+)?', 0)"
    return rf"""(
      select cast({number} as double) from (
        select ms, i, case when pct = '' then 0 else strpos({text}, pct) end as ps, length(pct) as pl,
          cast(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as bigint) + 1 as st
        from (select regexp_extract_all({text}, '{PRICE}') as ms, regexp_split_to_array({text}, '{PRICE}') as gaps,
          regexp_extract({text}, '{PERCENT}', 0) as pct), unnest(range(1, len(ms) + 1)) as u(i))
      where (ps = 0 or st + length(ms[i]) <= ps or st >= ps + pl)
        and cast({number} as double) between 1 and 10000
      order by i limit 1)"""


def signals(text: str) -> str:
    """Signals as one text with commas."""
    f = FOLD.format(text)
    tags = [
        ("BUY", any_term(f, V.BUY_TERMS, V.BUY_EMOJI)),
        ("SELL", any_term(f, V.SELL_TERMS)),
        ("HOLD", any_term(f, V.HOLD_TERMS)),
    ]
    topics = [
        ("EARNINGS", any_term(f, V.EARNINGS_TERMS)),
        ("NEWS", any_term(f, V.NEWS_TERMS)),
        ("TECHNICAL", any_term(f, V.TECHNICAL_TERMS)),
        ("OPTIONS", any_term(f, V.OPTIONS_TERMS)),
    ]

    def case(pairs):
        return [f"case when {cond} then '{tag}' end" for tag, cond in pairs]

    parts = [
        *case(tags),
        f"'CHANGE:' || {change(text)}",
        f"'PT:' || cast({price_expr(text)} as varchar)",
        *case(topics),
    ]
    return "concat_ws(',', " + ", ".join(parts) + ")"


def confidence(compound: str, score: str) -> str:
    return (
        f"cast(round(cast(0.7 * abs({compound}) + 0.3 * case when coalesce({score}, 0) = 0 then 0 "
        f"else least(1.0, ln(abs(cast({score} as double)) + 1) / 10) end as decimal(18,6)), 2) as double)"
    )


def context_parts(window: int, matches: int | None = None, pairs: str = "pairs") -> str:
    """For rows (key, text, ticker): text around the exact mentions, all or the first ones."""
    first = f"where rn <= {matches} " if matches else ""
    return f"""
      select key, string_agg(part, ' ' order by i) as windows from (
        select key, i, substr(text, greatest(st - dollar - {window}, 0) + 1,
            st + length(ticker) + {window} - greatest(st - dollar - {window}, 0)) as part,
          row_number() over (partition by key order by i) as rn
        from (
          select key, text, ticker, i,
            cast(list_sum(list_transform(pieces[1:i], lambda x: length(x))) as bigint) + (i - 1) * length(ticker) as st,
            case when pieces[i] = '' then case when i = 1 then '' else 'a' end else right(pieces[i], 1) end as prev,
            case when pieces[i + 1] = '' then case when i + 1 = len(pieces) then '' else 'a' end else left(pieces[i + 1], 1) end as nxt,
            case when right(pieces[i], 1) = '$' and ((length(pieces[i]) = 1 and i > 1)
              or regexp_matches(pieces[i], '{W}\\$$')) then 1 else 0 end as dollar
          from (select key, text, ticker, string_split(text, ticker) as pieces from {pairs}),
            unnest(range(1, len(pieces))) as u(i))
        where not regexp_matches(prev, '{W}') and not regexp_matches(nxt, '{W}'))
      {first}group by key"""


def text_ctes(limits: V.TextLimits, end: str = "") -> dict[str, str]:
    """The expressions from texts to mentions under some limits; their names get ``end``."""

    def head(text: str, n: int | None) -> str:
        return f"substr({text}, 1, {n})" if n else text

    f = FOLD.format(head("context", limits.scorer_chars))
    picked = f"where rn <= {limits.max_tickers}" if limits.max_tickers else ""
    return {
        f"words{end}": rf"""select message_id, i as pos,
        upper(regexp_extract(ws[i], '^([A-Za-z]{{2,5}})(?:[^A-Za-z]|$)', 1)) as w
      from (select message_id, regexp_extract_all({head('text', limits.max_chars)}, '{W}+') as ws from texts),
        unnest(range(1, len(ws) + 1)) as u(i)""",
        f"hits{end}": f"""select message_id, w as ticker, min(pos) as pos from words{end}
      where w <> '' and lower(w) not in ({_list(V.STOPWORDS)}) and w not in ({_list(V.NON_TICKER_WORDS)})
        and w in (select ticker from universe) group by 1, 2""",
        f"picked{end}": f"""select message_id, ticker from (select *, row_number() over (partition by message_id order by pos) as rn
      from hits{end}) {picked}""",
        f"pairs{end}": f"""select coalesce(p.message_id, '') || '/' || p.ticker as key, p.message_id, p.ticker, t.text from picked{end} p join texts t
      on p.message_id is not distinct from t.message_id""",
        f"windows{end}": context_parts(V.CONTEXT_WINDOW, limits.matches, f"pairs{end}"),
        f"contexts{end}": f"""select p.message_id, p.ticker, p.text, w.windows,
        case when length(text) <= {3 * V.CONTEXT_WINDOW} then text
          when windows is not null then windows
          when strpos(text, ticker) > 0 then {head('text', limits.head)}
          else '' end as found
      from pairs{end} p left join windows{end} w on p.key = w.key""",
        f"chosen{end}": f"""select message_id, ticker, case when found <> '' then found
      else {head('text', limits.fallback)} end as context from contexts{end}""",
        f"scored{end}": f"""select *, case when b + s > 0 then b / (b + s) else 0.0 end as pos,
        case when b + s > 0 then s / (b + s) else 0.0 end as neg,
        cast(case when b + s > 0 then 0 else 1 end as double) as neu from (
      select *, cast({_BUYS} as double) as b, cast({_SELLS} as double) as s from (
        select *, {f} as folded from chosen{end}))""",
        f"mentions{end}": f"""select s.message_id, s.ticker, t.author, t.created_at, t.subreddit, t.url,
        coalesce(t.score, 0) as score, t.message_type, compound as sentiment_compound,
        pos as sentiment_positive, neg as sentiment_negative, neu as sentiment_neutral,
        {signals('s.context')} as signals, {head('s.context', limits.stored_chars)} as context,
        {confidence('compound', 't.score')} as confidence
      from (select *, cast(round(cast(pos - neg as decimal(18,6)), 3) as double) as compound from scored{end}) s
      join texts t on s.message_id = t.message_id""",
    }


_BUYS = count_terms("folded", V.BUY_TERMS, V.BUY_EMOJI)
_SELLS = count_terms("folded", V.SELL_TERMS)

CTES = {
    "raw": derived.RAW_MESSAGES_SQL,
    "ohlcv": derived.OHLCV_SQL,
    "listing": derived.LISTING_SQL,
    "listed": """select symbol as ticker, exchange, trim(security_name) as company_name
      from listing where test_issue = 'N'""",
    "deduped": """select * exclude (rn) from (select *, row_number() over (
        partition by message_id order by ingestion_timestamp desc, event_id desc) as rn from raw)
      where rn = 1""",
    "clean": f"""select * exclude (rn) from (select *, row_number() over (
        partition by message_id order by created_at desc, "timestamp" desc, event_id desc) as rn
      from raw where {VALID}) where rn = 1""",
    "texts": rf"""select * from (select *, case when length(title) > 0 then title || ' ' || content
        else content end as text from clean) where regexp_matches(text, '[^\t-\r\x1c-\x1f \x{{85}}\p{{Z}}]')""",
    "universe": f"""select ticker from (select ticker, avg(volume) as v from ohlcv group by 1
        order by v desc, ticker limit {V.UNIVERSE_SIZE}) where regexp_full_match(ticker, '[A-Z]{{1,5}}')""",
    **text_ctes(V.WHOLE_TEXT),
    **text_ctes(V.SHORT_TEXT, "_short"),
}
_NEEDS = {
    "deduped": ["raw"], "clean": ["raw"], "texts": ["clean"], "universe": ["ohlcv"],
    "listed": ["listing"],
}
for _end in ("", "_short"):
    _NEEDS |= {
        f"words{_end}": ["texts"], f"hits{_end}": [f"words{_end}", "universe"], f"picked{_end}": [f"hits{_end}"],
        f"pairs{_end}": [f"picked{_end}", "texts"], f"windows{_end}": [f"pairs{_end}"],
        f"contexts{_end}": [f"pairs{_end}", f"windows{_end}"], f"chosen{_end}": [f"contexts{_end}"],
        f"scored{_end}": [f"chosen{_end}"], f"mentions{_end}": [f"scored{_end}", "texts"],
    }
# Expressions read more than once.
_KEPT = {"raw", "clean", "texts", "universe", *(f"{n}{e}" for n in ("pairs", "mentions", "words") for e in ("", "_short"))}


def _closure(names) -> set[str]:
    found: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += _NEEDS.get(name, [])
    return found


def select(tail: str, *names: str, more: str = "") -> str:
    """A query over the named table expressions; ``more`` adds others after them."""
    used = _closure(names)
    parts = [
        f"{n} as {'materialized ' if n in _KEPT else ''}({text})" for n, text in CTES.items() if n in used
    ]
    if more:
        parts.append(more)
    return "with " + ",\n".join(parts) + "\n" + tail
