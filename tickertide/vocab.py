"""Word lists, patterns and names that decide the results."""

from dataclasses import dataclass

# -- fixed values: upper-case words that are never tickers --
NON_TICKER_WORDS = (
    "CEO", "USA", "USD", "CFO", "SEC", "IRS", "IPO", "ETF", "GDP", "FDA", "AI",
    "YOLO", "FOMO", "WSB", "PDT", "ROI", "IMO", "TLDR", "DD", "TOS", "CAD",
)

# -- fixed values: lower-case English stopwords --
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "he",
    "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will", "with",
    "i", "you", "your", "they", "this", "we", "but", "or", "not", "if", "so", "just", "my",
    "their", "what", "which", "who", "whom", "why", "how", "can", "should", "would",
)

# -- fixed values: trading vocabulary, whole words, any case --
BUY_TERMS = (
    "buy", "bought", "buying", "long", "calls", "bullish", "moon", "rocket",
    "going up", "to the moon", "undervalued", "cheap", "discount",
)
BUY_EMOJI = ("🚀", "💎", "🙌")
SELL_TERMS = (
    "sell", "selling", "sold", "short", "puts", "bearish", "crash", "dump", "tank",
    "dropping", "overvalued", "expensive", "bubble", "correction", "margin call",
)
HOLD_TERMS = (
    "hold", "holding", "hodl", "diamond hands", "patient", "patience", "long term", "longterm",
)
EARNINGS_TERMS = (
    "earnings", "revenue", "growth", "profit", "loss", "guidance", "forecast", "EPS", "P/E",
    "dividend",
)
NEWS_TERMS = (
    "news", "announcement", "released", "launched", "partnership", "acquisition", "merger",
    "FDA", "approval", "patent", "lawsuit",
)
TECHNICAL_TERMS = (
    "resistance", "support", "trend", "breakout", "pattern", "cup", "handle", "head",
    "shoulders", "triangle", "wedge", "channel", "RSI", "MACD", "oversold", "overbought",
)
OPTIONS_TERMS = (
    "option", "call", "put", "strike", "expiry", "contracts", "leaps", "covered", "naked",
    "straddle", "strangle", "iron condor", "spread",
)
TERM_GROUPS = (
    BUY_TERMS, SELL_TERMS, HOLD_TERMS, EARNINGS_TERMS, NEWS_TERMS, TECHNICAL_TERMS, OPTIONS_TERMS,
)

# -- fixed values: substring sentiment, positive is tested first --
POSITIVE_PARTS = ("bullish", "buy", "up")
NEGATIVE_PARTS = ("bearish", "sell", "down")

# -- fixed values: names in the data --
DELETED = "[deleted]"
POST, COMMENT, ARTICLE = "REDDIT_POST", "REDDIT_COMMENT", "CNBC_ARTICLE"
DEFAULT_SOURCE = "reddit"
FORUMS = ("wallstreetbets", "stocks", "investing", "stockmarket", "options")
INDEX_TICKERS = ("SPY", "QQQ", "DIA", "IWM", "VTI")
LISTING_SYMBOL_COLUMN = {"NASDAQ": "Symbol", "NYSE": "ACT Symbol"}
PRICE_COLUMNS = ("Open", "High", "Low", "Close", "Adj_Close", "Volume")
STEPS = (
    "extraction", "analysis", "stock_persistence",
    "daily_aggregation", "hourly_aggregation", "weekly_aggregation",
    "daily_persistence", "hourly_persistence", "weekly_persistence",
)



@dataclass(frozen=True)
class TextLimits:
    """How much of a text the text rules use; None is all of it."""

    max_tickers: int | None = None  # tickers kept per message, in order of occurrence
    max_chars: int | None = None  # characters searched for tickers
    matches: int | None = None  # matches shown in a context
    fallback: int | None = None  # characters shown when the ticker has no exact match
    head: int | None = None  # characters shown when the ticker is only inside other words
    scorer_chars: int | None = None  # characters given to the sentiment scorer
    stored_chars: int | None = None  # characters of context stored


WHOLE_TEXT = TextLimits()
# -- fixed values: limits that a run can ask for, and thresholds --
SHORT_TEXT = TextLimits(
    max_tickers=10, max_chars=2000, matches=3, fallback=500, head=200, scorer_chars=512, stored_chars=200
)
CONTEXT_WINDOW = 100      # characters kept on each side of a match
HIGH_CONFIDENCE = 0.7
TOP_CONTEXTS = 3
UNIVERSE_SIZE = 1000
MIN_FORUM_MESSAGES = 10

# -- fixed values: patterns --
TICKER_PATTERN = "^[A-Z]{1,5}$"
WORD_CHAR = r"[\p{L}\p{N}_]"
SPACE_CHAR = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
