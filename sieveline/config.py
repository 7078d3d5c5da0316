"""Per-source rules and the fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

# --- Fixed values -----------------------------------------------------------
# Failure codes.
SCHEMA_MISSING_FIELD = "SCHEMA_MISSING_FIELD"
SCHEMA_WRONG_TYPE = "SCHEMA_WRONG_TYPE"
RANGE_VIOLATION = "RANGE_VIOLATION"
STALE = "STALE"
DUPLICATE = "DUPLICATE"

# Weight of each failure code in the daily trust score (a clean record weighs 0,
# the heaviest failure 2).
SEVERITY = {
    SCHEMA_MISSING_FIELD: 2.0,
    SCHEMA_WRONG_TYPE: 2.0,
    RANGE_VIOLATION: 1.5,
    STALE: 1.0,
    DUPLICATE: 0.5,
}
WORST_SEVERITY = 2.0

# A source whose day falls below this is blocked.
BREAKER_THRESHOLD = 0.85

SENTIMENTS = ("bullish", "bearish", "neutral")
RESPONSE_FIELDS = ("sentiment", "confidence", "tickers_mentioned", "topic_tags", "market_implication")

EXCHANGE_SUFFIX = ".NS"

# Symbols with enrichment, and their display names.
SYMBOL_NAMES = {
    "RELIANCE.NS": "Reliance Industries",
    "TCS.NS": "Tata Consultancy Services",
    "HDFCBANK.NS": "HDFC Bank",
    "INFY.NS": "Infosys",
    "ICICIBANK.NS": "ICICI Bank",
    "HINDUNILVR.NS": "Hindustan Unilever",
    "SBIN.NS": "State Bank of India",
    "BAJFINANCE.NS": "Bajaj Finance",
    "WIPRO.NS": "Wipro",
    "ADANIENT.NS": "Adani Enterprises",
}

# Words that make a press release relevant to the macro picture.
MACRO_KEYWORDS = (
    "repo rate", "monetary policy", "inflation", "cpi", "gdp",
    "money supply", "reserve money", "mpc", "interest rate",
    "foreign exchange", "forex", "current account", "rupee",
)

# Where a press release is read, and how its identifier stands in a link.
RELEASE_URL = "https://www.rbi.org.in/Scripts/BS_PressReleaseDisplay.aspx?prid="
RELEASE_ID = r"prid=(\d+)"

# Words a news query asks for.
NEWS_TERMS = ("Nifty", "Sensex", "NSE", "BSE", "RBI")

# Exchange session, local time.
SESSION_ZONE = "Asia/Kolkata"
SESSION_OPEN = (9, 15)
SESSION_CLOSE = (15, 30)

# Anomaly detection.
ANOMALY_DEVIATIONS = 2.0
ANOMALY_MIN_HISTORY = 5

# Text cuts that are part of the operators.
DESCRIPTION_CUT = 600
RAW_RECORD_CUT = 800
SNIPPET_CUT = 500
# --- End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class SourceRules:
    """What a record of one source must satisfy.

    ``required`` fields are present and not null; ``prices`` are above zero;
    ``volume`` is not negative; ``texts`` are not blank; ``numbers`` hold numbers;
    ``time_field`` is at most ``max_age`` old and ``max_ahead`` in the future.
    """

    source: str
    required: tuple[str, ...]
    key: tuple[str, ...]
    time_field: str
    max_age: timedelta
    max_ahead: timedelta = timedelta(minutes=5)
    date_only: bool = False
    prices: tuple[str, ...] = ()
    volume: str | None = None
    texts: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    max_move_pct: float | None = None


_OHLC = ("open", "high", "low", "close")

RULES: dict[str, SourceRules] = {
    "stocks": SourceRules(
        source="stocks",
        required=("ticker", "date", *_OHLC, "volume"),
        key=("ticker", "date"),
        time_field="date",
        max_age=timedelta(days=3),
        date_only=True,
        prices=_OHLC,
        volume="volume",
    ),
    "news": SourceRules(
        source="news",
        required=("article_id", "title", "url", "published_at"),
        key=("article_id",),
        time_field="published_at",
        max_age=timedelta(hours=48),
        texts=("title",),
    ),
    "macro": SourceRules(
        source="macro",
        required=("release_id", "title", "url", "scraped_at"),
        key=("release_id",),
        time_field="scraped_at",
        max_age=timedelta(days=7),
        texts=("title",),
    ),
    "reddit": SourceRules(
        source="reddit",
        required=("post_id", "subreddit", "title", "score", "created_utc"),
        key=("post_id",),
        time_field="created_utc",
        max_age=timedelta(hours=12),
        numbers=("score",),
    ),
    "ticks": SourceRules(
        source="ticks",
        required=("ticker", "timestamp", *_OHLC, "volume"),
        key=("event_id",),
        time_field="timestamp",
        max_age=timedelta(minutes=20),
        max_ahead=timedelta(minutes=2),
        prices=_OHLC,
        volume="volume",
        max_move_pct=20.0,
    ),
}
