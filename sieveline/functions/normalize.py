"""Received records brought to the common shape of their source."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sieveline import config as C
from sieveline.functions.text import strip, symbol_clean
from sieveline.operators.dedupe import dedupe_first, latest_per_key

log = logging.getLogger(__name__)

PRICES = ("open", "high", "low", "close")


def received(df: DataFrame, at: Column | None) -> DataFrame:
    """Add the time of receipt where one is given."""
    return df if at is None else df.withColumn("ingested_at", at)


def normalize_bars(
    bars: DataFrame, source: str = "yfinance", exchange: str = "NSE", ingested_at: Column | None = None
) -> DataFrame:
    """Prices to two decimals, whole volume, date as text, constant origin.

    A price or volume that is no number becomes null and is left to the gate.
    """
    normal = bars.select(
        "ticker",
        symbol_clean(F.col("ticker")).alias("ticker_clean"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[F.round(F.col(p).try_cast("double"), 2).alias(p) for p in PRICES],
        F.col("volume").try_cast("bigint").alias("volume"),
        F.lit(source).alias("source"),
        F.lit(exchange).alias("exchange"),
    )
    return received(normal, ingested_at)


def lookback(df: DataFrame, day: Column, days: int = 5, field: str = "date") -> DataFrame:
    """Rows of the half-open window [day - days, day)."""
    return df.filter((F.col(field) >= F.date_sub(day, days)) & (F.col(field) < day))


def url_hash_id(url: Column) -> Column:
    """Stable article identifier."""
    return F.md5(url)


def normalize_articles(articles: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Nested camel-case articles to flat rows keyed by the hash of their address."""
    flat = articles.select(
        url_hash_id(F.col("url")).alias("article_id"),
        "title",
        "description",
        "url",
        F.col("publishedAt").alias("published_at"),
        F.col("source.name").alias("source_name"),
    )
    return received(flat, ingested_at)


def any_word(text: Column, terms: Iterable[str]) -> Column:
    """True where the text holds any of the terms as a whole word, case ignored."""
    return text.rlike(r"(?i)\b(" + "|".join(re.escape(t) for t in terms) + r")\b")


def recent_matching(
    df: DataFrame,
    since: Column,
    terms: Iterable[str] = C.NEWS_TERMS,
    language: str = "en",
    n: int = 50,
    text: str = "text",
    at: str = "published_at",
    tie: str = "article_id",
) -> DataFrame:
    """The ``n`` newest rows in one language, at or after ``since``, that match a term."""
    return (
        df.filter((F.col("lang") == language) & (F.col(at) >= since) & any_word(F.col(text), terms))
        .orderBy(F.col(at).desc(), F.col(tie))
        .limit(n)
    )


# Named character references of running text; the ampersand comes last.
_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0", "&ndash;": "\u2013", "&mdash;": "\u2014",
    "&lsquo;": "\u2018", "&rsquo;": "\u2019", "&ldquo;": "\u201c", "&rdquo;": "\u201d", "&hellip;": "\u2026",
    "&euro;": "\u20ac", "&pound;": "\u00a3", "&copy;": "\u00a9", "&reg;": "\u00ae", "&amp;": "&",
}
# The attribute itself: after white space or another value, quoted either way or bare.
HREF = r"""(?is)^<a(?=[\s])[^>]*?(?<=[\s"'])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def _present(value: Column) -> Column:
    return F.when(value != "", value)


def _numbered(text: Column) -> Column:
    """Numeric character references, decimal and hexadecimal, of the basic plane; others stay as they are."""

    def shown(piece: Column, at: Column) -> Column:
        decimal = F.regexp_extract(piece, r"^(\d{1,5});", 1)
        hexed = F.regexp_extract(piece, r"^[xX]([0-9A-Fa-f]{1,4});", 1)
        code = F.when(decimal != "", decimal.try_cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
        good = code.between(1, 0xD7FF) | code.between(0xE000, 0xFFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        rest = F.regexp_replace(piece, r"^[^;]*;", "")
        return F.when(at == 0, piece).when(good, F.concat(character, rest)).otherwise(F.concat(F.lit("&#"), piece))

    return F.when(text.contains("&#"), F.array_join(F.transform(F.split(text, "&#"), shown), "")).otherwise(text)


def _anchor_text(anchor: Column) -> Column:
    """Text of an anchor: tags dropped, white space around each piece removed."""
    text = strip(F.regexp_replace(anchor, r"\s*<[^>]*>\s*", ""))
    text = _numbered(text)
    for entity, character in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def extract_links(
    pages: DataFrame,
    id_pattern: str = C.RELEASE_ID,
    url_prefix: str = C.RELEASE_URL,
    html: str = "html",
) -> DataFrame:
    """Links whose address carries an identifier: pos, release_id, title, url.

    The page is scanned once for whole anchors; address and text are then taken from
    each short anchor. Other columns of ``pages`` are kept, the page text is not.
    """
    kept = [c for c in pages.columns if c not in (html, "url")]
    anchors = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\s[^>]*>.*?</a>"), F.lit(0))
    links = pages.select(*kept, F.posexplode(anchors).alias("pos", "_anchor"))
    href = F.coalesce(*[_present(F.regexp_extract("_anchor", HREF, group)) for group in (1, 2, 3)], F.lit(""))
    return (
        links.withColumn("release_id", F.regexp_extract(href, id_pattern, 1))
        .filter(F.col("release_id") != "")
        .select(
            *kept,
            "pos",
            "release_id",
            _anchor_text(F.col("_anchor")).alias("title"),
            F.concat(F.lit(url_prefix), F.col("release_id")).alias("url"),
        )
    )


def mentions_keyword(title: Column, keywords: Iterable[str] = C.MACRO_KEYWORDS) -> Column:
    """True where the lower-cased title holds any keyword as a substring."""
    lowered = F.lower(title)
    hit = F.lit(False)
    for word in keywords:
        hit = hit | lowered.contains(word)
    return hit


def long_enough(title: Column, minimum: int = 10) -> Column:
    return F.coalesce(F.length(title) >= minimum, F.lit(False))


def press_releases(pages: DataFrame, scraped_at: Column, order: Iterable[str] = ("page_id", "pos")) -> DataFrame:
    """Relevant releases linked from pages, the first link to each in document order."""
    links = extract_links(pages).filter(long_enough(F.col("title")) & mentions_keyword(F.col("title")))
    return dedupe_first(links, ["release_id"], list(order)).select(
        "release_id", "title", "url", scraped_at.alias("scraped_at"), F.lit("rbi_press_releases").alias("source")
    )


def normalize_posts(
    listings: DataFrame, channel: Column, ingested_at: Column | None = None, cut: int = C.SNIPPET_CUT
) -> DataFrame:
    """Listing pages (``data.children[].data``) to one row per post, pinned posts left out.

    ``body_snippet`` holds the first ``cut`` characters of a post, as the model asks for.
    """
    posts = listings.select(channel.alias("subreddit"), F.explode("data.children").alias("child"))
    post = lambda name: F.col(f"child.data.{name}")
    flat = posts.filter(~F.coalesce(post("stickied"), F.lit(False))).select(
        post("id").alias("post_id"),
        "subreddit",
        post("title").alias("title"),
        F.coalesce(post("score"), F.lit(0)).try_cast("int").alias("score"),
        F.coalesce(post("num_comments"), F.lit(0)).try_cast("int").alias("num_comments"),
        post("upvote_ratio").cast("double").alias("upvote_ratio"),
        epoch_to_utc(post("created_utc")).alias("created_utc"),
        F.substring(F.coalesce(post("selftext"), F.lit("")), 1, cut).alias("body_snippet"),
    )
    return received(flat, ingested_at)


def epoch_to_utc(seconds: Column) -> Column:
    return F.timestamp_seconds(F.coalesce(seconds, F.lit(0)))


def union_channels(channels: Mapping[str, Callable[[], DataFrame]], column: str = "channel") -> DataFrame:
    """All channels in one table; one that cannot be read is logged and left out."""
    frames = []
    for name, load in channels.items():
        try:
            frames.append(load().withColumn(column, F.lit(name)))
        except Exception as error:  # any failure of one channel must not stop the rest
            log.warning("channel %s left out: %s", name, error)
    if not frames:
        raise ValueError("no channel could be read")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def tick_events(
    bars: DataFrame, poll_id: str | Column, polled_at: Column, source: str = "intraday_delayed"
) -> DataFrame:
    """One event per symbol from its latest bar; all events of a poll share ``poll_id``.

    ``bars`` has ticker, timestamp and prices; the event identifier is a content hash.
    """
    poll = poll_id if isinstance(poll_id, Column) else F.lit(poll_id)
    latest = latest_per_key(bars, ["ticker"], ["timestamp", "volume", *reversed(PRICES)])
    return latest.select(
        F.sha2(F.concat_ws("|", poll, "ticker"), 256).alias("event_id"),
        poll.alias("poll_id"),
        "ticker",
        F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        F.date_format(polled_at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("polled_at"),
        *[F.round(F.col(p).try_cast("double"), 2).alias(p) for p in PRICES],
        F.col("volume").try_cast("bigint").alias("volume"),
        F.lit(source).alias("source"),
    )
