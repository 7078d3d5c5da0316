"""Text expressions: number formats, request templates, response clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from sieveline import config as C

MARKET_WIDE_PREFIX = "No headline names this symbol. Market-wide signals:\n"
NO_HEADLINES = "No headline found for this symbol."

ARTICLE_TEMPLATE = """Read the market news article below and answer with one JSON object and nothing else.

Title: {title}
Description: {description}
Source: {source}
Symbols followed: {symbols}

The object has exactly these keys:
sentiment: bullish, bearish or neutral
confidence: a number from 0 to 1
tickers_mentioned: an array of followed symbols the article concerns, possibly empty
topic_tags: an array of two to four short lower-case labels
market_implication: one sentence on the likely effect on the market"""

ANOMALY_TEMPLATE = """Explain in one sentence why this close is unusual.

Symbol: {ticker}
Close: ₹{close}
Average of earlier closes: ₹{average}
Move: {move} ({direction})
Standard deviations from the average: {deviations}

Headlines:
{headlines}

Name a headline where one fits; otherwise say that no news accounts for the move."""

QUARANTINE_TEMPLATE = """Explain in one sentence to a colleague why this {source} record was rejected.

Code: {code}
Detail: {detail}
Record: {record}

Mention the values involved. Answer with the sentence only."""


def decimals(x: Column) -> Column:
    """Exact decimal of a double at eight digits, so later rounding has no binary ties;
    null for NaN and infinity."""
    return F.round(x, 8).try_cast("decimal(28,8)")


def _own(x: Column) -> Column:
    """A finite number in its own form."""
    return F.when(F.abs(x) < float("inf"), x.cast("string"))


def fixed(x: Column, digits: int) -> Column:
    """Text with a fixed number of decimals; a number too large for that in its own form."""
    return F.coalesce(F.round(decimals(x), digits).cast(f"decimal(28,{digits})").cast("string"), _own(x))


def signed_pct(x: Column) -> Column:
    """'+1.25%' or '-0.50%'."""
    shown = F.round(decimals(x), 2).cast("decimal(28,2)")
    small = F.concat(F.when(shown >= 0, "+").otherwise(""), shown.cast("string"), F.lit("%"))
    return F.coalesce(small, F.concat(F.when(x >= 0, "+").otherwise(""), _own(x), F.lit("%")))


def whole_pct(x: Column) -> Column:
    """'87%' for 0.87."""
    small = F.concat(F.round(decimals(x) * 100, 0).cast("bigint").cast("string"), F.lit("%"))
    return F.coalesce(small, F.concat(_own(x * 100), F.lit("%")))


def symbol_clean(x: Column, suffix: str = C.EXCHANGE_SUFFIX) -> Column:
    """Symbol without its exchange suffix, wherever it occurs."""
    return F.replace(x, F.lit(suffix), F.lit(""))


def headline_bullet(sentiment: Column, confidence: Column, title: Column) -> Column:
    return F.concat(F.lit("- ["), F.upper(sentiment), F.lit(" "), whole_pct(confidence), F.lit("] "), title)


def render(template: str, **values: Column) -> Column:
    """Fill {name} places of a template with columns; a null value leaves the text null."""
    pieces = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{") and piece[1:-1] in values:
            pieces.append(values[piece[1:-1]])
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def or_default(x: Column, default: str) -> Column:
    """The text, or ``default`` where it is null or empty."""
    return F.when(x.isNull() | (x == ""), F.lit(default)).otherwise(x)


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\n\r\f\x0b"))


def strip_fences(raw: Column) -> Column:
    """The body of a response wrapped in a code fence; others only lose outer white space."""
    outer = strip(raw)
    body = F.split_part(outer, F.lit("```"), F.lit(2))
    body = F.when(body.startswith("json"), F.substr(body, F.lit(5))).otherwise(body)
    return F.when(outer.startswith("```"), strip(body)).otherwise(outer)


def strip_quotes(x: Column) -> Column:
    """Outer double quotes, then outer single quotes removed."""
    return F.btrim(F.btrim(strip(x), F.lit('"')), F.lit("'"))
