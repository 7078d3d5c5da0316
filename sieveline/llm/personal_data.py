"""Personal data by base patterns and by contexts learned from them.

Base: e-mail addresses, IPv4 addresses, card numbers with a valid check digit, phone numbers
with a country code. They are the seeds. The method then bootstraps: the cue of a seed is the
word and signs right before it ("phone: ", "card = "). Cues and the values they stand
before form a graph. Per round, a cue's confidence is the share of its occurrences in the whole
corpus that stand before a trusted value, a value's confidence that of its cues
together; values of confident cues become trusted and support further cues. Tokens with a digit that
stand behind a confident cue and are no base match are the found identifiers.

Rounds end when one changes nothing more.

All of it is DataFrame operations; no Python runs on rows. Cues with too few
distinct values never enter the graph; counts of cues and of values are map-side combined, and
what is broadcast is counted first.

Row rules: null text counts as empty and has no spans; every row gives one row, repeated
rows and null ids included; columns that
``keep`` does not name are not returned; one that is named like a column made here (row, the kinds,
tokens, spans, more, _text, _base, _heads) raises.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import refuse, stored

# The base kinds, in the order in which spans are listed. The patterns are possessive
# where nothing could be given back, so no text makes them recurse or try a run again from inside.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
FOUND = "found"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_RANGE = rf"^{_PART}(?:\.{_PART}){{3}}$"
# A cue is a word and the signs and blanks after it; a value starts behind them and holds a digit. A value that
# starts with a digit, a bracketed prefix or the four characters of an IBAN runs over further groups of
# digits, joined by single blanks, brackets or dashes. Such a prefix's bracket is the value's, not the cue's.
_SIGNS = r"\s=:\"',;()<>|"
_PREFIX = r"\([0-9]++\)(?=[\x20-]?+[0-9])"
_GROUP = rf"[0-9]++(?:[./-][0-9]++)*+(?=[.!?]*+(?![^{_SIGNS}]))"
_MORE = rf"(?:(?<![.!?])(?:(?:[\x20-]|(?<=\))){_GROUP}|\x20?+{_PREFIX}))*+"
_IBAN = r"[A-Za-z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}(?=\x20[A-Z0-9]{0,3}[0-9](?![\p{L}\p{N}]))|\x20[A-Z0-9]{0,3}[0-9](?![\p{L}\p{N}]))++"
_OPENED = rf"(?<=[^{_SIGNS}]\()[0-9]++\)(?=[\x20-]?+[0-9])"
_HEADS = rf"{_IBAN}|(?:{_PREFIX}|{_OPENED}|\+?+[0-9][^{_SIGNS}]*+){_MORE}|[^{_SIGNS}0-9]*+[0-9][^{_SIGNS}]*+"
VALUE = rf"(?:\G|(?<![^{_SIGNS}]))(?:{_HEADS})"
HEAD = rf"^\(?[^{_SIGNS}]+"  # of a value: its first group
CUE = rf"[^{_SIGNS}]++[{_SIGNS}](?:(?!{_PREFIX})[{_SIGNS}])*+"
LAST_CUE = rf"(?:^|(?<=[{_SIGNS}]))([^{_SIGNS}]++[{_SIGNS}]++)$"

SMALL_SIDE = 500_000  # cues that may be broadcast; beyond, a shuffled join
STEP = 256  # matches that are dealt with in one piece
SETTLED = 0.001  # a round that raises no cue's confidence by more is the last
_SPAN = "array<struct<s:int,e:int,v:string,gap:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def in_steps(items: Column, start: Column, total: Callable, merge: Callable, produce: Callable) -> Column:
    """A running state over an array, in time that stays near its length.

    Appending to an array copies it, so the array is cut into pieces of STEP: their ``total``s are merged into the state
    before each piece, and ``produce(piece, state)`` gives a piece's results, appended to short arrays only.
    """

    def of_pieces(pieces: Column) -> Column:
        kind = "array<int>"
        states = F.aggregate(
            F.transform(pieces, total),
            F.struct(start.alias("at"), F.array().cast(kind).alias("out")),
            lambda acc, t: F.struct(merge(acc["at"], t).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
        )["out"]
        return bound(states, lambda at: F.flatten(F.transform(pieces, lambda piece, k: produce(piece, F.get(at, k)))))

    def cut(whole: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / STEP).cast("int"))
        return bound(F.transform(places, lambda k: F.slice(whole, k * STEP + 1, F.lit(STEP))), of_pieces)

    return bound(items, cut)


def find_all(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: start, end (code points), value, and the text between it and the match before."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), values.alias("v")), lambda p: p["v"].isNotNull())

    def width(p: Column) -> Column:
        return F.length(p["gap"]) + F.length(p["v"])

    def placed(piece: Column, at: Column) -> Column:
        return F.aggregate(
            piece,
            F.struct(at.alias("at"), F.array().cast(_SPAN).alias("out")),
            lambda acc, p: F.struct(
                (acc["at"] + width(p)).alias("at"),
                F.array_append(
                    acc["out"],
                    F.struct(
                        (acc["at"] + F.length(p["gap"])).alias("s"),
                        (acc["at"] + width(p)).alias("e"),
                        p["v"].alias("v"),
                        p["gap"].alias("gap"),
                    ),
                ).alias("out"),
            ),
        )["out"]

    found = in_steps(pairs, F.lit(0), lambda piece: F.aggregate(piece, F.lit(0), lambda n, p: n + width(p)), lambda at, n: at + n, placed)
    return F.when(text.rlike(pattern.replace(r"(?:\G|", "(?:", 1)), found).otherwise(F.array().cast(_SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check sum of a card number; every second digit from the right is doubled."""
    number = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(number, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind."""
    return {
        "email": find_all(text, EMAIL),
        "ip": F.filter(find_all(text, IP), lambda m: m["v"].rlike(IP_RANGE)),
        "card": F.filter(find_all(text, CARD), lambda m: F.length(_digits(m["v"])).between(13, 19) & _luhn(_digits(m["v"]))),
        "phone": F.filter(find_all(text, PHONE), lambda m: F.length(_digits(m["v"])).between(9, 15)),
    }


def _cue(before: Column) -> Column:
    """The cue at the end of a text: lower-cased, blanks made one; null without one."""
    cue = F.regexp_replace(F.lower(F.regexp_extract(before, LAST_CUE, 1)), r"\s+", " ")
    return F.when(cue != "", cue)


def _value(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, r"[.,;:!?]+$", ""))


def spans(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Base spans of each text, and its tokens with a digit that might be identifiers.

    Columns: row (a number unique to each row), those of ``keep``, one array per kind, tokens.
    """
    refuse(keep, ("row", *KINDS, "tokens", "spans", "more", "_text", "_base", "_heads"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = base_spans(F.col("_text"))
    cut = df.select(F.monotonically_increasing_id().alias("row"), *keep, text.alias("_text"))
    cut = cut.select("row", *keep, *[c.alias(k) for k, c in found.items()], find_all(F.col("_text"), VALUE).alias("tokens"))
    shaped = [
        F.transform(F.col(k), lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), _value(m["v"]).alias("v"), _cue(m["gap"]).alias("cue"))).alias(k)
        for k in KINDS
    ]
    base = F.concat(*[F.transform(k, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"))) for k in KINDS])

    # A word with a digit is a value itself; where only signs follow it, it is the next value's cue too.
    def cue(m: Column, i: Column) -> Column:
        before = F.get("tokens", i - 1)["v"]
        follows = (i > 0) & before.rlike(r"^\p{L}") & m["gap"].rlike(rf"^[{_SIGNS}]+$")
        return F.coalesce(_cue(m["gap"]), F.when(follows, _cue(F.concat(before, m["gap"]))))

    # A token's end has no closing marks; tokens whose first group touches a base span are not looked at
    # again, those that run into one end before it.
    heads = F.transform(
        F.col("tokens"),
        lambda m, i: F.struct(m["s"].alias("s"), m["e"].alias("e"), m["v"].alias("v"), (m["s"] + F.length(_value(F.regexp_extract(m["v"], HEAD, 0)))).alias("head"), cue(m, i).alias("cue")),
    )
    kind = "array<struct<s:int,e:int,v:string,cue:string>>"

    def free(piece: Column, spans: Column) -> Column:
        """Tokens of a piece that are apart from the base spans around it."""
        reach = F.struct(F.array_min(F.transform(piece, lambda t: t["s"])).alias("s"), F.array_max(F.transform(piece, lambda t: t["e"])).alias("e"))
        near = bound(reach, lambda r: F.filter(spans, lambda b: (b["s"] < r["e"]) & (r["s"] < b["e"])))

        def own(around: Column) -> Column:
            def trimmed(m: Column) -> Column:
                first = F.array_min(F.transform(F.filter(around, lambda b: (b["s"] >= m["head"]) & (b["s"] < m["e"])), lambda b: b["s"]))
                return F.when(first.isNull(), _value(m["v"])).otherwise(F.regexp_replace(F.lower(F.substring(m["v"], F.lit(1), first - m["s"])), r"[^\p{L}\p{N}]+$", ""))

            apart = F.filter(piece, lambda t: t["cue"].isNotNull() & ~F.exists(around, lambda b: (b["s"] < t["head"]) & (t["s"] < b["e"])))
            return F.transform(apart, lambda m: F.struct(m["s"].alias("s"), (m["s"] + F.length(trimmed(m))).alias("e"), trimmed(m).alias("v"), m["cue"].alias("cue")))

        return bound(near, own)

    # Piece by piece, so that a token meets the base spans near it only.
    def all_free(listed: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(listed) - 1) / STEP).cast("int"))
        pieces = F.transform(places, lambda k: F.slice(listed, k * STEP + 1, F.lit(STEP)))
        return bound(F.col("_base"), lambda spans: F.flatten(F.transform(pieces, lambda piece: free(piece, spans))))

    tokens = F.when(F.size("_heads") > 0, bound(F.col("_heads"), all_free)).otherwise(F.array().cast(kind))
    return cut.withColumn("_base", base).withColumn("_heads", heads).select("row", *keep, *shaped, tokens.alias("tokens"))


def _occurrences(df: DataFrame, text_col: str, cues: DataFrame) -> DataFrame:
    """How often each of ``cues`` stands in all texts, before whatever follows."""
    pieces = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(CUE), F.lit(0))
    said = df.select(F.explode(pieces).alias("piece")).select(F.regexp_replace("piece", r"\s+", " ").alias("cue"))
    return said.join(cues, "cue").groupBy("cue").agg(F.count("*").alias("said"))


def learn_cues(
    df: DataFrame,
    found: DataFrame,
    text_col: str = "text",
    support: int = 5,
    confidence: float = 0.8,
    rounds: int | None = None,
) -> DataFrame:
    """Confident cues (cue, confidence) from the graph of cues and values in ``found``.

    ``support``: distinct trusted values a cue needs. ``confidence``: least share of a cue's
    occurrences in all texts that stand before trusted values. ``rounds``: most rounds; without it they end
    when one adds no cue and raises no confidence by more than SETTLED.
    """
    seeds = found.select(F.explode(F.concat(*KINDS)).alias("m")).select("m.cue", "m.v", F.lit(1.0).alias("trust"))
    others = found.select(F.explode("tokens").alias("m")).select("m.cue", "m.v", F.lit(0.0).alias("trust"))
    edges = seeds.union(others).where("cue is not null").groupBy("cue", "v").agg(F.count("*").alias("n"), F.max("trust").alias("seed"))
    edges = stored(edges, "cue-graph")
    # Later rounds can trust values that are no seeds, so any cue with enough values may enter.
    enough = stored(edges.groupBy("cue").agg(F.count("*").alias("values")).where(F.col("values") >= support).select("cue"), "cues")
    small = enough.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE
    cues = F.broadcast(enough) if small else enough
    said = stored(_occurrences(df.where(F.col(text_col).isNotNull()), text_col, cues), "cue-counts")
    edges = stored(edges.join(cues, "cue"), "cue-edges")
    seeds_ = edges.where("seed > 0").select("v", F.lit(1.0).alias("trust")).distinct()
    trusted, before = seeds_, None
    for turn in itertools.count(1):
        # Values without trust add nothing to a cue.
        held = edges.join(trusted, "v")
        scores = held.groupBy("cue").agg(F.sum(F.col("n") * F.col("trust")).alias("good"), F.count_if(F.col("trust") >= confidence).alias("values"))
        scored = scores.join(said, "cue").where(F.col("values") >= support).select("cue", F.least(F.col("good") / F.col("said"), F.lit(1.0)).alias("confidence"))
        scored = stored(scored.where(F.col("confidence") >= confidence), "cue-scores")
        # Trust only grows from round to round; where no cue's confidence does, no further cue can follow.
        grown = scored if before is None else scored.join(before.withColumnRenamed("confidence", "old"), "cue", "left").where(F.col("confidence") - F.coalesce("old", F.lit(0.0)) > SETTLED)
        if turn == rounds or grown.limit(1).count() == 0:
            return scored
        before, now = scored, scored.limit(SMALL_SIDE + 1).count()
        # A value's trust: that at least one of its cues is right, were they independent.
        doubt = edges.join(F.broadcast(scored) if now <= SMALL_SIDE else scored, "cue").groupBy("v").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("trust")
        )
        trusted = stored(seeds_.union(doubt).groupBy("v").agg(F.max("trust").alias("trust")), "trusted")


def extract(
    df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", support: int = 5, confidence: float = 0.8, rounds: int | None = None
) -> DataFrame:
    """One row per input row: row, the ``keep`` columns, and an array of spans (kind, s, e) in the order of kinds, then start."""
    found = stored(spans(df, keep, text_col), "spans")
    cues = stored(learn_cues(df, found, text_col, support, confidence, rounds).select("cue"), "good-cues")
    more = (
        found.where(F.size("tokens") > 0)
        .select("row", F.explode("tokens").alias("m"))
        .select("row", "m.s", "m.e", F.col("m.cue").alias("cue"))
        .join(cues, "cue")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("more"))
    )
    extra = F.coalesce("more", F.array().cast("array<struct<s:int,e:int>>"))
    flat = [_kinded(F.col(k), k) for k in KINDS] + [_kinded(extra, FOUND)]
    return found.join(more, "row", "left").select("row", *keep, F.concat(*flat).alias("spans"))


def _kinded(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["s"].alias("s"), m["e"].alias("e")))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")


def mask(df: DataFrame, text_col: str, spans_col: str = "spans") -> Column:
    """``text_col`` with every span replaced by its kind in angle brackets; overlapping spans become one, named after the first."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ordered = F.array_sort(F.transform(spans_col, lambda m: F.struct(m["s"].alias("s"), (-m["e"]).alias("d"), m["kind"].alias("kind"))))

    def pieces(piece: Column, at: Column) -> Column:
        # Places are counted from the start of a string, so each piece has its own part of the text.
        part = F.substring(text, at + 1, F.greatest(F.array_max(F.transform(piece, lambda m: m["s"])) - at, F.lit(0)))

        def replaced(own: Column) -> Column:
            return F.aggregate(
                piece,
                F.struct(at.alias("at"), F.array().cast("array<string>").alias("out")),
                lambda acc, m: F.struct(
                    F.greatest(acc["at"], -m["d"]).alias("at"),
                    F.when(
                        m["s"] >= acc["at"],
                        F.concat(acc["out"], F.array(F.substring(own, acc["at"] - at + 1, m["s"] - acc["at"]), F.concat(F.lit("<"), m["kind"], F.lit(">")))),
                    ).otherwise(acc["out"]).alias("out"),
                ),
            )["out"]

        return bound(part, replaced)

    def last(piece: Column) -> Column:
        return F.array_max(F.transform(piece, lambda m: -m["d"]))

    parts = in_steps(ordered, F.lit(0), last, F.greatest, pieces)
    end = F.array_max(F.transform(spans_col, lambda m: m["e"]))
    masked = F.concat(F.array_join(parts, ""), F.substring(text, end + 1, F.length(text)))
    return F.when(F.col(text_col).isNull() | (F.size(spans_col) <= 0), F.col(text_col)).otherwise(masked)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["s"], m["e"])), ",")
    base = F.filter("spans", lambda m: m["kind"] != FOUND)
    return found.select(id_col, *map(_count, KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
