"""How far the sources of a language lie apart in the terms they use, and by which terms.

Each (lang, source) group counts the kept terms of its language; with smoothing a term's share is
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the group's count of kept terms, V their number. Two groups
differ in a term by f = floor((p - q)^2 / (p + q)), and as a whole by the sum of f over all kept terms.

Terms are dealt to blocks by their hash and numbered inside a block, so a group is a segment
tree whose upper part are the blocks. Inside a block the trees of all its groups are built bottom up and
*hash-consed*: a node is named by its two children, so equal count subtrees, of whichever group and place,
are one node. Two groups are compared by walking their trees from the roots at the same time; the pairs of
nodes met on a level are collapsed first, with the number of times each stands for (the memo), so each pair of
equal nodes is opened once and each pair of counts is priced once. Most of a small source's tree is a few
shared nodes of zeros, and so is its walk.

Work is dealt by (lang, block of terms, two tiles of groups): a hot language spreads over blocks, a language with many
sources over tiles, and a cell holds at most some ``2 * TILE * BLOCK`` counts. What cells give are sums per
pair of groups and the first ten terms per group and block; Spark adds and ranks them.

Row rules: null text, lang and source count as empty strings, and the empty string is a language and a source like any
other. Rows are documents, repeated or equal ids included; no id is read. Groups without terms, and languages
without kept terms (V = 0), have their pairs with value as computed (0 where V = 0). All numbers are exact. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sieveline.llm.common import stored

BLOCK = 256  # terms of a block, on average
TILE = 48  # groups of a tile, on average
PIECE = 1 << 20  # bytes of a text that are split at once
FLUSH = 200_000  # entries of a task's table of counts
UNIT = 1_000_000_000
TOP = 10  # terms reported for a group

# Bytes that belong to terms keep their value, A-Z become a-z, all others a space.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _terms(data: bytes) -> Iterator[list[bytes]]:
    """Terms of one text in lists of bounded size."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and _TABLE[data[end]] != 0x20:  # not inside a term
            end += 1
        yield data[at:end].translate(_TABLE).split()
        at = end


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (of_lang, of_source), (n, docs) in seen.items():
                words = list(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([of_lang] * len(words), pa.string()),
                        pa.array([of_source] * len(words), pa.string()),
                        pa.array(words, pa.binary()).cast(pa.string()),
                        pa.array(list(n.values()), pa.int64()),
                        pa.array([docs[w] for w in words], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
            seen.clear()

        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for of_lang, of_source, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                n, docs = seen.setdefault((of_lang, of_source), (Counter(), Counter()))
                before = len(n)
                own: set[bytes] = set()
                for words in _terms(body.as_py()):
                    n.update(words)
                    own.update(words)
                docs.update(own)
                held += len(n) - before + 1
                if held >= FLUSH:
                    yield from flush()
                    held = 0
        yield from flush()

    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))]
    parts = df.select(*named).mapInArrow(partial, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- trees of one cell ------------------------------------------------------------------------


class Trees:
    """Hash-consed segment trees over the same leaves, one per row of ``counts`` (groups x terms)."""

    def __init__(self, counts: np.ndarray):
        groups, width = counts.shape
        size = 1 << max(0, (width - 1).bit_length())
        leaves = np.full((groups, size), -1, dtype=np.int64)  # -1: no term here, without a price
        leaves[:, :width] = counts
        self.counts, ids = np.unique(leaves, return_inverse=True)
        ids = ids.reshape(groups, size)
        self.left: list[np.ndarray] = []  # by level, bottom up: the children of each node
        self.right: list[np.ndarray] = []
        n = len(self.counts)
        while ids.shape[1] > 1:
            key = ids[:, 0::2] * n + ids[:, 1::2]
            nodes, ids = np.unique(key, return_inverse=True)
            ids = ids.reshape(groups, -1)
            self.left.append(nodes // n)
            self.right.append(nodes % n)
            n = len(nodes)
        self.roots = ids[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of trees: (pair, count in a, count in b, how many leaves), each triple once."""
        pair, x, y = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), dtype=np.int64)
        for left, right in zip(reversed(self.left), reversed(self.right), strict=True):
            pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            pair, x, y, times = _collapsed(pair, x, y, times)
        real = self.counts[x] >= 0
        return pair[real], self.counts[x[real]], self.counts[y[real]], times[real]


def _collapsed(pair: np.ndarray, x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal (pair, node, node) once, with the sum of what they stand for."""
    nx, ny = int(x.max(initial=0)) + 1, int(y.max(initial=0)) + 1
    key, place = np.unique((pair * nx + x) * ny + y, return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, place, times)
    return key // (nx * ny), key // ny % nx, key % ny, total


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """p of each count in a group with ``total`` occurrences; exact, in Python's numbers where a long is too small."""
    below = total + 2 * terms
    if int(count.max(initial=0)) + 2 < (1 << 63) // UNIT:
        return 1 + (count + 2) * UNIT // below
    return np.array([1 + UNIT * (c + 2) // b for c, b in zip(count.tolist(), np.broadcast_to(below, count.shape).tolist(), strict=True)], dtype=np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)  # shares are at most 10^9 + 1, so the square fits


CELL = "lang string, part string, source string, item string, value long"


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """Prices of one cell: (pair, source, item, sum) for pairs of its two tiles, (term, source, item, f) for its first tile's best terms."""
    first, second = key[2].as_py(), key[3].as_py()
    table = table.combine_chunks()
    kind = table.column("kind").to_numpy()
    heads = table.filter(pa.array(kind == 0))
    if not heads.num_rows:  # a tile that no group's hash fell in
        return pa.table({c: pa.array([], pa.int64() if c == "value" else pa.string()) for c in ("lang", "part", "source", "item", "value")})
    sources, totals = heads.column("source").to_pylist(), heads.column("n").to_numpy().astype(np.int64)
    tiles = heads.column("tile").to_numpy()
    terms_of_lang = int(heads.column("terms")[0].as_py())
    body = table.filter(pa.array(kind == 1))
    words = pa.compute.unique(body.column("term")).cast(pa.binary()).sort().cast(pa.string()) if body.num_rows else pa.array([], pa.string())
    out = {"part": [], "source": [], "item": [], "value": []}

    def emit(part, of, item, value):
        out["part"] += [part] * len(of)
        out["source"] += of
        out["item"] += item
        out["value"] += value

    width = int(heads.column("block_terms")[0].as_py())  # terms that no group here has are leaves as well
    lang_total = int(heads.column("lang_n")[0].as_py())
    # Row 0 is the language, the others the groups.
    counts = np.zeros((len(sources) + 1, width), dtype=np.int64)
    if body.num_rows:
        at = {s: g + 1 for g, s in enumerate(sources)}
        g = np.array([0 if whole else at[s] for s, whole in zip(body.column("source").to_pylist(), body.column("whole").to_pylist(), strict=True)])
        t = pa.compute.index_in(body.column("term"), words).to_numpy()
        counts[g, t] = body.column("n").to_numpy()
    all_totals = np.array([lang_total, *totals.tolist()], dtype=np.int64)
    trees = Trees(counts) if width else None

    a, b = np.triu_indices(len(sources), 1)
    if first != second:
        cross = tiles[a] != tiles[b]
        a, b = a[cross], b[cross]
    step = max(1, (1 << 18) // max(1, width))
    for s in range(0, len(a), step):
        x, y = a[s : s + step], b[s : s + step]
        value = np.zeros(len(x), dtype=np.int64)
        if trees:
            pair, cx, cy, times = trees.walk(x + 1, y + 1)
            f = price(shares(cx, all_totals[x + 1][pair], terms_of_lang), shares(cy, all_totals[y + 1][pair], terms_of_lang))
            np.add.at(value, pair, f * times)
        emit("pair", [sources[i] for i in x], [sources[i] for i in y], value.tolist())

    if trees and first == second:
        # The group's tree against the language's: prices by pair of counts, then by the group's own terms.
        texts = words.to_pylist()
        pair, cx, cy, _ = trees.walk(np.arange(len(sources)) + 1, np.zeros(len(sources), dtype=np.int64))
        p = shares(cx, all_totals[1:][pair], terms_of_lang)
        q = shares(cy, np.full(len(cy), lang_total, dtype=np.int64), terms_of_lang)
        for g in range(len(sources)):
            mine = (pair == g) & (cx > 0) & (p > q)
            memo = dict(zip(zip(cx[mine].tolist(), cy[mine].tolist(), strict=True), price(p[mine], q[mine]).tolist(), strict=True))
            here = np.flatnonzero(counts[g + 1])
            found = [(memo[c], int(t)) for c, t in zip(zip(counts[g + 1, here].tolist(), counts[0, here].tolist(), strict=True), here, strict=True) if c in memo]
            best = sorted(found, key=lambda r: (-r[0], r[1]))[:TOP]  # words are in UTF-8 order
            emit("term", [sources[g]] * len(best), [texts[t] for _, t in best], [f for f, _ in best])
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * len(out["part"]), pa.string()),
            "part": pa.array(out["part"], pa.string()),
            "source": pa.array(out["source"], pa.string()),
            "item": pa.array(out["item"], pa.string()),
            "value": pa.array(out["value"], pa.int64()),
        }
    )


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows with every other source of the language, ``term`` rows with
    the ten terms that a source uses most beyond its language. Terms of fewer than ``least_docs`` documents of a language go.
    """
    counts = stored(term_counts(df, text, lang, source), "term-counts")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    vocabulary = stored(vocabulary.select("lang", "term", "n"), "kept-terms")
    of_lang = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_n"))
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    every = df.select(*named).distinct()
    kept = stored(counts.join(vocabulary.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "source", "term", "n"), "kept-counts")
    groups = every.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    sizes = every.groupBy("lang").agg(F.count("*").alias("sources")).join(of_lang, "lang", "left")
    sizes = stored(
        sizes.select(
            "lang",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            F.coalesce("lang_n", F.lit(0)).alias("lang_n"),
            F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).cast("int").alias("blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("sources") / TILE)).cast("int").alias("tiles"),
        ),
        "languages",
    )
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")

    # Heads: every group once for each cell it has part in, with or without terms there.
    heads = groups.join(sizes, "lang").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), "terms", "lang_n", "blocks", "tiles", tile.alias("tile"))
    heads = heads.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    in_block = vocabulary.join(sizes, "lang").groupBy("lang", block.alias("block")).agg(F.count("*").alias("block_terms"))
    heads = heads.join(in_block, ["lang", "block"], "left").select("*", other)
    none = F.lit(None)
    unset = [none.cast("long").alias(c) for c in ("terms", "lang_n", "block_terms")]
    heads = heads.select("lang", "block", "tile", "other", F.lit(0).alias("kind"), "source", F.lit(False).alias("whole"), none.cast("string").alias("term"), "n", "terms", "lang_n", F.coalesce("block_terms", F.lit(0)).alias("block_terms"))
    body = kept.join(sizes, "lang").select("lang", block.alias("block"), tile.alias("tile"), "tiles", "source", "term", "n").select("*", other)
    body = body.select("lang", "block", "tile", "other", F.lit(1).alias("kind"), "source", F.lit(False).alias("whole"), "term", "n", *unset)
    # The language's own tree goes where groups are compared with it: cells of one tile.
    whole = vocabulary.join(sizes, "lang").select("lang", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "term", "n")
    whole = whole.select("lang", "block", "tile", F.col("tile").alias("other"), F.lit(1).alias("kind"), F.lit("").alias("source"), F.lit(True).alias("whole"), "term", "n", *unset)
    cells = heads.unionByName(body).unionByName(whole).withColumns({"first": F.least("tile", "other"), "second": F.greatest("tile", "other")})
    priced = stored(cells.groupBy("lang", "block", "first", "second").applyInArrow(_cell, CELL), "prices")

    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p"), "value")
    both = both.select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = priced.where("part = 'term'").select("lang", "source", "part", "item", "value")
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOP)
    return both.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)


def oracle(least_docs: int = 10) -> str:
    """The same rows in SQL, by joining each pair of groups over all kept terms."""
    return rf"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
),
words as (select d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
per_doc as (select d, lang, source, term, count(*) as n from words group by all),
kept as (select lang, term, sum(n)::hugeint as n from per_doc group by lang, term having count(*) >= {least_docs}),
langs as (select g.lang, count(k.term)::hugeint as v, coalesce(sum(k.n), 0)::hugeint as total from (select distinct lang from docs) g left join kept k using (lang) group by g.lang),
grp as (select distinct lang, source from docs),
counted as (select lang, source, term, sum(n)::hugeint as n from per_doc semi join kept using (lang, term) group by all),
totals as (select g.lang, g.source, coalesce(sum(c.n), 0)::hugeint as total from grp g left join counted c using (lang, source) group by all),
shares as (
  select k.lang, t.source, k.term, coalesce(c.n, 0)::hugeint as n,
         1 + 1000000000::hugeint * (coalesce(c.n, 0)::hugeint + 2) // (t.total + 2 * l.v) as p,
         1 + 1000000000::hugeint * (k.n + 2) // (l.total + 2 * l.v) as q
  from kept k join totals t using (lang) join langs l using (lang) left join counted c on c.lang = k.lang and c.source = t.source and c.term = k.term
),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) as value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
),
terms as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from shares where n > 0 and p > q),
parts as (select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms)
select lang, source, part, item, value::bigint as value, rank::int as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from parts)
where part = 'pair' or rank <= {TOP}
"""
