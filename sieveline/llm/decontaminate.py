"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

An item is in a document when at least ``containment`` of its distinct word shingles are among
the document's. Jaccard similarity is useless here, as documents are much longer than items; so the search works
on the items' minima. A document that holds enough of an item with n shingles lacks fewer than
k = n - ceil(containment * n) + 1 of them, hence holds at least one of the k shingles with the smallest hashes:
the item's bottom-k MinHash. Items are partitioned by size. A partition has its own bound, the largest of its
minima, and its own least size of a document that can hold one of its items; a document looks up in each
partition it is large enough for the hashes below that partition's bound. No document is missed, whatever its length.

Candidates are then verified on the shingles themselves. Shingles are five words,
lower-cased, split at space and 0x09-0x0D; a text with fewer words is one shingle, an empty one has none.

All of it is DataFrame operations. Minima are broadcast when few and joined by shuffle
otherwise; rows per document are reduced to distinct (document, item) before they are moved.

Row rules: null texts are empty, and empty items are in no document. Rows with the same doc_id are one document
(an item is in it when one of its rows holds it; the best row counts); so are rows without one. ``clean``
judges each row by its own text.
Repeated items with one id count once, by their best text. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import stored, unused

SMALL_SIDE = 500_000  # rows that may be broadcast
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Lower-cased words; an empty array for null and blank texts."""
    found = F.split(F.btrim(F.lower(text), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    return F.when(F.length(F.btrim(text, F.lit(BLANKS))) > 0, found).otherwise(F.array().cast("array<string>"))


def _per_shingle(found: Column, width: int, make) -> Column:
    many = F.transform(F.sequence(F.lit(1), F.size(found) - (width - 1)), lambda i: make(F.slice(found, i, width)))
    return F.when(F.size(found) >= width, many).when(F.size(found) > 0, F.array(make(found)))


def hashes(found: Column, width: int) -> Column:
    return _per_shingle(found, width, F.xxhash64)


def shingles(found: Column, width: int) -> Column:
    return F.array_distinct(_per_shingle(found, width, lambda w: F.array_join(w, " ")))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE else df


def minima(items: DataFrame, width: int, containment: float) -> DataFrame:
    """(item, size_class, h): the bottom-k hashes of each item text."""
    listed = items.select("item", F.array_sort(F.array_distinct(hashes(F.col("words"), width))).alias("all"))
    n = F.size("all")
    k = n - F.ceil(F.lit(containment) * n - 1e-9) + 1
    return listed.where(n > 0).select("item", F.floor(F.log2(n.cast("double"))).cast("int").alias("size_class"), F.explode(F.slice("all", F.lit(1), k.cast("int"))).alias("h"))


def _least(size_class: int, containment: float) -> int:
    """Shingles of the smallest document that can hold an item of the class."""
    return max(1, math.ceil(containment * 2**size_class - 1e-9))


def lookups(sketch: DataFrame, bounds: dict[int, int], containment: float) -> DataFrame:
    """(doc, k, size, h): the hashes below the bound of a partition that the document is large enough for."""
    size = F.size("all")
    admitted = [F.when(size >= _least(c, containment), F.lit(b)) for c, b in bounds.items()]
    bound = F.greatest(*admitted) if len(admitted) > 1 else admitted[0]
    bounded = sketch.select("doc", "k", "all", size.alias("size"), F.explode(F.array(bound)).alias("bound")).where("bound is not null")
    return bounded.select("doc", "k", "size", F.explode(F.filter("all", lambda h: h <= F.col("bound"))).alias("h"))


def _large_enough(classes: list[int], containment: float) -> Column:
    """Whether a document has the size that the partition of the item it met asks for."""
    least = F.create_map(*[F.lit(v) for c in classes for v in (c, _least(c, containment))])
    return F.col("size") >= least[F.col("size_class")]


def find(
    docs: DataFrame,
    items: DataFrame,
    containment: float = 0.8,
    width: int = 5,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles): every item that a document holds, with the sizes that show it."""
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    items = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("words")).where(F.size("words") > 0).distinct()
    low = stored(minima(items, width, containment), "minima")
    bounds = low.groupBy("size_class").agg(F.max("h").alias("bound")).collect()  # one row per size class
    if not bounds:
        return docs.select(F.col("doc").alias(doc_id), F.lit(None).cast(items.schema["item"].dataType).alias(item_id), F.lit(0).alias("n_shared"), F.lit(0).alias("n_shingles")).where("false")
    # The words are a column of their own: inside the lambda an expression would be evaluated for each shingle.
    split = docs.select("doc", F.xxhash64("text").alias("k"), words(F.col("text")).alias("words"))
    # A generator of one element keeps what it holds a column: merged into later lambdas it would be computed for each hash.
    sketch = split.select("doc", "k", F.explode(F.array(hashes(F.col("words"), width))).alias("all"))
    met = lookups(sketch, {b.size_class: b.bound for b in bounds}, containment)
    candidates = met.join(_few(low.distinct()), "h").where(_large_enough([b.size_class for b in bounds], containment))
    candidates = stored(candidates.select("doc", "k", "item").distinct(), "candidates")

    small = _few(candidates)
    x, y = docs.withColumn("k2", F.xxhash64("text")).alias("x"), small.alias("y")
    pairs = x.join(y, F.expr("x.k2 = y.k and x.doc <=> y.doc")).select("x.doc", "y.item", words(F.col("text")).alias("of_doc"))
    listed = items.select(F.col("item").alias("item2"), shingles(F.col("words"), width).alias("of_item"))
    both = pairs.join(_few(listed), F.col("item").eqNullSafe(F.col("item2")))
    sized = both.select("doc", "item", F.size(F.array_intersect("of_item", shingles(F.col("of_doc"), width))).alias("shared"), F.size("of_item").alias("n"))
    held = sized.where(F.col("shared") >= F.ceil(F.lit(containment) * F.col("n") - 1e-9))
    best = held.groupBy("doc", "item").agg(F.max(F.struct("shared", "n")).alias("best"))
    return best.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), F.col("best.shared").alias("n_shared"), F.col("best.n").alias("n_shingles"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", **options) -> DataFrame:
    """Rows of ``docs`` whose text holds no item; all columns. Rows are judged one by one, under their text's fingerprint."""
    key, gone = unused(docs, "key"), unused(docs, "held")
    keyed = docs.withColumn(key, F.md5(F.col(text).cast("string")))
    held = find(keyed.select(key, text), items, doc_id=key, item_id=item_id, text=text, **options).select(F.col(key).alias(gone)).distinct()
    held = _few(stored(held, "held"))
    return keyed.join(held, F.col(key) == F.col(gone), "left_anti").drop(key)


def oracle(containment: float = 0.8, width: int = 5) -> str:
    """The same result over ``documents`` and ``benchmark`` in DuckDB's SQL."""
    cut = f"""
      select id, unnest(case when len(ws) = 0 then [] when len(ws) < {width} then [array_to_string(ws, ' ')]
        else list_transform(generate_series(1, len(ws) - {width - 1}), lambda i: array_to_string(ws[i:i + {width - 1}], ' ')) end) as s
      from (select id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws
            from ({{}}) where text is not null)"""
    return f"""
    with d as (select distinct id as doc_id, s from ({cut.format("select doc_id as id, text from documents")})),
      b as (select distinct id as item_id, s from ({cut.format("select item_id as id, text from benchmark")})),
      n as (select item_id, count(*) as n_shingles from b group by item_id)
    select doc_id, item_id, cast(count(*) as integer) as n_shared, cast(any_value(n_shingles) as integer) as n_shingles
    from d join b using (s) join n using (item_id) group by doc_id, item_id
    having count(*) >= ceil({containment} * any_value(n_shingles) - 1e-9)"""
