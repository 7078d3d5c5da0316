"""Exact set-similarity join on word shingles by partitioning the universe of shingles.

Two sets of together S shingles with a Jaccard similarity of t = p/q or more differ in at most
S * (q - p) / (q + p) shingles. Sets are put into size bands; in the scheme of a band that
bound is the same number H for all pairs whose larger set lies in the band. The scheme
deals all shingles to segments by hash and gives each segment a number of differences it
bears, 0 or 1, so that these numbers plus one add up to H + 1. By the pigeonhole principle a
similar pair has a segment in which it differs by no more than the segment bears. For
0 the segment's subset itself is indexed; for 1 also its one-deletion neighbourhood (each
subset without one shingle), where two subsets that differ by one shingle must meet.

How many segments of a scheme bear 1 is chosen by cost from the number of sets in each band
over the whole input: such segments are twice as large, so chance meetings are rarer by
orders of magnitude, and cost one row per shingle. A set enters its own band's scheme and the
next one, since its partners may be a band larger.

A segment in which a set has nothing would meet every other such set. A scheme therefore has a few segments
more than the bound asks for: a set whose empty segments are no more than that need not index them, since
similar sets then still agree in others; only sets with more of them index them.

Some segments more than that let similar sets agree in SHUNNED + 1 entries at least; a set that is smaller than its band's
largest agrees in more, all its entries but as many as it may differ in. So each set may leave out the
entries with the largest buckets (passages that many documents share), as many as it has to spare: in
the order of bucket sizes, two sets that share r + 1 entries share one that neither has among its last r.

Sets that meet are candidates. Entries carry the set's fingerprint, so copies count as one. They are moved
packed, partitioned by entry, and a partition keeps those that two sets share. In each
bucket candidates are paired with one centre; a set is verified with three centres of its buckets in a round, on the whole
sets; links give components. Members of a large bucket that are then still in different components meet other centres,
and after some rounds all cross-component pairs of all buckets are verified, so no link that could join two components
is missed, while a group of mutually similar sets costs a few pairs per member. Pairs whose sizes or sketches (numbers
of the shingles dealt to 128 places, modulo 16) show more differences than the similarity bears are never made; for unlike
sets that holds up to some 2,000 shingles.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.llm.common import discard, in_chunks, release, stored
from sieveline.llm.components import components
from sieveline.llm.shingles import U, distinct_by_text, mix, shingle_hashes

SHUNNED = 0.2  # share of further segments, so of entries with large buckets that a set may leave out
LARGE_BUCKET = 6  # buckets up to this size are never left out
ROUNDS = 4  # of further centres at most, before open pairs are verified one by one
CENTRES = 3  # of a large bucket in a round
CROWDED = 20  # members of a bucket; in smaller ones open pairs are verified at once
FEW_LINKED = 4  # a round that links no more than one of so many pairs is the last
SKETCH = 8  # longs of a set's sketch: four, one for each bit of a number, for each 64 places
SMALL_SIDE = 1_000_000  # ids that may be broadcast; beyond, a shuffled join
CHANCE = 1e-5  # cost model: chance that a shingle of one set lies in an unrelated set
WORD_BYTES = 6  # cost model: bytes of a word and its blank
PAIR_COST = 50.0  # cost model: verifying a pair against writing an index row
SKETCHES = [f"q{k}" for k in range(SKETCH)]
TEXTS = ["id", "n", "f1", "f2", *SKETCHES]


# ---- schemes --------------------------------------------------------------------------------


class Bands:
    """Size bands for a similarity, and the difference bound of each."""

    def __init__(self, similarity: Fraction, largest: int):
        self.similarity = similarity
        lows, ups = [1], []
        while True:
            ups.append(int(lows[-1] / similarity))
            if ups[-1] >= largest:
                break
            lows.append(ups[-1] + 1)
        lows.append(ups[-1] + 1)  # the scheme that the largest sets enter as smaller partners
        ups.append(int(lows[-1] / similarity))
        self.lows, self.ups = np.array(lows), np.array(ups)
        share = (1 - similarity) / (1 + similarity)
        self.differences = np.array([int(2 * u * share) for u in ups])
        self.shunned = np.ceil(SHUNNED * self.differences).astype(np.int64)
        least = self.differences + 1 + self.shunned
        self.spare = np.array([self._spare(float(similarity) * low, int(m)) for low, m in zip(lows, least, strict=True)])
        self.segments = least + self.spare  # if all bear nothing

    @staticmethod
    def _spare(size: float, least: int) -> int:
        """Segments beyond the bound: so many are empty in hardly any set of ``size`` shingles or more."""
        spare = 0
        for _ in range(20):
            empty = (least + spare) * np.exp(-size / (least + spare))
            wanted = min(int(empty + 4 * empty**0.5), least)
            if wanted <= spare:
                break
            spare = wanted
        return spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ups, sizes, side="left")

    def most_differences(self, sizes: np.ndarray, scheme: np.ndarray) -> np.ndarray:
        """How many shingles sets of these sizes and their partners in a scheme differ in at most."""
        p, q = self.similarity.numerator, self.similarity.denominator
        return (sizes + np.minimum(sizes * q // p, self.ups[scheme])) * (q - p) // (q + p)


def allocate(bands: Bands, sets: np.ndarray) -> np.ndarray:
    """For each band the number of segments that bear one difference, by cost.

    ``sets``: number of sets in each band. Cost: index rows of all sets, plus the pairs that
    would meet by chance, each at PAIR_COST. Segments hold Poisson-distributed numbers of shingles: two sets with no
    more than one in a segment that bears a difference always meet there, in the subset of none.
    """
    chosen = np.zeros(len(bands.ups), dtype=np.int64)
    for k, h in enumerate(bands.differences):
        members = float(sets[k] + (sets[k - 1] if k else 0))
        size = float(bands.lows[k] + bands.ups[k]) / 2
        best = None
        for a in sorted({round(x) for x in np.linspace(0, (h + 1) // 2, 9)}):
            b = bands.segments[k] - 2 * a
            s = size / (a + b)
            rows = members * (a + b + s * a)
            plain = np.exp(-s) * np.expm1(s * CHANCE)
            bears = (np.exp(-s) * (1 + s)) ** 2 + (1 + s) * np.exp(-s) * (np.expm1(s * CHANCE) / CHANCE - s)
            meet = b * plain + a * bears
            cost = rows + PAIR_COST * members * members / 2 * meet
            if best is None or cost < best[0]:
                best = (cost, a)
        chosen[k] = best[1]
    return chosen


def signatures(hashes: np.ndarray, starts: np.ndarray, bands: Bands, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index entries of each set, how many of a scheme's entries may be left out, and where each set's entries start.

    ``hashes``: distinct shingles, set after set. The schemes are those of the set's band and
    of the next.
    """
    sizes = np.diff(starts)
    own = bands.of(np.maximum(sizes, 1))
    entries, owners, shunned = [], [], []
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed = mix(hashes ^ U(0xA5A5A5A5DEADBEEF))
    for scheme in (own, own + 1):
        a = ones[scheme]
        m = bands.segments[scheme] - a
        m = np.where(sizes > 0, m, 0)
        base = np.concatenate([[0], np.cumsum(m)])
        sums = np.zeros(base[-1], U)
        segment = (mix(hashes + U(1)) % np.maximum(m, 1)[owner].astype(U)).astype(np.int64)
        np.add.at(sums, base[owner] + segment, mixed)
        number = np.arange(base[-1]) - np.repeat(base[:-1], m)
        salt = mix(np.repeat(scheme, m).astype(U) * U(1 << 32) + number.astype(U))
        of = np.repeat(np.arange(len(sizes)), m)
        held = np.bincount(base[owner] + segment, minlength=len(sums)) > 0
        plain_empty = ~held & (number >= a[of])
        many = np.bincount(of[plain_empty], minlength=len(sizes)) > bands.spare[scheme]
        keep = ~plain_empty | many[of]
        entries.append(mix(sums ^ salt)[keep])
        owners.append(of[keep])
        # Similar sets agree in all but the segments that their differences fall into. With segments that bear a difference
        # agreement is counted otherwise: nothing is left out there.
        indexed = np.where(many, m - bands.spare[scheme], np.bincount(of[keep], minlength=len(sizes)))
        more = np.maximum(indexed - 1 - bands.most_differences(sizes, scheme), 0)
        may = np.where(a > 0, 0, np.minimum(more, 32_000)) * 2 + (scheme is not own)
        shunned.append(may[of[keep]])
        bears = segment < a[owner]
        if bears.any():
            at = (base[owner] + segment)[bears]
            entries.append(mix((sums[at] - mixed[bears]) ^ salt[at]))
            owners.append(owner[bears])
            shunned.append(may[owner[bears]])
    entry, of, may = np.concatenate(entries), np.concatenate(owners), np.concatenate(shunned).astype(np.uint16)
    order = np.argsort(of, kind="stable")
    return entry[order], may[order], np.searchsorted(of[order], np.arange(len(sizes) + 1))


# ---- operator -------------------------------------------------------------------------------


def _ratio(similarity: float) -> Fraction:
    return Fraction(similarity).limit_denominator(10_000)


def _blob(entry: np.ndarray, of: np.ndarray, may: np.ndarray) -> bytes:
    """Fingerprints, and entries as their low 48 bits over ``may``: 16 bytes an entry, however many parts there are."""
    return of.tobytes() + ((entry << U(16)) | may.astype(U)).tobytes()


def _unblob(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    of, both = np.frombuffer(raw, U).reshape(2, -1)
    return both >> U(16), of, (both & U(0xFFFF)).astype(np.uint16)


def _packed(docs: DataFrame, width: int, bands: Bands, ones: np.ndarray, parts: int) -> DataFrame:
    """Index entries with fingerprints, packed by partition; with part -1 the TEXTS columns of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        texts: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            entry, of, may = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((of, entry))
            entry, of, may = entry[order], of[order], may[order]
            # Sets that this task holds twice (copies) need one entry.
            fresh = np.ones(len(entry), bool)
            fresh[1:] = (entry[1:] != entry[:-1]) | (of[1:] != of[:-1])
            entry, of, may = entry[fresh], of[fresh], may[fresh]
            part = (entry >> U(32)) * U(parts) >> U(32)
            cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(entry)]]) if len(entry) else np.array([0])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, texts[0].schema) as writer:
                for t in texts:
                    writer.write_batch(t)
            number = [int(texts_part())] + [int(part[c]) for c in cuts[:-1]]
            data = [sink.getvalue().to_pybytes()] + [_blob(entry[c:d], of[c:d], may[c:d]) for c, d in zip(cuts[:-1], cuts[1:], strict=True)]
            kind = [True] + [False] * (len(data) - 1)
            held.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(kind), pa.array(data, pa.binary())], names=["part", "texts", "data"])

        turn = iter(range(1 << 62))

        def texts_part() -> int:
            return next(turn) % parts  # any partition will do

        release()
        count = 0
        for batch in batches:
            for some in in_chunks(batch, "text", 1 << 18):
                hashes, starts = distinct_by_text(*shingle_hashes(some.column(1), width))
                entries, may, at = signatures(hashes, starts, bands, ones)
                prints = [_print(hashes, starts, half) for half in range(2)]
                named = ~np.asarray(some.column(0).is_null())
                of = np.repeat(np.arange(some.num_rows), np.diff(at))
                held.append((entries[named[of]], prints[0][of][named[of]], may[named[of]]))
                columns = [some.column(0), pa.array(np.diff(starts)), *(pa.array(p.view(np.int64)) for p in prints), *_sketch(hashes, starts)]
                texts.append(pa.RecordBatch.from_arrays(columns, names=TEXTS))
                count += len(entries)
                if count >= 500_000:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "part int, texts boolean, data binary")


def _buckets(packed: DataFrame, parts: int) -> DataFrame:
    """Per partition: the TEXTS columns of texts, and (entry, size, f1, may) of the entries that several sets share."""
    schema = ", ".join(f"{c} long" for c in TEXTS) + ", entry long, size long, may int"
    names = [*TEXTS, "entry", "size", "may"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part, texts, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if texts:
                    for t in pa.ipc.open_stream(data.as_buffer()):
                        none = pa.nulls(t.num_rows, pa.int64())
                        yield pa.RecordBatch.from_arrays([*t.columns, none, none, none.cast(pa.int32())], names=names)
                    continue
                entry, of, may = _unblob(data.as_py())
                blobs.append((entry + (U(part) << U(48)), of, may))  # those of other parts are others
        if not blobs:
            return
        entry, of, may = (np.concatenate(c) for c in zip(*blobs, strict=True))
        blobs.clear()
        order = np.argsort(entry)
        entry, of, may = entry[order], of[order], may[order]
        same = entry[1:] == entry[:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        entry, of, may = entry[several], of[several].view(np.int64), may[several]
        order = np.lexsort((of, entry))
        entry, of, may = entry[order], of[order], may[order]
        fresh = np.ones(len(entry), bool)
        fresh[1:] = (entry[1:] != entry[:-1]) | (of[1:] != of[:-1])
        entry, of, may = entry[fresh], of[fresh], may[fresh]
        if not len(entry):
            return
        starts = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
        size = np.diff(np.append(starts, len(entry)))
        size = np.repeat(size, size)
        entry, of, may, size = entry[size > 1].view(np.int64), of[size > 1], may[size > 1].astype(np.int32), size[size > 1]
        for a in range(0, len(entry), 200_000):
            some = slice(a, a + 200_000)
            none = pa.nulls(len(entry[some]), pa.int64())
            columns = [pa.array(of[some]) if c == "f1" else none for c in TEXTS]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(entry[some]), pa.array(size[some]), pa.array(may[some])], names=names)

    return packed.repartitionById(parts, F.col("part")).mapInArrow(run, schema)


def _sketch(hashes: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """Numbers (modulo 16) of each set's shingles dealt to 16 * SKETCH places, in Gray code, bit by bit.

    Sets differ in no fewer shingles than the numbers do, summed over all places. Parities of as many bits could show 256
    differences at most, so they told no unlike sets of more than 1,000 shingles apart.
    """
    n, places = len(starts) - 1, 16 * SKETCH
    owner = np.repeat(np.arange(n), np.diff(starts))
    place = (mix(hashes ^ U(0x3C6EF372FE94F82B)) % U(places)).astype(np.int64)
    numbers = np.bincount(owner * places + place, minlength=n * places).reshape(n, SKETCH // 4, 64)
    numbers = (numbers & 15) ^ ((numbers & 15) >> 1)
    planes = (numbers[:, :, None, :] >> np.arange(4)[:, None]) & 1
    longs = np.packbits(planes.astype(np.uint8), axis=-1, bitorder="little").reshape(n, SKETCH, 8).view("<i8")[:, :, 0]
    return [pa.array(np.ascontiguousarray(longs[:, k]), pa.int64()) for k in range(SKETCH)]


def _differences() -> Column:
    """The least number of shingles in which x and y differ, by their sketches: distances on a circle of 16, summed.

    The difference x - y is taken bit by bit with its borrow; from 8 on it is the other way round the circle.
    """

    def plain(side: str, codes: list[str]) -> list[Column]:
        bits = [F.col(f"{side}.{codes[-1]}")]
        for c in codes[-2::-1]:
            bits.append(bits[-1].bitwiseXOR(F.col(f"{side}.{c}")))
        return bits[::-1]

    total = F.lit(0)
    for k in range(0, SKETCH, 4):
        borrow, bits = None, []
        for x, y in zip(*(plain(side, SKETCHES[k : k + 4]) for side in "xy"), strict=True):
            unlike, less = x.bitwiseXOR(y), F.bitwise_not(x).bitwiseAND(y)
            bits.append(unlike if borrow is None else unlike.bitwiseXOR(borrow))
            borrow = less if borrow is None else less.bitwiseOR(F.bitwise_not(unlike).bitwiseAND(borrow))
        far = bits.pop()
        total = total + F.bit_count(far)
        for weight, bit in zip((1, 2, 4), bits, strict=True):
            total = total + F.bit_count(bit.bitwiseXOR(far)) * weight
    return total


def _near(met: DataFrame, similarity: Fraction) -> DataFrame:
    """The rows of ``met`` where sizes and sketches of the sets x and y allow the similarity. Similar pairs always stay."""
    p, q = similarity.numerator, similarity.denominator
    sized = met.where(f"least(x.n, y.n) * {q} >= greatest(x.n, y.n) * {p}")
    # Through a one-element array, so that the filter tests a column: in a join's condition every part that is
    # used twice would be worked out twice.
    shown = sized.select("*", _differences().alias("_differ")).select("*", F.explode(F.array("_differ")).alias("_least"))
    return shown.where(F.expr(f"_least * {q + p} <= (x.n + y.n) * {q - p}"))


def _print(hashes: np.ndarray, starts: np.ndarray, half: int) -> np.ndarray:
    """One half (0 or 1) of the fingerprint of each set."""
    out = np.zeros(len(starts) - 1, U)
    owner = np.repeat(np.arange(len(out)), np.diff(starts))
    np.add.at(out, owner, mix(hashes + U(0x51ED270B7F4A7C15 * (half + 1) & (2**64 - 1))))
    return out


def _texts(docs: DataFrame, width: int) -> DataFrame:
    """(id, f1, packed): one half of the fingerprint and the text, compressed; sets would take several times the room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_chunks(batch, "text", 1 << 18):
                hashes, starts = distinct_by_text(*shingle_hashes(part.column(1), width))
                packed = [zlib.compress((t or "").encode(), 1) for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array(_print(hashes, starts, 0).view(np.int64)), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "f1", "packed"])

    return docs.mapInArrow(run, "id long, f1 long, packed binary")


def _common(pairs: DataFrame, width: int) -> DataFrame:
    """``pairs`` with the sizes of the intersection and the union of their sets, instead of their texts (of_a, of_b)."""
    others = [c for c in pairs.columns if c not in ("of_a", "of_b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_chunks(batch, "of_a", 1 << 18):
                ends = [list(zip(*(part.column(c).to_pylist() for c in names), strict=True)) for names in (("a", "fa"), ("b", "fb"))]
                texts = {}
                for names, column in zip(ends, ("of_a", "of_b"), strict=True):
                    for name, packed in zip(names, part.column(column), strict=True):
                        if name not in texts:
                            texts[name] = zlib.decompress(packed.as_buffer())
                hashes, starts = distinct_by_text(*shingle_hashes(pa.array(texts.values(), pa.large_binary()), width))
                sets = {name: hashes[x:y] for name, x, y in zip(texts, starts[:-1], starts[1:], strict=True)}
                common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(*ends, strict=True)], np.int64)
                both = np.array([len(sets[x]) + len(sets[y]) for x, y in zip(*ends, strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(common), pa.array(both - common)], names=[*others, "common", "all"])

    return pairs.mapInArrow(run, ", ".join(f"{c} long" for c in [*others, "common", "all"]))


def _few(df: DataFrame) -> DataFrame:
    """Marks a side for broadcast when it is small; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE else df


def _verified(pairs: DataFrame, docs: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """Those pairs (a, b), sets by id and fingerprint, whose whole sets are similar enough, with intersection and union sizes.

    Texts are moved, compressed, and their sets made again where a pair meets.
    """
    wanted = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("fa").alias("f1")), F.struct(F.col("b").alias("id"), F.col("fb").alias("f1")))).alias("w"))
    wanted = stored(wanted.select("w.*").distinct(), "candidates")
    of_ids = _texts(docs.join(_few(wanted.select("id").distinct()), "id", "left_semi"), width)
    # An id may have other texts than the one that is meant.
    texts = stored(of_ids.join(_few(wanted), ["id", "f1"], "left_semi").dropDuplicates(["id", "f1"]), "sets")
    left = texts.select(F.col("id").alias("a"), F.col("f1").alias("fa"), F.col("packed").alias("of_a"))
    right = texts.select(F.col("id").alias("b"), F.col("f1").alias("fb"), F.col("packed").alias("of_b"))
    sized = _common(pairs.join(left, ["a", "fa"]).join(right, ["b", "fb"]), width)
    similar = sized.where(F.col("common") * similarity.denominator >= F.col("all") * similarity.numerator)
    similar = stored(similar.select("a", "b", "common", "all"), "jaccard-links")
    discard(wanted, texts)
    return similar


def join(
    df: DataFrame, similarity: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate classes of the texts of ``df``.

    Returns (members, links). members: one row per input row with id_col, n_shingles,
    set_id (smallest id with the same set), component_id (smallest id reachable by
    links, itself included) - null where the id is null, the id itself where the set is empty.
    links: verified pairs of set_ids (a < b) with ``common`` and ``all``, enough to connect
    every class; a pair of repeated ids may have a row for each pair of texts. Texts without words and null texts have empty sets and link with nothing. Rows with
    the same id count as one document that has all their links. Other columns are not returned.
    """
    ratio = _ratio(similarity)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Sets by size, estimated from the length of all texts; a text of b bytes has (b + 1) / 2 words at most.
    size = F.octet_length("text")
    step = F.floor(F.log(F.greatest(size / WORD_BYTES, F.lit(1.0))) * 20).alias("step")
    counted = docs.where("text is not null").groupBy(step).agg(F.count("*").alias("n"), F.max(size).alias("most")).collect()
    bands = Bands(ratio, max((r.most for r in counted), default=1) // 2 + 1)
    per_band = np.zeros(len(bands.ups))
    for r in counted:
        per_band[bands.of(np.exp(r.step / 20))] += r.n
    ones = allocate(bands, per_band)

    # Some 0.2 to 0.6 entries a shingle; a partition holds a few million.
    total = sum(r.n * np.exp(r.step / 20) for r in counted)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), round(total / 4_000_000))
    met = stored(_buckets(_packed(docs, width, bands, ones, parts), parts), "jaccard-buckets")
    index, shared = met.where("entry is null").drop("entry", "size", "may"), met.where("entry is not null").select("entry", "size", "f1", "may")
    # Each set leaves out its entries with the largest buckets, as many as its scheme has to spare.
    rank = F.row_number().over(Window.partitionBy("f1", "may").orderBy(F.desc("size"), F.desc("entry")))
    large = shared.where(F.col("size") > LARGE_BUCKET).withColumn("rank", rank).where(F.col("rank") > F.expr("may div 2")).drop("rank")
    buckets = stored(shared.where(F.col("size") <= LARGE_BUCKET).union(large).select("entry", "f1"), "jaccard-entries")
    named = index.where("id is not null and n > 0")
    key = ["f1", "f2", "n"]
    sketch = [F.min(c).alias(c) for c in SKETCHES]  # the same in all rows of a set
    set_ids = stored(named.groupBy(*key).agg(F.min("id").alias("set_id"), *sketch), "jaccard-sets")

    # Stars: members of a bucket are compared with its centre. One fingerprint half may name several sets; all are
    # verified. Ids may have several texts: a pair names the fingerprints too.
    of_print = set_ids.select("f1", "set_id", "n", *SKETCHES)
    ends = ["a", "fa", "b", "fb"]
    lower = F.col("x.set_id") < F.col("y.set_id")
    side = {s: F.struct(F.col(f"{s}.set_id").alias("i"), F.col(f"{s}.f1").alias("f")) for s in "xy"}

    def ordered(met: DataFrame, *more) -> DataFrame:
        both = met.select(F.when(lower, side["x"]).otherwise(side["y"]).alias("l"), F.when(lower, side["y"]).otherwise(side["x"]).alias("g"), *more)
        return both.select(F.col("l.i").alias("a"), F.col("l.f").alias("fa"), F.col("g.i").alias("b"), F.col("g.f").alias("fb"), *both.columns[2:])

    def picked(met: DataFrame, rank, pairs: DataFrame | None = None) -> DataFrame:
        """Of each x the pairs with its first and its last y by ``rank``, and with the y that seems nearest; without ``pairs``."""
        met = ordered(met, side["x"].alias("member"), rank.alias("rank"), F.struct("_least", rank).alias("near"))
        if pairs is not None:
            met = met.join(pairs, ends, "left_anti")
        end = F.struct(*ends)
        chosen = met.groupBy("member").agg(F.min_by(end, "rank").alias("first"), F.max_by(end, "rank").alias("last"), F.min_by(end, "near").alias("nearest"))
        return chosen.select(F.explode(F.array("first", "last", "nearest")).alias("p")).select("p.*").distinct()

    centres = buckets.groupBy("entry").agg(F.min("f1").alias("centre"), F.max("f1").alias("last")).where("centre < last").drop("last")
    stars = buckets.join(centres, "entry").where("f1 != centre").select("centre", "f1").distinct().alias("s")
    x, y = of_print.alias("x"), of_print.alias("y")
    stars = _near(stars.join(x, F.expr("s.f1 = x.f1")).join(y, F.expr("s.centre = y.f1 and x.set_id != y.set_id")), ratio)
    twins = ordered(_near(x.join(y, F.expr("x.f1 = y.f1 and x.set_id < y.set_id")), ratio))  # equal halves
    pairs = stored(picked(stars, F.col("y.f1")).union(twins).distinct(), "jaccard-pairs")
    links = _verified(pairs, docs, width, ratio)
    labels = stored(components(links), "jaccard-components")

    # What the stars leave open: members of a bucket in different components whose sizes and sketches allow the
    # similarity. In a round a set of a large bucket is compared with three centres of its large buckets, the nearest by sketch
    # among them, so pairs are no more than three times the sets, however large a group of like texts is, and the group
    # comes together. Then every pair that is still open is verified, so that no link is missed. Rounds read
    # large buckets only and join components set by set; all buckets get them once, behind the last round.
    def left_open(members: DataFrame) -> DataFrame:
        several = members.groupBy("entry").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("entry")
        return stored(members.join(several, "entry", "left_semi"), "jaccard-open")

    def between(pairs: DataFrame, of_set: DataFrame) -> DataFrame:
        """The components that ``pairs`` join."""
        ca, cb = (of_set.select(F.col("set_id").alias(e), F.col("component").alias(f"c{e}")) for e in "ab")
        return pairs.select("a", "b").join(ca, "a").join(cb, "b").where("ca != cb").select("ca", "cb").distinct()

    def merged(by_set: DataFrame, moves: DataFrame) -> DataFrame:
        """``by_set`` with the components that ``moves`` make of those in it."""
        to = components(moves, "ca", "cb").select(F.col("node").alias("component"), F.col("component").alias("to"))
        found = by_set.join(_few(to), "component", "left").withColumn("component", F.coalesce("to", "component"))
        return found.select(by_set.columns)

    placed = of_print.join(labels, of_print.set_id == labels.node, "left")
    placed = stored(placed.select("f1", "set_id", "n", F.coalesce("component", "set_id").alias("component"), *SKETCHES), "jaccard-placed")
    large = buckets.groupBy("entry").agg(F.count("*").alias("m")).where(F.col("m") > CROWDED).select("entry")
    crowd = stored(buckets.join(_few(large), "entry", "left_semi"), "jaccard-crowds")
    for turn in range(ROUNDS):
        left = left_open(crowd.join(placed, "f1"))
        # Some centres a bucket: with one, a group that shares many entries would meet at the same few sets in all.
        member = F.struct("set_id", "f1", "n", "component", *SKETCHES)
        some = [F.min_by(member, F.xxhash64("set_id", F.lit(turn * CENTRES + c))) for c in range(CENTRES)]
        centre = left.groupBy("entry").agg(F.array(*some).alias("c")).select("entry", F.explode("c").alias("c")).select("entry", "c.*")
        met = _near(left.alias("x").join(centre.alias("y"), F.expr("x.entry = y.entry and x.component != y.component")), ratio)
        new = stored(picked(met, F.xxhash64("y.set_id", F.lit(turn)), pairs), "jaccard-pairs")
        discard(left)
        found = new.count()
        if found == 0:
            break
        more = _verified(new, docs, width, ratio)
        pairs, links = pairs.union(new), links.union(more)
        linked = more.count()
        if linked:
            moves = stored(between(more, placed.select("set_id", "component").distinct()), "jaccard-moves")
            placed = stored(merged(placed, moves), "jaccard-placed")
        if linked * FEW_LINKED <= found:  # crowds of unlike sets: what is near there is left to the last step
            break
    discard(crowd)
    of_set = placed.select("set_id", "component").distinct()
    left = left_open(buckets.join(placed, "f1"))
    discard(buckets)
    moves = []
    # One end of each pair lies outside the component that has most members of the bucket.
    sizes = left.groupBy("entry", "component").agg(F.count("*").alias("m"))
    main = sizes.groupBy("entry").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
    x, y = left.join(main, "entry").where("component != main").alias("x"), left.alias("y")
    once = "(x.set_id < y.set_id or y.component = x.main)"
    rest = ordered(_near(x.join(y, F.expr(f"x.entry = y.entry and x.component != y.component and {once}")), ratio)).distinct()
    rest = stored(rest.join(pairs, ends, "left_anti"), "jaccard-rest")
    if rest.limit(1).count():
        more = _verified(rest, docs, width, ratio)
        links = links.union(more)
        moves.append(stored(between(more, of_set), "jaccard-moves"))
    discard(left)

    of_id = named.select("id", *key).distinct().join(set_ids, key).select("id", "set_id")
    # Rows that share an id tie their sets together.
    twice = of_id.groupBy("id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).where("lo < hi").select("id", "lo")
    ties = stored(of_id.join(twice, "id").select(F.col("lo").alias("a"), F.col("set_id").alias("b")), "jaccard-ties")
    if ties.limit(1).count():
        moves.append(stored(between(ties, of_set), "jaccard-moves"))
    if moves:
        of_set = merged(of_set, reduce(DataFrame.union, moves))
    members = (
        index.select(F.col("id"), F.col("n"), *key[:2])
        .join(set_ids, key, "left")
        .join(of_set, "set_id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("set_id", "id")).alias("set_id"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "set_id", "id")).alias("component_id"),
        )
    )
    return members, links


def oracle(similarity: float = 0.9, width: int = 3) -> str:
    """doc_id, n_shingles and component_id over ``documents`` in DuckDB's SQL (links by a join on shingles)."""
    ratio = _ratio(similarity)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    with recursive w as (
        select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'),
          lambda x: x <> '') as ws from documents),
      s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < {width} then [array_to_string(ws, ' ')]
          else list_transform(generate_series(1, len(ws) - {width - 1}), lambda i: array_to_string(ws[i:i + {width - 1}], ' ')) end) as sh from w),
      n as (select doc_id, count(*) as n from s group by doc_id),
      p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (sh) where a.doc_id <> b.doc_id group by all),
      e as (select x, y from p join n nx on x = nx.doc_id join n ny on y = ny.doc_id
        where {ratio.denominator} * c >= {ratio.numerator} * (nx.n + ny.n - c)),
      r(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, e.y from r join e on r.other = e.x)
    select doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
    from r left join n using (doc_id) group by doc_id"""
