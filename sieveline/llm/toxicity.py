"""Toxic text by a support vector machine over a subsequence string kernel.

The kernel of two strings counts their common subsequences of three characters, each
occurrence weighted by DECAY to the power of the length it spans, with at most GAPS
characters skipped, and is normalised by the strings' own kernels. An insult written with
characters between its letters, or with an ending, so keeps most of its kernel with the
plain one. A sentence's kernel with a string is the largest over its words; letters
set apart by spaces or signs are read as one word too.

Training: words of labelled sentences from a bounded sample of labelled rows. In each
sentence of a toxic row that has evidence, the witness is the word with the largest log odds
between toxic and clean sentences; witnesses are the positive strings, words of clean sentences the
negative ones. Landmarks spread over both give the Nyström feature map; a linear machine with squared
hinge loss is trained on it, scores the clean words it has not seen, and is trained again
with those it got wrong. A logistic curve turns a document's largest margin into a score.

Since the kernel is a product of (bounded) subsequence counts, the trained machine is one
weight per character triple, and a word's margin is computed once and kept.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import kept_for, stored

DECAY = 0.7
GAPS = 3
WINDOW = 24  # longer strings are looked at in windows of this length, half overlapping
_KINDS = 48
_SPACED = re.compile(r"(?<!\S)\w(?:[^\S\n]\w(?!\S)){2,}")
_DOTTED = re.compile(r"(?<!\S)\w{1,2}(?:[^\w\s]{1,2}\w{1,2}){2,}")
_SENTENCE = re.compile(r"[.!?]+\s|\n")
_EDGES = ".,;:!?\"'()[]{}|*$#&%"


# ---- strings --------------------------------------------------------------------------------


def strings_of(text: str | None) -> list[str]:
    """The strings of a text that are judged: lower-cased words, and letters set apart by spaces or signs, joined."""
    if not text:
        return []
    text = text.lower()
    found = text.split()
    spaced = _SPACED.findall(text)
    if spaced:
        found += ["".join(s.split()) for s in spaced]
    dotted = _DOTTED.findall(text)
    if dotted:
        found += [re.sub(r"\W", "", d) for d in dotted]
    return found


def sentences(text: str | None) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()] if text else []


def _letters(word: str) -> np.ndarray:
    code = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)
    out = np.full(len(code), _KINDS - 1, dtype=np.int64)
    out = np.where((code >= 97) & (code < 123), code.astype(np.int64) - 97, out)
    out = np.where((code >= 48) & (code < 58), code.astype(np.int64) - 48 + 26, out)
    return np.where((code >= 0xC0), 36 + code.astype(np.int64) % 11, out)


def _windows(word: str) -> list[str]:
    word = word.strip(_EDGES)
    if len(word) <= WINDOW:
        return [word]
    return [word[a : a + WINDOW] for a in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, triple, weight) of all counted subsequences, weights of equal triples of a string added up."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    joined = _letters("".join(words))
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    n = len(joined)
    keys, weights = [], []
    for first in range(GAPS + 1):
        for second in range(GAPS + 1 - first):
            last = 2 + first + second
            if n <= last:
                continue
            whole = owner[: n - last] == owner[last:]
            triple = (joined[: n - last] * _KINDS + joined[1 + first : n - last + 1 + first]) * _KINDS + joined[last:]
            keys.append((owner[: n - last] * _KINDS**3 + triple)[whole])
            weights.append(np.full(int(whole.sum()), DECAY ** (last + 1)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    if not len(key):
        return key, key, weight
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key = key[first]
    return key // _KINDS**3, key % _KINDS**3, np.add.reduceat(weight, first)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of each word with each landmark; 0 for strings without a triple."""
    spread = np.zeros((_KINDS**3, len(landmarks)), dtype=np.float32)
    of, triple, weight = subsequences(landmarks)
    spread[triple, of] = weight
    spread /= np.maximum(np.sqrt((spread**2).sum(axis=0)), 1e-9)
    out = np.zeros((len(words), len(landmarks)))
    for at in range(0, len(words), 1000):  # bounds the rows of the table of triples
        some = words[at : at + 1000]
        of, triple, weight = subsequences(some)
        if not len(of):
            continue
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sums = np.add.reduceat(spread[triple] * weight[:, None], first, axis=0)
        out[at + of[first]] = sums / np.sqrt(np.add.reduceat(weight**2, first))[:, None]
    return out


# ---- model ----------------------------------------------------------------------------------


@dataclass
class Model:
    """Weights of triples, bias, and the logistic curve of a document's largest margin."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(_KINDS**3))
    bias: float = -1.0
    slope: float = 1.0
    offset: float = 0.0
    landmarks: list[str] = field(default_factory=list)

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word: the largest over its windows."""
        parts = [_windows(w) for w in words]
        of, triple, weight = subsequences([p for ps in parts for p in ps])
        flat = np.full(sum(map(len, parts)), self.bias)
        if len(of):
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            dots = np.add.reduceat(weight * self.weights[triple], first)
            flat[of[first]] += dots / np.sqrt(np.add.reduceat(weight**2, first))
        starts = np.cumsum([0, *(len(p) for p in parts[:-1])])
        return np.maximum.reduceat(flat, starts) if parts else flat

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def _disguises(word: str) -> list[str]:
    """The word with a character put in, so that the machine learns to bear it."""
    if not 4 <= len(word) < WINDOW - 2:
        return []
    half = len(word) // 2
    return [word[:half] + "x" + word[half:], word[: half - 1] + "*" + word[half - 1 :], word[: half + 1] + "-" + word[half + 1 :], word[:2] + "a" + word[2:]]


def _landmarks(words: list[str], most: int) -> list[str]:
    """Farthest-first: each next landmark is the word least like those chosen."""
    chosen = [0]
    near = kernel(words, [words[0]])[:, 0]
    while len(chosen) < min(most, len(words)):
        at = int(np.argmin(near))
        if near[at] > 0.95:
            break
        chosen.append(at)
        near = np.maximum(near, kernel(words, [words[at]])[:, 0])
    return [words[k] for k in chosen]


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    active = None
    for _ in range(50):
        now = y * (x @ w) < 1
        if active is not None and (now == active).all():
            break
        active = now
        xa, c = x[active], weight[active, None]
        w = np.linalg.solve(ridge + cost * xa.T @ (c * xa), cost * xa.T @ (c[:, 0] * y[active]))
    return w


def _train(positive: list[str], negative: list[str], n_landmarks: int, cost: float) -> Model:
    half = n_landmarks // 2
    landmarks = _landmarks(positive, half)
    landmarks += [w for w in _landmarks(negative, half) if w not in landmarks]
    base = kernel(landmarks, landmarks)
    value, vector = np.linalg.eigh((base + base.T) / 2)
    good = value > 1e-6
    root = vector[:, good] / np.sqrt(value[good])
    words = positive + negative
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    weight = np.where(y > 0, len(negative) / len(positive), 1.0) ** 0.5
    w = _machine(kernel(words, landmarks) @ root, y, weight, cost)
    weights = np.zeros(_KINDS**3)
    of, triple, amount = subsequences(landmarks)
    norm = np.sqrt(np.bincount(of, amount**2, len(landmarks)))
    np.add.at(weights, triple, (root @ w[:-1])[of] * amount / norm[of])
    return Model(weights, float(w[-1]), landmarks=landmarks)


def _curve(model: Model, margin: np.ndarray, y: np.ndarray) -> None:
    """Logistic curve by Newton steps, with the smoothed targets that keep it finite."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(y))], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (target - p))
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    model.slope, model.offset = float(max(w[0], 1e-3)), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
    per_class: int = 3000,
    words_per_class: int = 60_000,
    n_landmarks: int = 160,
    cost: float = 4.0,
    evidence: float = 15.0,
) -> Model:
    """A model from texts and their labels (1 or 0; other labels, null keys and null texts teach nothing).

    At most ``per_class`` labels of each kind, those with the smallest hash of ``key``, and of
    each class's words the ``words_per_class`` found in most sentences, are learned from;
    these bounds alone limit what the driver sees. The sample is chosen among the labels, so only
    its texts are moved. Without rows of both labels every score is the rate of label 1.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).where("key is not null and y in (0, 1)").distinct()
    known = known.withColumn("h", F.xxhash64("key"))
    chosen = [known.where(f"y = {y}").orderBy("h", "key").limit(per_class).select("key", "y") for y in (1, 0)]
    chosen = stored(chosen[0].union(chosen[1]), "toxicity-labels")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")
    sample = stored(rows.join(F.broadcast(chosen), "key").select("text", "y"), "toxicity-sample")  # 2 * per_class keys at most
    counts = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    rate = (n1 + 1) / (n1 + n0 + 2)
    model = Model(slope=0.0, offset=float(np.log(rate / (1 - rate))))
    if not n1 or not n0:
        return model

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                prints, words = [], []
                for s in sentences(t):
                    found = sorted({p for w in strings_of(s) for p in _windows(w) if len(p) >= 3})
                    prints += [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)] * len(found)
                    words += found
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(words), pa.int32()), pa.array(prints, pa.int64()), pa.array(words, pa.string())], names=["y", "s", "word"])

    # Copies of a sentence count once: a passage that many toxic rows share is not evidence by itself.
    parts = sample.mapInArrow(split, "y int, s long, word string").distinct()
    parts = stored(parts, "toxicity-words")
    seen = parts.groupBy("word").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    # Evidence: log likelihood ratio of the word's rate of toxic sentences against the rate of all sentences.
    total = parts.select("y", "s").distinct().agg(F.avg("y"), F.count("*")).first()
    n, rate = F.col("bad") + F.col("good"), F.lit(min(max(total[0] or 0.5, 1e-6), 1 - 1e-6))
    here = F.least(F.greatest(F.col("bad") / n, F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = n * (here * F.log(here / rate) + (1 - here) * F.log((1 - here) / (1 - rate)))
    seen = stored(seen.withColumn("odds", F.when(here > rate, odds).otherwise(0.0)), "toxicity-seen")
    witness = (
        parts.where("y = 1").join(seen.where((F.col("odds") >= evidence) & (F.col("bad") >= F.col("good"))), "word").groupBy("s").agg(F.max_by("word", F.struct("odds", "word")).alias("word"))
        .groupBy("word").count().where("count >= 2").orderBy(F.desc("count"), "word").limit(words_per_class).toPandas()
    )
    clean = seen.where("good > 0").orderBy(F.desc("good"), "word").limit(words_per_class).toPandas()
    plain = witness["word"].tolist()
    known = set(plain)
    positive = list(dict.fromkeys(plain + [v for w in plain for v in _disguises(w) if v not in known]))
    clean = [w for w in clean["word"] if w not in known]
    if not plain or not clean:
        return model
    negative = clean[:: max(1, len(clean) // 6000)]
    for _ in range(3):
        model = _train(positive, negative, n_landmarks, cost)
        wrong = np.argsort(-(margin := model.margins(clean)))[:3000]
        new = set(negative)
        new.update(clean[k] for k in wrong if margin[k] > -0.8)
        if len(new) == len(negative):
            break
        negative = sorted(new)
    scored = margins(sample, model, keep=("y",)).toPandas()
    _curve(model, scored["margin"].to_numpy(), scored["y"].to_numpy().astype(float))
    return model


# ---- scoring --------------------------------------------------------------------------------


class _Margins(dict):
    """Margin by word; emptied by halves when full, so memory is bounded."""

    def __init__(self, model: Model, keep: int = 1_000_000):
        super().__init__()
        self.model, self.keep = model, keep

    def learn(self, words: list[str]) -> dict[str, float]:
        if len(self) + len(words) > self.keep:
            for word in list(self)[: self.keep // 2]:
                del self[word]
        learned: dict[str, float] = {}
        for at in range(0, len(words), 4000):
            some = words[at : at + 4000]
            learned.update(zip(some, self.model.margins(some).tolist(), strict=True))
        self.update(learned)
        return learned

    def largest(self, texts: list[str | None]) -> list[float]:
        split = [strings_of(t) for t in texts]
        # The batch's own table: learning may drop words that are known now.
        here = {w: self.get(w) for words in split for w in words}
        new = [w for w, margin in here.items() if margin is None]
        once = [w for w in new if len(w) > 2 * WINDOW]
        if new:
            here.update(self.learn(new))
        low = self.model.bias
        found = [max(map(here.__getitem__, words), default=low) for words in split]
        for w in once:
            self.pop(w, None)
        return found


def margins(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the largest margin of a word in the whole text; the bias for texts without words."""
    shared, token = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_for(token, lambda: _Margins(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = known.largest(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.float64())], names=[*keep, "margin"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, margin double")


def predict(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.7) -> DataFrame:
    """Per row: the ``keep`` columns, score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts are scored as texts without an insult. Equal texts get equal
    scores; other columns, labels among them, are not read.
    """
    value = F.greatest(F.least(F.col("margin") * model.slope + model.offset, F.lit(40.0)), F.lit(-40.0))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-value))
    return margins(df, model, text, keep).select(*keep, score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted"))
