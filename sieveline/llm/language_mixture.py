"""Languages of a document as a mixture, by expectation-maximisation over its words.

A model holds the frequencies of hashed byte trigrams (letters lower-cased, other ASCII
as word limits) for each language, counted over all training rows. In a document each word
has a likelihood under each language, the product over its trigrams. EM finds the language
proportions that make the words likeliest. Which languages a document holds is then
chosen by penalised likelihood: for k = 1, 2, ... the k most probable languages are
refitted, and the k with the largest log likelihood less ``penalty * (k - 1) * log(words)``
wins.

Row rules: null text, empty text and text without a letter get the language ``und`` with
score 0 and no languages. Rows without a language teach nothing. With nothing to learn from, every
row is ``und``. Repeated rows count as often as they occur. Other columns of the input
are not read; texts of any length are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import byte_offsets, in_chunks

BUCKETS = 1 << 16
UNDETERMINED = "und"
_CLASS = np.zeros(256, dtype=np.uint32)  # 0: between words
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, 155)


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around each word byte, the words' first trigrams, their texts, letters seen in ASCII."""
    data, offsets = byte_offsets(texts)
    # A zero between texts keeps words and trigrams apart.
    n = len(texts)
    kinds = np.zeros(len(data) + n + 1, dtype=np.uint32)
    places = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets)) + 1
    kinds[places] = _CLASS[data]
    middle = np.flatnonzero(kinds)
    code = kinds[middle - 1] * np.uint32(155 * 155) + kinds[middle] * np.uint32(155) + kinds[np.minimum(middle + 1, len(kinds) - 1)]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    first = np.flatnonzero(kinds[middle - 1] == 0)
    bounds = offsets + np.arange(n + 1)
    of_text = np.searchsorted(bounds, middle[first] - 1, side="right") - 1
    return code, first, of_text, np.isin(np.arange(n), of_text)


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages


def fit(df: DataFrame, text: str = "text", language: str = "lang", smoothing: float = 0.2, most_languages: int = 256) -> Model:
    """Trigram statistics of all rows that have a text and a language.

    Each task adds up its own rows; the driver sees one number per language and bucket. Where the language column holds
    more than ``most_languages`` values, which no labelling means, those with the most rows are learned: it bounds the model.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in in_chunks(batch, "text"):
                code, first, of_text, _ = _grams(part.column(0))
                if not len(code):
                    continue
                names = part.column(1).dictionary_encode()
                of_gram = np.repeat(of_text, np.diff([*first, len(code)]))
                kind = np.asarray(names.indices)[of_gram]
                for k, name in enumerate(names.dictionary.to_pylist()):
                    sums[name] = sums.get(name, 0) + np.bincount(code[kind == k], minlength=BUCKETS)
        for name, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])], names=["lang", "bucket", "n"])

    rows = df.select(F.col(text).alias("text"), F.col(language).cast("string").alias("lang")).where("text is not null and lang is not null")
    names = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages + 1).collect()]
    if len(names) > most_languages:
        rows = rows.where(F.col("lang").isin(names[:most_languages]))
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts.column("lang").to_pylist()))
    table = np.full((BUCKETS, len(languages)), smoothing)
    at = {name: k for k, name in enumerate(languages)}
    if languages:
        column = np.array([at[x] for x in counts.column("lang").to_pylist()])
        table[np.asarray(counts.column("bucket")), column] += np.asarray(counts.column("n"))
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _mixture(likely: np.ndarray, first: np.ndarray, words: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM from the given proportions: new proportions, log likelihood of each text (up to a constant of the text)."""
    owner = np.repeat(np.arange(len(words)), words)
    for _ in range(rounds):
        part = likely * share[owner]
        total = part.sum(axis=1)
        part /= np.maximum(total, 1e-30)[:, None]
        share = np.add.reduceat(part, first, axis=0) / words[:, None]
    total = (likely * share[owner]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-30)), first)


def _infer(model: Model, texts: pa.Array, rounds: int, most: int | None, penalty: float):
    """For texts with words: their places, proportions in the chosen set (texts x languages), score."""
    code, first, of_text, _ = _grams(texts)
    none = np.zeros(0, np.int64), np.zeros((0, len(model.languages))), np.zeros(0)
    if not len(code) or not model.languages:
        return none
    by_word = np.add.reduceat(model.log_probability[code], first, axis=0)
    likely = np.exp(by_word - by_word.max(axis=1, keepdims=True))
    place, start, words = np.unique(of_text, return_index=True, return_counts=True)
    kinds = len(model.languages)
    even = np.full((len(place), kinds), 1 / kinds, dtype=np.float32)
    share, _ = _mixture(likely, start, words, even, rounds)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    best, value = np.zeros_like(share), np.full(len(place), -np.inf)
    for k in range(1, min(most or kinds, kinds) + 1):
        some = np.where(rank < k, np.maximum(share, 1e-6), 0)
        some /= some.sum(axis=1, keepdims=True)
        some, fit_ = _mixture(likely, start, words, some.astype(np.float32), 0 if k == 1 else rounds // 2)
        fit_ = fit_ - penalty * (k - 1) * np.log(words + 1.0)
        better = fit_ > value
        best[better], value = some[better], np.maximum(value, fit_)
    score = (share.max(axis=1) * words + 0.5) / (words + 0.5 * kinds)
    return place, best, score


def predict(
    df: DataFrame,
    model: Model,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    rounds: int = 8,
    most: int | None = None,
    penalty: float = 1.0,
) -> DataFrame:
    """Per row: the ``keep`` columns, lang_pred, score, languages and their shares (largest first).

    Sets of every size up to all learned languages are tried, or up to ``most``; the penalty ends their growth.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            for part in in_chunks(batch, "_text"):
                texts = part.column(part.num_columns - 1)
                place, share, score = _infer(known, texts, rounds, most, penalty)
                # Bytes above ASCII may be signs: a text without an ASCII letter is looked at by character.
                found = np.full(len(texts), len(known.languages))
                scores = np.zeros(len(texts))
                sets: list[list] = [[] for _ in range(len(texts))]
                shares: list[list] = [[] for _ in range(len(texts))]
                for k, at in enumerate(place.tolist()):
                    s = texts[at].as_py()
                    if not _has_letter(s):
                        continue
                    order = np.argsort(-share[k], kind="stable")
                    order = order[share[k][order] > 0]
                    found[at], scores[at] = order[0], min(1.0, float(score[k]))
                    sets[at], shares[at] = names[order].tolist(), share[k][order].astype(float).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array(names[found].tolist(), pa.string()),
                        pa.array(scores),
                        pa.array(sets, pa.list_(pa.string())),
                        pa.array(shares, pa.list_(pa.float64())),
                    ],
                    names=[*keep, "lang_pred", "score", "languages", "shares"],
                )

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, lang_pred string, score double, languages array<string>, shares array<double>")


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
