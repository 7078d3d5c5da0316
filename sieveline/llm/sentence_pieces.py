"""SentencePiece encoding and decoding of merge-type (BPE) models by a prefix table.

The encoding of a text by merges has one property that makes a single left-to-right pass
enough: a sequence of tokens is what the merges yield exactly when every pair of adjacent
tokens is what the merges yield for the two tokens' text. So each prefix has one last
token. The table stores it for every prefix: of the vocabulary entries that end there (found
by an Aho-Corasick automaton) it is the one whose start is reachable and which is
compatible with the last token of the prefix before it. The ids are then read backwards.

Pieces never hold the space mark after another character (checked when the model is read),
so no merge crosses from a word to the next space: the table is built for each run of
spaces plus word, and the ids of a frequent run are kept.

Row rules: null text counts as empty; an empty text has no ids and decodes to an empty
text; repeated rows are encoded one by one; all columns of the input stay. Characters
outside the vocabulary become their UTF-8 byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from sieveline.llm.common import per_worker, sha256_hex

SPACE = "▁"
REPLACEMENT = "�"
SLICE = 500  # rows whose ids are in memory at once
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5  # piece types of the model format


class PieceTable:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str, keep: int = 1_000_000, keep_length: int = 48):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only merge-type models with identity normalisation are supported")
        self.dummy_prefix = norm.add_dummy_prefix
        pieces = model.pieces
        if any(p.type in (USER_DEFINED, UNUSED) for p in pieces):
            raise ValueError("user-defined or unused pieces are not supported")
        # Inside, the space mark is a plain space: texts need no replacement and stay one byte a character.
        self.pieces = [p.piece.replace(SPACE, " ") for p in pieces]
        self.types = [p.type for p in pieces]
        normal = [i for i, kind in enumerate(self.types) if kind == NORMAL]
        self.scores = {self.pieces[i]: pieces[i].score for i in normal}
        self.ids = {self.pieces[i]: i for i in normal}
        if any(" " in p.lstrip(" ") for p in self.scores):
            raise ValueError("a piece holds a space mark after another character")
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(pieces) if p.type == UNKNOWN)
        self.byte_ids = [byte_ids.get(b, self.unknown) for b in range(256)] if byte_ids else None
        # What a piece stands for when decoded: text, or one raw byte.
        self.raw = {i: b for b, i in byte_ids.items()}
        self.shown = [
            "" if kind == CONTROL else " ⁇ " if kind == UNKNOWN else piece
            for piece, kind in zip(self.pieces, self.types, strict=True)
        ]
        self.automaton = ahocorasick.Automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        for piece, i in self.ids.items():
            if self._merge(piece) == [piece]:  # an entry that merges never reach can't be a token
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        # Line feeds lie in no piece, so a run ends there as well.
        brk = "\n" if not any("\n" in p for p in self.scores) else ""
        self.runs = re.compile(f" *[^ {brk}]+| +" + (f"|{brk}+" if brk else ""))
        beside = {(a, b) for p in self.scores for a, b in zip(p, p[1:], strict=False)}
        # Marks that follow a letter in no piece: a word's ids don't depend on one at its end.
        self.closing = {c for c in ".,;:!?)" if c in self.ids and not any(b == c and a.isalpha() for a, b in beside)}
        self.known = _Known(self, keep, keep_length)

    def _merge(self, text: str) -> list[str]:
        """The merges themselves, for single entries and pairs: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        key = (left, right)
        if key not in self.compatible:
            a, b = self.pieces[left], self.pieces[right]
            self.compatible[key] = self._merge(a + b) == [a, b]
        return self.compatible[key]

    def encode_run(self, run: str) -> list[int]:
        """Ids of one run by the prefix table."""
        n = len(run)
        last, size = [-1] * (n + 1), [1] * (n + 1)  # -1: no vocabulary entry ends here, the character stands alone
        known, fits = self.compatible.get, self._fits
        for end, (length, token) in self.automaton.iter(run):
            end += 1
            if last[end] < 0:  # a prefix has one last token
                prior = last[end - length]
                if prior >= 0:
                    fit = known((prior, token))
                    if fit is None:
                        fit = fits(prior, token)
                    if not fit:
                        continue
                last[end], size[end] = token, length
        ids: list[int] = []
        at = n
        while at:
            if last[at] >= 0:
                ids.append(last[at])
            elif self.byte_ids is None:
                ids.append(self.unknown)
            else:
                ids.extend(self.byte_ids[b] for b in reversed(run[at - 1].encode()))
            at -= size[at]
        ids.reverse()
        return ids

    def _split(self, text: str) -> list[str]:
        if SPACE in text:
            text = text.replace(SPACE, " ")
        return self.runs.findall(" " + text if self.dummy_prefix else text)

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in self.encode_decimal(text).split(",") if i]

    def encode_decimal(self, text: str | None) -> str:
        """Ids in decimal, joined by commas."""
        if not text:
            return ""
        return ",".join(map(self.known.__getitem__, self._split(text)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are not UTF-8 show as replacement characters."""
        raw, shown = self.raw, self.shown
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in raw:
                pending.append(raw[i])
                continue
            if pending:
                out.append(_text_of(bytes(pending)))
                pending.clear()
            piece = shown[i]
            out.append(piece)
        if pending:
            out.append(_text_of(bytes(pending)))
        text = "".join(out)
        first = next((i for i in ids if i in raw or shown[i]), None)
        return text[1:] if self.dummy_prefix and first is not None and self.types[first] == NORMAL and text[:1] == " " else text


class _Known(dict):
    """Decimal ids by run, computed when missing. When full, what the last half brought stays: memory is bounded."""

    def __init__(self, table: PieceTable, keep: int, keep_length: int):
        super().__init__()
        self.table, self.keep, self.keep_length = table, keep, keep_length

    def __missing__(self, run: str) -> str:
        if len(run) > 2 and run[-1] in self.table.closing and run[-2].isalpha():
            ids = f"{self[run[:-1]]},{self.table.ids[run[-1]]}"
        else:
            ids = ",".join(map(str, self.table.encode_run(run)))
        if len(run) <= self.keep_length:
            if len(self) >= self.keep:
                late = dict(islice(self.items(), self.keep // 2, None))
                self.clear()
                self.update(late)
            self[run] = ids
        return ids


def _text_of(data: bytes) -> str:
    """UTF-8 decoding with one replacement character for each byte that fits nowhere."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(REPLACEMENT)
            at += 1
    return "".join(out)


_table = per_worker(PieceTable)


def encode(df: DataFrame, model_file: str, text: str = "text", ids: str = "piece_ids", decoded: str | None = None) -> DataFrame:
    """Adds the array column ``ids``, and with ``decoded`` the text that the ids decode to; all other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, back = _table(model_file), _decoder(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                joined = [table.encode_decimal(t) for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                found = [np.array(j.split(","), dtype=np.int32) if j else np.zeros(0, np.int32) for j in joined]
                columns = [_lists(found)]
                if decoded:
                    columns.append(pa.array([back(j.split(",") if j else []).decode() for j in joined], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, ids, *([decoded] if decoded else [])])

    schema = _schema(df, ids, "ids")
    return df.mapInArrow(run, _schema(df, decoded, "text", schema) if decoded else schema)


def decode(df: DataFrame, model_file: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """Adds the string column ``text``; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [table.decode(i or []) for i in part.column(part.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=[*part.schema.names, text])

    return df.mapInArrow(run, _schema(df, text, "text"))


def encode_digest(df: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of ids, digest of the ids, digest of the text decoded from them.

    One pass: ids are encoded, digested, decoded and digested again without leaving the
    Python worker, so that no column of ids is shipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        decoded = _decoder(model_file)
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            counts, of_ids, of_text = [], [], []
            for t in batch.column(1).to_pylist():
                joined = table.encode_decimal(t)
                ids = joined.split(",") if joined else []
                counts.append(len(ids))
                of_ids.append(sha256_hex(joined.encode()))
                of_text.append(sha256_hex(decoded(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=[doc_id, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(doc_id, text).mapInArrow(
        run, f"`{doc_id}` {df.schema[doc_id].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _make_decoder(model_file: str):
    """Decoder from decimal ids to UTF-8 bytes: pieces by look-up, odd byte runs the slow way."""
    table = _table(model_file)
    as_bytes = {str(i): (bytes([table.raw[i]]) if i in table.raw else s.encode()) for i, s in enumerate(table.shown)}
    cut = table.dummy_prefix

    def decoded(ids: list[str]) -> bytes:
        data = b"".join(map(as_bytes.__getitem__, ids))
        try:
            data.decode()
        except UnicodeDecodeError:
            return table.decode([int(i) for i in ids]).encode()
        if cut and data[:1] == b" ":
            return data[1:] if table.types[int(ids[0])] == NORMAL else table.decode([int(i) for i in ids]).encode()
        return data

    return decoded


_decoder = per_worker(_make_decoder)


def _schema(df: DataFrame, name: str, kind: str, before: StructType | None = None) -> StructType:
    if name in df.columns:
        raise ValueError(f"column {name} exists already; pass another name")
    return StructType(list((before or df.schema).fields)).add(name, StringType() if kind == "text" else ArrayType(IntegerType()))


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))
