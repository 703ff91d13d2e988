"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text is cut where a blank begins a word; no piece reaches over such a place, so each
distinct word is segmented once per worker. Words of equal length advance together: for
every end position and piece length, hashes of all words' substrings are looked up in the
sorted hashes of the pieces, and the best score so far and the length of its last piece are
kept. Walking the lengths back gives the pieces.

The result is the segmentation with the highest sum of the model file's scores, ties going
to the longer last piece. That is what the public library does for a model of unigram kind.
For a file of merge kind (BPE) the library applies merges in order instead; its ids differ
in most texts, while decoding gives the same text.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .common import Cache, mix, slices

BLANK = "▁"
CACHED = 80 << 20  # bytes of words a worker remembers
ROWS = 500  # texts worked on at once
LONG = 200  # longer words go one by one
UNKNOWN_PENALTY = 10.0
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNIT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6  # fixed values: kinds of pieces in the public file format


class Pieces:
    """The pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only files that keep texts as they are can be decoded exactly")
        self.prefix = spec.add_dummy_prefix
        kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type in (_NORMAL, _USER)}
        self.scores = np.array([p.score for p in model.pieces])
        self.bytes = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == _BYTE}
        self.unknown = kinds.index(_UNKNOWN)
        self.item = 2 if len(kinds) <= 1 << 16 else 4
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            raise ValueError("a piece reaches over the start of a word")
        self.floor = min(self.scores[k] for p, k in self.ids.items()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        self.surface = [bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(BLANK, " ").encode()
                        if p.type in (_NORMAL, _USER) else b"" for p in model.pieces]
        keys = np.zeros(len(self.ids), np.uint64)
        for size in range(1, self.longest + 1):
            own = [(n, p) for n, p in enumerate(self.ids) if len(p) == size]
            if own:
                keys[[n for n, _ in own]] = self._key(self._prefixes(_points([p for _, p in own], size)), 0, size)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.fromiter(self.ids.values(), np.int32)[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 22, bool)  # most substrings are no piece: one look tells
        self.maybe[self.keys >> np.uint64(42)] = True
        self.later, self.units = Cache(CACHED), Cache(CACHED // 4)

    def _prefixes(self, points: np.ndarray) -> np.ndarray:
        """Hashes of the first 0, 1, 2, ... characters of each row."""
        coded = mix(points.astype(np.uint64) + np.uint64(1))
        out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
        for k in range(points.shape[1]):
            out[:, k + 1] = out[:, k] * _BASE + coded[:, k]
        return out

    def _key(self, prefixes: np.ndarray, start: int, end: int) -> np.ndarray:
        power = np.uint64(pow(int(_BASE), end - start, 1 << 64))
        return mix(prefixes[:, end] - prefixes[:, start] * power + np.uint64(end - start))

    def _together(self, words: list[str], size: int) -> list[bytes]:
        points, n = _points(words, size), len(words)
        prefixes = self._prefixes(points)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0.0
        back = np.zeros((size + 1, n), np.int32)
        piece = np.full((size + 1, n), self.unknown, np.int32)
        for end in range(1, size + 1):
            single = np.zeros(n, bool)
            for start in range(max(0, end - self.longest), end):
                keys = self._key(prefixes, start, end)
                rows = np.flatnonzero(self.maybe[keys >> np.uint64(42)])
                at = np.minimum(np.searchsorted(self.keys, keys[rows]), len(self.keys) - 1)
                hit = self.keys[at] == keys[rows]
                rows, ids = rows[hit], self.key_ids[at[hit]]
                if start == end - 1:
                    single[rows] = True
                total = best[start, rows] + self.scores[ids]
                better = total > best[end, rows]
                rows = rows[better]
                best[end, rows], back[end, rows], piece[end, rows] = total[better], end - start, ids[better]
            total = best[end - 1] + self.floor
            lost = ~single & (total > best[end])
            best[end, lost], back[end, lost], piece[end, lost] = total[lost], 1, self.unknown
        at, count = np.full(n, size), np.zeros(n, np.int64)
        ids, ends = np.zeros((n, size), np.int32), np.zeros((n, size), np.int32)
        rows = np.arange(n)
        while rows.size:
            ids[rows, size - 1 - count[rows]] = piece[at[rows], rows]
            ends[rows, size - 1 - count[rows]] = at[rows]
            count[rows] += 1
            at[rows] -= back[at[rows], rows]
            rows = rows[at[rows] > 0]
        kind, out = f"<u{self.item}", []
        unsure = (ids == self.unknown) & (np.arange(size) >= size - count[:, None])
        plain = ids.astype(kind)
        for k, (c, odd) in enumerate(zip(count.tolist(), unsure.any(axis=1).tolist())):
            if odd:
                own = [self._of(i, words[k][e - 1]) for i, e in zip(ids[k, size - c:].tolist(), ends[k, size - c:].tolist())]
                out.append(np.array([i for x in own for i in x], kind).tobytes())
            else:
                out.append(plain[k, size - c:].tobytes())
        return out

    def _of(self, piece: int, char: str) -> list[int]:
        """An unknown character as its bytes, if the file has pieces for bytes."""
        if piece != self.unknown or not self.bytes:
            return [piece]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def _alone(self, word: str) -> bytes:
        """The same for one long word."""
        best, last = [0.0], [(0, 0)]
        for end in range(1, len(word) + 1):
            top, choice = -np.inf, (1, self.unknown)
            for start in range(max(0, end - self.longest), end):
                if (k := self.ids.get(word[start:end])) is not None and best[start] + self.scores[k] > top:
                    top, choice = best[start] + self.scores[k], (end - start, k)
            if word[end - 1] not in self.ids and best[end - 1] + self.floor > top:
                top, choice = best[end - 1] + self.floor, (1, self.unknown)
            best.append(top)
            last.append(choice)
        out, at = [], len(word)
        while at:
            out.append(self._of(last[at][1], word[at - 1]))
            at -= last[at][0]
        return np.array([i for x in reversed(out) for i in x], f"<u{self.item}").tobytes()

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of each word, a word being blanks and what follows to the next blank."""
        by_size: dict[int, list[int]] = defaultdict(list)
        for k, word in enumerate(words):
            by_size[len(word)].append(k)
        out: list[bytes] = [b""] * len(words)
        for size, own in by_size.items():
            for at in range(0, len(own), 1 << 15):
                some = own[at:at + (1 << 15)]
                found = [self._alone(words[k]) for k in some] if size > LONG else self._together([words[k] for k in some], size)
                for k, ids in zip(some, found):
                    out[k] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, `item` bytes each."""
        cut = [t.split(" ") if self.prefix and t and BLANK not in t else None for t in texts]
        cut = [None if c is None or "" in c else c for c in cut]
        odd = {k: _UNIT.findall(((BLANK if self.prefix and t else "") + t.replace(" ", BLANK)))
               for k, (t, c) in enumerate(zip(texts, cut)) if c is None}
        for kept, blank, words in ((self.later, BLANK, filter(None, cut)), (self.units, "", odd.values())):
            kept.make_room()
            new = kept.missing(words)
            kept.learn(new, self.segment([blank + w for w in new]))
        return [b"".join(map(self.later.__getitem__, c)) if c is not None else b"".join(map(self.units.__getitem__, odd[k]))
                for k, c in enumerate(cut)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")
        return text[1:] if self.prefix else text


def _points(words: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), size)


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers), round_trip, ids (array, on request).

    round_trip says whether decoding the ids gives the text again; it fails only for texts
    with U+2581, the sign that stands for a blank. NULL counts as empty and has no ids.
    Rows come out as they came in, repeated ones too; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = pieces(model)
        for whole in batches:
            for batch in slices(whole, ROWS):
                texts = batch.column("text").to_pylist()
                ids = [np.frombuffer(x, f"<u{source.item}") for x in source.encode(texts)]
                columns = [batch.column("id"), pa.array([len(x) for x in ids], pa.int64()),
                           pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                           pa.array([source.decode(x) == t for x, t in zip(ids, texts)])]
                if with_ids:
                    ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n_tokens", "ids_crc32", "round_trip"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_crc32 bigint, round_trip boolean" + ", ids array<int>" * with_ids
    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def with_tokens(docs: DataFrame, model: str, text_col: str = "text", name: str = "tokens") -> DataFrame:
    """`docs` with a column of ids; the text is what decoding them gives. NULL texts stay NULL and have no ids.

    A few hundred texts are worked on at once and handed on, so memory does not grow with a batch's texts.
    """
    rest = docs.drop(name)
    schema = StructType([*rest.schema.fields, StructField(name, ArrayType(IntegerType()))])
    at = rest.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = pieces(model)
        for whole in batches:
            for some in slices(whole, ROWS):
                given = some.column(at).to_pylist()
                ids = [np.frombuffer(x, f"<u{source.item}") for x in source.encode([t or "" for t in given])]
                columns = list(some.columns)
                columns[at] = pa.array([None if t is None else source.decode(i) for t, i in zip(given, ids)], pa.string())
                ends = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rest.mapInArrow(work, schema)
