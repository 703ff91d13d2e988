"""Token ids on disk: concatenated id arrays whose document boundaries are Elias-Fano coded.

A file holds the ids of many documents in a row. Its n + 1 boundaries are a rising
sequence, and so are the document ids: both are stored by Elias-Fano coding (the low bits
of each value packed, the high bits as gaps in unary), about 2 + log2(ids / documents)
bits each, with the place of every 256th value for direct access. No table of 64-bit
offsets exists.

Documents are dealt out in ranges of ascending ids; each task writes files of bounded
size one after the other and reports them. The table of reports is written before it is
used, so what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .common import Cache, slices

MAGIC = b"EFTOK1\x00\x00"
FILE_IDS = 8_000_000  # ids in a file, unless one document alone has more
CACHED = 300 << 20  # bytes of words a worker remembers
LOT = 100  # new words given to the library as one text
SAMPLE = 256
READERS = 10_000


# --- Elias-Fano -------------------------------------------------------------------


class EliasFano:
    """A rising sequence of non-negative integers in nearly the least space."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.n, self.width, self.low, self.high, self.places = n, width, low, high, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        width = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = np.packbits(((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.places.astype("<u4").tobytes()]
        return struct.pack("<QBQQQ", self.n, self.width, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        n, width, *sizes = struct.unpack_from("<QBQQQ", data)
        at = struct.calcsize("<QBQQQ")
        low, high, places = (np.frombuffer(data, np.uint8, size, at + sum(sizes[:k])) for k, size in enumerate(sizes))
        return cls(n, width, low, high, places.view("<u4")), at + sum(sizes)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        low = np.unpackbits(self.low, count=self.n * self.width, bitorder="little").reshape(self.n, self.width).astype(np.uint64)
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)) | (
            low << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sampled place on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.places[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        bits[:place % 8] = 0
        while (found := int(bits.sum())) <= left:
            left -= found
            byte += 1
            bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        one = byte * 8 + int(np.flatnonzero(bits)[left])
        first = i * self.width
        low = np.unpackbits(self.low[first // 8:(first + self.width + 7) // 8], bitorder="little")[first % 8:first % 8 + self.width]
        return (one - i << self.width) | sum(int(b) << k for k, b in enumerate(low))


# --- files ------------------------------------------------------------------------


def file_bytes(doc_ids: list[int | None], tokens: list[bytes], item: int) -> bytes:
    """doc_ids ascend, NULL first; tokens are little-endian ids of `item` bytes each."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([0] + [len(t) // item for t in tokens])
    parts = [EliasFano.of(ends).to_bytes(), EliasFano.of((known - least).view(np.uint64)).to_bytes()]
    head = struct.pack("<8sBQqQQ", MAGIC, item, len(doc_ids) - len(known), least, *map(len, parts))
    return b"".join([head, *parts, *tokens])


class TokenFile:
    """A file that was read: doc_ids, bounds (Elias-Fano) and the id array."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, item, nulls, least, first, second = struct.unpack_from("<8sBQqQQ", view)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize("<8sBQqQQ")
        self.bounds, _ = EliasFano.from_bytes(view[at:at + first])
        known, _ = EliasFano.from_bytes(view[at + first:at + first + second])
        self.doc_ids: list[int | None] = [None] * nulls + (known.all().view(np.int64) + least).tolist()
        self.ids = np.frombuffer(view, "<u2" if item == 2 else "<u4", offset=at + first + second)

    def tokens(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


# --- encoding ---------------------------------------------------------------------

# White space on both sides of a blank: the pre-tokenizer may then join across it.
_JOINED = re.compile(r" (?:(?=[\s᠎])|(?<=[\s᠎] ))")


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them.

    Byte-level BPE cuts a text into words first, and a blank between two other characters
    always starts a word. Such texts are cut at blanks and each distinct piece is encoded
    once per worker; all other texts, and all texts of other tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        pre = told.get("pre_tokenizer") or {}
        self.cuts = (not told.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                     and pre.get("use_regex", True) and not told.get("truncation") and not told.get("padding")
                     and (told.get("model") or {}).get("dropout") is None)
        self.special = [t["content"] for t in told.get("added_tokens") or []]
        self.item = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.first, self.later = Cache(CACHED // 8), Cache(CACHED)

    def _whole(self, texts: list[str]) -> list[bytes]:
        kind = f"<u{self.item}"
        return [np.array(e.ids, kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The same for words: those without any white space inside are joined by line breaks, whose id shows where each ends."""
        plain = [k for k, w in enumerate(words) if self.line is not None and w.split() == [w.lstrip(" ")] and "\u180e" not in w]
        texts = ["\n".join([words[k] for k in plain[at:at + LOT]]) + "\n" for at in range(0, len(plain), LOT)]
        out, kind, at = [b""] * len(words), f"<u{self.item}", 0
        for coded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(coded.ids, kind)
            ends = (np.flatnonzero(ids == self.line) * self.item).tolist()
            data, begin = ids.tobytes(), 0
            for k, end in zip(plain[at:at + LOT], ends, strict=True):
                out[k] = data[begin:end]
                begin = end + self.item
            at += LOT
        odd = list(set(range(len(words))).difference(plain))
        for k, ids in zip(odd, self._whole([words[k] for k in odd])):
            out[k] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if not self.cuts or _JOINED.search(t) or any(s in t for s in self.special)]
        out: list[bytes | None] = [None] * len(texts)
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        cut = [(i, t.split(" ")) for i, t in enumerate(texts) if out[i] is None]
        heads = [pieces.pop(0) for _, pieces in cut]
        for kept, blank, words in ((self.first, "", [heads]), (self.later, " ", [pieces for _, pieces in cut])):
            kept.make_room()
            new = kept.missing(words)
            kept.learn(new, self._words([blank + w for w in new]))
        find = self.later.__getitem__
        for head, (i, pieces) in zip(heads, cut):
            out[i] = self.first[head] + b"".join(map(find, pieces))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 file_ids: int = FILE_IDS) -> DataFrame:
    """Encode every text (NULL: empty), add `end_id`, write files in ascending id order; the files as a table.

    Returns (part, seq, file, docs, ids), written to `folder` beside the files: the files
    in the order of (part, seq) hold the documents in ascending id order, NULL ids first.
    Repeated rows are written as often as they come. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(F.col("id")).sortWithinPartitions("id", F.length("text"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, part = encoder(tokenizer), TaskContext.get().partitionId()
        store, path = fs.FileSystem.from_uri(folder)
        end = end_id.to_bytes(source.item, "little")
        ids: list[int | None] = []
        tokens: list[bytes] = []
        size = seq = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, tokens, size, seq
            name = f"part-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.tok"
            store.create_dir(path, recursive=True)
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(file_bytes(ids, tokens, source.item))
            done = pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "file": name, "docs": len(ids), "ids": size // source.item}], schema)
            ids, tokens, size, seq = [], [], 0, seq + 1
            return done

        for batch in batches:
            for piece in slices(batch):
                for i, coded in zip(piece.column("id").to_pylist(), source.encode(piece.column("text").to_pylist())):
                    if ids and size + len(coded) + len(end) > file_ids * source.item:
                        yield flush()
                    ids.append(i)
                    tokens.append(coded + end)
                    size += len(coded) + len(end)
        if ids:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
    files = dealt.mapInArrow(write, "part int, seq int, file string, docs bigint, ids bigint")
    files.write.parquet(f"{folder}/files")
    return docs.sparkSession.read.schema(files.schema).parquet(f"{folder}/files")


def read_tokens(files: DataFrame, folder: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Per document from the files: id, start (ids of all documents before), n_tokens, ids_crc32, tokens (on request).

    The running total over files is one small row per file; the files are read in parallel.
    """
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).select("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_stream(f"{path}/{name}") as source:
                    found = TokenFile(source.read())
                bounds = found.bounds.all().astype(np.int64)
                for at in range(0, len(found.doc_ids), 1000):
                    edge = bounds[at:at + 1001]
                    wide = found.ids[edge[0]:edge[-1]].astype("<u4")
                    cuts = (edge - edge[0]).tolist()
                    data = memoryview(wide).cast("B")
                    columns = [pa.array(found.doc_ids[at:at + 1000], pa.int64()), pa.array(start + edge[:-1]),
                               pa.array(np.diff(edge)), pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(cuts, cuts[1:])], pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(wide.view("<i4"))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "start", "n_tokens", "ids_crc32"] + ["tokens"] * with_ids
    tasks = max(1, min(files.count(), READERS))  # a table this small would otherwise be read by one task
    return placed.repartition(tasks).mapInArrow(
        read, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", tokens array<int>" * with_ids)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Write the documents' tokens into the cluster's shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, tokenizer, end_id, folder, id_col, text_col), folder, id_col, with_ids)
