"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct shingles of five words. Minima of 224 hash functions
over the set are cut into 32 bands, of 7 from 85 % on and of fewer below (`band_rows`);
documents that agree in a band are candidates.
Only the low two bits of each minimum are kept for estimating: seven packed numbers, whose
agreement is counted with bit operations and corrected for chance agreement. Candidates
whose estimate is within five standard deviations of the threshold are confirmed on their
full sets, so every link returned is exact; a link just at the threshold is missed with a
chance of about 4 in a million (3 at 80 %).

What keeps it linear where groups are large:

* documents with equal sets are one class; only classes are compared;
* the members of a band's bucket are compared with its least member first; only buckets
  in which that fails are looked at further, in pairs of blocks, and each pair of blocks
  returns a spanning forest of its candidates, never all pairs;
* a family of candidates is confirmed in pairs of blocks likewise: the most alike first,
  and nothing that is already linked is compared again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected, in_block_pairs, join_crowded, mix, per_group, row_key, slices, written

WORDS, BANDS, ROWS, BITS = 5, 32, 7, 2
HASHES = BANDS * ROWS
MISSED = 5e-6  # chance that a pair just at the threshold meets in no band
LONGS = HASHES * BITS // 64
BLOCK = 256
CHUNK = 1 << 15  # shingles hashed at once: they stay in the processor's cache

_rng = np.random.default_rng(20240501)
_TIMES = _rng.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)
_PLUS = _rng.integers(0, 1 << 64, HASHES, np.uint64)
_PLACE = _rng.integers(0, 1 << 64, WORDS, np.uint64) | np.uint64(1)
_ROW = _rng.integers(0, 1 << 64, ROWS, np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 1 << 64, BANDS, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word 5-grams; of the whole sequence where it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    last = len(words) - WORDS + 1
    total = hashed[:last] * _PLACE[0]
    for k in range(1, WORDS):
        total += hashed[k:last + k] * _PLACE[k]
    return np.unique(mix(total))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Least value of each hash function over each non-empty set: uint32, one row per set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= CHUNK):
            size += len(sets[last])
            last += 1
        joined = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        for k in range(HASHES):
            value = joined * _TIMES[k]
            value += _PLUS[k]
            out[first:last, k] = np.minimum.reduceat(value, starts) >> np.uint64(32)
        first = last
    return out


def band_rows(percent: int) -> int:
    """Minima in a band: as many as miss no more than `MISSED` of the pairs at the threshold, `ROWS` at most."""
    return next((r for r in range(ROWS, 1, -1) if (1 - (percent / 100) ** r) ** BANDS <= MISSED), 1)


def band_keys(least: np.ndarray, rows: int = ROWS) -> np.ndarray:
    folded = (least[:, :BANDS * rows].reshape(-1, BANDS, rows).astype(np.uint64) * _ROW[:rows]).sum(axis=2, dtype=np.uint64)
    return mix(folded + _BAND).view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 32 to a 64-bit number."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, LONGS, 64 // BITS)
    return (low << np.arange(0, 64, BITS, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def agreeing(similarity: float) -> float:
    """Expected share of agreeing low bits: equal minima, or unequal ones that agree by chance."""
    return similarity + (1 - similarity) / 2**BITS


def least_agreement(threshold: float) -> int:
    """Agreeing positions below which a pair cannot plausibly reach the threshold (five standard deviations)."""
    p = agreeing(threshold)
    return math.floor(HASHES * p - 5 * math.sqrt(HASHES * p * (1 - p)))


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Agreeing positions of packed signatures along the last axis."""
    differ = a ^ b
    return HASHES - np.bitwise_count((differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=-1, dtype=np.int32)


def agreement_sql(a: Column, b: Column) -> Column:
    """The same as a column of two arrays of longs."""
    unlike = []
    for k in range(LONGS):
        differ = a[k].bitwiseXOR(b[k])
        unlike.append(F.bit_count(differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))))
    return F.lit(HASHES) - sum(unlike[1:], unlike[0])


def sketches(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Per row: id, row key, set size, 16-byte identity of the set, band keys and packed low bits (NULL for no words)."""
    in_band = band_rows(percent)
    rows = docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (some for whole in batches for some in slices(whole)):
            sets = [shingles(x.as_py()) for x in batch.column("text")]
            full = [s for s in sets if len(s)]
            least = minima(full) if full else np.empty((0, HASHES), np.uint32)
            where = np.cumsum([0] + [len(s) > 0 for s in sets]).astype(np.int32)
            valid = pa.array([len(s) == 0 for s in sets])

            def lists(values: np.ndarray, width: int) -> pa.Array:
                flat = pa.array(values.reshape(-1).view(np.int64))
                return pa.ListArray.from_arrays(pa.array(where * width, pa.int32()), flat, mask=valid)

            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                lists(band_keys(least, in_band), BANDS), lists(packed(least), LONGS)],
                names=["id", "key", "n", "set", "bands", "bits"])

    return rows.mapInArrow(sketch, f"id {kind}, key binary, n bigint, set binary, bands array<bigint>, bits array<bigint>")


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.view(np.uint64).reshape(len(lists), -1)


def _alike(group: pa.Table, percent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a pair of blocks whose sizes and low bits allow the threshold, the most alike first."""
    bits, n = _matrix(group.column("bits")), group.column("n").to_numpy()
    if group.column("lo")[0].as_py() == group.column("hi")[0].as_py():
        left = right = np.arange(len(n))
    else:
        block = group.column("block").to_numpy()
        left, right = (np.flatnonzero(block == group.column(k)[0].as_py()) for k in ("lo", "hi"))
    found = []
    for at in range(0, len(left), 64):
        rows = left[at:at + 64]
        same = agreement(bits[rows][:, None, :], bits[right][None, :, :])
        small, great = np.minimum.outer(n[rows], n[right]), np.maximum.outer(n[rows], n[right])
        ok = (same >= least) & (100 * small >= percent * great)
        if left is right:
            ok &= rows[:, None] < right[None, :]
        i, j = np.nonzero(ok)
        found.append(np.stack([rows[i], right[j], same[i, j]]))
    a, b, same = np.concatenate(found, axis=1)
    order = np.argsort(-same, kind="stable")
    return a[order], b[order]


def _links(group: pa.Table, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    names = group.column("set").to_pylist()
    return pa.RecordBatch.from_arrays(
        [pa.array([names[i] for i, _ in pairs], pa.binary()), pa.array([names[j] for _, j in pairs], pa.binary())], names=["a", "b"])


def _forest(group: pa.Table, percent: int, least: int, confirm: bool) -> pa.RecordBatch | None:
    """Pairs that connect the block pair's alike members, each confirmed on full sets if asked."""
    a, b = _alike(group, percent, least)
    parent, kept = list(range(group.num_rows)), []
    sets: dict[int, np.ndarray] = {}
    texts = group.column("text") if confirm else None
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = _root(parent, i), _root(parent, j)
        if x == y:
            continue
        if confirm:
            for k in (i, j):
                if k not in sets:
                    sets[k] = shingles(texts[k].as_py())
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common < percent * (len(sets[i]) + len(sets[j]) - common):
                continue
        parent[y] = x
        kept.append((i, j))
    return _links(group, kept) if kept else None


def _families(classes: DataFrame, percent: int, least: int) -> DataFrame:
    """(set, family): classes that candidate links connect."""
    members = classes.select("set", F.explode("bands").alias("band"))
    buckets = written(members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("set").alias("center")).where("size > 1"), "buckets")
    met = written(join_crowded(members, buckets, "band", "set", BLOCK), "met")
    spokes = met.where(F.col("set") != F.col("center")).select("set", "center").distinct()
    left = classes.select("set", F.col("bits").alias("bits_a"), F.col("n").alias("n_a"))
    right = classes.select(F.col("set").alias("center"), F.col("bits").alias("bits_b"), F.col("n").alias("n_b"))
    judged = written(spokes.join(left, "set").join(right, "center").select(
        "set", "center",
        ((agreement_sql(F.col("bits_a"), F.col("bits_b")) >= least)
         & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))).alias("alike")), "spokes")
    # Where a member is unlike the centre, it may still be like another member.
    open_buckets = met.where("size > 2").join(judged.where("NOT alike"), ["set", "center"]).select("band", "size").distinct()
    rest = join_crowded(met.select("band", "set"), open_buckets, "band", "set", BLOCK)
    blocks = in_block_pairs(rest, "band", F.col("size"), "set", BLOCK).join(classes.select("set", "n", "bits"), "set")
    more = per_group(blocks, ["band", "lo", "hi"], lambda g: _forest(g, percent, least, False), "a binary, b binary")
    links = judged.where("alike").select(F.col("set").alias("a"), F.col("center").alias("b")).union(more)
    return connected(links).select(F.col("node").alias("set"), F.col("root").alias("family"))


def _components(docs: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and per set of shingles the first row (no_id, id, key) of its component."""
    least = least_agreement(percent / 100)
    rows = written(sketches(docs, id_col, text_col, percent), "sketches")
    classes = written(
        rows.where("n > 0").groupBy("set").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("bits").alias("bits")), "classes")
    families = written(_families(classes, percent, least), "families")
    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    suspects = classes.join(families, "set").join(sizes, "family").select("set", "family", "size", "first.key", "n", "bits")
    texts = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    with_text = suspects.join(texts, "key").dropDuplicates(["key"])
    blocks = in_block_pairs(with_text, "family", F.col("size"), "set", BLOCK).drop("key", "size")
    links = per_group(blocks, ["family", "lo", "hi"], lambda g: _forest(g, percent, least, True), "a binary, b binary")
    roots = connected(links).select(F.col("node").alias("set"), "root")
    rooted = written(classes.select("set", "first").join(roots, "set", "left").select(
        "set", "first", F.coalesce("root", "set").alias("root")), "roots")
    return rows, rooted.join(rooted.groupBy("root").agg(F.min("first").alias("head")), "root").select("set", "head")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id (least id that links reach), kept (it is its own component).

    Two documents are linked when 100 * |A & B| >= percent * |A | B| holds for their
    shingle sets. NULL, empty and blank texts have an empty set and are linked with
    nothing. Rows with a NULL id take part, but lend no id to a component: it is NULL only
    where every member's is. Repeated rows come out as often as they came in, all with the
    same answer. Other columns of `docs` are not read.
    """
    rows, heads = _components(docs, id_col, text_col, percent)
    joined = rows.select("id", "n", "set").join(heads.select("set", "head.id").withColumnRenamed("id", "component"), "set", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of `docs` with one row left of each component, all columns as they were.

    The row with the least id stays, one without an id only where none has one; of repeated
    rows one stays. Rows without words are linked with nothing and all stay.
    """
    _, heads = _components(docs, id_col, text_col, percent)
    stays = heads.select(F.col("head.key").alias("__key")).distinct()
    blank = F.length(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "[\\x20\\x09-\\x0D]+", "")) == 0
    keyed = docs.withColumn("__key", row_key(F.col(id_col), F.col(text_col))).withColumn("__blank", blank)
    full = keyed.where("NOT __blank").join(stays, "__key", "left_semi").dropDuplicates(["__key"])
    return full.select(*docs.columns).union(keyed.where("__blank").select(*docs.columns))
