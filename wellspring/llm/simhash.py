"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has bit k set if over half of its word shingles'
XXH64 values have it. Documents link where fingerprints differ in at most
``RADIUS`` = 3 bits, and a group is a connected component of links.

Candidates: two fingerprints within 2 bits share a variant that is within 1
bit (half the radius, rounded down) of both. For the third bit, the 64 bits
fall into ``BLOCKS`` = 4 blocks of 16, and every distinct fingerprint emits the
variants within 1 bit of its other 48 bits once for each left-out block: if
two fingerprints differ in 1 to 3 bits, leaving out a block that holds one of
those bits leaves at most 2, so both emit a common variant. That is 4 * 49 =
196 variants for each distinct fingerprint whatever the data; a full radius of
2 without left-out blocks would take 2,081.

The variants are shuffled; colliding fingerprints are verified by their true
distance inside each bucket, and only a star for each verified group is
emitted, never all pairs. Equal fingerprints are merged before (a group of
copies is one row), so a bucket holds distinct fingerprints only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._graph import components
from wellspring.llm._stage import store, table, take, unpack, with_row
from wellspring.llm._text import U64
from wellspring.operators import skew_join

RADIUS, BLOCKS, SHINGLE, SEED = 3, 4, 3, 42
_BITS = 64 // BLOCKS
_KEPT = 64 - _BITS
_LOW = U64((1 << _KEPT) - 1)
_PAIRWISE = 1024  # buckets up to this size are verified by a distance matrix, larger ones by lookups


# --- fingerprints ---------------------------------------------------------------

def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of every run of ``size`` words, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, seed = xxhash.xxh64_intdigest, SEED
    return [digest(joined[a:b], seed) for a, b in zip(starts[:len(words) - size + 1].tolist(),
                                                     ends[size - 1:].tolist(), strict=True)]


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint; 0 without words."""
    hashes = shingle_hashes(text or b"", size)
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.array(hashes[i:i + 65536], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), size) for t in batch.column(0)], dtype=U64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found.view(np.int64))],
                                             names=[*batch.schema.names[1:], "fp"])
    return run


# --- variants and buckets -------------------------------------------------------------

def _rotated(fps: np.ndarray, block: int, back: bool = False) -> np.ndarray:
    """The bits turned so that ``block`` is on top."""
    turn = (block + 1) * _BITS % 64
    if back:
        turn = (64 - turn) % 64
    return fps if turn == 0 else (fps >> U64(turn)) | (fps << U64(64 - turn))


def _variants(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key: the left-out block's number over the 48 kept bits, one of them or none
    turned; code: the left-out bits, and which bit was turned (0: none)."""
    flips = np.concatenate([[0], U64(1) << np.arange(_KEPT, dtype=U64)]).astype(U64)
    which = np.arange(_KEPT + 1, dtype=np.int32)
    for batch in batches:
        fps = np.asarray(batch.column(0)).view(U64)
        for i in range(0, len(fps), 2000):
            for block in range(BLOCKS):
                turned = _rotated(fps[i:i + 2000], block)
                keys = ((turned & _LOW)[:, None] ^ flips[None, :]) | U64(block << _KEPT)
                codes = ((turned >> U64(_KEPT)).astype(np.int32) * 64)[:, None] + which[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(codes.ravel())],
                                                 names=["key", "code"])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _restore(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    flip = codes % 64
    kept = (keys & _LOW) ^ np.where(flip > 0, U64(1) << (np.maximum(flip, 1) - 1).astype(U64), U64(0))
    turned = kept | ((codes // 64).astype(U64) << U64(_KEPT))
    block = (keys >> U64(_KEPT)).astype(np.int64)
    out = np.zeros(len(keys), U64)
    for b in range(BLOCKS):
        own = block == b
        out[own] = _rotated(turned[own], b, back=True)
    return out


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each member's group, from linked index pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _bucket_links(fps: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Star links (member, first member) of the groups within one bucket."""
    n = len(fps)
    if n <= _PAIRWISE:
        left, right = np.nonzero(np.triu(_distance(fps[:, None], fps[None, :]) <= RADIUS, 1))
    else:
        left, right = _lookup_pairs(codes)
    root = _roots(n, left, right)
    moved = np.flatnonzero(root != np.arange(n))
    return np.stack([fps[moved], fps[root[moved]]], axis=1)


def _lookup_pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all of a large bucket's linked members, in time linear
    in its size. Members whose left-out bits agree are within 2 bits: a star
    each. Left-out bits 1 apart: within 3 bits, so one pair joins both stars.
    2 apart: linked if the kept bits are at most 1 apart, so if one has no
    turned bit, or both turned the same one. 3 apart: if both turned the same.
    """
    out, flip = codes // 64, codes % 64
    order = np.lexsort((flip, out))
    groups, at = np.unique(out[order], return_index=True)
    first = order[at]  # of each left-out value; a member without turned bit where there is one
    place = np.full(1 << _BITS, -1, np.int64)
    place[groups] = first
    whole = np.full((1 << _BITS) * 64, -1, np.int64)
    whole[codes] = np.arange(len(codes))
    left, right = [place[out]], [np.arange(len(codes))]
    one = 1 << np.arange(_BITS)
    two = [a | b for i, a in enumerate(one) for b in one[:i]]
    three = [a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    for p in one:
        other = place[out[first] ^ p]
        left.append(first[other >= 0])
        right.append(other[other >= 0])
    unturned = first[flip[first] == 0]
    for p in two:
        other = place[out[unturned] ^ p]
        left.append(unturned[other >= 0])
        right.append(other[other >= 0])
    for p in [*two, *three]:
        other = whole[(out ^ p) * 64 + flip]
        left.append(np.flatnonzero(other >= 0))
        right.append(other[other >= 0])
    return np.concatenate(left), np.concatenate(right)


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links from rows sorted by key; buckets may span batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append((np.asarray(batch.column(0)).view(U64), np.asarray(batch.column(1))))
        rows += batch.num_rows
        if rows < 200_000:
            continue
        keys, codes = (np.concatenate(x) for x in zip(*held, strict=True))
        whole = len(keys) - int((keys[::-1] != keys[-1]).argmax()) if keys[0] != keys[-1] else 0
        if whole:
            yield from _chunk_links(keys[:whole], codes[:whole])
        held, rows = [(keys[whole:], codes[whole:])], len(keys) - whole
    if rows:
        keys, codes = (np.concatenate(x) for x in zip(*held, strict=True))
        yield from _chunk_links(keys, codes)


def _chunk_links(keys: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    pairs = starts[sizes == 2]
    a, b = _restore(keys[pairs], codes[pairs]), _restore(keys[pairs], codes[pairs + 1])
    near = _distance(a, b) <= RADIUS
    found = [np.stack([a[near], b[near]], axis=1)]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        found.append(_bucket_links(_restore(keys[s:s + n], codes[s:s + n]), codes[s:s + n]))
    links = np.concatenate(found)
    if len(links):
        links = np.unique(np.sort(links, axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].view(np.int64)), pa.array(links[:, 1].view(np.int64))],
                                         names=["a", "b"])


# --- the operator ------------------------------------------------------------------------

def near_groups(fps: DataFrame) -> DataFrame:
    """``fps(fp, ...)`` to ``(fp, root)``: for every distinct fingerprint, the
    representative fingerprint of its component."""
    distinct = store(fps.select("fp").distinct(), "simhash_distinct")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored fingerprints lie in few files, and each becomes 196 rows: deal them out first
    buckets = (distinct.repartition(parts, "fp").mapInArrow(_variants, "key long, code int")
               .repartition(parts, "key").sortWithinPartitions("key", "code"))
    links = buckets.mapInArrow(_links, "a long, b long")
    roots = store(components(links), "simhash_roots")
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs(doc_id, text, ...)`` to ``(doc_id, fp, component_id)``, a row for each row.

    ``component_id`` is the smallest doc_id of the group. Null or wordless
    texts have fingerprint 0 and link like any other. A null doc_id joins its
    group but names it only if all its ids are null (component_id null);
    repeated rows are members each. An empty table gives no rows; other
    columns are ignored.
    """
    base = take(docs, "text", "doc_id").select(F.col("text").cast("binary").alias("text"), "doc_id")
    fps = store(base.mapInArrow(_fingerprints(size), "doc_id long, fp long")
                .withColumn("rid", F.monotonically_increasing_id()), "simhash_fps")
    groups = near_groups(fps)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = store(groups.join(least, "fp"), "simhash_named")
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # a third of the rows may share a fingerprint, a third of the fingerprints a group: such keys are cut into pieces
    by_fp = skew_join(named.select("fp", "root"), heads, "root", row_key=["fp"]).select("fp", "component_id")
    return skew_join(fps, by_fp, "fp", row_key=["rid"]).select("doc_id", "fp", "component_id")


def keep_one_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each near-duplicate group: the row with the smallest
    doc_id (null last; ties by a digest of the whole row).
    Returns the columns of ``docs``."""
    columns = docs.columns
    base = with_row(docs, "text")
    fps = store(base.select(F.col("text").cast("binary").alias("text"), "_ws_row")
                .mapInArrow(_fingerprints(size), base.select("_ws_row").schema.add("fp", "long")), "simhash_rows")
    groups = near_groups(fps)
    at = columns.index("doc_id")
    key = F.struct(F.col(f"_ws_row.c{at}").isNull().alias("none"), F.col(f"_ws_row.c{at}").alias("id"),
                   F.md5(F.to_json("_ws_row")).alias("row"))
    keyed = fps.withColumn("k", key)
    # small rows decide (smallest key per fingerprint, then per group, combined per task); texts move once
    least = keyed.groupBy("fp").agg(F.min("k").alias("k")).join(groups, "fp")
    heads = least.groupBy("root").agg(F.min(F.struct("k", "fp")).alias("h")).select("h.fp", "h.k")
    return (keyed.join(heads, ["fp", "k"]).groupBy("fp", "k").agg(F.first("_ws_row").alias("_ws_row"))
            .select(*unpack(columns)))


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
