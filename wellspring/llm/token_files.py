"""Token ids as Parquet list columns, for selective reads.

``write_tokens`` encodes texts with a byte-level BPE and writes one row per
document in ascending doc_id order: ``doc_id``, ``shard``, ``local_start`` (ids
before it in its shard), ``n_tokens`` and ``ids`` (a list of ints). The columns
are laid out for their use:

* ``ids`` are dictionary encoded (16 bits an id for a 50k vocabulary) and
  compressed; ``doc_id``, ``local_start`` and ``n_tokens`` are delta encoded
  (Parquet format version 2, no dictionary), a few bits each as they ascend;
* row groups of 32 MB, pages of 256 KB and 20,000 rows at most, with Parquet's page
  indexes (minimum and maximum of each page): a filter on doc_id opens only
  the row groups and pages that can hold it, and reading metadata only
  (lengths, ids of documents) does not touch the token pages.

``start``, the ids of all documents before one, needs the sizes of the shards
before it: a manifest of one row per shard holds the first id's number.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspring.llm._stage import store, table, take
from wellspring.llm._text import byte_rows, gather_runs, regroup
from wellspring.llm._units import UnitCache, by_items, list_column, put_together, unit_codes
from wellspring.operators.scans import fresh_path

END_ID = 2
PARQUET = {
    "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "20000",
    "parquet.dictionary.page.size": str(2 << 20), "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# A cut before a white-space byte needs a byte before it that ends no white space: not an ASCII separator
# (0x1C-0x1F), and no character whose second-last byte is one that Unicode's other spaces have there.
_BEFORE = ~_SPACE.copy()
_BEFORE[0x1C:0x20] = False
_SECOND_LAST = np.zeros(256, bool)
_SECOND_LAST[[0xC2, 0x9A, 0x80, 0x81]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)  # ASCII punctuation
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_AFTER_MARK = _MARK.copy()
_AFTER_MARK[0x27] = False  # an apostrophe may take the letters behind it
_BREAK = _SPACE.copy()
_BREAK[0x20] = False  # a space may go with the piece behind it
# The same as bits of one table, from the lowest: space, may stand before a cut, ASCII, second-last of a space, mark,
# break, letter, mark that no letters belong to.
_KIND = np.zeros(256, np.uint8)
for _bit, _has in enumerate((_SPACE, _BEFORE, np.arange(256) < 0x80, _SECOND_LAST, _MARK, _BREAK, _LETTER, _AFTER_MARK)):
    _KIND |= (_has.astype(np.uint8) << _bit).astype(np.uint8)
_encoders: dict[str, UnitCache] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str) -> UnitCache:
    """One encoder for each Python worker. Strings of special tokens in a text are ordinary text."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True

        line_break = tokenizer.encode("\n", add_special_tokens=False).ids

        def encode(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            """Plain units are encoded as one text, a line break before each (a call for every unit would
            cost more than its work): the pattern makes it a piece of its own, so its id parts them."""
            data = np.frombuffer(b"".join(units) + b"\n\n", np.uint8)
            ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
            plain = _plain(data, np.concatenate([np.zeros(1, np.int64), ends])[:-1], ends) & (len(line_break) == 1)
            order, flat, sizes = [], [], []
            for i in np.flatnonzero(~plain).tolist():
                found = tokenizer.encode(units[i].decode(), add_special_tokens=False).ids
                order.append([i])
                flat.append(np.array(found, np.int32))
                sizes.append([len(found)])
            own = np.flatnonzero(plain)
            for part in np.array_split(own, len(own) // 10_000 + 1):
                if len(part):
                    text = b"\n" + b"\n".join([units[i] for i in part.tolist()])
                    found = np.array(tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.int32)
                    cut = np.flatnonzero(found == line_break[0])
                    order.append(part)
                    flat.append(np.delete(found, cut))
                    sizes.append(np.diff(np.append(cut, len(found))) - 1)
            if not order:
                return np.zeros(0, np.int32), np.zeros(0, np.int64)
            order, flat, sizes = (np.concatenate(x) for x in (order, flat, sizes))
            back = np.argsort(order)
            return gather_runs(flat, (np.cumsum(sizes) - sizes)[back], sizes[back]), sizes[back].astype(np.int64)
        _encoders[path] = UnitCache(encode)
    return _encoders[path]


def _safe_end(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the bytes before each end surely end no white space."""
    last = data[ends - 1]
    return _BEFORE[last] & ((last < 0x80) | ~_SECOND_LAST[data[np.maximum(ends - 2, 0)]])


def _plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Units without white space, or with one space in front of something else, that
    surely neither start (behind the space) nor end with another kind of white space."""
    first = starts + (data[starts] == 0x20)
    lead = data[first]
    spaces = np.concatenate([[0], np.cumsum(_SPACE[data], dtype=np.int64)])
    fine = (first < ends) & (spaces[np.maximum(ends, first)] == spaces[first]) & ((lead < 0x80) & ((lead < 0x1C) | (lead > 0x1F)) | (lead >= 0xC3) & (lead < 0xE0))
    out = np.zeros(len(starts), bool)
    out[fine] = _safe_end(data, ends[fine])
    return out


def bpe_cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Row boundaries and places where the byte-level BPE's pattern starts a new piece
    whatever stands around, so a text's ids are those of its parts: before white space
    behind something else, between an ASCII letter and a mark behind it, between a
    mark (no apostrophe) and a letter, and behind a single white-space character other than a space."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 3:
        kind = _KIND[data]  # one look-up, then bits
        here, back, second = kind[1:], kind[:-1], kind[:-2]
        space = here & back >> 1 & 1
        space[1:] &= back[1:] >> 2 | ~second >> 3
        single = here[1:] >> 6 | here[1:] >> 4  # a letter or a mark, behind a break that a cut lies before
        single &= space[:-1] & back[1:] >> 5
        cut[1:-1] = (space | back >> 6 & here >> 4 | back >> 7 & here >> 6) & 1
        cut[2:-1] |= (single & 1).astype(bool)
    cut[offs] = True
    return np.flatnonzero(cut)


def _encode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard, start = _encoder(path), TaskContext.get().partitionId(), 0
        for batch in regroup(batches, "text", max_bytes=6 << 20):
            data, offs = byte_rows(batch.column(1))
            cuts = bpe_cuts(data, offs)
            codes, units = unit_codes(data, cuts)
            flat, starts, lens = cache.ids(units)
            ids, at = put_together(codes, flat, starts, lens, np.searchsorted(cuts, offs))
            ids = np.insert(ids, at[1:], END_ID)
            at = at + np.arange(len(at))
            sizes = np.diff(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), shard, np.int32)), pa.array(start + at[:-1]),
                 pa.array(sizes), list_column(ids, at)],
                names=["doc_id", "shard", "local_start", "n_tokens", "ids"])
            start += int(at[-1])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode ``docs(doc_id, text, ...)`` and write token files to ``path``.

    Null text is empty: its document holds the end id only. Null ids come
    first; rows with one id follow each other in an order fixed by their text;
    an empty table writes files without rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = take(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    placed = (base.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie")
              .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    rows = placed.mapInArrow(_encode(tokenizer or default_tokenizer()),
                             "doc_id long, shard int, local_start long, n_tokens long, ids array<int>")
    rows.write.options(**PARQUET).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The documents of token files, with ``start``; only the asked-for columns are read."""
    rows = spark.read.parquet(path)
    columns = columns or ["doc_id", "start", "n_tokens", "ids"]
    if "start" not in columns:
        return rows.select(*columns)
    sizes = store(rows.groupBy("shard").agg(F.sum("n_tokens").alias("size")), "token_manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    first = sizes.select(F.col("shard").alias("s"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return (rows.join(first, rows["shard"] == first["s"])
            .withColumn("start", F.col("base") + F.col("local_start")).select(*columns))


def _checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_items(batches, 3):
        lists = batch.column(3)
        values = np.asarray(lists.flatten()).astype("<u4")
        offs = np.asarray(lists.offsets) - (lists.offsets[0].as_py() if len(lists) else 0)
        raw = memoryview(values.tobytes())
        sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(offs).astype(np.int64)),
                                          pa.array(sums, pa.int64())],
                                         names=["doc_id", "start", "stated", "n_tokens", "ids_crc32"])


def op9_token_files(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = fresh_path(docs, "token_files", temporary=True)
    write_tokens(docs, path)
    back = read_tokens(spark, path, ["doc_id", "start", "n_tokens", "ids"])
    return (back.mapInArrow(_checksums, "doc_id long, start long, stated long, n_tokens long, ids_crc32 long")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))
