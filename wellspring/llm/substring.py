"""Exact substring dedup with difference-cover anchors.

A window is ``WINDOW`` = 35 consecutive words. Every window whose word sequence
also starts anywhere else (same document included) goes, all copies of it.

Hashing every window would shuffle one row per word. Instead only positions
whose number modulo ``period`` = 21 is in the difference cover (5 of 21) send a
hash of 15 words. For any two positions i, j some k < 21 makes i + k and j + k
both cover positions, and 21 + 15 - 1 = 35: two equal windows always share an
aligned anchor inside them. Anchors that occur once are thereby proof that
nothing around them repeats. An anchor that repeats is extended: the up to 21
windows around it are hashed in full (128 bits) and shuffled, and those that
occur twice are removed.

Steps, each stored so that lost executors repeat at most one:

1. equal texts are merged into one row with a count of copies;
2. anchors, grouped by hash -> repeating anchors of each text;
3. windows around these, grouped by 128-bit hash -> repeating windows;
4. texts joined with their repeating windows -> kept words, joined back to the
   documents by a 128-bit digest of the text.

Equal hashes within a batch are merged before each shuffle (one row goes, the
rest are known to repeat), so a passage that a third of all documents share
sends one row per batch of texts to a task, not one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm._stage import store, table, take, unpack, with_row
from wellspring.llm._text import (U64, _mix, byte_rows, find_words, hash_spans, regroup, rows_of,
                                  window_hashes)
from wellspring.operators import skew_join
from wellspring.operators.joins import MIN_ROWS

WINDOW = 35
# Perfect difference sets: every difference modulo the period occurs once.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}
_BASE1, _BASE2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD95  # odd, 5 modulo 8
_DIGEST = ("_ws_d1", "_ws_d2")


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length: the longest period whose anchor
    (window - period + 1 words) is at least half as long."""
    period = max(p for p in COVERS if window - p + 1 >= max(1, (p + 1) // 2))
    return period, COVERS[period], window - period + 1


def _digest(text):
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _merged(rid, pos, keys: list[np.ndarray], weight: np.ndarray) -> pa.RecordBatch:
    """One row for each hash of the batch, with weight 2 if it occurs twice; the
    other places of such a hash go under a hash of their own with weight 2."""
    _, first, inverse, count = np.unique(keys[0], return_index=True, return_inverse=True, return_counts=True)
    lead = first[inverse]
    same = np.ones(len(rid), bool)
    for k in keys[1:]:
        same &= k == k[lead]
    twice = np.zeros(len(rid), np.int32)
    np.add.at(twice, lead[same], 1)
    known = same & (twice[lead] > 1)
    apart = known & (lead != np.arange(len(rid)))
    with np.errstate(over="ignore"):
        spread = _mix(rid.astype(U64) * U64(_BASE1) + pos.astype(U64) * U64(_BASE2))
    out = [np.where(apart, spread, k).view(np.int64) for k in keys]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, out), pa.array(rid), pa.array(pos.astype(np.int32)),
         pa.array(np.where(known, 2, weight).astype(np.int32))],
        names=[*(f"h{i + 1}" for i in range(len(keys))), "rid", "pos", "weight"])


def _anchors(window: int):
    period, cover, width = cover_for(window)
    on_cover = np.zeros(period, bool)
    on_cover[list(cover)] = True

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text"):
            data, offs = byte_rows(batch.column(1))
            starts, ends, words = find_words(data, offs)
            row, size = rows_of(words), np.diff(words)
            pos = np.arange(len(starts)) - words[row]
            at = np.flatnonzero(on_cover[pos % period] & (pos + width <= size[row]) & (size[row] >= window))
            if len(at):
                h = window_hashes(hash_spans(data, starts, ends), width, _BASE1)[at]
                rid = np.asarray(batch.column(0))[row[at]]
                yield _merged(rid, pos[at], [h], np.ones(len(at), np.int32))
    return run


def _windows(window: int):
    period, _, _ = cover_for(window)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text"):
            data, offs = byte_rows(batch.column(1))
            starts, ends, words = find_words(data, offs)
            lists = batch.column(3)
            found = np.asarray(lists.flatten(), dtype=np.int64)
            anchor = found + np.repeat(words[:-1], np.diff(np.asarray(lists.offsets)))
            low = np.repeat(words[:-1], np.diff(np.asarray(lists.offsets)))
            step = np.zeros(len(starts) + 2, np.int64)  # windows that start up to period - 1 before an anchor
            np.add.at(step, np.maximum(anchor - period + 1, low), 1)
            np.add.at(step, anchor + 1, -1)
            row = rows_of(words)
            pos = np.arange(len(starts)) - words[row]
            at = np.flatnonzero((np.cumsum(step)[:len(starts)] > 0) & (pos + window <= np.diff(words)[row]))
            if len(at):
                h = hash_spans(data, starts, ends)
                copies = np.asarray(batch.column(2))[row[at]]
                yield _merged(np.asarray(batch.column(0))[row[at]], pos[at],
                              [window_hashes(h, window, b)[at] for b in (_BASE1, _BASE2)],
                              np.minimum(copies, 2).astype(np.int32))
    return run


def _kept(window: int, with_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text"):
            n_words, n_removed, digests, kept = [], [], [], []
            copies = batch.column(1).to_pylist()
            for text, n, starts in zip(batch.column(0), copies, batch.column(2), strict=True):
                words = text.as_py().split()
                total = len(words)
                if n > 1 and total >= window:
                    words = []
                elif starts.is_valid:
                    step = np.zeros(total + 1, np.int64)
                    begins = np.asarray(starts.values)
                    step[begins] += 1
                    np.add.at(step, begins + window, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(step)[:total] == 0).tolist()]
                joined = b" ".join(words)
                n_words.append(total)
                n_removed.append(total - len(words))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined)
            out = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            out += [pa.array(kept, pa.binary())] if with_text else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], *out],
                names=[*batch.schema.names[3:], "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])
    return run


def _repeating(rows: DataFrame, keys: list[str], name: str, out: str) -> DataFrame:
    """Places whose hash has weight 2 or more in all, as one array for each text."""
    total = F.sum("weight").over(Window.partitionBy(*keys))
    hits = rows.withColumn("total", total).filter("total >= 2")
    return store(hits.groupBy("rid").agg(F.collect_list("pos").alias(out)), name)


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """The distinct texts of ``docs`` (null counts as empty), stored: rid, text, copies and digest columns."""
    text = F.coalesce("text", F.lit(""))
    d1, d2 = _digest(F.col("text"))
    return store(take(docs, "text").select(text.alias("text")).groupBy("text")
                 .agg(F.count("*").alias("copies"))
                 .select(F.monotonically_increasing_id().alias("rid"), F.col("text").cast("binary").alias("text"),
                         "copies", d1.alias(_DIGEST[0]), d2.alias(_DIGEST[1])), "substring_texts")


def _hot_texts(texts: DataFrame, share: float = 0.01) -> dict[int, float]:
    """First digests of the texts that hold ``share`` of all rows, at most 1 / share of them, with their share."""
    total = texts.agg(F.sum("copies")).first()[0] or 0
    hot = texts.filter(F.col("copies") >= max(share * total, MIN_ROWS)).select(_DIGEST[0], "copies").collect()
    return {r[0]: r[1] / total for r in hot}


def kept_texts(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """For every distinct text of ``docs`` (null counts as empty): its digest
    columns, n_words, n_removed, kept_sha256 and, if asked for, the kept words
    joined by one space (binary column ``kept``)."""
    return _kept_of(_distinct_texts(docs), window, with_text)


def _kept_of(texts: DataFrame, window: int, with_text: bool = False) -> DataFrame:
    anchors = texts.select("rid", "text").mapInArrow(_anchors(window), "h1 long, rid long, pos int, weight int")
    live = _repeating(anchors, ["h1"], "substring_anchors", "anchors")
    around = (texts.select("rid", "text", "copies").join(live, "rid")
              .mapInArrow(_windows(window), "h1 long, h2 long, rid long, pos int, weight int"))
    spans = _repeating(around, ["h1", "h2"], "substring_windows", "starts")
    return (texts.join(spans, "rid", "left").select("text", "copies", "starts", *_DIGEST)
            .mapInArrow(_kept(window, with_text), f"{_DIGEST[0]} long, {_DIGEST[1]} long, n_words long, "
                        "n_removed long, kept_sha256 string" + ", kept binary" * with_text))


def substring_counts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, a row for each row of ``docs``.

    Null and empty texts have no words (0, 0 and the digest of nothing). Two rows
    with equal texts repeat each other, whatever their ids: if they have 35 words
    or more, nothing of them is kept. Ids may be null or repeat; other columns
    are ignored; an empty table gives no rows. Whole texts of any length are read,
    each in one task. Rows of a text that many share are spread by their ids.
    """
    d1, d2 = _digest(F.coalesce("text", F.lit("")))
    ids = take(docs, "doc_id", "text").select("doc_id", d1.alias(_DIGEST[0]), d2.alias(_DIGEST[1]))
    texts = _distinct_texts(docs)
    # joined by the first digest, cut into pieces for texts that many rows share; the second one settles the rest
    kept = _kept_of(texts, window).withColumnRenamed(_DIGEST[1], "_ws_own")
    joined = skew_join(ids, kept, _DIGEST[0], hot=_hot_texts(texts), row_key=["doc_id"])
    return joined.filter(F.col(_DIGEST[1]) == F.col("_ws_own")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def remove_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with each text cut to its kept words, joined by one space
    (``n_chars``, where there is such a column, follows). A text from which
    nothing was removed stays as it is; null stays null. Same columns and rows."""
    columns = docs.columns
    d1, d2 = _digest(F.coalesce("text", F.lit("")))
    rows = with_row(docs, "text").select("_ws_row", d1.alias(_DIGEST[0]), d2.alias(_DIGEST[1]))
    cut = kept_texts(docs, window, with_text=True).filter("n_removed > 0")
    own = F.col(f"_ws_row.c{columns.index('text')}")
    text = F.when(F.col("n_removed").isNull(), own).otherwise(F.col("kept").cast("string"))
    new = {"text": text}
    if "n_chars" in columns:
        old = F.col(f"_ws_row.c{columns.index('n_chars')}")
        new["n_chars"] = F.when(F.col("n_removed").isNull(), old).otherwise(
            F.char_length("kept_text")).cast(docs.schema["n_chars"].dataType)
    joined = rows.join(cut, list(_DIGEST), "left").withColumn("kept_text", F.col("kept").cast("string"))
    return joined.select(*unpack(columns, new))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_counts(table(spark, sf_dir, "documents"))
