"""Quality classifier: hashed word n-grams, FTRL-trained logistic regression.

Words are split where letters and symbols meet ("end%%%" is "end" and "%%%"),
in lower case (ASCII). Unigrams and bigrams are hashed to 2**20 coordinates;
a bigram of two equal words shares one coordinate, "said again". A document is
the vector of square roots of its n-grams' shares, which has length 1 whatever
the document's length, and its score the sigmoid of a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm import _ftrl
from wellspring.llm._stage import table, take, unpack, with_row
from wellspring.llm._text import U64, _mix, byte_rows, hash_spans, regroup, rows_of
from wellspring.llm._units import list_column

MAX_TRAIN_ROWS = 40_000  # labelled rows that training uses at most
EPOCHS, SETTINGS = 3, {"alpha": 0.5, "beta": 1.0, "l1": 0.02, "l2": 0.1}
THRESHOLD, FOLDS, HELD = 0.3, 5, 0
_CLASS = np.full(256, 2, np.uint8)  # 0 space, 1 letter or digit (all beyond ASCII too), 2 symbol
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_AGAIN = U64(0x5851F42D4C957F2D)


def word_parts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words' parts, and the rows' offsets among them."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    kind = _CLASS[data]
    turn = np.ones(len(data) + 1, bool)
    turn[1:-1] = kind[1:] != kind[:-1]
    turn[offs] = True
    cuts = np.flatnonzero(turn)
    starts, ends = cuts[:-1], cuts[1:]
    own = kind[starts] > 0
    starts, ends = starts[own], ends[own]
    return starts, ends, np.searchsorted(starts, offs)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the coordinates, their values, and the rows' offsets among these."""
    data = _LOWER[data]
    starts, ends, parts = word_parts(data, offs)
    row, h = rows_of(parts), hash_spans(data, starts, ends, 3)
    with np.errstate(over="ignore"):
        two = _mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:])
        two = np.where(h[:-1] == h[1:], _AGAIN, two)
    inside = row[1:] == row[:-1]
    keys = np.concatenate([row * _ftrl.DIM + _ftrl.slots(h),
                           row[1:][inside] * _ftrl.DIM + _ftrl.slots(two[inside])])
    keys, count = np.unique(keys, return_counts=True)
    row, at = keys // _ftrl.DIM, keys % _ftrl.DIM
    total = np.bincount(row, weights=count, minlength=len(offs) - 1)
    return at, np.sqrt(count / total[row]), np.searchsorted(row, np.arange(len(offs)))


def _feature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in regroup(batches, "text", _ftrl.BATCH_BYTES):
        at, x, offs = features(*byte_rows(batch.column(0)))
        xs = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(x.astype(np.float32)))
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], list_column(at, offs), xs],
                                         names=[*batch.schema.names[1:], "at", "x"])


def _scorer(weights):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in regroup(batches, "text", _ftrl.BATCH_BYTES):
            at, x, offs = features(*byte_rows(batch.column(0)))
            total = np.concatenate([[0.0], np.cumsum(w[at] * x)])
            score = _ftrl.sigmoid(total[offs[1:]] - total[offs[:-1]] + float(w[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score)],
                                             names=[*batch.schema.names[1:], "_ws_score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> np.ndarray:
    """Weights learned from labelled rows outside the held-out fold."""
    sample = _ftrl.sample_labels(labels, "quality", ~_ftrl.held_out(FOLDS, HELD), max_rows)
    rows = _ftrl.labelled(take(docs, "doc_id", "text"), sample, max_rows)
    return _ftrl.train(rows.mapInArrow(_feature_rows, "turn long, label int, at array<int>, x array<float>"),
                       EPOCHS, **SETTINGS)


def with_scores(docs: DataFrame, weights: np.ndarray, keep: list[str], name: str = "score") -> DataFrame:
    """The columns of ``keep`` and each text's score."""
    packed = with_row(docs, "text")
    row = F.struct(*[F.col(f"_ws_row.c{docs.columns.index(c)}").alias(f"c{i}") for i, c in enumerate(keep)])
    rows = packed.select(F.col("text").cast("binary").alias("text"), row.alias("_ws_row"))
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # DIM floats
    done = rows.mapInArrow(_scorer(sent), rows.select("_ws_row").schema.add("_ws_score", "double"))
    return done.select(*unpack(keep), F.col("_ws_score").alias(name))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts get the bias alone. Without any label to learn from
    all scores are 0.5; labels that are null, or of null ids, don't count; a
    label that occurs twice, and rows that agree in id and text, count once. A null id is not held out. Other
    columns are ignored; an empty table gives no rows.
    """
    scored = with_scores(docs, fit(docs, labels, max_rows), ["doc_id"])
    return scored.select("doc_id", _ftrl.held_out(FOLDS, HELD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with its columns."""
    columns = docs.columns
    scored = with_scores(docs.toDF(*[f"c{i}" if c != "text" else c for i, c in enumerate(columns)]),
                         fit(docs, labels, max_rows),
                         [f"c{i}" if c != "text" else c for i, c in enumerate(columns)], "_ws_score")
    kept = scored.filter(F.col("_ws_score") >= THRESHOLD).drop("_ws_score")
    return kept.toDF(*columns)


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
