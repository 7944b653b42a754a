"""Quality rules on repetition, from a suffix array of each text's words.

The suffix array is built by prefix doubling for a whole batch of texts at once
(suffixes of different texts never compare equal): ranks of 1, 2, 4, ... words
are refined only where suffixes still tie. The longest common prefix (LCP) of
neighbours in the array comes from the kept ranks, longest first. A place's
longest repeat is the larger LCP with its two neighbours: the depth of the
deepest LCP interval it lies in. The places with ``MIN_REPEAT`` words or more
span the maximal repeated substrings; their union is the covered part.

A text is kept unless the base rules fail it, more than ``MAX_COVERED`` of its
words are covered, or a repeat is longer than ``MAX_REPEAT`` words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._stage import table, take
from wellspring.llm._text import U64, _mix, byte_rows, find_words, hash_spans, regroup, rows_of

MIN_REPEAT, MAX_COVERED, MAX_REPEAT = 8, 0.5, 100
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row, the number of set flags."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def _with_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(hashes + _mix(row.astype(U64) * U64(0xD6E8FEB86659FD93)))


def _doubled(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The suffix array, and for 1, 2, 4, ... words the places that tie and their ranks."""
    n = len(words)
    keys = _with_row(words, row)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    heads = np.flatnonzero(new)
    rank = np.empty(n + 1, np.int64)
    rank[order] = heads[np.cumsum(new) - 1]
    rank[n] = -1
    last = np.append(row[1:] != row[:-1], True)  # of its row
    end = np.flatnonzero(last)[np.searchsorted(np.flatnonzero(last), np.arange(n))] + 1
    tied = np.repeat(np.diff(np.append(heads, n)) > 1, np.diff(np.append(heads, n)))
    levels, step = [], 1
    while tied.any():
        slots = np.flatnonzero(tied)  # places in the suffix array that are not settled
        at = order[slots]
        by_place = np.argsort(at)
        levels.append((at[by_place], rank[at][by_place]))
        nxt = at + step
        second = np.where(nxt < end[at], rank[np.minimum(nxt, n)] + 1, 0)
        first = rank[at]
        within = np.lexsort((second, first))
        at, first, second = at[within], first[within], second[within]
        order[slots] = at
        head = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        starts = np.flatnonzero(head)
        rank[at] = slots[starts][np.cumsum(head) - 1]
        sizes = np.diff(np.append(starts, len(at)))
        tied[slots] = np.repeat(sizes > 1, sizes)
        step *= 2
    return order, levels


def longest_repeats(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For every word place, the length of the longest run that starts there and
    also starts elsewhere in the same row."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    order, levels = _doubled(words, row)
    lcp = np.zeros(n + 1, np.int64)  # lcp[i]: of order[i - 1] and order[i]
    left, right, slot = order[:-1].copy(), order[1:].copy(), np.arange(1, n)
    if levels:  # only neighbours that both tie on their first word share anything
        first = _rank_at(levels[0], left)
        same = (first >= 0) & (first == _rank_at(levels[0], right))
        left, right, slot = left[same], right[same], slot[same]
        for k in range(len(levels) - 1, -1, -1):
            a = _rank_at(levels[k], left)
            same = (a >= 0) & (a == _rank_at(levels[k], right))
            grow = same.astype(np.int64) << k
            lcp[slot] += grow
            left, right = left + grow, right + grow
    out = np.zeros(n, np.int64)
    out[order] = np.maximum(lcp[:-1], lcp[1:])
    return out


def _rank_at(level: tuple[np.ndarray, np.ndarray], places: np.ndarray) -> np.ndarray:
    """The rank of each place in a level, -1 where it is settled there."""
    held, ranks = level
    i = np.minimum(np.searchsorted(held, places), len(held) - 1)
    return np.where(held[i] == places, ranks[i], -1)


def _covered(starts: np.ndarray, lens: np.ndarray, n: int) -> np.ndarray:
    """Places inside the union of the spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lens, -1)
    return np.cumsum(step[:-1]) > 0


def _repeated_lines(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line."""
    rows = len(offs) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([offs[:-1], breaks + 1])
    row = np.concatenate([np.arange(rows), np.searchsorted(offs, breaks, side="right") - 1])
    by = np.lexsort((starts, row))
    starts, row = starts[by], row[by]
    ends = np.append(starts[1:] - 1, len(data))  # before the line break
    final = np.append(row[1:] != row[:-1], True)
    ends[final] = offs[row[final] + 1]
    total = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    worded = total[ends] > total[starts]
    starts, ends, row = starts[worded], ends[worded], row[worded]
    keys = _with_row(hash_spans(data, starts, ends, 7), row)
    _, first = np.unique(keys, return_index=True)
    return np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)


def _measure(min_repeat: int):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text"):
            data, offs = byte_rows(batch.column(0))
            starts, ends, words = find_words(data, offs)
            row, rows = rows_of(words), len(offs) - 1
            inside = ~_BLANK[data]
            longest = longest_repeats(hash_spans(data, starts, ends), row)
            three, many = np.flatnonzero(longest >= 3), np.flatnonzero(longest >= min_repeat)
            repeat = _covered(three, np.full(len(three), 3), len(row))
            covered = _covered(many, longest[many], len(row))
            most = np.zeros(rows, np.int64)
            np.maximum.at(most, row, longest)
            found = [np.diff(words), _sums(inside & ((data & 0xC0) != 0x80), offs), _sums(_SYMBOLS[data], offs),
                     _repeated_lines(data, offs, inside), _sums(repeat, words), _sums(covered, words), most]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(x.astype(np.int64)) for x in found)],
                                             names=[*batch.schema.names[1:], *names])
    return run


def repetition_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
                     max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Counts and verdict for every row of ``docs(doc_id, text, ...)``.

    Null and empty texts have no words and fail the base rules (under 50
    words). Repeated rows and null ids are judged each on its own; other columns
    are ignored; an empty table gives no rows. No row depends on another, so
    nothing is shuffled; a long text is one row of its own batch.
    """
    counts = (take(docs, "text", "doc_id").select(F.col("text").cast("binary").alias("text"), "doc_id")
              .mapInArrow(_measure(min_repeat), "doc_id long, n_words long, word_chars long, n_symbols long, "
                          "n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat")
