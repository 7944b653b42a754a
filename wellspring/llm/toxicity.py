"""Toxicity of texts after noisy-channel deobfuscation.

1. Character language model: 4-gram counts of the letters of all words of all
   documents (a table of at most 28**4 counts whatever the corpus), smoothed by
   interpolation with shorter contexts.
2. Restoring: all words with a character that has more readings than itself (a
   digit or symbol that resembles a letter, a separator inside), with a letter said
   three times or more, or spelled out with spaces (three letters or more) become
   lattices: each character may stand for itself, for the letters it resembles, for
   nothing (separators), and a run of one letter for one or two of it, each at a
   channel cost. Viterbi finds the likeliest reading under the language model,
   exactly (a state is the last three letters). A word whose literal reading wins, or whose reading says no
   letter, stays as it was; full stops and hyphens around a word aren't part of it.
3. Scoring: words and word beginnings of the restored text are hashed features
   (present or not), and so are steps in the share of shouted words, of an
   FTRL-trained logistic regression, calibrated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm import _ftrl
from wellspring.llm._stage import table, take, unpack, with_row
from wellspring.llm._text import byte_rows, find_words, hash_spans, regroup, rows_of
from wellspring.llm._units import list_column

MAX_TRAIN_ROWS = 40_000  # labelled rows that training uses at most
EPOCHS, SETTINGS = 3, {"alpha": 0.5, "beta": 1.0, "l1": 5.0, "l2": 0.1}
SHARDS = 1  # words of one language and tone are rare: the sample isn't split
SHARES = (0.1, 0.3, 0.6)  # of shouted words: in capitals, or with two exclamation marks behind
THRESHOLD, FOLDS, HELD = 0.3, 4, 2
SYMBOLS = 28  # 0: word boundary, 1-26: a-z, 27: any other letter

# The letters that digits and symbols stand for, and separators that may stand for nothing.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou",
}
SEPARATORS = " .-_*~"
COST_LOOKS, COST_ANY, COST_DROP, COST_RUN, COST_LITERAL = 1.0, 2.5, 0.7, 0.7, 2.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOOKS = np.zeros(256, bool)
_LOOKS[list("".join(LOOKS_LIKE).encode())] = True
_READS = _LOOKS.copy()  # bytes other than letters that have more readings than the literal one
_READS[list(SEPARATORS.strip().encode())] = True
_AROUND = np.zeros(256, bool)  # separators that are punctuation at a word's ends
_AROUND[list(b".-")] = True
_CODE = np.zeros(256, np.uint8)
_CODE[0x61:0x7B] = np.arange(1, 27)
_CODE[0xC0:] = 27
_CODE[0x80:0xC0] = 255  # inside a character: no symbol of its own
_SIZE = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])  # bytes of a character, by its first
_SPELLED = 3  # that many letters or look-alikes as words of their own in a row are read as spelled out
_cache: dict[tuple, dict[bytes, bytes | None]] = {}  # of one model


# --- character language model ---------------------------------------------------------

def gram_codes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The 4-gram number of every letter and word end; contexts start anew with each word."""
    spaced = np.append(np.insert(_LOWER[data], offs[:-1], 0x20), np.uint8(0x20))
    codes = _CODE[spaced]
    codes = codes[codes != 255].astype(np.int32)
    padded = np.concatenate([np.zeros(3, np.int32), codes])
    a, b, c = padded[:-3], padded[1:-2], padded[2:-1]
    b = np.where(c == 0, 0, b)
    a = np.where(b == 0, 0, a)
    out = ((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + codes
    return out[(codes > 0) | (c > 0)]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**4, np.int64)
    for batch in regroup(batches, "text"):
        total += np.bincount(gram_codes(*byte_rows(batch.column(0))), minlength=SYMBOLS**4)
    seen = np.flatnonzero(total)
    for i in range(0, len(seen), 100_000):
        part = seen[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["gram", "n"])


def letter_counts(docs: DataFrame) -> np.ndarray:
    """4-gram counts over all texts (at most 28**4 rows reach the driver)."""
    rows = take(docs, "text").select(F.col("text").cast("binary").alias("text")).mapInArrow(_count, "gram int, n long")
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(SYMBOLS**4, np.float64)
    total[found["gram"].to_numpy(np.int64)] = found["n"].to_numpy()
    return total


def language_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """log P(symbol | last three), as an array of shape (28, 28, 28, 28)."""
    n = counts.reshape((SYMBOLS,) * 4)
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for kept in range(4):  # contexts of 0 to 3 symbols
        c = n.sum(axis=tuple(range(3 - kept)))
        p = (c + weight * p) / (c.sum(axis=-1, keepdims=True) + weight)
    return np.log(p).astype(np.float32)


# --- lattice and Viterbi ----------------------------------------------------------------

def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 if ord(c) >= 0x80 else 0


def edges_at(text: str, i: int, spelled: bool) -> list[tuple[int, str, float]]:
    """From place ``i``, the readings (characters used, what they say, cost)."""
    c, here = text[i], []
    if _symbol(c):
        here.append((1, c, 0.0))
        run = 1
        while (i == 0 or text[i - 1] != c) and i + run < len(text) and text[i + run] == c:
            run += 1
        if run >= 2:
            here.append((run, c, COST_RUN if run > 2 else 2 * COST_RUN))
            if run > 2:
                here.append((run, c + c, COST_RUN))
    else:
        here.append((1, c, 0.0 if spelled and c != " " else COST_LITERAL))
        for letter in LOOKS_LIKE.get(c, ""):
            here.append((1, letter, COST_ANY if c == "*" else COST_LOOKS))
        if c in SEPARATORS:
            here.append((1, "", 0.0 if spelled and c == " " else COST_DROP))
    return here


def edges(text: str, spelled: bool) -> list[list[tuple[int, str, float]]]:
    """The readings from every place."""
    return [edges_at(text, i, spelled) for i in range(len(text))]


def _said(node: list | None) -> str:
    parts = []
    while node is not None:
        parts.append(node[1])
        node = node[0]
    return "".join(reversed(parts))


def _settled(ends: list[list]) -> tuple[str, list] | None:
    """What all the paths that end in these nodes say alike, and the node where that ends, cut off from what is
    before it; None if they have nothing in common."""
    nodes = {id(n): n for n in ends}
    while len(nodes) > 1:
        last = max(n[2] for n in nodes.values())
        back = [n[0] for n in nodes.values() if n[2] == last]
        if None in back:
            return None
        nodes = {k: n for k, n in nodes.items() if n[2] < last} | {id(n): n for n in back}
    node = next(iter(nodes.values()))
    said, node[0], node[1] = _said(node), None, ""
    return said, node


_SETTLE = 256  # places after which the paths' common beginning is written off


def restore_word(text: str, lm: np.ndarray, spelled: bool = False) -> str:
    """The likeliest reading of a disguised word.

    A path is a chain of nodes [node before, letters, place behind them]; only places that lie ahead keep their states, and what
    all living paths have in common is written off, so memory follows the stretch that is still open, not the word's
    length."""
    ahead: dict[int, dict] = {0: {(0, 0, 0): (0.0, [None, "", 0])}}  # place -> last three -> (loss, path)
    done: list[str] = []
    wait, due, upto = _SETTLE, _SETTLE, 0
    for i in range(len(text)):
        here = edges_at(text, i, spelled)
        for state, (loss, path) in ahead.pop(i, {}).items():
            for used, said, cost in here:
                now, total = state, loss + cost
                for c in said:
                    s = _symbol(c)
                    if s or now[2]:
                        total -= float(lm[now][s])
                    now = (now[1], now[2], s) if s else (0, 0, 0)
                there = ahead.setdefault(i + used, {})
                old = there.get(now)
                if old is None or total < old[0]:
                    there[now] = (total, [path, said, i + used])
        if i >= due:
            found = _settled([path for states in ahead.values() for _, path in states.values()])
            if found and found[1][2] > upto:
                done.append(found[0])
                wait, upto = _SETTLE, found[1][2]
            else:  # a long run of one letter is open from its beginning: look again after twice as long
                wait *= 2
            due = i + wait
    last = ahead[len(text)]
    final = min(last, key=lambda s: (last[s][0] - (float(lm[s][0]) if s[2] else 0.0), s))
    return "".join(done) + _said(last[final][1])


_CACHED, _CACHED_BYTES, _LONGEST = 200_000, 32 << 20, 256  # readings kept, their bytes, and a kept word's bytes


def _restored(token: bytes, spelled: bool, lm: np.ndarray, name: int) -> bytes | None:
    """The reading of a token; None if it is the literal one or says no letter (spelled out: fewer than two)."""
    if (name, spelled) not in _cache:
        if (name, not spelled) not in _cache:
            _cache.clear()
        _cache[name, spelled] = {}
    known = _cache[name, spelled]
    if token in known:
        return known[token]
    new = restore_word(token.decode(), lm, spelled)
    said = sum(_symbol(c) > 0 for c in new)
    found = new.encode() if said > spelled and new.encode() != token else None
    if len(token) <= _LONGEST:
        # two caches of two byte strings an entry, each with some 100 bytes around it
        if len(known) >= min(_CACHED, _CACHED_BYTES // (2 * (_LONGEST + 100))):
            known.clear()
        known[token] = found
    return found


def _ranges(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[ends] - total[starts]


def _inner(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words without full stops and hyphens around them; none is left of a word of these alone."""
    starts, ends = starts.copy(), ends.copy()
    at = np.arange(len(starts))
    while len(at := at[(starts[at] < ends[at])]) and len(at := at[_AROUND[data[starts[at]]]]):
        starts[at] += 1
    at = np.arange(len(starts))
    while len(at := at[(starts[at] < ends[at])]) and len(at := at[_AROUND[data[ends[at] - 1]]]):
        ends[at] -= 1
    return starts, ends


def _holds(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(mask)
    return np.searchsorted(at, ends) > np.searchsorted(at, starts)


def disguised(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    """Words to decode (``_inner`` of them), and runs of spelled-out words as (first, last) pairs."""
    first, last = _inner(data, starts, ends)
    letter = _LETTER[data]
    triple = np.zeros(len(data), bool)  # a letter said twice is ordinary spelling
    triple[:-2] = letter[:-2] & (data[:-2] < 0x80) & (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:])
    odd = _holds(_READS[data], first, last) | _holds(triple, first, np.maximum(last - 2, first))
    single = ends - starts == _SIZE[data[starts]]
    says = single & (letter[starts] | _LOOKS[data[starts]])
    single = says | (single & _READS[data[starts]])
    turn = np.concatenate([[True], (single[1:] != single[:-1]) | (row[1:] != row[:-1])])
    heads = np.flatnonzero(turn)
    tails = np.append(heads[1:], len(single)) - 1
    spelled = single[heads] & (_ranges(says, heads, tails + 1) >= _SPELLED)
    odd &= ~np.repeat(spelled, tails - heads + 1)
    return np.flatnonzero(odd), np.stack([heads[spelled], tails[spelled]], axis=1)


def restore_batch(data: np.ndarray, offs: np.ndarray, lm: np.ndarray, name: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a batch with disguised words restored (in lower case)."""
    low = _LOWER[data]
    starts, ends, words = find_words(low, offs)
    if len(starts) == 0:
        return data, offs
    odd, spelled = disguised(low, starts, ends, rows_of(words))
    first, last = _inner(low, starts[odd], ends[odd])
    spans = list(zip(first.tolist(), last.tolist(), [False] * len(odd), strict=True))
    spans += [(int(starts[a]), int(ends[b]), True) for a, b in spelled]
    raw = low.tobytes()
    parts, at, moved, places = [], 0, [], []
    for a, b, spell in sorted(spans):
        new = _restored(b" ".join(raw[a:b].split()) if spell else raw[a:b], spell, lm, name)
        if new is None:
            continue
        parts += [data[at:a], np.frombuffer(new, np.uint8)]
        places.append(b)
        moved.append(len(new) - (b - a))
        at = b
    if not places:
        return data, offs
    parts.append(data[at:])
    shift = np.concatenate([[0], np.cumsum(moved)])
    return np.concatenate(parts), offs + shift[np.searchsorted(places, offs, side="right")]


# --- features and scores -----------------------------------------------------------------

def word_slots(data: np.ndarray, offs: np.ndarray, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Per row the coordinates of its words and word beginnings, each once; only
    those that are set in ``only``, if given. Second, the rows' offsets among them."""
    low = _LOWER[data]
    starts, ends, words = find_words(low, offs)
    row = rows_of(words)
    core = np.flatnonzero(_LETTER[low])
    if len(core) and len(starts):
        lo, hi = np.searchsorted(core, starts), np.searchsorted(core, ends)
        own = hi > lo
        row, starts, ends = row[own], core[lo[own]], core[hi[own] - 1] + 1
    else:
        row, starts, ends = row[:0], starts[:0], ends[:0]
    keys = [row * _ftrl.DIM + _ftrl.slots(hash_spans(low, starts, ends, 5))]
    for k in (4, 5, 6):
        own = ends - starts > k
        keys.append(row[own] * _ftrl.DIM + _ftrl.slots(hash_spans(low, starts[own], starts[own] + k, 5 + k)))
    keys = np.concatenate([*keys, _shouting(data, starts, ends, row, len(offs) - 1)])
    if only is not None:
        keys = keys[only[keys % _ftrl.DIM]]
    keys = np.unique(keys)
    return keys % _ftrl.DIM, np.searchsorted(keys // _ftrl.DIM, np.arange(len(offs)))


def _shouting(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Keys of the steps that each row's shares of shouted words reach."""
    capital = (data >= 0x41) & (data <= 0x5A)
    small = (data >= 0x61) & (data <= 0x7A)
    caps = (_ranges(capital, starts, ends) >= 2) & (_ranges(small, starts, ends) == 0)
    bang = np.zeros(len(data) + 2, bool)
    bang[:len(data)] = data == 0x21
    size, out = np.maximum(np.bincount(row, minlength=rows), 1), []
    after = np.minimum(ends, len(data))
    for k, said in enumerate((caps, (bang[after] & bang[after + 1]) | (bang[np.minimum(after + 1, len(data))]
                                                                       & bang[np.minimum(after + 2, len(data) + 1)]))):
        share = np.bincount(row[said], minlength=rows) / size
        for j, least in enumerate(SHARES):
            out.append(np.flatnonzero(share >= least) * _ftrl.DIM + 1 + len(SHARES) * k + j)
    return np.concatenate(out)


def _feature_rows(lm):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", _ftrl.BATCH_BYTES):
            at, offs = word_slots(*restore_batch(*byte_rows(batch.column(0)), lm.value, lm.id_))
            ones = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(np.ones(len(at), np.float32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], list_column(at, offs), ones],
                                             names=[*batch.schema.names[1:], "at", "x"])
    return run


def _scorer(lm, weights):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        known = w != 0
        for batch in regroup(batches, "text", _ftrl.BATCH_BYTES):
            at, offs = word_slots(*restore_batch(*byte_rows(batch.column(0)), lm.value, lm.id_), known)
            total = np.concatenate([[0.0], np.cumsum(w[at], dtype=np.float64)])
            score = _ftrl.sigmoid(total[offs[1:]] - total[offs[:-1]] + float(w[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score)],
                                             names=[*batch.schema.names[1:], "_ws_score"])
    return run


class _Sent:
    """A broadcast with a number that tells models apart in a worker's cache."""

    def __init__(self, broadcast):
        self._broadcast, self.id_ = broadcast, broadcast.id if hasattr(broadcast, "id") else id(broadcast)

    @property
    def value(self):
        return self._broadcast.value


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS):
    """The language model of all documents, broadcast (28**4 floats), and the weights."""
    context = docs.sparkSession.sparkContext
    lm = _Sent(context.broadcast(language_model(letter_counts(docs))))
    sample = _ftrl.sample_labels(labels, "toxic", ~_ftrl.held_out(FOLDS, HELD), max_rows)
    rows = _ftrl.labelled(take(docs, "doc_id", "text"), sample, max_rows)
    weights = _ftrl.train(rows.mapInArrow(_feature_rows(lm), "turn long, label int, at array<int>, x array<float>"),
                          EPOCHS, SHARDS, **SETTINGS)
    return lm, weights


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts get the bias alone. Without any label to learn from
    all scores are 0.5; labels that are null, or of null ids, don't count; a
    label that occurs twice, and rows that agree in id and text, count once. A null id is not held out. Other
    columns are ignored; an empty table gives no rows.
    """
    lm, weights = fit(docs, labels, max_rows)
    rows = take(docs, "text", "doc_id").select(F.col("text").cast("binary").alias("text"), "doc_id")
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # DIM floats
    scored = rows.mapInArrow(_scorer(lm, sent), "doc_id long, score double")
    return scored.select("doc_id", _ftrl.held_out(FOLDS, HELD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _restorer(lm):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", _ftrl.BATCH_BYTES):
            data, offs = restore_batch(*byte_rows(batch.column(0)), lm.value, lm.id_)
            text = pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(
                offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], text.cast(pa.binary())],
                                             names=[*batch.schema.names[1:], "_ws_text"])
    return run


def restore_texts(docs: DataFrame, out: str = "restored") -> DataFrame:
    """The columns of ``docs`` and the restored text as ``out`` (null text: null)."""
    keep = [c for c in docs.columns if c != out]
    lm = _Sent(docs.sparkSession.sparkContext.broadcast(language_model(letter_counts(docs))))
    row = F.struct(*[F.col(f"_ws_row.c{docs.columns.index(c)}").alias(f"c{i}") for i, c in enumerate(keep)])
    rows = with_row(docs, "text").select(F.col("text").cast("binary").alias("text"), row.alias("_ws_row"))
    done = rows.mapInArrow(_restorer(lm), rows.select("_ws_row").schema.add("_ws_text", "binary"))
    own = F.col(f"_ws_row.c{keep.index('text')}")
    return done.select(*unpack(keep), F.when(own.isNotNull(), F.col("_ws_text").cast("string")).alias(out))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
