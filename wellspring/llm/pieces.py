"""SentencePiece (BPE) encoding with seeded merge dropout, and lossless decoding.

A text is its characters with spaces as the mark U+2581 and one mark in front.
Agenda processing merges, again and again, the adjacent pair whose joined piece
has the best score (leftmost of equals). A candidate pair is skipped for good if a
hash keyed by the seed, the document, the unit's place in it, its place and its two symbols
falls below the dropout rate: other merges then shape the text, so texts are
segmented in varied ways that only use merges of the model. What no piece
covers falls back to byte pieces.

No piece has the mark after another character, so merges never cross the place
before a run of spaces and a text is encoded in units cut there. Distinct units of a
batch are encoded once without dropout, all of them together in numpy (a round merges
one pair of every unit), and the candidates met are noted. An occurrence whose own
hashes skip none of them is segmented like that; all others are encoded each on its own.

Decoding joins pieces and bytes, turns marks to spaces and drops the first. A
literal U+2581 is encoded as its three bytes, hence every text comes back as it was.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.llm._stage import table, take, unpack, with_row
from wellspring.llm._text import U64, _mix, byte_rows, gather_runs, regroup
from wellspring.llm._units import by_items, list_column, put_together, unit_codes

DROPOUT, SEED = 0.1, 42
MARK = "▁"
BATCH_BYTES = 3 << 20  # of text encoded at once: a worker holds about 50 times that
_LONG = 48  # symbols; longer units are encoded one by one
_TESTS, _OWN = 1 << 18, 1 << 16  # hashes tested, and occurrences encoded, at once
_IDS = 1 << 16  # decoded at once
_NONE = np.int32(2**31 - 1)
_ODD1, _ODD2 = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
_models: dict[str, "Model"] = {}
_vocabularies: dict[str, "Vocabulary"] = {}


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def model(path: str) -> "Model":
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def vocabulary(path: str) -> "Vocabulary":
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


class Vocabulary:
    """The bytes of each piece, which is all that decoding needs: its workers don't hold the merges."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        plain = {p: i for i, p in enumerate(pieces)
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        own = set(plain.values())
        texts = [bytes([self._byte(p)]) if sp.is_byte(i) else b"" if i not in own else
                 p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.out_len = np.array([len(t) for t in texts], np.int64)
        self.out_start = np.cumsum(self.out_len) - self.out_len
        self.out = np.frombuffer(b"".join(texts), np.uint8)
        self._merges(sp, plain)

    def _merges(self, sp, plain: dict[str, int]) -> None:
        """Nothing to keep for decoding."""

    @staticmethod
    def _byte(piece: str) -> int:
        return int(piece[3:5], 16)


class Model(Vocabulary):
    """The merges of a SentencePiece BPE model. Symbols below ``size`` are its
    pieces, ``size`` + code point is a character without a piece."""

    def _merges(self, sp, plain: dict[str, int]) -> None:
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("a piece has a space inside: units can't be cut before spaces")
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        scores = {i: sp.get_score(i) for i in plain.values()}
        ranked = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.priority = np.full(self.size, _NONE, np.int32)  # smaller is merged earlier
        for i, s in scores.items():
            self.priority[i] = ranked[s]
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.size
        for p, i in plain.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.of_char[0x20] = plain[MARK]
        self.of_char[ord(MARK)] = self.size + ord(MARK)  # a literal mark is no space
        symbol = dict(plain)
        symbol.update({c: self.size + ord(c) for p in plain for c in p if c not in plain})
        self.pairs = {(symbol[p[:k]], symbol[p[k:]]): i for p, i in plain.items() for k in range(1, len(p))
                      if p[:k] in symbol and p[k:] in symbol}
        self._index()

    def _index(self) -> None:
        """The pairs as an open-addressing table in numpy."""
        keys = np.array([(a << 21) | b for a, b in self.pairs], np.uint64)
        values = np.fromiter(self.pairs.values(), np.int32, len(self.pairs))
        bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self._shift, self._mask = U64(64 - bits), (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, ~U64(0)), np.full(1 << bits, -1, np.int32)
        self._probes, left = 0, np.arange(len(keys))
        while len(left):
            slot = (self._hash(keys[left]) + self._probes) & self._mask
            free = self._keys[slot] == ~U64(0)
            _, one = np.unique(slot[free], return_index=True)
            taken = np.flatnonzero(free)[one]
            self._keys[slot[taken]], self._values[slot[taken]] = keys[left[taken]], values[left[taken]]
            left = np.delete(left, taken)
            self._probes += 1

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _ODD1) >> self._shift).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 if none."""
        keys = (left.astype(U64) << U64(21)) | right.astype(U64)
        slot = self._hash(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for p in range(self._probes):
            at = (slot[open_] + p) & self._mask
            found = self._keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[at[hit]]
            open_ = open_[~hit & (found != ~U64(0))]
            if not len(open_):
                break
        return out

    def ids(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to ids, characters without a piece as their UTF-8 bytes; lens: symbols of each unit."""
        rare = np.flatnonzero(symbols >= self.size)
        if not len(rare):
            return symbols, lens
        p = symbols[rare].astype(np.int64) - self.size
        n = np.where(p < 0x80, 1, np.where(p < 0x800, 2, np.where(p < 0x10000, 3, 4)))
        size = np.ones(len(symbols), np.int64)
        size[rare] = n
        out = np.repeat(symbols, size)
        start = (np.cumsum(size) - size)[rare]
        out[start] = self.byte_ids[np.array([0, 0, 0xC0, 0xE0, 0xF0])[n] | (p >> 6 * (n - 1))]
        for k in (1, 2, 3):
            more = n > k
            later = 6 * (n[more] - 1 - k)  # bits of the bytes after this one
            out[start[more] + k] = self.byte_ids[0x80 | ((p[more] >> later) & 0x3F)]
        total = np.concatenate([[0], np.cumsum(np.add.reduceat(size, np.cumsum(lens) - lens))]) \
            if len(lens) else np.zeros(1, np.int64)
        return out.astype(np.int32), np.diff(total)


def _candidate(place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (place.astype(U64) * _ODD1) ^ ((left.astype(U64) << U64(21) | right.astype(U64)) * _ODD2)


def _skipped(h: np.ndarray, rate: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(_mix(h) * _ODD1) >> U64(11)) < U64(int(rate * 2**53))


def _merge_matrix(m: Model, symbols: np.ndarray, key: np.ndarray, rate: float,
                  met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Agenda processing of units with equally many symbols (a row each): every
    round merges the best pair of each row. Symbols stay in their places, linked to the next and the one before, so a
    merge touches three of them. Returns the merged symbols of all rows, one row's behind the other's, and the rows'
    lengths; ``met`` gets the candidates, as arrays of rows and of ``_candidate``."""
    n, width = symbols.shape
    value = np.ascontiguousarray(symbols).reshape(-1).copy()
    place = np.arange(n * width)
    column = place % width
    after = np.where(column < width - 1, place + 1, -1)
    before = np.where(column > 0, place - 1, -1)
    made = np.full(n * width, -1, np.int32)
    best = np.full((n, width), _NONE, np.int32)
    flat = best.reshape(-1)

    def propose(at: np.ndarray) -> None:
        """The pairs of the symbols ``at`` and those behind them become candidates, or none."""
        left, right = value[at], value[after[at]]
        piece = m.joined(left, right)
        own = np.flatnonzero(piece >= 0)
        flat[at] = _NONE
        if not len(own):
            return
        at, piece, row = at[own], piece[own], at[own] // width
        rank = m.priority[piece]
        if rate > 0 or met is not None:
            which = _candidate(column[at], left[own], right[own])
            if met is not None:
                met.append((row, which))
            if rate > 0:
                rank = np.where(_skipped(key[row] ^ which, rate), _NONE, rank)
        made[at], flat[at] = piece, rank

    if width > 1:
        propose(np.flatnonzero(after >= 0))
    alive = np.arange(n)
    while len(alive):
        of = best if len(alive) == n else best[alive]
        at = alive * width + np.argmin(of, axis=1)
        go = flat[at] < _NONE
        alive, at = alive[go], at[go]
        if not len(alive):
            break
        gone = after[at]
        value[at] = made[at]
        then, back = after[gone], before[at]
        after[at], value[gone], flat[gone] = then, -1, _NONE
        some = then >= 0
        before[then[some]] = at[some]
        flat[at[~some]] = _NONE
        propose(np.concatenate([at[some], back[back >= 0]]))
    kept = value >= 0
    return value[kept], kept.reshape(n, width).sum(axis=1)


def _merge_one(m: Model, symbols: list[int], key: int, rate: float) -> list[int]:
    """The same agenda for one long unit, as a heap."""
    n = len(symbols)
    symbols, before, after = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int, int]] = []
    pairs, priority = m.pairs, m.priority
    mask, one, two, limit = (1 << 64) - 1, int(_ODD1), int(_ODD2), int(rate * 2**53)

    def mix(h: int) -> int:
        h ^= h >> 32
        h = h * 0xC2B2AE3D27D4EB4F & mask
        return h ^ h >> 29

    def propose(i: int) -> None:
        j = after[i]
        a, b = symbols[i], symbols[j]
        piece = pairs.get((a, b))
        if piece is not None:
            heapq.heappush(heap, (int(priority[piece]), i, a, b, piece))

    for i in range(n - 1):
        propose(i)
    while heap:
        _, i, a, b, piece = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        if rate > 0:
            h = key ^ (i * one & mask) ^ (((a << 21) | b) * two & mask)
            if mix(mix(h) * one & mask) >> 11 < limit:
                continue
        symbols[i], symbols[j] = piece, -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            propose(i)
        if before[i] >= 0:
            propose(before[i])
    return [s for s in symbols if s >= 0]


def encode_units(m: Model, units: list[bytes], key: np.ndarray, rate: float,
                 met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the units and how many each has; ``met`` gets the candidates of units up to ``_LONG``."""
    points = np.frombuffer(b"".join(units).decode().encode("utf-32-le"), "<u4")
    symbols = m.of_char[points]
    raw = np.frombuffer(b"".join(units), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))])
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[bounds]
    starts, lens = chars[:-1], np.diff(chars)
    count = lens.copy()
    flat = symbols.copy()  # each unit's result goes to the front of its own place
    for width in np.unique(lens[lens <= _LONG]).tolist():
        own = np.flatnonzero(lens == width)
        for part in np.array_split(own, len(own) * width // 400_000 + 1):
            at = starts[part][:, None] + np.arange(width)[None, :]
            found = None if met is None else []
            merged, size = _merge_matrix(m, symbols[at], key[part], rate, found)
            count[part] = size
            flat[np.repeat(starts[part] - (np.cumsum(size) - size), size) + np.arange(len(merged))] = merged
            if met is not None:
                met += [(part[rows], which) for rows, which in found]
    for i in np.flatnonzero(lens > _LONG).tolist():
        found = _merge_one(m, symbols[starts[i]:starts[i] + lens[i]].tolist(), int(key[i]), rate)
        flat[starts[i]:starts[i] + len(found)], count[i] = found, len(found)
    return m.ids(gather_runs(flat, starts, count), count)


def occurrence_keys(doc_key: np.ndarray, rows: np.ndarray, seed: int) -> np.ndarray:
    """The key of every unit from its document's key and its place; ``rows``: the documents' unit offsets."""
    with np.errstate(over="ignore"):
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        nth = (np.arange(rows[-1]) - rows[row]).astype(U64)
        return _mix(_mix(doc_key[row] + nth * _ODD2 + U64(seed)) * _ODD1)


def _varied(codes: np.ndarray, key: np.ndarray, met: list, always: np.ndarray, rate: float) -> np.ndarray:
    """The occurrences (by the code of their unit) that skip a candidate met without dropout."""
    unit = np.concatenate([rows for rows, _ in met]) if met else np.zeros(0, np.int64)
    which = np.concatenate([c for _, c in met]) if met else np.zeros(0, U64)
    which = which[np.argsort(unit, kind="stable")]
    count = np.bincount(unit, minlength=len(always))
    first, out = np.cumsum(count) - count, always[codes]
    upto = np.concatenate([[0], np.cumsum(count[codes])])
    a = 0
    while a < len(codes):
        b = max(int(np.searchsorted(upto, upto[a] + _TESTS, side="right")) - 1, a + 1)
        n = count[codes[a:b]]
        hit = _skipped(np.repeat(key[a:b], n) ^ gather_runs(which, first[codes[a:b]], n), rate)
        out[a:b] |= np.bincount(np.repeat(np.arange(b - a), n)[hit], minlength=b - a) > 0
        a = b
    return out


def encode_batch(m: Model, data: np.ndarray, offs: np.ndarray, doc_key: np.ndarray, rate: float,
                 seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a batch, and the texts' offsets in them."""
    filled = np.flatnonzero(np.diff(offs) > 0)
    data = np.insert(data, offs[:-1][filled], 0x20)  # the mark in front
    offs = offs + np.searchsorted(filled, np.arange(len(offs)))
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    cut[offs] = True
    cuts = np.flatnonzero(cut)
    codes, distinct = unit_codes(data, cuts)
    rows = np.searchsorted(cuts, offs)
    if len(codes) == 0:
        return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
    units, met = distinct.to_pylist(), [] if rate > 0 else None
    flat, lens = encode_units(m, units, np.zeros(len(units), U64), 0.0, met)
    if rate > 0:
        key = occurrence_keys(doc_key, rows, seed)
        long = np.array([len(u) > _LONG for u in units])  # bytes: some units are encoded alone without need
        own = np.flatnonzero(_varied(codes, key, met, long, rate))
        del met
        parts, sizes = [flat], [lens]
        for i in range(0, len(own), _OWN):
            part = own[i:i + _OWN]
            ids, n = encode_units(m, [units[c] for c in codes[part].tolist()], key[part], rate)
            parts.append(ids)
            sizes.append(n)
        codes = codes.astype(np.int64)
        codes[own] = len(units) + np.arange(len(own))
        flat, lens = np.concatenate(parts), np.concatenate(sizes)
    return put_together(codes, flat, np.cumsum(lens) - lens, lens, rows)


def decode_batch(m: Vocabulary, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the texts' offsets in them."""
    lens = m.out_len[ids]
    at = np.concatenate([[0], np.cumsum(lens)])
    data = np.empty(at[-1], np.uint8)
    for i in range(0, len(ids), _IDS):  # the bytes' places take much more than the bytes
        part = slice(i, i + _IDS)
        data[at[i]:at[min(i + _IDS, len(ids))]] = gather_runs(m.out, m.out_start[ids[part]], lens[part])
    at = at[offs]
    filled = np.flatnonzero(np.diff(at) > 0)
    data = np.delete(data, at[:-1][filled])
    return data, at - np.searchsorted(filled, np.arange(len(at)))


# --- the operators ------------------------------------------------------------------

def _encode(path: str, rate: float, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in regroup(batches, "_ws_text", max_bytes=BATCH_BYTES):
            data, offs = byte_rows(batch.column(0))
            key = np.asarray(batch.column(1)).view(U64)
            ids, at = encode_batch(m, data, offs, key, rate, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(np.diff(at)), list_column(ids, at)],
                names=[*batch.schema.names[2:], "_ws_n", "_ws_ids"])
    return run


def encode(docs: DataFrame, path: str | None = None, rate: float = DROPOUT, seed: int = SEED,
           keep: list[str] | None = None, copies: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (array of ints) behind its columns
    (or behind those of ``keep``); an input column of one of these names is replaced.

    Null and empty texts have no ids (null stays null in the text column).
    Dropout is drawn by doc_id (null: 0), text and place, so rows that repeat both are
    encoded alike and reruns agree; rows are independent, nothing is shuffled. With
    ``copies`` such rows are numbered first (a shuffle), and each has draws of its own.
    """
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c not in ("n_tokens", "ids")]
    packed = with_row(docs, "text", "doc_id")
    row = F.struct(*[F.col(f"_ws_row.c{docs.columns.index(c)}").alias(f"c{i}") for i, c in enumerate(keep)])
    doc, number = [F.coalesce("doc_id", F.lit(0)), F.xxhash64("text")], F.lit(0)
    if copies:
        packed = packed.withColumn("_ws_doc", doc[0]).withColumn("_ws_hash", doc[1])
        number = F.row_number().over(Window.partitionBy("_ws_doc", "_ws_hash").orderBy(F.xxhash64("_ws_row")))
    rows = packed.select(F.col("text").cast("binary").alias("_ws_text"),
                         F.xxhash64(*doc, number).alias("_ws_key"), row.alias("_ws_row"))
    schema = rows.select("_ws_row").schema.add("_ws_n", "long").add("_ws_ids", T.ArrayType(T.IntegerType()))
    done = rows.mapInArrow(_encode(path or default_model(), rate, seed), schema)
    return done.select(*unpack(keep), F.col("_ws_n").alias("n_tokens"), F.col("_ws_ids").alias("ids"))


def _decode(path: str, digest: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = vocabulary(path)
        for batch in by_items(batches, 0):
            lists = batch.column(0)
            offs = np.asarray(lists.offsets).astype(np.int64)
            offs = offs - offs[0] if len(offs) else offs
            ids = np.asarray(lists.flatten())
            data, at = decode_batch(m, ids, offs)
            if digest:
                names, new = _DIGESTS.names, _digests(ids, offs, data, at)
            else:
                text = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(at.astype(np.int64)),
                                                                             pa.py_buffer(data)])
                names, new = ["_ws_text"], [text.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], names=[*batch.schema.names[1:], *names])
    return run


_DIGESTS = T.StructType().add("n_tokens", "long").add("ids_crc32", "long").add("decoded_sha256", "string")


def _digests(ids: np.ndarray, offs: np.ndarray, data: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """The columns of ``_DIGESTS`` for rows of ids and of decoded bytes, given with their offsets."""
    def rows(raw, ends):
        return (raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))

    crc = [zlib.crc32(r) for r in rows(memoryview(ids.astype("<u4").tobytes()), 4 * offs)]
    sha = [hashlib.sha256(r).hexdigest() for r in rows(memoryview(data), at)]
    return [pa.array(np.diff(offs)), pa.array(crc, pa.int64()), pa.array(sha, pa.string())]


def decode(encoded: DataFrame, path: str | None = None, keep: list[str] | None = None,
           out: str = "decoded", digest: bool = False) -> DataFrame:
    """The columns of ``keep`` (all, if none are named) with the text of each row's ``ids`` as ``out``.

    With ``digest``, the number of the ids (``n_tokens``), the unsigned crc32 of the ids as little-endian 32-bit
    integers and the decoded text's SHA-256 (``decoded_sha256``) instead of the text, computed by the worker that
    decodes: neither ids nor texts are sent on to another.
    """
    replaced = _DIGESTS.names if digest else [out]
    keep = [c for c in (encoded.columns if keep is None else keep) if c not in replaced]
    packed = with_row(encoded, "ids")
    row = F.struct(*[F.col(f"_ws_row.c{encoded.columns.index(c)}").alias(f"c{i}") for i, c in enumerate(keep)])
    rows = packed.select(F.coalesce("ids", F.array().cast("array<int>")).alias("ids"), row.alias("_ws_row"))
    schema = rows.select("_ws_row").schema
    schema = T.StructType([*schema, *_DIGESTS]) if digest else schema.add("_ws_text", "binary")
    done = rows.mapInArrow(_decode(path or default_model(), digest), schema)
    return done.select(*unpack(keep), *(replaced if digest else [F.col("_ws_text").cast("string").alias(out)]))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every text encoded with dropout and decoded again: doc_id, n_tokens, the
    unsigned crc32 of the ids as little-endian 32-bit integers, and the SHA-256 of the decoded text."""
    encoded = encode(take(table(spark, sf_dir, "documents"), "doc_id", "text"), keep=["doc_id"])
    return decode(encoded, keep=["doc_id"], digest=True)
