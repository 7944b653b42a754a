"""Byte-level BPE encoding and decoding by a rank file, with the ``tokenizers`` library.

A rank file lists byte strings with their ids; a smaller id is merged earlier. The library's
BPE works on characters, so each of the 256 bytes is mapped to a printable character (the byte
table) and the listed strings become its vocabulary. Its merges are all pairs of listed strings
that join to a listed string, in the order of the joined string's id, and a piece that is listed
whole is taken whole: the ids are those that the ranks mean, not those of one order of merges.

Texts come as Arrow batches. A piece of the library's pattern never goes on behind something other
than white space into white space, so texts are cut there, and the distinct units of a batch are
given to the library once. A token's bytes have a known length, so a batch's tokens have byte
offsets, and counting the bytes that begin a character gives their offsets in characters.

Decoding looks up the characters of each id, reverses the byte table, and joins the bytes of the
whole text before they are read as UTF-8: characters split over several tokens come back. Bytes
that are no UTF-8 (of cut lists of ids) become U+FFFD in a string, and stay as they are in binary.
"""

from __future__ import annotations

import base64
import functools
import itertools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.llm._stage import table, take, unpack, with_row
from wellspring.llm._text import byte_rows, gather_runs, regroup
from wellspring.llm._units import UnitCache, by_items, list_column, put_together, unit_codes

BATCH_BYTES = 2 << 20  # of text encoded at once: a worker holds about 40 times that
_CALL = 2000  # units in a call of the library, whose answers are large objects
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_PRINTING = np.zeros(256, bool)  # an ASCII character that is surely no white space
_PRINTING[0x21:0x7F] = True
_models: dict[str, "Model"] = {}


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_table() -> list[str]:
    """The character of each byte: itself where Latin-1 prints it, else the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0x100)} - {0xAD}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Model:
    """A rank file: its byte strings for decoding and, made when a text is first encoded, the library's tokenizer."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path} has no rank for some single bytes")
        self.path, self.cache = path, UnitCache(self._encode)
        to_char = byte_table()
        to_byte = {c: b for b, c in enumerate(to_char)}
        shown = [""] * (max(ranks.values()) + 1)  # the vocabulary, in the characters of the byte table
        for token, rank in ranks.items():
            shown[rank] = "".join([to_char[b] for b in token])
        self.size = len(shown)
        self.length = np.fromiter(map(len, shown), np.int64, self.size)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(bytes([to_byte[c] for s in shown for c in s]), np.uint8)

    @functools.cached_property
    def tokenizer(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers
        ranks, to_char = read_ranks(self.path), byte_table()
        vocab = {"".join([to_char[b] for b in token]): rank for token, rank in ranks.items()}
        merges = [(rank, k, s) for s, rank in vocab.items() for k in range(1, len(s)) if s[:k] in vocab and s[k:] in vocab]
        merges.sort()
        made = Tokenizer(models.BPE(vocab=vocab, merges=[(s[:k], s[k:]) for _, k, s in merges], ignore_merges=True))
        made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return made

    def _encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, np.int32)], []
        for i in range(0, len(units), _CALL):
            part = [u.decode() for u in units[i:i + _CALL]]
            found = [f.ids for f in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes += map(len, found)
            flat.append(np.fromiter(itertools.chain.from_iterable(found), np.int32))
        return np.concatenate(flat), np.array(sizes, np.int64)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a batch's texts, and the texts' offsets in them."""
        cuts = unit_cuts(data, offs)
        codes, units = unit_codes(data, cuts)
        flat, starts, lens = self.cache.ids(units)
        return put_together(codes, flat, starts, lens, np.searchsorted(cuts, offs))

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a batch's lists of ids, and the lists' offsets in them. Ids that aren't listed have no bytes."""
        known = (ids >= 0) & (ids < self.size)
        at = np.where(known, ids, 0)
        lens = np.where(known, self.length[at], 0)
        return gather_runs(self.flat, self.start[at], lens), np.concatenate([[0], np.cumsum(lens)])[offs]

    def spans(self, data: np.ndarray, offs: np.ndarray, ids: np.ndarray,
              at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and (excluded) last character of every token in its text. Tokens that share a split
        character all have its offsets."""
        ends = np.cumsum(self.length[ids])
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # number of the character that a byte is in
        base = np.repeat(char[np.minimum(offs[:-1], len(char) - 1)] if len(char) else offs[:-1], np.diff(at))
        return char[ends - self.length[ids]] - base, char[ends - 1] + 1 - base


def model(path: str) -> Model:
    """One model for each Python worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def unit_cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Row boundaries and the places before ASCII white space behind a printing ASCII character, where a
    piece ends whatever follows."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[1:-1] = _WHITE[data[1:]] & _PRINTING[data[:-1]]
    cut[offs] = True
    return np.flatnonzero(cut)


def _encode(path: str, offsets: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in regroup(batches, "_ws_text", max_bytes=BATCH_BYTES):
            data, offs = byte_rows(batch.column(0))
            ids, at = m.encode(data, offs)
            lists = [ids, *m.spans(data, offs, ids, at)] if offsets else [ids]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[list_column(x, at) for x in lists]],
                                             names=[*batch.schema.names[1:], *_LISTS[:len(lists)]])
    return run


_LISTS = ("_ws_ids", "_ws_starts", "_ws_ends")


def encode(docs: DataFrame, path: str | None = None, keep: list[str] | None = None,
           offsets: bool = False) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``ids``, an array of ints, and with ``offsets`` also
    ``starts`` and ``ends``, the characters of ``text`` that each token covers. Input columns of these names
    are replaced; others, also with names that differ in case only or occur twice, stay.

    Null and empty texts have no ids. A text of any length is one row's work: memory is about 40 times its
    bytes. Strings of special tokens are ordinary text. Rows are independent, nothing is shuffled,
    equal rows give equal rows, and an empty table gives none. ``path`` is a rank file that every executor can open.
    """
    made = ["ids", "starts", "ends"][:3 if offsets else 1]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    packed = with_row(docs, "text")
    row = F.struct(*[F.col(f"_ws_row.c{i}").alias(f"c{k}") for k, i in enumerate(_places(docs, keep))])
    rows = packed.select(F.col("text").cast("binary").alias("_ws_text"), row.alias("_ws_row"))
    schema = rows.select("_ws_row").schema
    for name in _LISTS[:len(made)]:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    done = rows.mapInArrow(_encode(path or default_ranks(), offsets), schema)
    return done.select(*unpack(keep), *[F.col(a).alias(b) for a, b in zip(_LISTS, made)])


def _places(df: DataFrame, keep: list[str]) -> list[int]:
    """Where the columns of ``keep`` stand; the n-th mention of a name is its n-th column."""
    left: dict[str, list[int]] = {}
    for i, c in enumerate(df.columns):
        left.setdefault(c, []).append(i)
    return [left[c].pop(0) for c in keep]


def _decode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in by_items(batches, 0, 250_000):
            lists = batch.column(0)
            offs = np.asarray(lists.offsets).astype(np.int64)
            ids = np.asarray(lists.flatten().fill_null(-1))
            data, at = m.decode(ids, offs - offs[0])
            text = pa.Array.from_buffers(pa.large_binary(), len(lists),
                                         [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], text.cast(pa.binary())],
                                             names=[*batch.schema.names[1:], "_ws_bytes"])
    return run


def decode(encoded: DataFrame, path: str | None = None, keep: list[str] | None = None, out: str = "decoded",
           binary: bool = False) -> DataFrame:
    """``encoded`` (or its columns ``keep``) with the text of ``ids`` as ``out``: a string, or its bytes if
    ``binary``. A null list and an empty one give an empty text; null ids and ids that the rank file doesn't list
    have no bytes."""
    keep = [c for c in (encoded.columns if keep is None else keep) if c != out]
    packed = with_row(encoded, "ids")
    row = F.struct(*[F.col(f"_ws_row.c{i}").alias(f"c{k}") for k, i in enumerate(_places(encoded, keep))])
    rows = packed.select(F.coalesce("ids", F.array().cast("array<int>")).alias("ids"), row.alias("_ws_row"))
    schema = rows.select("_ws_row").schema.add("_ws_bytes", "binary")
    done = rows.mapInArrow(_decode(path or default_ranks()), schema)
    text = F.col("_ws_bytes") if binary else F.make_valid_utf8(F.col("_ws_bytes").cast("string"))
    return done.select(*unpack(keep), text.alias(out))


def op13_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again: doc_id, n_tokens, and the SHA-256 of the ids in decimal,
    joined by spaces, and of the decoded bytes."""
    encoded = encode(take(table(spark, sf_dir, "documents"), "doc_id", "text"), keep=["doc_id"])
    back = decode(encoded, binary=True)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
                       .alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
