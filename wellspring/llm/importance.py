"""Importance resampling towards a target distribution, on hashed word n-grams.

A text is lower-cased (A-Z only) and every separator becomes a single space; then a regular
expression with boundary lookarounds scans it with overlapping matches, so each run of 1 to n words
is a span of the text as it stands, and its CRC-32 modulo the number of buckets is its feature. No list of
words is built and nothing is joined. Whole batches are scanned as one buffer, a line break between texts.

Counts of the features in the corpus and in the target give each bucket a gain (the logarithm of the smoothed
ratio of its shares, in thousandths). A document's weight is the mean gain of its features; adding Gumbel noise,
keyed by seed and id, and taking the highest sums draws without replacement in proportion to the weights.

The features are stored once as lists of small integers (two bytes a word before compression), so counting
and weighing read those instead of the texts. Only the gains (one number a bucket) reach the driver and are broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._stage import store, table, take
from wellspring.llm._text import byte_rows, regroup
from wellspring.llm._units import by_items
from wellspring.operators import running_totals

NGRAM, BUCKETS, SEED = 1, 10_000, 2024
PERCENT, LEAST_WORDS = 10, 20
BATCH_BYTES = 2 << 20  # of text scanned at once: a worker holds about 40 times that
# Each byte in lower case; all but digits, letters and bytes of other characters is a space.
_CLEAN = bytes([b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                for b in range(256)])
_SPACES = regex.compile(rb" {2,}")


def ngram_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words parted by single spaces, from a word's beginning to a word's end, within a line."""
    return regex.compile(rb"(?<![^ \n])[^ \n]++(?: [^ \n]++){%d}(?![^ \n])" % (n - 1))


def scan(data: bytes, offs: np.ndarray, ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all runs of 1 to ``ngram`` words of a batch's texts, the texts' offsets in them, and their
    numbers of words. A text's single words come first, then its pairs, and so on."""
    ends = offs.tolist()
    texts = [_SPACES.sub(b" ", data[a:b].translate(_CLEAN)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    joined, crc = b"\n".join(texts), zlib.crc32
    first = np.cumsum([0, *[len(t) + 1 for t in texts]])
    found, rows = [], []
    for n in range(1, ngram + 1):
        spans = [m.span() for m in ngram_pattern(n).finditer(joined, overlapped=True)]
        found.append(np.fromiter((crc(joined[a:b]) % buckets for a, b in spans), np.int32, len(spans)))
        at = np.fromiter((a for a, _ in spans), np.int64, len(spans))
        rows.append(np.searchsorted(first, at, side="right") - 1)
    words = np.bincount(rows[0], minlength=len(texts))
    row, bucket = np.concatenate(rows), np.concatenate(found)
    if ngram > 1:
        bucket = bucket[np.argsort(row, kind="stable")]
    total = np.cumsum(np.bincount(row, minlength=len(texts)))
    return bucket, np.concatenate([[0], total]), words


def _features(ngram: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", max_bytes=BATCH_BYTES):
            data, offs = byte_rows(batch.column(1))
            bucket, at, words = scan(data.tobytes(), offs, ngram, buckets)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(bucket))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.astype(np.int64)), lists],
                                             names=["doc_id", "n_words", "buckets"])
    return run


def features(docs: DataFrame, text: str = "text", key: str | None = "doc_id", ngram: int = NGRAM,
             buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id long, n_words long, buckets array<int>)`` of every row; ``key`` None gives null ids. Null and empty
    texts have no features."""
    if ngram < 1 or buckets < 1:
        raise ValueError("ngram and buckets must be at least 1")
    rows = take(docs, *([key] if key else []), text)
    doc = F.col(key).cast("long") if key else F.lit(None).cast("long")
    rows = rows.select(doc.alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_features(ngram, buckets), "doc_id long, n_words long, buckets array<int>")


def bucket_counts(found: DataFrame) -> DataFrame:
    """``(bucket, n)``: how often each bucket occurs, added up in each task before the shuffle."""
    return found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain long)`` for every bucket, from two tables of ``bucket_counts``:
    floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))), in doubles."""
    ours, theirs = corpus.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(ours, "bucket", "left").join(theirs, "bucket", "left").fillna(0, ["s", "t"])
    total_s, total_t = (x.select(F.coalesce(F.sum("n"), F.lit(0))).scalar() for x in (corpus, target))

    def d(c, more):
        return (c + F.lit(more)).cast("double")

    ratio = d(F.col("t"), 1) * d(total_s, buckets) / (d(F.col("s"), 1) * d(total_t, buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def _weights(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_items(batches, 2):
            lists = batch.column(2)
            offs = np.asarray(lists.offsets).astype(np.int64)
            offs = offs - offs[0]
            total = np.concatenate([[0], np.cumsum(sent.value[np.asarray(lists.flatten())])])
            n = np.diff(offs)
            weight = (total[offs[1:]] - total[offs[:-1]]) // np.maximum(n, 1)  # floors go down; no features: 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(weight)],
                                             names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(seed: int = SEED):
    """Gumbel noise in thousandths, from the first 32 bits of a SHA-256 of the seed and ``doc_id``."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, target_text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS,
             seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every document with its draw: ``doc_id, n_features, weight, score, rank`` (all long). Of the N documents with
    at least ``least_words`` words the floor(percent * N / 100) highest scores are drawn and ranked 1, 2, 3, ...;
    ties go to the smaller doc_id (null last), then to fewer features; rows alike in all that may swap places.
    ``rank`` is null for the others.

    Null and empty texts have no features and weight 0 and are never drawn (unless ``least_words`` is 0). Each row is a
    document of its own, also where ids or whole rows repeat; noise depends on the id alone, and a null id
    draws as the text "null". A text of any length is scanned whole, in memory of about 40 times its bytes. An empty
    target or corpus counts as none in every bucket; without documents there are no rows. Further columns don't matter.
    """
    found = store(features(docs, ngram=ngram, buckets=buckets), "importance_features")
    wanted = store(bucket_counts(features(target, target_text, None, ngram, buckets)), "importance_target")
    ours = store(bucket_counts(found), "importance_corpus")
    table_ = np.zeros(buckets, np.int64)
    for r in gains(ours, wanted, buckets).collect():  # one row a bucket
        table_[r["bucket"]] = r["gain"]
    sent = found.sparkSession.sparkContext.broadcast(table_)
    rows = found.mapInArrow(_weights(sent), "doc_id long, n_words long, n_features long, weight long")
    scored = rows.withColumn("score", F.col("weight") + noise(seed)).withColumn(
        "eligible", (F.col("n_words") >= least_words).cast("long"))
    scored = store(scored, "importance_scores")
    some = scored.select(F.coalesce(F.sum("eligible"), F.lit(0))).scalar()
    # the tie column parts rows that are alike, so that a third of all rows may be copies of one
    tied = scored.withColumn("tie", F.monotonically_increasing_id())
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight", "tie"]
    placed = running_totals(tied, [], order, F.lit(1).cast("bigint"), "before", "importance_ranks", write=store)
    drawn = (F.col("eligible") == 1) & (F.col("before") < F.floor(some * percent / 100))
    return placed.select("doc_id", "n_features", "weight", "score",
                         F.when(drawn, F.col("before") + 1).alias("rank"))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The bytes of a word in DuckDB, and its CRC-32 bit by bit (the reflected polynomial 0xEDB88320).
_CRC = """list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, octet_length(encode({w})), 1),
  lambda k: ('0x' || substr(hex(encode({w})), 2 * k::int + 1, 2))::bigint)), lambda c, b:
  list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, zero:
    xor(x >> 1, 3988292384 * (x & 1)) + zero))"""

OP12_SQL = f"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w, true as ours from documents
  union all
  select null, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')), false from benchmark),
distinct_words as (select distinct w from words),
hashed as (select w, xor({_CRC.format(w="w")}, 4294967295) % {BUCKETS} as bucket from distinct_words),
placed as (select doc_id, ours, bucket from words join hashed using (w)),
totals as (select count(*) filter (ours) as ss, count(*) filter (not ours) as tt from placed),
gains as (
  select bucket, floor(1000 * ln(((t + 1)::double * (ss + {BUCKETS})::double)
                                 / ((s + 1)::double * (tt + {BUCKETS})::double)))::bigint as gain
  from (select bucket, count(*) filter (ours) as s, count(*) filter (not ours) as t from placed group by bucket), totals),
per_doc as (select doc_id, count(*) as n, sum(gain)::bigint as total from placed join gains using (bucket)
            where ours group by doc_id),
scored as (
  select d.doc_id, coalesce(n, 0)::bigint as n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0)::bigint as weight,
         ('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::bigint as h
  from documents d left join per_doc p on p.doc_id = d.doc_id),
summed as (select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint as score from scored),
eligible as (select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as many
             from summed where n_features >= {LEAST_WORDS})
select s.doc_id, s.n_features, s.weight, s.score,
       case when r <= floor({PERCENT} * many / 100.0) then r end as rank
from summed s left join eligible e on e.doc_id = s.doc_id"""
