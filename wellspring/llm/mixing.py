"""Mixing sources to target weights with a low-discrepancy schedule.

1. Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, ... and
   share the words of all documents; no target exceeds ``MAX_EPOCHS`` = 3 times
   its source's words, the excess is shared again by weight until none does.
   That is min(cap, level * weight) with one level for all.
2. Stream: each source's documents in an order shuffled by a keyed hash, laid
   end to end and repeated; it is cut into blocks of ``BLOCK_WORDS`` words.
3. Quotas: a source has as many slots as blocks cover its target (rounded to words); its last block is
   cut there, so that every source reaches its target to the word, however small it is.
4. Schedule: slot i gets the golden-ratio point i * g mod N, where N is the number of slots and g, the number
   nearest to N / golden ratio that has no divisor in common with N, makes it visit every number below N once. The slot
   goes to the source in whose part of the cumulative quotas the point falls; the k-th slot of a source takes its
   k-th block. The points are spread so evenly that after any number of slots each source has its share to
   within a few blocks.
5. Slots are joined with the documents' parts of their blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm._stage import store, table, take, unpack, with_row
from wellspring.operators import running_totals, skew_join

BLOCK_WORDS, MAX_EPOCHS, SEED = 32, 3, 42
WEIGHTS = (1, 2, 3)
GOLDEN_RATIO = (1 + 5 ** 0.5) / 2
MOST_SLOTS = 1 << 41  # products of slot numbers and halves of the step stay below 2**63
CHUNK = 1 << 12  # points of a source that are made together
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, to ``(source, source_size, target)``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
    rows = sizes.withColumn("weight", weight.cast("double"))
    rows = rows.withColumn("cap", (F.col("source_size") * MAX_EPOCHS).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level if exactly the sources before this one are capped; it holds for the first that stays under its cap
    rows = rows.withColumn("level", (F.sum("source_size").over(whole) - capped) / left)
    rows = rows.withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    rows = rows.withColumn("nth", F.row_number().over(by_ratio))  # sources may tie in their ratio
    rows = rows.withColumn("first", F.min(F.struct(~F.col("fits"), "nth", "level")).over(whole))
    target = F.when(F.col("first.col1"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("first.level") * F.col("weight")))
    return rows.select("source", "source_size", target.alias("target"))


def golden_step(slots: int) -> int:
    """The number nearest to ``slots`` / golden ratio that has no divisor in common with ``slots``."""
    if slots > MOST_SLOTS:
        raise ValueError(f"{slots} slots: at most {MOST_SLOTS} blocks of {BLOCK_WORDS} words can be scheduled")
    near = round(slots / GOLDEN_RATIO)
    return next(g for d in range(slots + 1) for g in (near + d, near - d) if g > 0 and math.gcd(g, slots) == 1)


def _times(x: Column, factor: int, modulus: int) -> Column:
    """x * factor mod ``modulus`` (up to ``MOST_SLOTS``) without a product beyond 63 bits."""
    high, low = divmod(factor, 1 << 20)
    return (x * F.lit(high) % modulus * F.lit(1 << 20) + x * F.lit(low)) % modulus


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """``(source_id, slot, block)``: for every slot its source, and which of the source's blocks it takes.

    ``sources(source_id, lo, hi)`` has each source's part [lo, hi) of the points 0 to ``slots`` - 1. A point belongs to one
    slot, so the points of a source are multiplied back to their slots; a large source's points are made by many tasks,
    and its slots are ranked by many (``running_totals``)."""
    slots = max(slots, 1)
    back = pow(golden_step(slots), -1, slots) if slots > 1 else 0
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = sources.filter("hi > lo").select("source_id", "lo", "hi", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("hi") - F.col("lo") - 1) / CHUNK))).alias("chunk"))
    first = F.col("lo") + F.col("chunk") * CHUNK
    points = chunks.repartition(parts, "source_id", "chunk").select("source_id", F.explode(F.sequence(
        first, F.least(first + CHUNK, "hi") - 1)).alias("point"))
    dealt = points.select("source_id", _times(F.col("point"), back, slots).alias("slot"))
    return running_totals(dealt, ["source_id"], ["slot"], F.lit(1).cast("bigint"), "block", "mix_slots", store)


def mix(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, source, size)`` to ``(doc_id, source, size, source_size,
    target, at, copy, taken)`` for each row: its place in the source's
    stream, and the words that the mix takes of it."""
    # equal rows are one item with copies, so repeated rows never gather in one block of the order
    items = store(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")), "mix_items")
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    running = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    goal = F.least(F.round("target").cast("long"), F.col("source_size") * MAX_EPOCHS)
    sources = source_targets(sizes).withColumn("source_id", F.row_number().over(running)).withColumn(
        "goal", goal).withColumn("hi", F.sum(F.ceil(F.col("goal") / BLOCK_WORDS)).over(running))
    sources = store(sources.withColumn("lo", F.coalesce(F.lag("hi").over(running), F.lit(0))), "mix_sources")
    slots = sources.agg(F.max("hi")).first()[0] or 0  # none without words
    key = F.xxhash64(F.lit(SEED), F.coalesce("doc_id", F.lit(0)), "size")
    said = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("named")  # null is a source like others
    named = skew_join(items.select("*", said), sources.select(said, "source_id", "source_size", "target", "goal"), "named",
                      row_key=["doc_id", "size"]).drop("named")
    placed = running_totals(named.withColumn("key", key).withColumn("length", F.col("size") * F.col("copies")),
                            ["source_id"], ["key", "doc_id", "size"], "length", "begin", "mix_placed", store)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    placed = store(placed.withColumn("copy", copy).withColumn("at", F.col("begin") + F.col("copy") * F.col("size"))
                   .select("doc_id", "source", "source_id", "size", "source_size", "target", "goal", "at", "copy"),
                   "mix_rows")
    blocks = schedule(sources.select("source_id", "lo", "hi"), slots).select("source_id", "block")
    epoch = F.explode(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1)))
    # the document's words in round e lie at [from, to) of the repeated stream, in blocks from // B to (to - 1) // B
    parts = (placed.filter("size > 0").withColumn("epoch", epoch)
             .withColumn("from", F.col("epoch") * F.col("source_size") + F.col("at")).filter("from < goal").withColumn("to", F.least(F.col("from") + F.col("size"), "goal"))
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / BLOCK_WORDS),
                                                       F.floor((F.col("to") - 1) / BLOCK_WORDS)))))
    words = (F.least("to", (F.col("block") + 1) * BLOCK_WORDS) - F.greatest("from", F.col("block") * BLOCK_WORDS))
    taken = (parts.join(blocks, ["source_id", "block"])
             .groupBy("source_id", "doc_id", "size", "at", "copy").agg(F.sum(words).alias("taken")))
    taken = taken.select(*[F.col(c).alias(f"t_{c}") for c in ("source_id", "doc_id", "size", "at", "copy")], "taken")
    same = (F.col("source_id") == F.col("t_source_id")) & (F.col("at") == F.col("t_at")) & (
        F.col("copy") == F.col("t_copy")) & (F.col("size") == F.col("t_size")) & F.col("doc_id").eqNullSafe(F.col("t_doc_id"))
    out = placed.join(taken, same, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "at", "copy", "taken")


def mix_counts(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, a row for each row of ``docs``.

    Null and empty texts have size 0 and are taken 0 times; a null source is a
    source of its own. Null or repeated ids are rows like others; equal rows are
    laid one behind the other. Without words all targets are 0. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = take(docs, "doc_id", "source", "text").select("doc_id", "source", word_count("text").alias("size"))
    return mix(rows).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each round in which a
    document is taken; the document that a source's last block cuts gives its
    words up to there, joined by one space (``n_chars`` follows)."""
    columns = docs.columns
    text = F.col(f"_ws_row.c{columns.index('text')}")  # each text moves once, inside its row
    packed = (with_row(docs, "doc_id", "source", "text").withColumn("size", word_count("text")).filter("size > 0")
              .drop("text"))
    # rows that agree in doc_id, source and size are interchangeable to mix(): number them
    number = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64(text))
    rows = packed.withColumn("copy", F.row_number().over(number).cast("long") - 1)
    taken = mix(packed.select("doc_id", "source", "size")).filter("taken > 0").select(
        F.col("doc_id").alias("m_doc"), F.col("source").alias("m_source"), F.col("size").alias("m_size"),
        F.col("copy").alias("m_copy"), "taken")
    same = (F.col("doc_id").eqNullSafe(F.col("m_doc")) & F.col("source").eqNullSafe(F.col("m_source"))
            & (F.col("size") == F.col("m_size")) & (F.col("copy") == F.col("m_copy")))
    rounds = F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size"))))
    rows = rows.join(taken, same).withColumn("round", rounds).withColumn(
        "words", F.least("size", F.col("taken") - (F.col("round") - 1) * F.col("size")))
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), 1, F.col("words").cast("int")), " ")
    rows = rows.withColumn("new", F.when(F.col("words") == F.col("size"), text).otherwise(part))
    replace = {"text": F.col("new")}
    if "n_chars" in columns:
        old = F.col(f"_ws_row.c{columns.index('n_chars')}")
        replace["n_chars"] = F.when(F.col("words") == F.col("size"), old).otherwise(
            F.char_length("new")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*unpack(columns, replace))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents"))
