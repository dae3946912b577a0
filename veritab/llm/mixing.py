"""Mix sources to target weights in fixed-length blocks.

Each source's words, in a pseudorandom document order, are packed into blocks of ``block_words`` words; a small
source has shorter blocks, so that its target is BLOCKS_PER_TARGET blocks at least (one word each at the least). The
mix is a table of slots: every output shard draws how many of its slots go to each source (multinomial draws
from what the sources still have to give, so the totals meet the targets exactly), slot j of a source takes
block ``perm(j mod blocks)`` of that source, where perm is a keyed pseudorandom permutation (a small Feistel
network with cycle walking), and blocks are joined to slots by index. A block is taken at most
``max_repeats`` times, so no document is either.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.llm.store import materialize
from veritab.llm.words import mix

WORDS = r"[^\x20\x09-\x0D]+"
GROUP_ROWS = 1_000  # least size aimed at; larger tables aim at the square root of their rows
BLOCKS_PER_TARGET = 32
BROADCAST_SOURCES = 100_000  # tables with a row per source are broadcast up to this measured size


def word_count(text: str | Column) -> Column:
    """Number of words of the whole text; null: 0. Only the places where a word begins are counted."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, docs, weight, target) from (source, source_size, docs).

    Sources in code-point order, null last, take the weights in turn and share the whole size; a target stops
    at ``max_repeats`` times its source's size and the excess is shared again by weight until none is above.
    The final level is found in closed form: with sources sorted by size per weight, the first k are capped
    and the others get ``level * weight``. One row per source; the text never comes here."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("pos"), F.lit(len(weights))) + 1).cast("int"))
    pos = F.row_number().over(W.orderBy(F.col("source").isNull(), F.encode(F.coalesce(F.col("source"), F.lit("")), "UTF-8"))) - 1
    t = sizes.withColumn("pos", pos).withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    total = F.sum("source_size").over(W.partitionBy())
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "pos")
    upto = by_cap.rowsBetween(W.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, W.unboundedFollowing)
    # level if all sources before this one are capped and this one and the later ones are not
    t = t.withColumn("total", total).withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(after))
    t = t.withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    t = t.withColumn("final", F.max(F.when(F.col("open"), F.struct(-F.row_number().over(by_cap), F.col("level").alias("level")))).over(W.partitionBy())["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap")))
    return t.select("source", "source_size", "docs", "weight", "pos", target.alias("target"))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Pseudorandom permutation of 0 … size-1 for each row's key: Feistel rounds on the next even power of two,
    walking along the cycle until the value is inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = index.astype(np.uint64)
    out = np.zeros(len(x), dtype=np.int64)
    todo = np.arange(len(x))
    limit = size.astype(np.uint64)
    while len(todo):
        v, m, h, k = x[todo], mask[todo], half[todo], key[todo].astype(np.uint64)
        left, right = v >> h, v & m
        with np.errstate(over="ignore"):
            for r in range(rounds):
                left, right = right, left ^ (mix(right + k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1)) & m)
        v = (left << h) | right
        x[todo] = v
        inside = v < limit[todo]
        out[todo[inside]] = v[inside].astype(np.int64)
        todo = todo[~inside]
    return out


def _small(per_source: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(per_source) if sources <= BROADCAST_SOURCES else per_source


def packed(docs: DataFrame, seed: int, sources: int) -> DataFrame:
    """Add ``first_word`` to (row, source, size): the position of each document's first word in its source's
    sequence. Documents come in a keyed pseudorandom order; a source is cut into hash groups of about
    sqrt(rows) documents (GROUP_ROWS at least), whose totals give the groups' first positions, so a source with a third of all
    rows is spread over many tasks."""
    salt = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), F.lit(1 << 30))
    total = docs.count()
    per_source = docs.groupBy("source").agg(F.count("*").alias("rows")).select(F.col("source").alias("s"), F.ceil(F.col("rows") / max(GROUP_ROWS, total**0.5)).cast("int").alias("groups"))
    rows = docs.withColumn("salt", salt).join(_small(per_source, sources), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("grp", F.floor(F.col("salt") * F.col("groups") / (1 << 30)).cast("int")).drop("groups")
    totals = rows.groupBy("source", "grp").agg(F.sum("size").alias("words"))
    first = totals.select(F.col("source").alias("s"), F.col("grp").alias("g"), F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("grp").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("group_first"))
    inside = W.partitionBy("source", "grp").orderBy("salt", "doc_id", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(first, F.col("source").eqNullSafe(F.col("s")) & (F.col("grp") == F.col("g")))
    return rows.withColumn("first_word", F.col("before") + F.col("group_first")).drop("s", "g", "grp", "salt", "before", "group_first")


def draw_counts(slots: dict[int, int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source position, first slot of the source, count): every shard's draw over the sources.

    Counts are multinomial without replacement: each shard draws from what is left, so the totals are exact.
    The table has shards x sources rows, whatever the number of documents."""
    pos = sorted(slots)
    left = np.array([slots[p] for p in pos], dtype=np.int64)
    used = np.zeros_like(left)
    rng = np.random.default_rng(seed)
    out, shard = [], 0
    while left.sum():
        take = min(shard_slots, int(left.sum()))
        got = np.minimum(rng.multinomial(take, left / left.sum()), left)
        for i in rng.permutation(len(pos)):  # what a short source could not give, the others do
            more = min(take - int(got.sum()), int(left[i] - got[i]))
            got[i] += more
        out += [(shard, int(p), int(u), int(g)) for p, u, g in zip(pos, used, got) if g]
        used += got
        left -= got
        shard += 1
    return out


SLOTS = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("epoch", T.IntegerType())])


def _slot_rows(seed: int):
    def run(frames):
        for f in frames:
            for pos, shard, first, n, blocks in zip(f["pos"], f["shard"], f["first"], f["n"], f["blocks"]):
                for a in range(int(first), int(first + n), 1 << 17):
                    j = np.arange(a, min(a + (1 << 17), int(first + n)), dtype=np.int64)
                    size = np.full(len(j), int(blocks), dtype=np.int64)
                    epoch = j // size
                    # every epoch runs over the blocks in an order of its own
                    key = mix(np.full(len(j), (seed << 20) + int(pos), dtype=np.uint64)) + epoch.astype(np.uint64)
                    yield pd.DataFrame({"pos": np.int32(pos), "shard": np.int32(shard), "block": permute(j % size, size, key), "epoch": epoch.astype(np.int32)})

    return run


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3, block_words: int = 64, shards: int = 64, seed: int = 17, share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(documents, slots) of the mix.

    documents: doc_id, text_hash, source, size, source_size, target and ``taken``, the words the mix takes of
    the document with repeats. slots: pos (source position), shard, block, epoch: which block fills each slot.
    Null texts have size 0; documents of size 0 take no part (taken 0); null sources are one source. The same
    rows give the same mix, whatever their partitioning. Extra columns are ignored."""
    base = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"))
    base = materialize(base, "mix-sizes")
    per = materialize(source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), weights, max_repeats), "mix-targets")
    length = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.least("source_size", "target") / BLOCKS_PER_TARGET))).cast("long")
    per = per.withColumn("len", length)
    plan = per.withColumn("blocks", F.expr("(source_size + len - 1) div len")).withColumn("slots", F.least(F.round(F.col("target") * share * F.try_divide("blocks", "source_size")), F.col("blocks") * max_repeats).cast("long"))
    plan = plan.withColumn("slots", F.coalesce("slots", F.lit(0)))
    small = {r["pos"]: (r["slots"], r["blocks"]) for r in plan.select("pos", "slots", "blocks").where("slots > 0").collect()}  # a row per source
    wanted = {p: s for p, (s, _) in small.items()}
    shard_slots = max(1, -(-sum(wanted.values()) // shards))
    # a shard's slots of one source in pieces, so that a hot source is dealt over many tasks
    counts = [(p, s, u + o, min(1 << 20, n - o), small[p][1]) for s, p, u, n in draw_counts(wanted, shard_slots, seed) for o in range(0, n, 1 << 20)]
    spark = docs.sparkSession
    draws = spark.createDataFrame(counts, "pos int, shard int, first long, n long, blocks long").repartition(max(1, min(len(counts), 256)))
    slots = draws.mapInPandas(_slot_rows(seed), SLOTS)
    times = slots.groupBy("pos", "block").agg(F.count("*").alias("times"))
    sources = per.count()
    rows = packed(base, seed, sources).join(_small(per.select(F.col("source").alias("s"), "source_size", "target", "pos", "len"), sources), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    last = F.expr("(first_word + size - 1) div len")
    parts = rows.where("size > 0").select("row", "pos", "first_word", "size", "len", F.explode(F.sequence(F.expr("first_word div len"), last)).alias("block"))
    overlap = F.least(F.col("first_word") + F.col("size"), (F.col("block") + 1) * F.col("len")) - F.greatest(F.col("first_word"), F.col("block") * F.col("len"))
    taken = parts.withColumn("words", overlap).join(times, ["pos", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = rows.join(taken, "row", "left").select("doc_id", "text_hash", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return out, slots
