"""Audit of how text filters interact: sorted posting lists of failing ids, merged by galloping.

1. ``mark_documents`` judges every text where it is read (whole texts, numpy on the Arrow buffers) and finds texts
   that are identical to the text of a smaller id, table-wide, by a 128-bit digest.
2. ``posting_lists`` deals rows to id ranges, sorted by (part, id), and writes one row per part and piece of a
   range: for every filter the sorted list of the rows that fail it, and the lists of good and toxic rows. A list
   holds positions in the piece's sorted ids, so rows without an id and repeated ids keep their place. A piece holds
   at most PIECE_ROWS rows, so no list grows with its part.
3. ``union_sizes`` merges the lists of every set of filters: unions and intersections gallop through the longer
   list. The sizes of the pieces add up over a part.
4. ``interactions`` reads every order's steps off these sums: what a step removes is the difference of two unions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm import words as wd
from veritab.llm.skew import join_counted
from veritab.llm.store import materialize
from veritab.session import shuffle_partitions

FILTERS = "ABCDE"
PIECE_ROWS = 1 << 16
FEW_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"

_CASED = wd.alphabet(wd.SPACE_WORDS.is_word, lower=False)
_LISTS = [*FILTERS, "good", "toxic"]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offsets[1:]] - total[offsets[:-1]]


def text_faults(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bit i is set where a text fails the i-th of the filters A to D."""
    starts, ends, n = wd.split(data, offsets, _CASED)
    hashes = wd.word_hashes(data, starts, ends, _CASED)
    first = np.concatenate(([0], np.cumsum(n)))
    distinct = np.array([len(np.unique(hashes[first[i] : first[i + 1]])) for i in range(len(n))], dtype=np.int64)
    points = _sums((data & 0xC0) != 0x80, offsets)
    capitals = _sums((data >= 65) & (data <= 90), offsets)
    symbols = _sums(np.isin(data, np.frombuffer(SYMBOLS, dtype=np.uint8)), offsets)
    fails = [n < FEW_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * capitals > CAPITAL_PERCENT * points, symbols > 0]
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        faults, digests = [], []
        for _, data, offsets in wd.pieces(b.column("__text")):
            faults += text_faults(data, offsets).tolist()
            raw, at = data.tobytes(), offsets.tolist()
            digests += [hashlib.md5(raw[s:e], usedforsecurity=False).digest() for s, e in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("part"), pa.array(faults, pa.int32()), pa.array(digests, pa.binary())], names=["id", "part", "faults", "digest"])


def mark_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part: str = "lang", text: str = "text") -> DataFrame:
    """(id, part, faults, good, toxic) of every row; bit i of ``faults`` is set where it fails the i-th filter.

    A null text is empty and a null part is the empty string. A row is good (toxic) when any label row of its id has
    quality (toxic) 1. A row without an id has no labels, is a copy of nothing, and makes no other row a copy."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    type_ = src.schema["id"].dataType.simpleString()
    marked = materialize(src.mapInArrow(_mark, f"id {type_}, part string, faults int, digest binary"), "marked")
    same = marked.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n")).where("least <> most").drop("most")
    rows = join_counted(marked, same, "digest", "n", ["id", "part"], max(1, marked.count()))
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.select("id", "part", F.col("faults").bitwiseOR(F.when(F.col("id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)).alias("faults"))
    return rows.join(said, "id", "left").select("id", "part", "faults", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def gallop(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of the first entry of sorted ``held`` that is not below each of the sorted ``keys``.

    Every 64th key is searched for in the whole list; the keys after it start there and double their step until they
    have passed their place, then halve it. All keys step at once."""
    n = len(held)
    if n == 0 or len(keys) == 0:
        return np.zeros(len(keys), dtype=np.int64)
    low = np.repeat(np.searchsorted(held, keys[::64]), 64)[: len(keys)]
    step, high = 1, low.copy()
    while True:
        behind = (high < n) & (held[np.minimum(high, n - 1)] < keys)
        if not behind.any():
            break
        low[behind] = high[behind] + 1
        high[behind] += step
        step *= 2
    high = np.minimum(high, n)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        below = open_ & (held[np.minimum(middle, n - 1)] < keys)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def members(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of the sorted list ``a`` are in the sorted list ``b``; the shorter one gallops."""
    if len(a) > len(b):
        at = gallop(a, b)
        out = np.zeros(len(a), dtype=bool)
        hit = at < len(a)
        hit[hit] = a[at[hit]] == b[hit]
        out[at[hit]] = True
        return out
    at = gallop(b, a)
    hit = at < len(b)
    hit[hit] = b[at[hit]] == a[hit]
    return hit


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[~members(a, b)]


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted union of sorted lists, the longest taking in what the others have and it lacks."""
    lists = sorted(lists, key=len, reverse=True)
    out = lists[0]
    for one in lists[1:]:
        new = difference(one, out)
        if len(new):
            out = np.insert(out, gallop(out, new), new)
    return out


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, id) -> pieces (part, first_id, last_id, rows, a list per filter and label)."""

    def piece(part: str, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        faults = t.column("faults").to_numpy()
        lists = [np.flatnonzero(faults & (1 << i)) for i in range(len(FILTERS))] + [np.flatnonzero(t.column(c).to_numpy() == 1) for c in ("good", "toxic")]
        ids = t.column("id").combine_chunks()
        cols = [pa.array([part]), ids.slice(0, 1), ids.slice(len(ids) - 1, 1), pa.array([len(ids)], pa.int64())]
        cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
        return pa.RecordBatch.from_arrays([*cols, *[pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in lists]], names=["part", "first_id", "last_id", "rows", *_LISTS])

    part, held, n = None, [], 0
    for b in batches:
        if not len(b):
            continue
        codes = b.column("part").dictionary_encode()
        code = codes.indices.to_numpy()
        cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(b)]
        for s, e in zip(cuts, cuts[1:]):
            own = codes.dictionary[int(code[s])].as_py()
            while s < e:
                if held and (own != part or n == PIECE_ROWS):
                    yield piece(part, held)
                    held, n = [], 0
                take = min(e - s, PIECE_ROWS - n)
                part, n = own, n + take
                held.append(b.slice(s, take))
                s += take
    if held:
        yield piece(part, held)


def posting_lists(marked: DataFrame) -> DataFrame:
    """(part, first_id, last_id, rows, A, B, C, D, E, good, toxic): per part and piece of an id range, sorted lists of
    the places (in id order) of the rows that fail a filter or carry a label. Written once to the shared folder."""
    type_ = marked.schema["id"].dataType.simpleString()
    tie = F.xxhash64("faults", "good", "toxic")
    # ranges of (part, id): a part holding most rows is many ranges; rows equal in everything may share one
    dealt = marked.repartitionByRange(shuffle_partitions(marked.sparkSession), "part", "id", tie).sortWithinPartitions("part", "id", tie)
    return materialize(dealt.mapInArrow(_lists, f"part string, first_id {type_}, last_id {type_}, rows long, " + ", ".join(f"{c} array<int>" for c in _LISTS)), "postings")


def _unions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for i in range(len(b)):
            lists = [b.column(c)[i].values.to_numpy() for c in _LISTS]
            good, toxic = lists[-2:]
            out.append((b.column("part")[i].as_py(), 0, b.column("rows")[i].as_py(), 0, 0))
            merged = {0: lists[0][:0]}
            for chosen in range(1, 1 << len(FILTERS)):
                last = chosen.bit_length() - 1
                merged[chosen] = u = union([merged[chosen ^ (1 << last)], lists[last]])
                out.append((out[-1][0], chosen, len(u), int(members(good, u).sum()), int(members(toxic, u).sum())))
        cols = list(zip(*out)) if out else [[]] * 5
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["part", "chosen", "n", "n_good", "n_toxic"])


def union_sizes(postings: DataFrame) -> DataFrame:
    """(part, chosen, n, n_good, n_toxic): rows of the part that fail any filter of the bit set ``chosen``, how many of
    them are good and toxic; for the empty set, n counts all rows of the part."""
    sizes = postings.mapInArrow(_unions, "part string, chosen int, n long, n_good long, n_toxic long")
    return sizes.groupBy("part", "chosen").agg(*[F.sum(c).alias(c) for c in ("n", "n_good", "n_toxic")])


def interactions(sizes: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    An empty table has no parts and gives no rows."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    every = (1 << len(FILTERS)) - 1
    # 32 entries a part
    per = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("chosen", F.struct("n", "n_good", "n_toxic")))).alias("of"))
    rows = per.select("part", "of", F.explode(F.array(*[F.lit(o) for o in orders])).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits(letters):
        found = [F.when(F.contains(letters, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)]
        return sum(found[1:], found[0])

    own = F.expr("substring(filter_order, step, 1)")
    rows = rows.withColumn("before", bits(F.expr("substring(filter_order, 1, step - 1)"))).withColumn("own", bits(own))
    size = lambda chosen, field: F.when(chosen == 0, F.lit(0).cast("long")).otherwise(F.col("of")[chosen][field])
    before, mine = F.col("before"), F.col("own")
    after, others = before.bitwiseOR(mine), F.lit(every).bitwiseXOR(mine)
    total = F.col("of")[F.lit(0)]["n"]
    lost = lambda field: size(after, field) - size(before, field)
    rows = rows.select("part", "filter_order", "step", own.alias("filter"), (total - size(after, "n")).alias("kept"), lost("n").alias("removed"), (size(mine, "n") - lost("n")).alias("redundant"), (size(F.lit(every), "n") - size(others, "n")).alias("unique_fails"), lost("n_good").alias("good_lost"), lost("n_toxic").alias("toxic_lost"))
    share = rows.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return rows.join(share, ["part", "filter"]).drop("filter")


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part: str = "lang", text: str = "text") -> DataFrame:
    """:func:`interactions` of the five filters on the documents, by way of their posting lists."""
    return interactions(union_sizes(posting_lists(mark_documents(docs, labels, id_col, part, text))))
