"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of every benchmark item (an item with fewer words is
one pattern). For each pattern length m, blocks of two words index a shift table: a block that ends no
pattern lets the scan jump ahead by its distance from the patterns' ends, at most m-1 words. Where the shift
is zero, the bucket of that block holds the patterns that end in it, and each is compared word by word.

Texts are scanned in whole. A batch's words are cut into stretches that advance in lock step (numpy), so one
step of the scan moves thousands of positions; a stretch owns the pattern ends that fall into it, so nothing
is lost or found twice at its borders.

The patterns go to the tasks inside the closure, in parts of at most PATTERN_BYTES benchmark text each; a
larger benchmark takes one pass over the documents per part and the passes' hits are merged, so the size of
what is sent is bounded while every item is searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm import words as wd

PATTERN_BYTES = 16 << 20
TABLE_BITS = 18
STRETCH = 256


@dataclass
class Length:
    """Patterns of one length with their shift table and buckets."""

    m: int
    patterns: np.ndarray  # (patterns, m) word hashes, sorted by the block at their end
    shift: np.ndarray  # by block slot: words to jump ahead
    bucket_first: np.ndarray  # patterns of slot s: bucket_first[s] … bucket_first[s+1]-1
    item_first: np.ndarray  # items of pattern p: items[item_first[p] … item_first[p+1]-1]
    items: np.ndarray


@dataclass
class Index:
    lengths: list[Length] = field(default_factory=list)
    names: list[str] = field(default_factory=list)  # item ids as strings, by item number


def _slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def build_index(item_ids: list, texts: list[str | None], window: int) -> Index:
    """Windows of all items, each distinct window once with the list of items that hold it."""
    column = pa.array(texts, type=pa.large_string())
    found: dict[int, dict[tuple, set[int]]] = {}
    names = [None if i is None else str(i) for i in item_ids]
    for row, data, offsets in wd.pieces(column):
        starts, ends, counts = wd.split(data, offsets, wd.ALNUM_WORDS)
        h = wd.word_hashes(data, starts, ends, wd.ALNUM_WORDS).tolist()
        at = 0
        for i, c in enumerate(counts.tolist()):
            m = min(window, c)
            for j in range(c - m + 1 if m else 0):
                found.setdefault(m, {}).setdefault(tuple(h[at + j : at + j + m]), set()).add(row + i)
            at += c
    out = Index(names=names)
    for m, patterns in sorted(found.items()):
        keys = list(patterns)
        p = np.array(keys, dtype=np.uint64).reshape(len(keys), m)
        tail = _slots(p[:, -2], p[:, -1]) if m > 1 else _slots(np.zeros(len(p), dtype=np.uint64), p[:, -1])
        order = np.argsort(tail, kind="stable")
        p, tail = p[order], tail[order]
        n = 1 << TABLE_BITS
        shift = np.full(n, max(1, m - 1), dtype=np.int32)
        for j in range(m - 1):  # block of words j, j+1 ends m-2-j words before the pattern's end
            np.minimum.at(shift, _slots(p[:, j], p[:, j + 1]), m - 2 - j)
        if m == 1:
            shift[tail] = 0
        lists = [sorted(patterns[keys[i]]) for i in order]
        out.lengths.append(Length(m, p, shift, np.searchsorted(tail, np.arange(n + 1)), np.concatenate(([0], np.cumsum([len(x) for x in lists]))), np.concatenate([np.array(x, dtype=np.int64) for x in lists])))
    return out


def find(length: Length, w: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word position where an occurrence starts, pattern) for the words ``w`` of rows of ``counts`` words."""
    m = length.m
    rows = np.flatnonzero(counts >= m)
    none = np.zeros(0, dtype=np.int64)
    if not len(rows) or not len(length.patterns):
        return none, none
    # stretches of end positions: each row's ends run from first+m-1 to first+count-1
    low, high = first[rows] + m - 1, first[rows] + counts[rows]
    per = -(-(high - low) // STRETCH)
    pos = np.repeat(low, per) + (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * STRETCH
    stop = np.minimum(pos + STRETCH, np.repeat(high, per))
    at, pattern = [], []
    zero = np.zeros(1, dtype=np.uint64)
    while len(pos):
        slot = _slots(w[pos - 1], w[pos]) if m > 1 else _slots(zero, w[pos])
        jump = length.shift[slot]
        hit = np.flatnonzero(jump == 0)
        if len(hit):
            a, n = length.bucket_first[slot[hit]], length.bucket_first[slot[hit] + 1] - length.bucket_first[slot[hit]]
            cand = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
            end = np.repeat(pos[hit], n)
            for j in range(m):  # word by word from the first, dropping what differs
                same = w[end - m + 1 + j] == length.patterns[cand, j]
                cand, end = cand[same], end[same]
                if not len(cand):
                    break
            at.append(end - m + 1)
            pattern.append(cand)
        pos = pos + np.maximum(jump, 1)
        alive = pos < stop
        pos, stop = pos[alive], stop[alive]
    return (np.concatenate(at), np.concatenate(pattern)) if at else (none, none)


def scan(column: pa.Array, index: Index) -> Iterator[tuple[int, list[int], list[list[tuple[int, int]]], list[list[str]]]]:
    """(first row, words per row, hit word runs [start, end) per row, items per row) for pieces of a text column."""
    for row, data, offsets in wd.pieces(column):
        starts, ends, counts = wd.split(data, offsets, wd.ALNUM_WORDS)
        w = wd.word_hashes(data, starts, ends, wd.ALNUM_WORDS)
        first = np.cumsum(counts) - counts
        runs: list[list[tuple[int, int]]] = [[] for _ in counts]
        items: list[list[str]] = [[] for _ in counts]
        cover = np.zeros(len(w) + 1, dtype=np.int32)
        pairs = []
        for length in index.lengths:
            at, pattern = find(length, w, first, counts)
            if len(at):
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length.m, -1)
                doc = np.searchsorted(first + counts, at, side="right")
                pattern_docs = np.unique(np.stack([doc, pattern]), axis=1)
                n = length.item_first[pattern_docs[1] + 1] - length.item_first[pattern_docs[1]]
                item = length.items[np.repeat(length.item_first[pattern_docs[1]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                pairs.append(np.stack([np.repeat(pattern_docs[0], n), item]))
        if pairs:
            hit = np.cumsum(cover[:-1]) > 0
            row_of = np.repeat(np.arange(len(counts)), counts)
            edge = np.flatnonzero(np.diff(np.concatenate(([False], hit))) | (np.diff(np.concatenate(([-1], row_of))) != 0))
            edge = np.append(edge, len(w))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if hit[a]:
                    r = int(row_of[a])
                    runs[r].append((a - int(first[r]), b - int(first[r])))
            for r, i in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
                if index.names[i] is not None:
                    items[r].append(index.names[i])
        yield row, counts.tolist(), runs, items


RESULT = "n_words long, hit_runs array<struct<start:long,end:long>>, items array<string>"
_RUN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _mapper(ids: list, texts: list, window: int, keep: list[str], text: str):
    state: list[Index] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(build_index(ids, texts, window))
        for b in batches:
            n, runs, items = [], [], []
            for _, c, r, i in scan(b.column(b.schema.get_field_index(text)), state[0]):
                n += c
                runs += [[{"start": x, "end": y} for x, y in row] for row in r]
                items += [sorted(set(row)) for row in i]
            cols = [b.column(b.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(items, pa.list_(pa.string()))], names=[*keep, "n_words", "hit_runs", "items"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: list[str] | None = None, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep`` columns of every document with n_words, hit_runs (maximal runs of hit word positions, [start, end))
    and items (ids, as strings, of the items with an occurring window, sorted).

    Null and empty texts have no words. Items without words match nothing; an item whose id is null hits words
    but is not listed; repeated items count once by id. The result has one row per input row; no text is
    shuffled when the benchmark fits one part."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    clash = {"n_words", "hit_runs", "items"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by this operator; rename or leave them out of keep")
    bench = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t IS NOT NULL").distinct()
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    parts = max(1, -(-total["b"] // PATTERN_BYTES))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), RESULT])
    if parts > 1:  # one pass per part; a surrogate row number ties the passes together
        from veritab.llm.store import materialize

        docs = materialize(docs.select(*dict.fromkeys([*keep, text])).withColumn("__row", F.monotonically_increasing_id()), "decontaminate")
        found = None
        for p in range(parts):
            some = bench.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == p).collect()  # at most about PATTERN_BYTES
            one = docs.mapInArrow(_mapper([r["i"] for r in some], [r["t"] for r in some], window, ["__row"], text), f"__row long, {RESULT}")
            found = one if found is None else found.unionByName(one)
        runs = F.array_sort(F.flatten(F.collect_list("hit_runs")))
        merged = F.aggregate(
            runs,
            F.array().cast("array<struct<start:bigint,end:bigint>>"),
            lambda acc, r: F.when(F.size(acc) == 0, F.array(r))
            .when(F.element_at(acc, -1)["end"] >= r["start"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(r))),
        )
        joined = found.groupBy("__row").agg(F.max("n_words").alias("n_words"), merged.alias("hit_runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        return docs.select(*keep, "__row").join(joined, "__row").drop("__row")
    some = bench.collect()  # bounded: total["b"] <= PATTERN_BYTES
    cols = list(dict.fromkeys([*keep, text]))
    return docs.select(*cols).mapInArrow(_mapper([r["i"] for r in some], [r["t"] for r in some], window, keep, text), schema)


def digest(found: DataFrame) -> DataFrame:
    """Per-document counts of a decontamination result."""
    hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_runs") > 0).alias("contaminated"))


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
