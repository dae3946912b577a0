"""N-gram Jaccard self-join with signature trees.

1. Every text becomes its set of word shingles (64-bit hashes). Equal sets collapse to one member right away,
   by a 128-bit fingerprint of the set, so groups of copies count once from here on.
2. MinHash bands bring members together that can be similar. The band count is computed from the threshold so
   that a pair exactly at the threshold misses every band with probability below 1e-10 (higher similarity:
   far below). Members that meet in a band are linked to the smallest member of that band bucket; the
   connected components of these links are the candidate clusters. This only groups work: no pair is
   accepted or refused here.
3. Inside a cluster a signature tree is built: members are ordered by size, leaves hold a few members, and
   every node holds the OR of its members' token bitmaps, the range of their set sizes and the largest number
   of tokens that share a bit. A dual traversal walks pairs of nodes and drops a pair when the sizes cannot
   match or the largest possible overlap is too small. Pairs of leaves that remain are compared by exact set
   intersection, also where their members are connected already, so every link is found. A task gives each
   member's number of links, weighted by the copies of the other set, not the pairs: their number would grow
   with the square of a group.
   A cluster beyond BLOCK_MEMBERS or BLOCK_TOKENS is cut by size class and hash into blocks, and every pair of
   blocks whose sizes can match is one task of its own; blocks are all compared, none is skipped.
4. Components of the accepted links give the classes; the tasks' link counts add up to a row's ``links``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm import words as wd
from veritab.llm.components import connected_components
from veritab.llm.store import materialize

BAND_ROWS = 4
MISS = 1e-10
BLOCK_MEMBERS = 2048
BLOCK_TOKENS = 1_000_000
LEAF_MEMBERS = 32
LEAF_TOKENS = 1 << 16
FANOUT = 4


def bands_for(threshold: float, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at ``threshold`` shares none of them with probability below ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1


def fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """128 bits per set from two sums over its (mixed) members; empty sets have none."""
    full = np.flatnonzero(sizes)
    out: list[bytes | None] = [None] * len(sizes)
    if len(full):
        first = (np.cumsum(sizes) - sizes)[full]
        with np.errstate(over="ignore"):
            a = wd.mix(np.add.reduceat(wd.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first) + sizes[full].astype(np.uint64))
            b = wd.mix(np.add.reduceat(wd.mix(hashes * np.uint64(0xD6E8FEB86659FD93)), first))
        both = np.stack([a, b], axis=1).astype(">u8").tobytes()
        for j, i in enumerate(full.tolist()):
            out[i] = both[16 * j : 16 * j + 16]
    return out


def band_keys(hashes: np.ndarray, sizes: np.ndarray, bands: int, rows: int, seed: int = 11) -> np.ndarray:
    """(sets, bands) keys; rows of empty sets are not included."""
    full = sizes[sizes > 0]
    keys = np.zeros((len(full), bands), dtype=np.uint64)
    if not len(full):
        return keys
    first = np.cumsum(full) - full
    rng = np.random.default_rng(seed)
    mul = rng.integers(1, 1 << 32, size=(bands, rows, 2), dtype=np.uint64) | np.uint64(1)
    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(full), b + 1, dtype=np.uint64)
            for r in range(rows):
                # both halves of the hash take part, so the functions are not shifts of one another
                v = (low * np.uint32(mul[b, r, 0])) ^ (high * np.uint32(mul[b, r, 1]))
                v *= np.uint32(0x9E3779B1)
                key = wd.mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, first))
            keys[:, b] = key
    return keys


def _sketch(keep: list[str], shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, prints, keys = [], [], []
            for _, data, offsets in wd.pieces(b.column("__text")):
                h, sizes = wd.shingle_sets(data, offsets, shingle)
                k = band_keys(h, sizes, bands, rows).view(np.int64)
                n += sizes.tolist()
                prints += fingerprints(h, sizes)
                at = iter(k)
                keys += [next(at) if s else None for s in sizes]
            cols = [b.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=[*keep, "n_shingles", "fp", "bands"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = []
            for _, data, offsets in wd.pieces(b.column("__text")):
                h, sizes = wd.shingle_sets(data, offsets, shingle)
                raw, at = h.tobytes(), 0
                for s in sizes.tolist():
                    sets.append(raw[8 * at : 8 * (at + s)])
                    at += s
            yield pa.RecordBatch.from_arrays([b.column("fp"), pa.array(sets, pa.binary())], names=["fp", "tokens"])

    return run


class Union:
    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.label[x], self.label[y]
            if p != q:  # few: callers leave out pairs that were connected before
                self.label[self.label == max(p, q)] = min(p, q)


class Node:
    __slots__ = ("low", "high", "least", "most", "excess", "bits", "children", "vocabulary", "dense")

    def __init__(self, low: int, high: int):
        self.low, self.high, self.children, self.vocabulary, self.dense = low, high, [], None, None


class SignatureTree:
    """Tree over sets given as token ids (``tokens`` of set i: first[i] … first[i+1]-1), ordered by set size."""

    def __init__(self, tokens: np.ndarray, first: np.ndarray, order: np.ndarray):
        self.tokens, self.first, self.order = tokens, first, order
        self.sizes = np.diff(first)
        most = int(self.sizes.max()) if len(self.sizes) else 1
        self.width = max(256, 1 << (2 * most - 1).bit_length())
        slot = (wd.mix(tokens.astype(np.uint64)) % np.uint64(self.width)).astype(np.int64)
        level, low = [], 0
        while low < len(order):
            high, held = low, 0
            while high < len(order) and (high == low or (high - low < LEAF_MEMBERS and held + self.sizes[order[high]] <= LEAF_TOKENS)):
                held += self.sizes[order[high]]
                high += 1
            level.append(self._leaf(low, high, slot))
            low = high
        while len(level) > 1:
            level = [self._parent(level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
        self.root = level[0] if level else None

    def _leaf(self, low: int, high: int, slot: np.ndarray) -> Node:
        node = Node(low, high)
        members = self.order[low:high]
        sizes = self.sizes[members]
        node.least, node.most = int(sizes.min()), int(sizes.max())
        seen = np.zeros(self.width, dtype=bool)
        node.excess = 0
        for m in members:
            s = np.unique(slot[self.first[m] : self.first[m + 1]])
            seen[s] = True
            node.excess = max(node.excess, int(self.sizes[m]) - len(s))
        node.bits = np.packbits(seen)
        return node

    def _parent(self, children: list[Node]) -> Node:
        node = Node(children[0].low, children[-1].high)
        node.children = children
        node.least, node.most = min(c.least for c in children), max(c.most for c in children)
        node.excess = max(c.excess for c in children)
        node.bits = np.bitwise_or.reduce([c.bits for c in children])
        return node

    def possible(self, a: Node, b: Node, percent: int) -> bool:
        """Whether some pair of members can reach the threshold: sizes, then the largest possible overlap."""
        if 100 * a.most < percent * b.least or 100 * b.most < percent * a.least:
            return False
        shared = int(np.bitwise_count(a.bits & b.bits).sum())
        most = min(a.most, b.most, shared + min(a.excess, b.excess))
        return (100 + percent) * most >= percent * (a.least + b.least)

    def counts(self, a: Node, b: Node) -> np.ndarray:
        """Exact intersection sizes of the members of two leaves."""
        if a.dense is None:
            members = self.order[a.low : a.high]
            parts = [self.tokens[self.first[m] : self.first[m + 1]] for m in members]
            flat = np.concatenate(parts)
            a.vocabulary, where = np.unique(flat, return_inverse=True)
            a.dense = np.zeros((len(a.vocabulary), len(members)), dtype=np.uint8)
            a.dense[where, np.repeat(np.arange(len(members)), [len(p) for p in parts])] = 1
        members = self.order[b.low : b.high]
        parts = [self.tokens[self.first[m] : self.first[m + 1]] for m in members]
        flat, owner = np.concatenate(parts), np.repeat(np.arange(len(members)), [len(p) for p in parts])
        at = np.searchsorted(a.vocabulary, flat)
        at[at == len(a.vocabulary)] = 0
        same = a.vocabulary[at] == flat
        out = np.zeros((len(members), a.high - a.low), dtype=np.int64)
        rows, owner = a.dense[at[same]], owner[same]
        if len(owner):
            begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            out[owner[begin]] = np.add.reduceat(rows, begin, axis=0, dtype=np.int64)
        return out.T

    def connect(self, percent: int, cross: np.ndarray | None = None) -> np.ndarray:
        """Component label of every set under links of Jaccard similarity >= percent/100."""
        return self.links(percent, cross)[0]

    def links(self, percent: int, cross: np.ndarray | None = None, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(component label, links) of every set under links of Jaccard similarity >= percent/100; a link counts as
        often as the other set has ``copies`` (1 each when not given).

        With ``cross`` (a side per set) only sets of different sides are linked."""
        union = Union(len(self.sizes))
        copies = np.ones(len(self.sizes), dtype=np.int64) if copies is None else copies
        number = np.zeros(len(self.sizes), dtype=np.int64)
        todo = [(self.root, self.root)] if self.root else []
        while todo:
            a, b = todo.pop()
            if a is not b and not self.possible(a, b, percent):
                continue
            if a.children or b.children:
                left, right = a.children or [a], b.children or [b]
                if a is b:
                    todo += [(left[i], left[j]) for i in range(len(left) - 1, -1, -1) for j in range(len(left) - 1, i - 1, -1)]
                else:
                    todo += [(x, y) for x in left for y in right]
                continue
            both = self.counts(a, b)
            ma, mb = self.order[a.low : a.high], self.order[b.low : b.high]
            whole = self.sizes[ma][:, None] + self.sizes[mb][None, :] - both
            link = 100 * both >= percent * whole
            if cross is not None:
                link &= cross[ma][:, None] != cross[mb][None, :]
            if a is b:
                link = np.triu(link, 1)
            number[ma] += link @ copies[mb]
            number[mb] += copies[ma] @ link
            i, j = np.nonzero(link & (union.label[ma][:, None] != union.label[mb][None, :]))
            union.join(ma[i], mb[j])
        return union.label, number


def _connect(percent: int):
    """Rows (task, side, fp, copies, tokens) sorted by task: (member, smallest connected member, links) of every
    member with links in a task. No pair of members is compared in two tasks, so a member's links add up."""

    def solve(prints: list[bytes], sides: list[int], copies: list[int], sets: list[bytes]) -> tuple[list[bytes], list[bytes], list[int]]:
        members = {p: r for p, *r in zip(prints, sides, copies, sets)}  # a repeated row counts once
        if len(members) < 2:
            return [], [], []
        names = list(members)
        tokens = np.frombuffer(b"".join(t for _, _, t in members.values()), dtype=np.uint64)
        sizes = np.array([len(t) // 8 for _, _, t in members.values()], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)))
        _, ids = np.unique(tokens, return_inverse=True)
        lead = ids[np.minimum(first[:-1], len(ids) - 1)]
        tree = SignatureTree(ids, first, np.lexsort((lead, sizes)))
        side = np.array([s for s, _, _ in members.values()])
        # sides 1 and 2 are two blocks, also when the other one has no member: pairs inside a block have their own task
        label, number = tree.links(percent, side if side.any() else None, np.array([n for _, n, _ in members.values()], dtype=np.int64))
        linked = np.flatnonzero(number)
        return [names[i] for i in linked], [names[label[i]] for i in linked], number[linked].tolist()

    def found(a: list[bytes], b: list[bytes], n: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, ([], [], [], [])
        out = ([], [], [])
        for batch in batches:
            t = batch.to_pydict()
            for task, *row in zip(t["task"], t["side"], t["copies"], t["tokens"], t["fp"]):
                if task != last:
                    for all_, new in zip(out, solve(held[3], *held[:3])):
                        all_ += new
                    last, held = task, ([], [], [], [])
                for column, value in zip(held, row):
                    column.append(value)
            yield found(*out)
            out = ([], [], [])
        yield found(*solve(held[3], *held[:3]))

    return run


def _tasks(members: DataFrame, percent: int) -> DataFrame:
    """(task, side, fp, copies): members of every comparison task of every candidate cluster.

    A cluster within the block limits is one task. A larger one is cut by size class (sets whose sizes can
    match are in the same or in neighbouring classes) and hash, and every pair of blocks is a task."""
    whole = members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("held"))
    small = (F.col("docs") <= BLOCK_MEMBERS) & (F.col("held") <= BLOCK_TOKENS)
    one = members.join(whole.where(small).select("cluster"), "cluster").select(F.hex("cluster").alias("task"), F.lit(0).alias("side"), "fp", "copies")
    width = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-9
    big = members.join(whole.where(~small).select("cluster"), "cluster").withColumn("cls", F.floor(F.log("n_shingles") / width).cast("long"))
    per = big.groupBy("cluster", "cls").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("held"))
    per = per.withColumn("k", F.ceil(F.greatest(F.col("docs") / BLOCK_MEMBERS, F.col("held") / BLOCK_TOKENS)).cast("long"))
    near = per.select("cluster", (F.col("cls") + 1).alias("cls"), F.col("k").alias("below")).alias("n")
    above = per.select("cluster", (F.col("cls") - 1).alias("cls"), F.col("k").alias("above"))
    per = per.select("cluster", "cls", "k").join(near, ["cluster", "cls"], "left").join(above, ["cluster", "cls"], "left").na.fill(0, ["below", "above"])
    placed = big.join(per, ["cluster", "cls"]).withColumn("s", F.pmod(F.xxhash64("fp"), "k"))

    def name(c1, s1, c2, s2):
        return F.concat_ws("-", F.hex("cluster"), c1, s1, c2, s2)

    pair = lambda task, side: F.struct(task.alias("task"), F.lit(side).cast("int").alias("side") if isinstance(side, int) else side.cast("int").alias("side"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    cls, s = F.col("cls"), F.col("s")
    same = F.transform(upto(F.col("k")), lambda j: pair(name(cls, F.least(s, j), cls, F.greatest(s, j)), F.when(j == s, 0).when(s < j, 1).otherwise(2)))
    up = F.transform(upto(F.col("above")), lambda j: pair(name(cls, s, cls + 1, j), 1))
    down = F.transform(upto(F.col("below")), lambda j: pair(name(cls - 1, j, cls, s), 2))
    many = placed.select("fp", "copies", F.explode(F.concat(same, up, down)).alias("t")).select("t.task", "t.side", "fp", "copies")
    return one.unionByName(many)


def jaccard_classes(docs: DataFrame, keep: list[str], shingle: int = 4, percent: int = 85, text: str = "text") -> DataFrame:
    """``keep`` columns of every row with n_shingles (set size), fp (fingerprint of the set, null when empty),
    class (the smallest fingerprint reachable by links of Jaccard similarity >= percent/100; null when empty) and
    links (the number of other rows whose set has that similarity to the row's, rows with an equal set included).

    Words are runs of non-space bytes with A-Z lower-cased. A text with fewer than ``shingle`` words is one
    shingle; null and empty texts have an empty set and are linked with nothing. Rows with equal sets are in
    one class. Repeated rows stay. Extra columns are ignored."""
    clash = {"n_shingles", "fp", "class", "links"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by this operator")
    bands = bands_for(percent / 100)
    row_key = F.md5(F.concat_ws("\u0000", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in keep], F.col("__text")))
    src = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("__key", row_key)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.drop("__text").schema)
    names = [*keep, "__key"]
    sketched = materialize(src.mapInArrow(_sketch(names, shingle, bands, BAND_ROWS), f"{types}, n_shingles long, fp binary, bands array<bigint>"), "sketch")
    # one member per set: the row with the smallest key stands for it
    member = materialize(sketched.where("fp IS NOT NULL").groupBy("fp").agg(F.min("__key").alias("__key"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("copies")), "members")
    # candidate clusters only group work, so 64 bits name a member here; two members of one name share a cluster
    short = F.xxhash64("fp")
    cells = sketched.join(member.select("fp", "__key"), ["fp", "__key"], "left_semi").select(short.alias("id"), F.explode("bands").alias("key"))
    met = cells.groupBy("key").agg(F.min("id").alias("root"), F.max("id").alias("last")).where("root <> last")
    edges = cells.join(met.select("key", "root"), "key").where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    clusters = materialize(connected_components(edges).join(member.withColumn("id", short), "id").select("fp", "__key", "n_shingles", "copies", F.col("root").alias("cluster")), "clusters")
    # a shuffle join at every size: the members of clusters grow with the corpus, so they are never broadcast
    texts = src.select("__key", "__text").join(clusters.select("__key", "fp").hint("merge"), "__key")
    sets = texts.select("fp", "__text").mapInArrow(_sets(shingle), "fp binary, tokens binary")
    work = _tasks(clusters, percent).join(sets, "fp").select("task", "side", "fp", "copies", "tokens")
    links = materialize(work.repartition("task").sortWithinPartitions("task").mapInArrow(_connect(percent), "a binary, b binary, n long"), "links")
    number = links.groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("others"))
    classes = connected_components(links.select("a", "b")).withColumnRenamed("id", "fp")
    of_set = member.select("fp", "copies").join(classes, "fp", "left").join(number, "fp", "left")
    of_set = of_set.select("fp", "root", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    out = sketched.select(*keep, "n_shingles", "fp").join(of_set, "fp", "left")
    return out.select(*keep, "n_shingles", "fp", F.coalesce("root", "fp").alias("class"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def smallest_of_class(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add ``component_id``: the smallest id of the row's class; a row without a set is a class of its own."""
    low = rows.where("class IS NOT NULL").groupBy("class").agg(F.min(id_col).alias("__low"))
    return rows.join(low, "class", "left").withColumn("component_id", F.when(F.col("class").isNull(), F.col(id_col)).otherwise(F.col("__low"))).drop("__low")
