"""Near-duplicate classes by fast similarity sketching, banding and exact verification.

1. Every text becomes its set of word shingles (64-bit hashes). A sketch of t coordinates is filled in rounds: in
   round i each shingle is hashed to one coordinate and a value, and a coordinate that no earlier round has filled
   takes the smallest value it gets. After t such rounds, round t+j offers every shingle to coordinate j, so every
   coordinate is filled after 2t rounds at the latest. Two sets agree in a coordinate with probability equal to
   their Jaccard similarity, and the number of agreements is concentrated as for t independent functions; a large
   set needs about two rounds instead of t functions.
2. Bands of consecutive coordinates name buckets. Sets that share a bucket are linked to the bucket's smallest
   set; the components of these links are clusters, which only gather work. The number of bands follows the
   threshold: a pair exactly at it shares no band with probability below 1e-10.
3. Links are verified on the full sets. A cluster within the block limits is one task. A larger one first meets a
   few pivots drawn from it: sets linked to one pivot (or to pivots that are linked) form a body that needs no
   comparison inside. Jaccard distance is a metric, so sets whose distances to a pivot differ by more than the
   threshold's distance cannot be linked; sets are cut into blocks by body, size class and ring around the first
   pivot, and only pairs of blocks that may hold a link between different bodies are compared. A task walks the
   links breadth first: a set is compared only with sets not reached yet.
4. Components of the verified links are the classes.
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
from veritab.llm.jaccard import fingerprints
from veritab.llm.skew import bit_filter, in_filter, join_counted
from veritab.llm.store import materialize

BAND_ROWS = 4
MISS = 1e-10
BLOCK_MEMBERS = 2048
BLOCK_TOKENS = 1_000_000
PIVOTS = 4
RINGS = 20

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROUND = np.uint64(0xD1B54A32D192ED03)


def bands_for(threshold: float, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at ``threshold`` shares none of them with probability below ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1


def fast_sketches(hashes: np.ndarray, sizes: np.ndarray, t: int) -> np.ndarray:
    """(sets, t) sketch of the sets given one after another; empty sets are not included."""
    sizes = sizes[sizes > 0]
    m = len(sizes)
    out = np.full(m * t, _EMPTY, dtype=np.uint64)
    owner, x = np.repeat(np.arange(m, dtype=np.int64) * t, sizes), hashes

    def offer(place: np.ndarray, value: np.ndarray) -> None:
        free = out[place] == _EMPTY  # filled by an earlier round otherwise
        np.minimum.at(out, place[free], np.minimum(value[free], _EMPTY - np.uint64(1)))

    def values(i: int, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return wd.mix(x + _ROUND * np.uint64(i + 1))

    for i in range(t):
        v = values(i, x)
        coordinate = ((v >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        offer(owner + coordinate.astype(np.int64), (v << np.uint64(32)) | (v >> np.uint64(32)))
        unfinished = (out.reshape(m, t) == _EMPTY).any(axis=1)
        if not unfinished.any():
            return out.reshape(m, t)
        still = unfinished[owner // t]
        owner, x = owner[still], x[still]
    for j in range(t):
        need = out[owner + j] == _EMPTY
        if need.any():
            offer(owner[need] + j, values(t + j, x[need]))
    return out.reshape(m, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sketches), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(sketches), b + 1, dtype=np.uint64)
            for r in range(rows):
                key = wd.mix(key * _ROUND + sketches[:, b * rows + r])
            keys[:, b] = key
    return keys


def _sketch(keep: list[str], shingle: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, prints, keys = [], [], []
            for _, data, offsets in wd.pieces(b.column("__text")):
                h, sizes = wd.shingle_sets(data, offsets, shingle)
                at = iter(band_keys(fast_sketches(h, sizes, bands * BAND_ROWS), bands, BAND_ROWS).view(np.int64))
                n += sizes.tolist()
                prints += fingerprints(h, sizes)
                keys += [next(at) if s else None for s in sizes]
            cols = [b.column(c) for c in keep]
            made = [pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*cols, *made], names=[*keep, "n_shingles", "fp", "__bands"])

    return run


def _sets(shingle: int, wanted):
    """(key, fp, tokens) of the rows whose key the broadcast bitmap holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(in_filter(wanted.value, b.column("__key").to_numpy())))
            prints, sets = [], []
            for _, data, offsets in wd.pieces(b.column("__text")):
                h, sizes = wd.shingle_sets(data, offsets, shingle)
                prints += fingerprints(h, sizes)
                raw, at = h.tobytes(), 0
                for s in sizes.tolist():
                    sets.append(raw[8 * at : 8 * (at + s)])
                    at += s
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], names=["__key", "fp", "tokens"])

    return run


class Sets:
    """Sets of tokens given one after another, renumbered so that a set can be marked in a flat array."""

    def __init__(self, sets: list[bytes]):
        self.sizes = np.array([len(s) // 8 for s in sets], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        _, self.tokens = np.unique(np.frombuffer(b"".join(sets), dtype=np.uint64), return_inverse=True)
        self._mark = np.zeros(int(self.tokens.max()) + 1 if len(self.tokens) else 1, dtype=np.int64)

    def shared(self, one: int, others: np.ndarray) -> np.ndarray:
        """Intersection sizes of set ``one`` with each of ``others``."""
        own = self.tokens[self.first[one] : self.first[one + 1]]
        self._mark[own] = 1
        sizes = self.sizes[others]
        begin = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) + np.repeat(self.first[others] - begin, sizes)
        out = np.add.reduceat(self._mark[self.tokens[place]], begin)
        self._mark[own] = 0
        return out

    def linked(self, one: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Which of ``others`` reach the similarity with ``one``."""
        a, b = self.sizes[one], self.sizes[others]
        fits = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (b > 0)
        out = np.zeros(len(others), dtype=bool)
        if fits.any():
            both = self.shared(one, others[fits])
            out[fits] = 100 * both >= percent * (a + b[fits] - both)
        return out


def walk(sets: Sets, percent: int, side: np.ndarray, body: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the sets: breadth first, each set compared only with sets not reached yet. Sets of one
    body are connected beforehand; with sides other than 0, only sets of different sides are compared."""
    edges, left = [], np.ones(len(sets.sizes), dtype=bool)
    order = np.argsort(-body, kind="stable")  # bodies first: what they reach needs no walk of its own
    for start in order.tolist():
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            one = front.pop()
            if body[one] >= 0:
                mates = np.flatnonzero(left & (body == body[one]))
                left[mates] = False
                front += mates.tolist()
            others = np.flatnonzero(left & (side != side[one]) if side[one] else left)
            if len(others):
                found = others[sets.linked(one, others, percent)]
                left[found] = False
                front += found.tolist()
                edges += [(one, f) for f in found.tolist()]
    return edges


def _edges(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _verify(percent: int):
    """Rows (task, side, body, fp, tokens) sorted by task -> links (a, b)."""

    def solve(held: dict) -> pa.RecordBatch:
        if len(held) < 2:
            return _edges([], [])
        names = list(held)
        side, body = (np.array([held[f][i] for f in names]) for i in (0, 1))
        pairs = walk(Sets([held[f][2] for f in names]), percent, side, body)
        return _edges([names[i] for i, _ in pairs], [names[j] for _, j in pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}
        for batch in batches:
            t = batch.to_pydict()
            for task, side, body, fp, tokens in zip(t["task"], t["side"], t["body"], t["fp"], t["tokens"]):
                if task != last:
                    yield solve(held)
                    last, held = task, {}
                held[fp] = (side, body, tokens)  # a repeated row counts once
        yield solve(held)

    return run


def _meet(percent: int):
    """Rows (cluster, salt, pivot, fp, tokens), pivots (numbered) before members (-1): the body of every member (the
    smallest pivot connected to it through pivots, -1 for none), its ring around the first pivot and the pivot it is
    linked to."""

    def measure(pivots: list, members: list) -> tuple[list, list, list]:
        sets = Sets([p[1] for p in pivots] + [m[1] for m in members])
        k, everyone = len(pivots), np.arange(len(pivots) + len(members))
        link = np.stack([sets.linked(j, everyone, percent) for j in range(k)])
        label = np.arange(k)
        for _ in range(k):
            for i in range(k):
                label[i] = min([label[i], *label[:k][link[:, i]]])
                label[link[i, :k]] = np.minimum(label[link[i, :k]], label[i])
        both = sets.shared(0, everyone)
        far = 1 - both / np.maximum(sets.sizes[0] + sets.sizes - both, 1)
        ring = np.floor(far * RINGS).astype(int)[k:]
        body, to = [], []
        for i in range(len(members)):
            met = np.flatnonzero(link[:, k + i])
            body.append(int(label[met].min()) if len(met) else -1)
            to.append(pivots[met[0]][0] if len(met) else None)
        return body, ring.tolist(), to

    def flush(cluster, pivots, members) -> pa.RecordBatch:
        body, ring, to = measure(pivots, members) if members else ([], [], [])
        cols = [pa.array([cluster] * len(members), pa.int64()), pa.array([m[0] for m in members], pa.binary()), pa.array(body, pa.int32()), pa.array(ring, pa.int32()), pa.array(to, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["cluster", "fp", "body", "ring", "pivot_fp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivots, members, held = None, [], [], 0
        for batch in batches:
            t = batch.to_pydict()
            for cluster, salt, pivot, fp, tokens in zip(t["cluster"], t["salt"], t["pivot"], t["fp"], t["tokens"]):
                if (cluster, salt) != last or held > 8 * BLOCK_TOKENS:
                    if members:
                        yield flush(last[0], pivots, members)
                    if (cluster, salt) != last:
                        pivots = []
                    last, members, held = (cluster, salt), [], 0
                if pivot >= 0:
                    pivots.append((fp, tokens))
                else:
                    members.append((fp, tokens))
                    held += len(tokens)
        if members:
            yield flush(last[0], pivots, members)

    return run


def _large_tasks(big: DataFrame, whole: DataFrame, percent: int, total: int) -> tuple[DataFrame, DataFrame]:
    """Links to pivots and the block-pair tasks of clusters beyond the block limits (``big``: cluster, fp, n_shingles,
    tokens, salts; ``whole``: a row per such cluster)."""
    drawn = whole.select("cluster", "salts", F.posexplode(F.array_distinct(F.array(*[F.col(f"p{j}.fp") for j in range(PIVOTS)]))).alias("pivot", "fp"))
    pivots = drawn.join(big.select("fp", "tokens"), "fp").dropDuplicates(["cluster", "pivot"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    members = big.withColumn("salt", F.pmod(F.xxhash64("fp"), "salts").cast("int"))
    cols = ["cluster", "salt", "pivot", "fp", "tokens"]
    rows = pivots.select(cols).unionByName(members.withColumn("pivot", F.lit(-1)).select(cols))
    rows = rows.repartition("cluster", "salt").sortWithinPartitions("cluster", "salt", (F.col("pivot") < 0), "pivot")
    met = materialize(rows.mapInArrow(_meet(percent), "cluster long, fp binary, body int, ring int, pivot_fp binary"), "met")
    links = met.where("pivot_fp <> fp").select(F.col("fp").alias("a"), F.col("pivot_fp").alias("b"))

    width = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-9
    sized = met.join(big.select("fp", "n_shingles").dropDuplicates(["fp"]), "fp").withColumn("cls", F.floor(F.log("n_shingles") / width).cast("long"))
    kind = ["cluster", "body", "cls", "ring"]
    sized = sized.withColumn("kind", F.concat_ws("-", F.hex("cluster"), "body", "cls", "ring"))
    per = sized.groupBy("kind", *kind).agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("held"))
    per = per.withColumn("k", F.ceil(F.greatest(F.col("docs") / BLOCK_MEMBERS, F.col("held") / BLOCK_TOKENS)).cast("int"))
    blocks = per.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("block", F.concat_ws("-", "kind", "s"))
    reach = math.ceil((1 - percent / 100) * RINGS) + 1
    other = blocks.select("cluster", F.col("cls").alias("c2"), F.col("ring").alias("r2"), F.col("body").alias("b2"), F.col("block").alias("block2"))
    near = blocks.withColumn("c2", F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)))
    near = near.withColumn("r2", F.explode(F.sequence(F.col("ring") - reach, F.col("ring") + reach)))
    pairs = near.join(other, ["cluster", "c2", "r2"]).where("block <= block2 AND NOT (body >= 0 AND body = b2)")
    task = F.concat_ws("/", "block", "block2")
    sides = pairs.select(F.explode(F.when(F.col("block") == F.col("block2"), F.array(F.struct(F.col("block").alias("block"), task.alias("task"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("block").alias("block"), task.alias("task"), F.lit(1).alias("side")), F.struct(F.col("block2").alias("block"), task.alias("task"), F.lit(2).alias("side"))))).alias("x")).select("x.*")
    placed = join_counted(sized, per.select("kind", "k", "docs"), "kind", "docs", ["fp"], total)
    placed = placed.withColumn("block", F.concat_ws("-", "kind", F.pmod(F.xxhash64(F.lit(1), "fp"), "k")))
    return links, placed.select("fp", "body", "block").join(sides, "block").select("task", "side", "body", "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", shingle: int = 3, percent: int = 85, text: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_shingles (set size), fp (128-bit fingerprint of the set, null when empty) and
    component_id: the smallest id reachable by links of Jaccard similarity >= percent/100.

    Words are runs of non-space bytes with A-Z lower-cased. A text with fewer than ``shingle`` words is one shingle;
    null and empty texts have an empty set, are linked with nothing and keep their own id. Rows with equal sets are
    linked. Repeated rows stay. A row without an id takes its class's smallest id, null when no row of the class has
    one. Other columns are ignored."""
    bands = bands_for(percent / 100)
    src = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("__key", F.xxhash64("__id", "__text"))
    type_ = src.schema["__id"].dataType.simpleString()
    sketched = materialize(src.mapInArrow(_sketch(["__id", "__key"], shingle, bands), f"__id {type_}, __key long, n_shingles long, fp binary, __bands array<bigint>"), "sketch")
    total = max(1, sketched.count())
    # one member per set; the row with the smallest key stands for it
    member = sketched.where("fp IS NOT NULL").groupBy("fp").agg(F.min("__key").alias("__key"), F.max("n_shingles").alias("n_shingles"), F.min("__id").alias("low"), F.count("*").alias("copies"), F.any_value("__bands").alias("__bands"))
    member = materialize(member, "members")
    # 64 bits name a member in the buckets; two members of one name only share a cluster
    cells = member.select(F.xxhash64("fp").alias("id"), F.explode("__bands").alias("key"))
    met = cells.groupBy("key").agg(F.min("id").alias("root"), F.max("id").alias("last"), F.count("*").alias("n")).where("root <> last").select("key", "root", "n")
    edges = join_counted(cells, met, "key", "n", ["id"], total * bands).where("root IS NOT NULL AND id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    clusters = connected_components(edges).withColumnRenamed("root", "cluster")
    clusters = materialize(member.withColumn("id", F.xxhash64("fp")).join(clusters, "id").select("fp", "__key", "n_shingles", "cluster"), "clusters")
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(bit_filter(clusters.select("__key"), "__key"))
    sets = src.select("__key", "__text").mapInArrow(_sets(shingle, wanted), "__key long, fp binary, tokens binary")
    sets = materialize(clusters.hint("merge").join(sets, ["__key", "fp"]).select("cluster", "fp", "n_shingles", "tokens"), "sets")
    pivot = [F.min(F.struct(F.xxhash64(F.lit(j), "fp").alias("h"), "fp")).alias(f"p{j}") for j in range(PIVOTS)]
    whole = clusters.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("held"), *pivot)
    salts = F.ceil(F.greatest(F.col("docs") / BLOCK_MEMBERS, F.col("held") / BLOCK_TOKENS)).cast("int")
    whole = materialize(whole.withColumn("salts", salts), "sizes")  # 1: within the limits
    placed = join_counted(sets, whole.select("cluster", "salts", "docs"), "cluster", "docs", ["fp"], total)
    tasks = placed.where("salts = 1").select(F.hex("cluster").alias("task"), F.lit(0).alias("side"), F.lit(-1).alias("body"), "fp", "tokens")
    links = None
    if whole.where("salts > 1").count():
        big = materialize(placed.where("salts > 1"), "large")
        links, pairs = _large_tasks(big, whole.where("salts > 1"), percent, total)
        tasks = tasks.unionByName(pairs.join(big.select("fp", "tokens").dropDuplicates(["fp"]), "fp").select("task", "side", "body", "fp", "tokens"))
    found = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_verify(percent), "a binary, b binary")
    links = materialize(found if links is None else found.unionByName(links), "links")
    wanted.unpersist()
    classes = connected_components(links).withColumnRenamed("id", "fp").join(member.select("fp", "low"), "fp")
    least = classes.groupBy("root").agg(F.min("low").alias("least"), F.count("*").alias("n"))
    least = join_counted(classes.select("fp", "root"), least, "root", "n", ["fp"], total).select("fp", "least")
    of_set = member.select("fp", "low", "copies").join(least, "fp", "left").select("fp", F.coalesce("least", "low").alias("least"), "copies")
    out = join_counted(sketched.select("__id", "__key", "n_shingles", "fp"), of_set, "fp", "copies", ["__id", "__key"], total)
    return out.select(F.col("__id").alias(id_col), "n_shingles", "fp", F.when(F.col("fp").isNull(), F.col("__id")).otherwise(F.col("least")).alias("component_id"))
