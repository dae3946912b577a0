"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are ordered grades 0 … G-1. One weight per hashed text feature is shared by all grades, and G-1
ordered thresholds cut the score: P(grade > g) = sigmoid(score - threshold_g). The expected grade is the sum of
these tail probabilities; selection uses the tail probability of the grade wanted.

Features are present or not: hashed words (A-Z lower-cased, outer punctuation cut off), and a few words that
describe the text's shape in steps (share of words without letters, of words equal to the one before, of
repeated lines and words, of words with several marks, and the length). A text of any length is read whole. The weights have an L1
penalty, so words that carry no signal stay at zero and long clean texts do not collect noise.

The model is fitted on about ``sample_rows`` labelled rows, an equal number of every grade as far as there are so
many (smallest key hashes first); labels need not cover the corpus. The executors find their features, count them and
drop the rare ones; the descents over the bounded rest run in one task. Only the fitted weights come to the driver.
Scoring reads every text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm import words as wd
from veritab.llm.store import materialize

BITS = 44  # hashed feature space; the model holds the few slots with a weight, so collisions do not matter
SAMPLE_ROWS = 12_000
SAMPLE_FEATURES = 8_000_000  # feature slots (4 bytes each) that the fitting task takes at once
MIN_ROWS = 4  # words of fewer sampled rows get no weight


@dataclass
class OrdinalModel:
    slots: np.ndarray  # sorted feature slots with a weight; shape slots follow the hashed words
    weights: np.ndarray  # by position in ``slots``
    thresholds: np.ndarray  # increasing, one per border between grades
    bits: int = BITS

    def scores(self, slots: np.ndarray, owners: np.ndarray, rows: int) -> np.ndarray:
        """Sum of the weights of every row's features."""
        if not len(self.slots):
            return np.zeros(rows)
        at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        known = self.slots[at] == slots
        return np.bincount(owners[known], weights=self.weights[at[known]], minlength=rows)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """(rows, borders): P(grade > g)."""
        return 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


#: Borders of the steps of a shape figure: none, up to 2%, 5%, 10%, 20%, 40%, more.
STEPS = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.4])
SHAPE_SLOTS = 64
SHAPE_VALUE = 3.0  # value of a shape feature; words have 1


def _share(flags: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.bincount(owner[flags], minlength=len(counts)) / np.maximum(counts, 1)


def features(column: pa.Array, bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, feature slots, row of each slot) of pieces of a text column; distinct slots per row."""
    for first, data, offsets in wd.pieces(column):
        rows = len(offsets) - 1
        starts, ends, counts = wd.split(data, offsets, wd.SPACE_WORDS)
        owner = np.repeat(np.arange(rows), counts)
        whole = wd.word_hashes(data, starts, ends, wd.SPACE_WORDS)
        # the core of a word: from its first to its last letter, digit or byte beyond ASCII
        s2, e2, _ = wd.split(data, offsets, wd.ALNUM_WORDS)
        a = np.searchsorted(s2, starts)
        z = np.searchsorted(e2, ends, side="right") - 1
        core = a <= z
        word = whole.copy()
        if core.any():
            word[core] = wd.word_hashes(data, s2[a[core]], e2[z[core]], wd.ALNUM_WORDS)
        same = np.zeros(len(whole), dtype=bool)
        same[1:] = (whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])
        slot = (word >> np.uint64(64 - bits)).astype(np.int64)
        pair = np.unique((owner << bits) | slot)
        pair_owner, pair_slot = pair >> bits, pair & ((1 << bits) - 1)
        distinct = np.bincount(pair_owner, minlength=rows)
        line_starts = np.concatenate((offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(data == 10) + 1))
        line_starts = np.unique(line_starts[line_starts < len(data)])
        line_ends = np.append(line_starts[1:], len(data))
        lines = wd.word_hashes(data, line_starts, line_ends, _ALL)
        line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
        line_counts = np.bincount(line_owner, minlength=rows)
        _, one = np.unique(wd.mix(lines + wd.mix(line_owner)), return_index=True)
        line_distinct = np.bincount(line_owner[one], minlength=rows)
        shapes = [
            _share(~core, owner, counts),
            _share(same, owner, counts),
            1 - line_distinct / np.maximum(line_counts, 1),
            np.where(counts >= 50, 1 - distinct / np.maximum(counts, 1), 0.0),
            _share(_odd(data, starts, ends), owner, counts),
            np.log2(np.maximum(counts, 1)) / 40,
        ]
        # shape slots come after the hashed words, so that no word shares a weight with them
        extra = [(1 << bits) + 8 * i + np.searchsorted(STEPS, v, side="left") for i, v in enumerate(shapes)]
        full = np.flatnonzero(counts)
        slots = np.concatenate([pair_slot, *[x[full] for x in extra]])
        owners = np.concatenate([pair_owner, *[full for _ in extra]])
        yield first, slots, owners


_ALL = wd.alphabet(np.ones(256, dtype=bool))
_MARK = np.zeros(256, dtype=np.int64)
_MARK[0x21:0x30] = _MARK[0x3A:0x41] = _MARK[0x5B:0x61] = _MARK[0x7B:0x7F] = 1


def _odd(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words with the same punctuation mark twice in a row."""
    again = np.zeros(len(data), dtype=np.int64)
    again[1:] = _MARK[data[1:]] & (data[1:] == data[:-1])
    total = np.concatenate(([0], np.cumsum(again)))
    return (ends > starts + 1) & (total[ends] - total[np.minimum(starts + 1, len(data))] > 0)


def _descend(slot: np.ndarray, begin: np.ndarray, value: np.ndarray, grades: np.ndarray, levels: int, size: int, epochs: int, rate: float, l1: float, batch: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds): adaptive-gradient descent on the cumulative-link likelihood with a proximal L1 step."""
    n = len(grades)
    w, g2 = np.zeros(size), np.full(size, 1e-8)
    share = np.array([(grades > g).mean() for g in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    t = np.sort(-np.log(share / (1 - share))) + np.arange(levels - 1) * 1e-6
    t2 = np.full(levels - 1, 1e-8)
    # rare grades count as much as common ones
    present = np.bincount(grades, minlength=levels)
    weight = (n / np.maximum(present, 1) / max(1, (present > 0).sum()))[grades]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
            lens = begin[rows + 1] - begin[rows]
            at = np.repeat(begin[rows] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
            idx, val = slot[at], value[at]
            own, r, y = np.repeat(np.arange(len(rows)), lens), np.arange(len(rows)), grades[rows]
            score = np.bincount(own, weights=w[idx] * val, minlength=len(rows))
            above = 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - t[None, :], -40, 40)))  # P(y > g)
            above = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
            p = np.maximum(above[r, y] - above[r, y + 1], 1e-9)
            slope = above * (1 - above)
            d = -(slope[r, y] - slope[r, y + 1]) / p * weight[rows]  # by score
            grad_t = np.zeros(levels - 1)
            low, high = y > 0, y < levels - 1
            np.add.at(grad_t, y[low] - 1, (slope[r, y] / p * weight[rows])[low])
            np.add.at(grad_t, y[high], -(slope[r, y + 1] / p * weight[rows])[high])
            grad = np.bincount(idx, weights=d[own] * val, minlength=size) / len(rows)
            hit = np.unique(idx)
            g2[hit] += grad[hit] ** 2
            step = rate / np.sqrt(g2[hit])
            moved = w[hit] - step * grad[hit]
            w[hit] = np.sign(moved) * np.maximum(0.0, np.abs(moved) - step * l1)
            grad_t /= len(rows)
            t2 += grad_t * grad_t
            t = np.maximum.accumulate(t - rate / np.sqrt(t2) * grad_t + np.arange(levels - 1) * 1e-9)
    return w, t


def fit(texts: pa.Array, grades: np.ndarray, levels: int, bits: int = BITS, epochs: int = 30, rate: float = 0.5, l1: float = 1e-3, batch: int = 512, seed: int = 5, min_rows: int = MIN_ROWS, relevant: float = 0.3) -> OrdinalModel:
    """Two descents: the first finds the features that matter, the second fits only those.

    Words of fewer than ``min_rows`` labelled rows get no weight, nor do words whose first weight stays below
    ``relevant``: thousands of tiny weights would add up to noise in long texts."""
    slots, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first, s, o in features(texts, bits):
        by_row = np.argsort(o, kind="stable")  # pieces come in row order
        slots.append(s[by_row])
        owners.append(o[by_row] + first)
    lens = np.bincount(np.concatenate(owners), minlength=len(grades))
    return fit_slots(np.concatenate(slots), lens, grades, levels, bits, epochs, rate, l1, batch, seed, min_rows, relevant)


def fit_slots(slots: np.ndarray, lens: np.ndarray, grades: np.ndarray, levels: int, bits: int = BITS, epochs: int = 30, rate: float = 0.5, l1: float = 1e-3, batch: int = 512, seed: int = 5, min_rows: int = MIN_ROWS, relevant: float = 0.3) -> OrdinalModel:
    """``fit`` on feature slots, row after row, ``lens`` of them in each row."""
    names, slot, rows = np.unique(slots, return_inverse=True, return_counts=True)
    common = (rows >= min_rows) | (names >= 1 << bits)
    held = common[slot]
    lens = np.bincount(np.repeat(np.arange(len(grades)), lens)[held], minlength=len(grades))
    return fit_common(names[common], (np.cumsum(common) - 1)[slot[held]].astype(np.int32), lens, grades, levels, bits, epochs, rate, l1, batch, seed, relevant)


def fit_common(names: np.ndarray, slot: np.ndarray, lens: np.ndarray, grades: np.ndarray, levels: int, bits: int = BITS, epochs: int = 30, rate: float = 0.5, l1: float = 1e-3, batch: int = 512, seed: int = 5, relevant: float = 0.3) -> OrdinalModel:
    """``fit_slots`` on the common slots alone: ``slot`` holds their positions in the sorted ``names``."""
    n = len(grades)
    owner = np.repeat(np.arange(n, dtype=np.int32), lens)
    shape = names >= 1 << bits
    wanted = np.ones(len(names), dtype=bool)
    batch = min(batch, max(16, n // 32))
    epochs = max(epochs, -(-1200 * batch // max(n, 1)))  # small samples take more rounds
    for _ in range(2):
        keep = wanted[slot]
        value = np.where(shape, SHAPE_VALUE, 1.0)[slot[keep]]
        w, t = _descend(slot[keep], np.searchsorted(owner[keep], np.arange(n + 1, dtype=np.int32)), value, grades, levels, len(names), epochs, rate, l1, batch, seed)
        wanted = (np.abs(w) >= relevant) | shape
    w[shape] *= SHAPE_VALUE
    held = np.flatnonzero(w)
    return OrdinalModel(names[held], w[held], t, bits)


def quotas(present: dict[int, int], rows: int) -> dict[int, int]:
    """Rows to take of every grade: equal shares of ``rows``; what a rare grade does not have, the others get."""
    out, left = {}, rows
    for i, (g, n) in enumerate(sorted(present.items(), key=lambda p: (p[1], p[0]))):
        out[g] = min(n, left // (len(present) - i))
        left -= out[g]
    return out


def _thinned(rows: DataFrame, key: Column, share: dict[int, float]) -> DataFrame:
    """The smallest key hashes of every grade, up to the grade's share."""
    limit = F.create_map(*[F.lit(x) for g, part in share.items() for x in (g, int((1 << 30) * part))])
    return rows.where(F.pmod(key, F.lit(1 << 30)) < limit[F.col("grade")])


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: Column, sample_rows: int = SAMPLE_ROWS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(text, grade) of about ``sample_rows`` labelled rows, stratified by grade and chosen by key hash; null keys and
    grades are left out, as are labels without a document.

    The sample's keys are bounded, so they are broadcast to the documents."""
    rated = labels.select(F.col(key).alias("__k"), grade.cast("int").alias("grade")).where("__k IS NOT NULL AND grade IS NOT NULL")
    rated = rated.groupBy("__k").agg(F.max("grade").alias("grade")).join(docs.select(F.col(key).alias("__k")), "__k", "left_semi")
    rated = materialize(rated, "rated")
    present = {r["grade"]: r["n"] for r in rated.groupBy("grade").agg(F.count("*").alias("n")).collect()}  # a row per grade
    if sum(present.values()) > sample_rows:
        rated = _thinned(rated, F.xxhash64("__k"), {g: n / present[g] for g, n in quotas(present, sample_rows).items()})
    return docs.select(F.col(key).alias("__k"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(rated), "__k").select("text", "grade")


def _slots(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, lens = [np.zeros(0, np.int64)], np.zeros(b.num_rows, dtype=np.int64)
            for first, s, o in features(b.column("text"), bits):
                found.append(s[np.argsort(o, kind="stable")])
                lens += np.bincount(o + first, minlength=b.num_rows)
            offsets = pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("grade"), b.column("mark"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))], names=["grade", "mark", "slots"])

    return run


def _positions(names):
    """Every row's slots as positions in the broadcast sorted ``names``; other slots go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = names.value
        for b in batches:
            lists = b.column("slots")
            found = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.searchsorted(known, found)
            held = known[np.minimum(at, len(known) - 1)] == found if len(known) else np.zeros(len(found), dtype=bool)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner[held], minlength=b.num_rows))))
            cut = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(at[held].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("grade"), b.column("mark"), cut], names=["grade", "mark", "slots"])

    return run


MODEL = "slots array<bigint>, weights array<double>, thresholds array<double>, grades array<int>"


def _fitted(names, levels: int, bits: int, settings: dict):
    """One row: the model of the rows of this task, and the grades they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(b.num_rows for b in parts):
            return
        rows = pa.Table.from_batches(parts).sort_by([("grade", "ascending"), ("mark", "ascending")])
        del parts
        lists = rows.column("slots").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        grades = rows.column("grade").to_numpy().astype(np.int64)
        model = fit_common(names.value, lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()), grades, levels, bits, **settings)
        arrays = [pa.array([x.tolist()], pa.list_(t)) for x, t in ((model.slots, pa.int64()), (model.weights, pa.float64()), (model.thresholds, pa.float64()), (np.unique(grades), pa.int32()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["slots", "weights", "thresholds", "grades"])

    return run


def train(docs: DataFrame, labels: DataFrame, grade: Column, levels: int, sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES, text: str = "text", key: str = "doc_id", bits: int = BITS, min_rows: int = MIN_ROWS, **settings) -> OrdinalModel | None:
    """Fit on the bounded labelled sample; None when no labelled row has a document.

    Whole texts are used; a sample beyond ``sample_features`` slots is thinned by rows, the same part of every
    grade, never cut inside a text. Fails when a bound leaves no row of a grade that has labelled rows.

    Slots of fewer than ``min_rows`` sampled rows are counted out before anything is fitted; at most
    ``sample_features / min_rows`` names (8 bytes each) are left and broadcast. One task, repeated elsewhere if its
    executor is lost, runs the descents."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, grade, sample_rows, text, key).withColumn("mark", F.xxhash64("text"))
    sample = materialize(sample.mapInArrow(_slots(bits), "grade int, mark long, slots array<bigint>"), "labelled")
    held = sample.groupBy("grade").agg(F.sum(F.size("slots")).alias("n")).collect()  # a row per grade
    total = sum(r["n"] for r in held)
    if not held:
        rated = labels.select(grade.cast("int").alias("grade"), F.col(key).alias("__k")).where("__k IS NOT NULL AND grade IS NOT NULL")
        if rated.join(docs.select(F.col(key).alias("__k")), "__k", "left_semi").isEmpty():
            return None
    if total > sample_features:
        sample = _thinned(sample, F.col("mark"), {r["grade"]: sample_features / total for r in held})
    counted = sample.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    common = counted.where((F.col("n") >= min_rows) | (F.col("slot") >= F.lit(1 << bits))).select("slot")
    names = spark.sparkContext.broadcast(np.sort(common.toArrow().column("slot").to_numpy()))
    cut = sample.mapInArrow(_positions(names), "grade int, mark long, slots array<int>")
    row = cut.repartition(1).mapInArrow(_fitted(names, levels, bits, settings), MODEL).toArrow().to_pylist()
    names.unpersist()
    if not row or {r["grade"] for r in held} - set(row[0]["grades"]):
        raise RuntimeError(f"sample_rows={sample_rows} and sample_features={sample_features} leave no row of a labelled grade; raise them")
    found = row[0]
    return OrdinalModel(np.array(found["slots"], np.int64), np.array(found["weights"], float), np.array(found["thresholds"], float), bits)


def _score(model: OrdinalModel, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = np.zeros(b.num_rows)
            for first, slots, owners in features(b.column(b.schema.get_field_index(text)), model.bits):
                part = model.scores(slots, owners, int(owners.max()) + 1 if len(owners) else 0)
                score[first : first + len(part)] = part
            tails = model.tails(score)
            cols = [b.column(b.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))], names=[*keep, "expected_grade", "tails"])

    return run


def score(docs: DataFrame, model: OrdinalModel, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` columns of every row with expected_grade and tails (P(grade > g) for every border g).

    Null and empty texts have no features; their score is 0, so they get the thresholds' own probabilities."""
    keep = list(docs.columns) if keep is None else keep
    clash = {"expected_grade", "tails"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by this operator")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    cols = list(dict.fromkeys([*keep, text]))
    return docs.select(*cols).mapInArrow(_score(model, keep, text), f"{kinds}, expected_grade double, tails array<double>")


#: Grades of the labels table: 0 toxic, 1 low quality, 2 good.
LEVELS = 3
KEEP = 0.4  # a document stays when P(grade > 1) reaches this


def document_grade() -> Column:
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def grade_documents(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every document with expected_grade, p_good (P(grade > 1)) and keep.

    The model is fitted on the labelled rows of ``labelled_docs``; without any, every document is kept with
    null figures."""
    model = train(labelled_docs, labels, document_grade(), LEVELS, text=text)
    if model is None:
        return docs.select(*keep, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("p_good"), F.lit(True).alias("keep"))
    scored = score(docs, model, keep, text)
    return scored.select(*keep, "expected_grade", F.col("tails")[1].alias("p_good"), (F.col("tails")[1] >= KEEP).alias("keep"))
