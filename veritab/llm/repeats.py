"""Removal of repeated byte strings with a run-length compressed suffix index.

Every byte covered by a string of ``length`` bytes that also starts anywhere else (any text, the same one
included) is removed.

1. Anchors. Each window of ``length`` bytes is assigned the position of the smallest hash among its substrings
   of a third of that length, a choice that depends on the window's content only. Consecutive windows with the same anchor
   form one segment. Equal windows have equal anchor substrings, so only segments whose anchor substring
   occurs at least twice in the corpus can hold a repeated window; the others are done.
2. The anchor substrings that occur twice become a bit filter, which goes to the tasks; segments that pass it are cut
   where the texts are read, so no text is shuffled for that and only candidates are. More such substrings than
   FILTER_BITS can tell apart are joined to the texts as lists of keys instead. Equal segments are counted once with
   their number (combined in the task first; a task passes on a text at most twice, which is enough to know that it
   repeats). Segments with the same anchor substring meet in one task, in bounded batches.
3. Run-length index. For the batch's segments the Burrows-Wheeler transform is built and run-compressed, with
   suffix-array samples at the first and last row of every run. The longest match of a suffix with its
   predecessor (successor) in suffix order drops by exactly one per text position between samples, so only
   the samples are compared and the matching statistics of all positions stream out of them: the longest
   match with any other suffix is the larger of both. Positions with a match of at least ``length`` bytes,
   and all windows of a segment that occurs more than once, are marked.
   An anchor group with more than GROUP_SEGMENTS different segments is not indexed in one task: its windows
   are counted by 128-bit hash instead (map-side combined), which marks the same windows.
4. The places of the segments are found again where the texts are read, meet the marks, and the marks are merged into
   maximal runs of each text. Texts shorter than ``length`` take no part in any join.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm import words as wd
from veritab.llm.skew import bit_filter, in_filter, join_counted
from veritab.llm.store import drop_table, write_table

CHUNK = 1 << 20
BATCH_BYTES = 1 << 18
GROUP_SEGMENTS = 4096
FILTER_BITS = 1 << 29  # 64 MB, the largest filter that is sent to the tasks
BITS_PER_KEY = 4  # a filter with fewer lets too many other segments through


def gram_for(length: int) -> int:
    """Bytes of an anchor substring: long ones are rarely shared by chance, short ones give longer segments."""
    return max(1, length // 3)


_CODES = wd.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POSITION = np.uint64((1 << 22) - 1)


def rolling(data: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """64-bit hash of every k consecutive bytes."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = wd._power(len(data) + 1)
    codes = _CODES if not salt else wd.mix(_CODES + np.uint64(salt))
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(codes[data] * power[: len(data)], out=total[1:])
        return wd.mix((total[k:] - total[:n]) * inverse[:n])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive entries."""
    m, size = x, 1
    while size * 2 <= w:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    return np.minimum(m[: len(x) - w + 1], m[w - size : w - size + len(x) - w + 1]) if size < w else m[: len(x) - w + 1]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window start, last window start, anchor hash) of every segment; starts are inside the row."""
    if len(data) < length:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(np.uint64)
    gram = gram_for(length)
    h = rolling(data, gram)
    with np.errstate(over="ignore"):
        packed = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    at = (_window_min(packed, length - gram + 1) & _POSITION).astype(np.int64)  # by window start
    lens = np.diff(offsets)
    row = np.repeat(np.arange(len(lens)), np.maximum(lens - length + 1, 0))
    start = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(lens - length + 1, 0)) - np.maximum(lens - length + 1, 0), np.maximum(lens - length + 1, 0)) + offsets[row]
    if not len(row):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(np.uint64)
    a = at[start]
    begin = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (row[1:] != row[:-1]))))
    last = np.append(begin[1:], len(row)) - 1
    return row[begin], start[begin] - offsets[row[begin]], start[last] - offsets[row[last]], h[a[begin]]


def _segments(batches: Iterator[pa.RecordBatch], length: int, most: int) -> Iterator[tuple]:
    """(batch, row, first window in the text, first and end byte in ``data``, anchor hash, data) of every piece's
    segments. A text that the task has met ``most`` times already is left out."""
    met: Counter = Counter()
    for b in batches:
        fresh = []
        for h in b.column("__h").to_pylist():
            met[h] += 1
            fresh.append(met[h] <= most)
        if not all(fresh):
            b = b.filter(pa.array(fresh))
        for first, data, offsets in wd.pieces(b.column("__text"), CHUNK):
            if len(offsets) == 2 and offsets[1] > 2 * CHUNK:  # one very long text, in chunks that share length-1 bytes
                parts = ((c, data[c : c + CHUNK + length - 1]) for c in range(0, int(offsets[1]) - length + 1, CHUNK))
                cut = ((c, part, np.array([0, len(part)])) for c, part in parts)
            else:
                cut = ((0, data, offsets),)
            for base, part, bounds in cut:
                row, low, high, key = anchors(part, bounds, length)
                begin = bounds[row] + low
                yield b, row + first, low + base, begin, begin + (high - low) + length, key, part


def _keys(length: int):
    """Anchor hashes of the segments with their number in the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, key, _data in _segments(batches, length, 2):
            one, n = np.unique(key.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(n, pa.int64())], names=["key", "n"])

    return run


def _chosen(b: pa.RecordBatch, row: np.ndarray, key: np.ndarray, bits: Broadcast | None) -> np.ndarray:
    """Which segments may repeat: by the filter, or by the list of keys that came with the text."""
    if bits is not None:
        return in_filter(bits.value, key.view(np.int64))
    lists = b.column("__keys")
    owner = np.repeat(np.arange(len(lists), dtype=np.uint64), lists.value_lengths().to_numpy(zero_copy_only=False))
    listed = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.isin(key ^ wd.mix(row.astype(np.uint64)), listed ^ wd.mix(owner))


def _names(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of every data[begin:end], as two numbers."""
    power, inverse = wd._power(len(data) + 1)
    out = []
    for salt in (2, 3):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(wd.mix(_CODES + np.uint64(salt))[data] * power[: len(data)], out=total[1:])
            out.append(wd.mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64)))
    return out[0], out[1]


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    to = np.concatenate(([0], np.cumsum(end - begin)))
    got = data[np.repeat(begin - to[:-1], end - begin) + np.arange(to[-1])]
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(got)])


def _cut(length: int, bits: Broadcast | None):
    """(key, s1, s2, s, n): segments that may repeat, equal ones of a piece together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, row, _low, begin, end, key, data in _segments(batches, length, 2):
            ok = _chosen(b, row, key, bits)
            key, begin, end = key[ok], begin[ok], end[ok]
            s1, s2 = _names(data, begin, end)
            _, at, n = np.unique(s1 ^ wd.mix(s2), return_index=True, return_counts=True)
            for i in range(0, len(at), 4096):
                a = at[i : i + 4096]
                longs = [pa.array(x[a].view(np.int64)) for x in (key, s1, s2)]
                yield pa.RecordBatch.from_arrays([*longs, _strings(data, begin[a], end[a]), pa.array(n[i : i + 4096], pa.int64())], names=["key", "s1", "s2", "s", "n"])

    return run


def _places(length: int, bits: Broadcast | None):
    """(__h, key, s1, s2, lows): where a text has its segments that may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, row, low, begin, end, key, data in _segments(batches, length, 1):
            ok = _chosen(b, row, key, bits)
            row, low, key = row[ok], low[ok], key[ok]
            if not len(row):
                continue
            s1, s2 = _names(data, begin[ok], end[ok])
            name = s1 ^ wd.mix(s2)
            order = np.lexsort((low, name, row))
            head = np.flatnonzero(np.concatenate(([True], (row[order][1:] != row[order][:-1]) | (name[order][1:] != name[order][:-1]))))
            a = order[head]
            lows = pa.ListArray.from_arrays(pa.array(np.append(head, len(order)), pa.int32()), pa.array(low[order], pa.int64()))
            longs = [pa.array(x[a].view(np.int64)) for x in (key, s1, s2)]
            yield pa.RecordBatch.from_arrays([b.column("__h").take(pa.array(row[a])), *longs, lows], names=["__h", "key", "s1", "s2", "lows"])

    return run


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of several byte strings with samples at the run ends."""

    PAD = 8

    def __init__(self, strings: list[bytes]):
        lens = np.array([len(s) for s in strings], dtype=np.int64)
        first = np.cumsum(lens + self.PAD) - (lens + self.PAD)
        flat = np.zeros(int((lens + self.PAD).sum()) + self.PAD, dtype=np.uint64)
        inside = np.repeat(first - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        flat[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        self.first, self.lens, self.flat, self.pos = first, lens, flat, inside
        self.end = np.zeros(len(flat), dtype=np.int64)
        self.end[inside] = np.repeat(first + lens, lens)
        self._sort()
        self._compress()

    def _sort(self) -> None:
        """Suffix order by prefix doubling; positions past a string's end rank lowest, ties keep string order."""
        flat, pos = self.flat, self.pos
        key = np.zeros(len(flat), dtype=np.uint64)
        n = len(flat) - 7
        for j in range(7):
            key[:n] |= flat[j : j + n] << np.uint64(9 * (6 - j))
        rank = np.zeros(len(flat), dtype=np.int64)
        _, inv = np.unique(key[pos], return_inverse=True)
        rank[pos] = inv + 1
        self.levels, step, most = [(7, rank)], 7, int(self.lens.max()) if len(self.lens) else 0
        while step < most and len(inv) and inv.max() + 1 < len(pos):
            after = pos + step
            ok = after < self.end[pos]
            second = np.zeros(len(pos), dtype=np.int64)
            second[ok] = rank[after[ok]]
            _, inv = np.unique(rank[pos] * (len(flat) + 1) + second, return_inverse=True)
            rank = np.zeros(len(flat), dtype=np.int64)
            rank[pos] = inv + 1
            step *= 2
            self.levels.append((step, rank))
        self.sa = pos[np.argsort(rank[pos], kind="stable")]

    def _compress(self) -> None:
        before = np.where(self.sa > 0, self.flat[self.sa - 1], 0)  # 0: the row of a whole string, a run of its own
        head = np.ones(len(before), dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.heads = np.flatnonzero(head)  # first row of each run
        self.symbols = before[self.heads]
        self.head_samples = self.sa[self.heads]
        self.tail_samples = self.sa[np.append(self.heads[1:], len(self.sa)) - 1]
        # longest common prefix of the first row of each run with the row before it
        self.border = np.zeros(len(self.heads), dtype=np.int64)
        self.border[1:] = self._common(self.sa[self.heads[1:] - 1], self.sa[self.heads[1:]])

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y, n = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        last = len(self.flat) - 1
        for step, rank in reversed(self.levels):
            same = (n < most) & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)])
            n[same] += step
            x[same] += step
            y[same] += step
        for _ in range(6):
            same = (n < most) & (self.flat[np.minimum(x, last)] == self.flat[np.minimum(y, last)])
            n[same] += 1
            x[same] += 1
            y[same] += 1
        return np.minimum(n, most)

    def _stream(self, samples: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Values at all positions: one less per step since the last sample."""
        order = np.argsort(samples)
        at, v = samples[order], values[order]
        i = np.searchsorted(at, self.pos, side="right") - 1
        return v[i] - (self.pos - at[i])

    def matching_statistics(self) -> list[np.ndarray]:
        """For every string, the longest match of each suffix with any other suffix of the strings."""
        if not len(self.pos):
            return [np.zeros(0, dtype=np.int64) for _ in self.lens]
        up = self._stream(self.head_samples, self.border)
        down = self._stream(self.tail_samples, np.append(self.border[1:], 0))
        return np.split(np.maximum(up, down), np.cumsum(self.lens)[:-1])


def repeated_windows(strings: list[bytes], counts: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per string the runs [first, last] of window starts that also start elsewhere."""
    out = []
    matches = RunLengthIndex(strings).matching_statistics() if min(counts, default=2) < 2 else [None] * len(strings)
    for s, c, ms in zip(strings, counts, matches):
        windows = max(0, len(s) - length + 1)
        marked = np.ones(windows, dtype=bool) if c > 1 else ms[:windows] >= length
        edge = np.flatnonzero(np.diff(np.concatenate(([False], marked, [False])).astype(np.int8)))
        out.append([(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])])
    return out


_RUN = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _index(length: int):
    """Segments sorted by key: batches of whole key groups go through one index each. A group of more than
    GROUP_SEGMENTS different segments gives one row without ``runs`` instead."""

    def marks(rows: list[tuple]) -> pa.RecordBatch:
        runs = repeated_windows([r[3] for r in rows], [r[4] for r in rows], length)
        return table([(*r[:3], [{"a": a, "b": b} for a, b in u]) for r, u in zip(rows, runs) if u])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        longs = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*longs, pa.array([r[3] for r in rows], pa.list_(_RUN))], names=["key", "s1", "s2", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, open_rows, sure_rows, held = [], 0, [], [], 0

        def close() -> list[tuple]:
            # a group whose segments all occur more than once is marked whole; a single one has no other to match
            nonlocal held, group, size
            crowded = [(group[0][0], None, None, None)] if size > GROUP_SEGMENTS else []
            if not crowded and all(r[4] > 1 for r in group):
                sure_rows.extend(group)
            elif not crowded and size > 1:
                open_rows.extend(group)
                held += sum(len(r[3]) for r in group)
            group, size = [], 0
            return crowded

        for b in batches:
            t, crowded = b.to_pydict(), []
            for row in zip(t["key"], t["s1"], t["s2"], t["s"], t["n"]):
                if group and row[0] != group[0][0]:
                    crowded += close()
                    if held >= BATCH_BYTES:
                        yield marks(open_rows)
                        open_rows, held = [], 0
                size += 1
                if size <= GROUP_SEGMENTS:
                    group.append(row)
            if crowded:
                yield table(crowded)
            if sure_rows:
                yield marks(sure_rows)
                sure_rows = []
        crowded = close() if group else []
        if crowded:
            yield table(crowded)
        for rows in (open_rows, sure_rows):
            if rows:
                yield marks(rows)

    return run


def _hot_windows(length: int):
    """(key, s1, s2, offset, w1, w2, n): every window of a segment with its 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.to_pydict()
            for key, s1, s2, s, c in zip(t["key"], t["s1"], t["s2"], t["s"], t["n"]):
                data = np.frombuffer(s, dtype=np.uint8)
                one, two = rolling(data, length).view(np.int64), rolling(data, length, 1).view(np.int64)
                m = len(one)
                same = [pa.array([x] * m, pa.int64()) for x in (key, s1, s2)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(m)), pa.array(one), pa.array(two), pa.array([c] * m, pa.int64())], names=["key", "s1", "s2", "o", "w1", "w2", "n"])

    return run


_SEGMENT = ["key", "s1", "s2"]


def _distinct(texts: DataFrame, length: int, bits: Broadcast | None) -> DataFrame:
    cut = texts.mapInArrow(_cut(length, bits), "key long, s1 long, s2 long, s binary, n long")
    return cut.groupBy(*_SEGMENT, "s").agg(F.sum("n").alias("n"))


def _counted(segments: DataFrame, length: int) -> DataFrame:
    """Marks of crowded groups by window counts."""
    windows = segments.mapInArrow(_hot_windows(length), "key long, s1 long, s2 long, o long, w1 long, w2 long, n long")
    twice = windows.groupBy("key", "w1", "w2").agg(F.sum("n").alias("n")).where("n > 1").select("key", "w1", "w2")
    found = windows.drop("n").join(twice, ["key", "w1", "w2"]).groupBy(*_SEGMENT)
    return found.agg(F.transform(F.array_sort(F.collect_set("o")), lambda o: F.struct(o.alias("a"), o.alias("b"))).alias("runs"))


def repeated_spans(texts: DataFrame, length: int = 200) -> DataFrame:
    """(__h, __spans) for every different text with a repeated string: byte runs [a, b) to remove.

    ``texts`` has __h (128-bit hash of the text) and __text. Texts shorter than ``length`` have none; a text that
    occurs twice is repeated as a whole, which its segments' counts show."""
    spark, used = texts.sparkSession, []

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = write_table(df, name)
        used.append(path)
        return out

    # the texts are read three times: finding anchors again costs less than writing them all
    texts = texts.where(F.octet_length("__text") >= length)
    counts = texts.mapInArrow(_keys(length), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    often = kept(counts.where("n > 1").select("key"), "anchors")
    bits = None
    if often.count() * BITS_PER_KEY <= FILTER_BITS:
        bits = spark.sparkContext.broadcast(bit_filter(often, "key", FILTER_BITS))
    else:
        each = texts.mapInArrow(_text_keys(length), "__h binary, key long").join(often, "key").groupBy("__h").agg(F.collect_set("key").alias("__keys"))
        one = texts.groupBy("__h").agg(F.first("__text").alias("__text"), F.least(F.count("*"), F.lit(2)).alias("__n"))
        texts = kept(one.join(each, "__h").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))), "candidates")
    sorted_ = _distinct(texts, length, bits).repartition("key").sortWithinPartitions(*_SEGMENT)
    marks = kept(sorted_.mapInArrow(_index(length), "key long, s1 long, s2 long, runs array<struct<a:long,b:long>>"), "marks")
    crowd = marks.where("runs is null").select("key")
    marks = marks.where("runs is not null")
    if not crowd.isEmpty():
        few = bits if bits is None else spark.sparkContext.broadcast(bit_filter(crowd, "key", FILTER_BITS))
        marks = marks.unionByName(_counted(_distinct(texts, length, few).join(crowd, "key"), length))
    places = texts.mapInArrow(_places(length, bits), "__h binary, key long, s1 long, s2 long, lows array<long>")
    met = places.join(marks, _SEGMENT)
    spans = F.flatten(F.transform("lows", lambda low: F.transform("runs", lambda r: F.struct((low + r["a"]).alias("a"), (low + r["b"] + length).alias("b")))))
    # copies of a text bring equal spans, which count once
    out, _ = write_table(met.select("__h", spans.alias("s")).groupBy("__h").agg(F.flatten(F.collect_set("s")).alias("__spans")), "spans")
    for path in used:
        drop_table(spark, path)
    return out


def _text_keys(length: int):
    """(__h, key) of every segment, each pair once per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, row, _low, _begin, _end, key, _data in _segments(batches, length, 1):
            pairs = np.unique(np.stack([row.astype(np.int64), key.view(np.int64)]), axis=1)
            yield pa.RecordBatch.from_arrays([b.column("__h").take(pa.array(pairs[0])), pa.array(pairs[1])], names=["__h", "key"])

    return run


def merge(spans) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for s in sorted((int(x["a"]), int(x["b"])) for x in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append([*s])
    return [(a, b) for a, b in out]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, runs, digest = [], [], []
        for text, spans in zip(b.column("__text"), b.column("__spans").to_pylist()):
            raw = text.as_buffer() if text.is_valid else None
            view = memoryview(raw) if raw is not None else memoryview(b"")
            merged, at, h = merge(spans or ()), 0, hashlib.sha256()
            for a, z in merged:
                h.update(view[at:a])
                at = z
            h.update(view[at:])
            n.append(len(view))
            runs.append([{"a": a, "b": z} for a, z in merged])
            digest.append(h.hexdigest())
        keep = [b.column(c) for c in b.schema.names if c not in ("__text", "__spans")]
        names = [c for c in b.schema.names if c not in ("__text", "__spans")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(digest)], names=[*names, "n_bytes", "removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, keep: list[str], length: int = 200, text: str = "text") -> DataFrame:
    """``keep`` columns of every row with n_bytes, removed (maximal byte runs [a, b) that go) and kept_sha256.

    Null texts are empty. Matches never cross rows. Rows with equal texts get equal results, and such a text of
    at least ``length`` bytes is removed as a whole. Extra columns are ignored."""
    clash = {"n_bytes", "removed", "kept_sha256"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by this operator")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("__h", F.unhex(F.md5("__text")))
    long, short = rows.where(F.octet_length("__text") >= length), rows.where(F.octet_length("__text") < length)
    spans = repeated_spans(rows.select("__h", "__text"), length)
    # a text that a large share of the rows hold is joined in several tasks
    copies = long.groupBy("__h").agg(F.count("*").alias("__n"))
    placed = long.withColumn("__row", F.monotonically_increasing_id())
    joined = join_counted(placed, spans.join(copies, "__h"), "__h", "__n", ["__row"], docs.count())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    none = F.lit(None).cast("array<struct<a:long,b:long>>").alias("__spans")
    both = joined.select(*keep, "__text", "__spans").unionByName(short.select(*keep, "__text", none))
    return both.mapInArrow(_removed, f"{kinds}, n_bytes long, removed array<struct<a:long,b:long>>, kept_sha256 string")


def digest(found: DataFrame) -> DataFrame:
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["b"] - r["a"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")
