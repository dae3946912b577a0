import re
from collections import defaultdict

import numpy as np
import pytest

from veritab.llm import mixing

from .helpers import DOCS, some_texts


def targets(sizes, weights=(5, 2, 1), most=3):
    """Plain rounds of sharing out, by the words of the contract."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, openly = {}, float(sum(sizes.values())), set(order)
    while openly:
        whole = sum(w[s] for s in openly)
        over = [s for s in openly if left * w[s] / whole > most * sizes[s]]
        if not over:
            out.update({s: left * w[s] / whole for s in openly})
            break
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(most * sizes[s] for s in over)
        openly -= set(over)
    return out


def test_permutation_covers_every_index():
    for n in (1, 2, 3, 7, 64, 1000):
        for key in (0, 5):
            got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(got.tolist()) == list(range(n))


def test_draws_meet_the_totals():
    want = {0: 100, 1: 7, 2: 1, 5: 0}
    rows = mixing.draw_counts(want, 10, 3)
    total = defaultdict(int)
    for _, p, u, g in rows:
        assert u == total[p]
        total[p] += g
    assert {p: total[p] for p in want} == want and len({r[0] for r in rows}) == 11


@pytest.mark.parametrize("case", [0, 1, 2])
def test_targets_match_the_rounds(spark, case):
    sizes = [{"a": 100, "b": 1000, "c": 10, None: 5}, {"a": 1, "b": 1, "é": 5000, "Z": 3}, {"a": 0, "b": 0}][case]
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, docs long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    for s, t in targets(sizes).items():
        assert got[s] == pytest.approx(t)


def test_mix(spark):
    texts = some_texts(n=200)
    rows = [(i if i % 17 else None, t, None, [None, "a", "b", "c", "hot", "hot", "hot"][i % 7], None) for i, t in enumerate(texts)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS row", "2 AS size", "3 AS pos")
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    out, slots = mixing.mix_sources(df)
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]]
    for s, t in targets(sizes).items():
        assert abs(taken[s] - t) <= 2 * 64
    again = mixing.mix_sources(df.repartition(7))[0].collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["text_hash"], str(r["source"]), r["taken"]) for r in rs)
    assert key(again) == key(got)
    assert slots.groupBy("pos", "block", "epoch").count().where("count > 1").count() == 0
    assert mixing.mix_sources(spark.createDataFrame([], DOCS))[0].count() == 0
    none = mixing.mix_sources(spark.createDataFrame([(1, None, None, None, None), (2, " ", None, "a", None)], DOCS))[0].collect()
    assert [r["taken"] for r in none] == [0, 0]


def test_small_sources_come_near_their_targets(spark):
    rows = [(i, f"w{i} " * 50, None, f"s{i:02d}", None) for i in range(60)]
    out, _ = mixing.mix_sources(spark.createDataFrame(rows, DOCS))
    got = out.collect()
    want = targets({r[3]: 50 for r in rows})
    assert len(got) == 60 and all(abs(r["taken"] - want[r["source"]]) <= 3 and r["taken"] <= 150 for r in got)
