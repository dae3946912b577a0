import re

import numpy as np
import pytest

from veritab.llm import sketching

from .helpers import DOCS, frame, lower, some_texts
from .test_jaccard import copies


def brute(texts, k=3, percent=85):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return {i: (len(s), label[i]) for i, s in enumerate(sets)}


def run(spark, texts, **kw):
    rows = sketching.near_duplicates(frame(spark, texts, extra=True), **kw).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_matches_brute_force(spark):
    texts = some_texts() + copies(4)
    texts += texts[:5]
    assert run(spark, texts) == brute(texts)


@pytest.mark.parametrize("members", [2, 5])
def test_large_clusters_lose_no_link(spark, monkeypatch, members):
    monkeypatch.setattr(sketching, "BLOCK_MEMBERS", members)
    texts = copies(5) + some_texts()
    assert run(spark, texts) == brute(texts)


def test_other_threshold(spark):
    texts = copies(8)
    assert run(spark, texts, shingle=5, percent=80) == brute(texts, 5, 80)


def test_every_coordinate_is_filled_and_agrees_as_the_similarity():
    rng = np.random.default_rng(1)
    t, sets = 128, []
    for n, shared in ((1, 1), (2, 1), (40, 20), (400, 300), (3000, 2500)):
        both = rng.integers(0, 1 << 63, size=shared, dtype=np.uint64)
        sets += [np.unique(np.append(both, rng.integers(0, 1 << 63, size=n - shared, dtype=np.uint64))) for _ in range(2)]
    s = sketching.fast_sketches(np.concatenate(sets), np.array([len(x) for x in sets]), t)
    assert s.shape == (10, t) and not (s == sketching._EMPTY).any()
    for i in range(0, 10, 2):
        both = len(np.intersect1d(sets[i], sets[i + 1]))
        j = both / (len(sets[i]) + len(sets[i + 1]) - both)
        assert abs((s[i] == s[i + 1]).mean() - j) < 4.5 * np.sqrt(j * (1 - j) / t) + 1e-9
    alone = sketching.fast_sketches(sets[6], np.array([len(sets[6])]), t)
    assert (alone[0] == s[6]).all()  # a sketch does not depend on the other sets of a batch


def test_edges(spark):
    rows = [(None, "a b c d e", None, None, None), (None, "a b c d e", None, None, None), (4, "a b c d e", None, None, None), (7, None, None, None, None), (7, None, None, None, None), (None, "q r s t", None, None, None)]
    got = sketching.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(str(r["component_id"]) for r in got) == ["4", "4", "4", "7", "7", "None"]
    assert sketching.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
