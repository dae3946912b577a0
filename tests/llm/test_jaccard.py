import random
import re

import numpy as np
import pytest

from veritab.llm import jaccard

from .helpers import DOCS, frame, lower, some_texts


def brute(texts, k=4, percent=85):
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


def copies(seed=2, groups=6, size=14):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
            out.append(" ".join(w[rng.randrange(3) :]))
    return out


def run(spark, texts, **kw):
    df = frame(spark, texts, extra=True)
    rows = jaccard.smallest_of_class(jaccard.jaccard_classes(df, ["doc_id"], **kw)).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_matches_brute_force(spark):
    texts = some_texts() + copies()
    assert run(spark, texts) == brute(texts)


def test_blocks_of_a_large_cluster_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(jaccard, "LEAF_MEMBERS", 2)
    texts = copies(5) + some_texts()
    assert run(spark, texts) == brute(texts)


def test_other_threshold(spark):
    texts = copies(8)
    assert run(spark, texts, shingle=5, percent=80) == brute(texts, 5, 80)


def test_tree_bound_never_drops_a_link():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 150, size=n)) for n in rng.integers(1, 90, size=120)]
    sets += [np.unique(np.append(s[: len(s) - len(s) // 12], 200 + i)) for i, s in enumerate(sets[:60])]
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    tree = jaccard.SignatureTree(np.concatenate(sets), first, np.argsort(np.diff(first), kind="stable"))
    got = tree.connect(85)
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    assert got.tolist() == label


def test_band_count_keeps_its_promise():
    assert (1 - 0.85**4) ** jaccard.bands_for(0.85) <= jaccard.MISS and jaccard.bands_for(1.0) == 1


def test_edges(spark):
    rows = [(None, "a b c d e", None, None, None), (None, "a b c d e", None, None, None), (4, "a b c d e", None, None, None), (7, None, None, None, None), (7, None, None, None, None)]
    got = jaccard.smallest_of_class(jaccard.jaccard_classes(spark.createDataFrame(rows, DOCS), ["doc_id"])).collect()
    assert sorted(str(r["component_id"]) for r in got) == ["4", "4", "4", "7", "7"]
    assert jaccard.jaccard_classes(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        jaccard.jaccard_classes(frame(spark, ["a"]).withColumnRenamed("lang", "class"), ["class"])


def brute_links(texts, k=4, percent=85):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    near = lambda a, b: bool(a & b) and 100 * len(a & b) >= percent * len(a | b)
    return {i: sum(near(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)}


@pytest.mark.parametrize("block", [2048, 3])
def test_every_link_is_counted(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(jaccard, "LEAF_MEMBERS", 2)
    texts = copies(5) + some_texts()
    texts += texts[:9]
    got = {r["doc_id"]: r["links"] for r in jaccard.jaccard_classes(frame(spark, texts), ["doc_id"]).collect()}
    assert got == brute_links(texts) and max(got.values()) > 2
