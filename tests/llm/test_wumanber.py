import hashlib
import re

import pytest

from veritab.llm import wumanber

from .helpers import DOCS, frame, lower, some_texts

BENCH = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(texts, items, m=10):
    patterns = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        k = min(m, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            patterns.setdefault(tuple(w[j : j + k]), set()).add(i)
    out = {}
    for d, t in enumerate(texts):
        w = WORD.findall(lower(t))
        hit, found = set(), set()
        for k in {len(p) for p in patterns}:
            for j in range(len(w) - k + 1):
                ids = patterns.get(tuple(w[j : j + k]))
                if ids:
                    hit |= set(range(j, j + k))
                    found |= {str(i) for i in ids if i is not None}
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def run(spark, texts, items):
    df = wumanber.decontaminate(frame(spark, texts, extra=True), spark.createDataFrame(items, BENCH).selectExpr("*", "1 AS h"), keep=["doc_id"])
    return {r["doc_id"]: tuple(r)[1:] for r in wumanber.digest(df).collect()}


def cases():
    texts = some_texts(n=60)
    words = [WORD.findall(t) for t in texts if t]
    long = [w for w in words if len(w) > 60]
    items = [(10 + i, " -- ".join(w[5:40]).upper()) for i, w in enumerate(long[:4])]
    items += [(2, "the of"), (3, "one"), (100, "one two three"), (5, None), (6, ""), (7, "... !"), (2, "the of"), (None, " ".join(long[1][20:31])), (9, " ".join(long[2][8:30]))]
    return texts + [" ".join(long[0][5:15]), " ".join(long[0][5:14]), "x " * 700 + " ".join(long[1][5:40]) + " y" * 700], items


def test_matches_brute_force(spark):
    texts, items = cases()
    assert run(spark, texts, items) == brute(texts, items)


def test_parts_of_a_large_benchmark_give_the_same(spark, monkeypatch):
    texts, items = cases()
    monkeypatch.setattr(wumanber, "PATTERN_BYTES", 200)
    assert run(spark, texts, items) == brute(texts, items)


def test_edges(spark):
    texts, items = cases()
    assert all(v[1:3] == (0, 0) for v in run(spark, texts, []).values())
    assert wumanber.decontaminate(spark.createDataFrame([], DOCS), spark.createDataFrame(items, BENCH)).count() == 0
    with pytest.raises(ValueError):
        wumanber.decontaminate(frame(spark, ["a"]).withColumnRenamed("lang", "items"), spark.createDataFrame(items, BENCH), keep=["items"])
