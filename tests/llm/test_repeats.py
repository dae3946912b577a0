import hashlib
import random
from collections import Counter

import pytest

from veritab.llm import repeats

from .helpers import DOCS, frame, some_texts


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    n = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = {}
    for k, t in enumerate(raw):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[k] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, texts, length, **kw):
    got = repeats.digest(repeats.remove_repeats(frame(spark, texts, **kw), ["doc_id"], length)).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got}


def corpus():
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdefghij üß") for _ in range(n))
    p, q = make(230), make(90)
    texts = some_texts() + [make(50) + p + make(70), p[:150] + make(9) + p, p[5:120], make(300), q + make(20) + q, "ab" * 300, "x" * 1000]
    return texts + [make(30 + i) + p[10:200] + make(12) for i in range(12)]


@pytest.mark.parametrize("length", [50, 200])
def test_matches_brute_force(spark, length):
    texts = corpus()
    assert run(spark, texts, length, extra=True) == brute(texts, length)


def test_crowded_anchor_groups_give_the_same(spark, monkeypatch):
    texts = corpus()
    monkeypatch.setattr(repeats, "GROUP_SEGMENTS", 2)
    assert run(spark, texts, 60) == brute(texts, 60)


def test_key_lists_instead_of_a_filter_give_the_same(spark, monkeypatch):
    texts = corpus()
    monkeypatch.setattr(repeats, "FILTER_BITS", 8)
    assert run(spark, texts, 60) == brute(texts, 60)
    monkeypatch.setattr(repeats, "GROUP_SEGMENTS", 2)
    assert run(spark, texts, 60) == brute(texts, 60)


def test_columns_named_like_inner_ones(spark):
    texts = [t for t in corpus() if t][:8] * 2
    df = frame(spark, texts).withColumnRenamed("lang", "h").withColumnRenamed("source", "spans")
    got = repeats.remove_repeats(df.withColumn("key", df["h"]), ["doc_id", "h", "spans", "key", "text"], 60)
    assert {"h", "spans", "key", "text"} < set(got.columns)
    assert {r["doc_id"]: r["n_bytes"] - sum(s["b"] - s["a"] for s in r["removed"]) for r in got.collect()} == {k: v[0] - v[1] for k, v in brute(texts, 60).items()}


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 500)
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh") for _ in range(5000))
    texts = [long + long[700:1200], long[2000:2600] + "zz", "short"]
    assert run(spark, texts, 100) == brute(texts, 100)


def test_matching_statistics():
    rng = random.Random(2)
    base = bytes(rng.choice(b"ab") for _ in range(60))
    strings = [base, base[10:40], base[5:] + b"x", b"a", b"", bytes(200), b"abab" * 20]
    got = repeats.RunLengthIndex(strings).matching_statistics()
    suffixes = [(s, i) for s in range(len(strings)) for i in range(len(strings[s]))]

    def lcp(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for s, i in suffixes:
        want = max(lcp(strings[s][i:], strings[t][j:]) for t, j in suffixes if (t, j) != (s, i))
        assert got[s][i] == want


def test_empty_and_clash(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
    assert run(spark, [None, "", "a"], 200) == brute([None, "", "a"], 200)
    with pytest.raises(ValueError):
        repeats.remove_repeats(frame(spark, ["a"]).withColumnRenamed("lang", "removed"), ["removed"])
