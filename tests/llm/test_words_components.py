import random
import re

import numpy as np
import pyarrow as pa

from veritab.llm import words as wd
from veritab.llm.components import connected_components

from .helpers import lower, some_texts


def test_split_matches_regex():
    texts = some_texts()
    for letters, pattern in ((wd.SPACE_WORDS, r"[^\x20\x09-\x0D]+"), (wd.ALNUM_WORDS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        seen = {}
        for first, data, offsets in wd.pieces(pa.array(texts), limit=500):
            s, e, counts = wd.split(data, offsets, letters)
            h = wd.word_hashes(data, s, e, letters)
            at = 0
            for i, c in enumerate(counts):
                want = re.findall(pattern, lower(texts[first + i]))
                got = [bytes(data[a:b]).decode() for a, b in zip(s[at : at + c], e[at : at + c])]
                assert [lower(g) for g in got] == want
                for w, x in zip(want, h[at : at + c].tolist()):
                    assert seen.setdefault(w, x) == x
                at += c
        assert len(set(seen.values())) == len(seen)


def test_shingle_sets():
    texts = ["a b c d e", "A B C D", "a b", "", None, "a b c d a b c d"]
    h, sizes = [], []
    for _, data, offsets in wd.pieces(pa.array(texts)):
        x, n = wd.shingle_sets(data, offsets, 4)
        h, sizes = x, n.tolist()
    assert sizes == [2, 1, 1, 0, 0, 4]
    first = np.concatenate(([0], np.cumsum(sizes)))
    assert set(h[first[1] : first[2]].tolist()) <= set(h[: first[1]].tolist())


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(None, 3), (5, None), (7, 7), (1000, 1001), (1000, 1001)]
    pairs += [(2000 + i, 2001 + i) for i in range(40)]  # a long path
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    got = {r["id"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in label}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
