import re
from itertools import permutations

import numpy as np
import pytest

from veritab.llm import audit

from .helpers import DOCS, some_texts

COLS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    docs = []
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for i, t, lang, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        fails |= {"A"} if len(w) < 100 else set()
        fails |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows) else set()
        docs.append((lang or "", fails, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d[1:] for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                earlier = sum(f in d[0] for d in own) - len(gone)
                out[part, order, step] = [len(left), len(gone), earlier, sum(d[0] == {f} for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), r in out.items():
            if p == part:
                r.append(shapley[order[step - 1]])
    return out


def make(spark):
    texts = [f"{t} {'#$'[i % 2]}" if t and i % 7 == 0 else t for i, t in enumerate(some_texts())]
    texts += ["ALL CAPS HERE", "a b " * 200, texts[0], None, "fine words " * 3] + ["x y z"] * 20
    rows = [(i, t, ["en", "de", None, ""][i % 4] if i % 3 else "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "x y z", "en", None, None), (None, None, None, None, None)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, len(rows), 2)] + [(2, 1, 0), (None, 1, 1), (4, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("id", "part", "digest", "faults", "good", "least", "n"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return rows, labels, df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("piece", [1 << 16, 4])
def test_matches_brute_force(spark, monkeypatch, piece):
    rows, labels, docs, said = make(spark)
    monkeypatch.setattr(audit, "PIECE_ROWS", piece)
    marked = audit.mark_documents(docs, said)
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLS] for r in audit.interactions(audit.union_sizes(audit.posting_lists(marked))).collect()}
    assert got == brute(rows, labels)


def test_posting_lists_hold_the_failing_rows(spark):
    rows, labels, docs, said = make(spark)
    marked = audit.mark_documents(docs, said)
    lists = audit.posting_lists(marked).collect()
    assert sum(r["rows"] for r in lists) == len(rows)
    for i, f in enumerate(audit.FILTERS):
        assert sum(len(r[f]) for r in lists) == marked.where(f"(faults & {1 << i}) <> 0").count()
        assert all(r[f] == sorted(set(r[f])) for r in lists)


def test_galloping():
    rng = np.random.default_rng(5)
    for n, m in ((0, 5), (5, 0), (1, 1), (3, 900), (900, 3), (700, 800), (5000, 64)):
        a, b = (np.unique(rng.integers(0, 4000, size=k)) for k in (n, m))
        assert (audit.gallop(a, b) == np.searchsorted(a, b)).all()
        assert (audit.members(a, b) == np.isin(a, b)).all()
        assert (audit.difference(a, b) == np.setdiff1d(a, b)).all()
        assert (audit.union([a, b, a[::2]]) == np.union1d(a, b)).all()


def test_empty_table(spark):
    assert audit.audit_filters(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
