"""Small fixtures and brute-force forms shared by the tests."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def frame(spark, texts, extra=False):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # columns whose names clash with nothing the operator makes, but with its inner ones
        for c in ("h", "key", "row", "size", "id", "grp", "host_depth"):
            df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def some_texts(seed=1, n=40):
    rng = random.Random(seed)
    vocab = ["ab", "Cde", "fgh", "ünï", "x1", "the", "of", "zz,", "(k)", "Wort"]
    make = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = make(60)
    texts = [make(rng.choice([1, 3, 5, 30, 120])) for _ in range(n)]
    texts += [make(20) + " " + passage + " " + make(15), passage, passage.upper() + "\n" + make(9), make(4000)]
    texts += [texts[0], texts[0], None, "", " \t\n", "one", "one two three", "ONE two three"]
    long = make(150).split()
    for i in range(8):  # near copies
        w = list(long)
        w[i * 7] = f"edit{i}"
        texts.append(" ".join(w))
    return texts
