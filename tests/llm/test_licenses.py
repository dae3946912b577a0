import random

import pytest

from veritab.llm import licenses

from .helpers import DOCS, frame, some_texts

APACHE = ("Licensed under the Apache License, Version 2.0.", dict(licenses.NOTICES)["Apache-2.0"])
MIT_LONG = dict(licenses.NOTICES)["MIT"]


def _found(spark, texts, **kw):
    rows = licenses.scan(frame(spark, texts, extra=True), ["doc_id"], **kw).collect()
    return {(r["doc_id"], r["license"]): r["containment"] for r in rows}


def test_notices_are_found_anywhere(spark):
    filler = "lorem ipsum dolor sit amet " * 40
    edited = MIT_LONG.split()
    edited[20] = "thing"
    texts = [filler + APACHE[0], APACHE[0] + " " + filler, filler + MIT_LONG + " " + filler, filler + " ".join(edited), filler, None, "", "Licensed", (filler + "\n") * 200 + APACHE[1], APACHE[0].upper() + " " + APACHE[0]]
    got = _found(spark, texts)
    assert {k for k in got} == {(0, "Apache-2.0"), (1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), (8, "Apache-2.0"), (9, "Apache-2.0")}
    assert got[(2, "MIT")] == 1.0 and 0.8 <= got[(3, "MIT")] < 1.0


def test_every_place_of_an_exact_template_collides(spark):
    # containment of an exact occurrence is found at every alignment to the windows
    texts = ["w " * i + t + " v" * 9 for i in range(0, 70, 9) for _, t in licenses.TEMPLATES]
    got = licenses.scan(frame(spark, texts), ["doc_id"]).where("containment = 1").select("doc_id").distinct().count()
    assert got == len(texts)


def test_half_a_notice_is_not_a_match(spark):
    words = MIT_LONG.split()
    assert _found(spark, [" ".join(words[: len(words) // 2]), "the license of the software"]) == {}


def test_few_templates_and_edges(spark):
    some = tuple(t for t in licenses.TEMPLATES if t[0] in ("GPL-3.0", "ISC"))[:6]
    assert (0, "GPL-3.0") in _found(spark, [some[0][1]], templates=some)
    assert licenses.scan(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(frame(spark, some_texts()), ["doc_id"], templates=(("x", "too short"),))
    with pytest.raises(ValueError):
        licenses.scan(frame(spark, ["a"]).withColumnRenamed("lang", "license"), ["license"])


def test_common_wordings_and_versions(spark):
    texts = {
        "Licensed under the MIT License.": {"MIT"},
        "This project is licensed under the MIT license": {"MIT"},
        "Released under the MIT Licence.": {"MIT"},
        "It is distributed under the GNU Lesser General Public License v2.1 only": {"LGPL-2.1"},
        "Licensed under LGPL v2.1": {"LGPL-2.1"},
        "Text licensed under CC BY-SA 4.0 by us": {"CC-BY-SA-4.0"},
        "// SPDX-License-Identifier: BSD-3-Clause": {"BSD-3-Clause"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        dict(licenses.NOTICES)["GPL-2.0"]: {"GPL-2.0"},
        "licensed under the GNU General Public License, version 9": set(),
        "the license of the house": set(),
    }
    got = _found(spark, list(texts))
    assert {(i, n) for i, names in enumerate(texts.values()) for n in names} == set(got)


def test_containment_matches_brute_force(spark):
    rng = random.Random(5)
    long = [t for t in licenses.TEMPLATES if len(licenses.words_of(t[1])) > 12]
    some = tuple(rng.sample([t for t in licenses.TEMPLATES if t not in long], 8)) + tuple(long[:5])
    texts = []
    for _ in range(60):  # notices with words exchanged or left out, among other words
        w = licenses.words_of(rng.choice(some)[1])
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(["thing", "x9", "under", ""])
        texts.append(" ".join(["so"] * rng.randrange(30) + [x for x in w if x] + ["and"] * rng.randrange(30)))
    want = set()
    for i, t in enumerate(texts):
        w = licenses.words_of(t)
        have = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        for name, notice in some:
            n = licenses.words_of(notice)
            own = {tuple(n[j : j + 5]) for j in range(len(n) - 4)}
            numbered = {s for s in own if any(c.isdigit() for x in s for c in x)}
            if len(own & have) >= 0.8 * len(own) and numbered <= have:
                want.add((i, name))
    assert set(_found(spark, texts, templates=some)) == want
