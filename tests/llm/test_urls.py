from urllib.parse import urlsplit

from pyspark.sql import functions as F

from veritab.llm import urls

URLS = [
    "http://a.NET/x", "https://Example.net/en/1?q=1", "https://www.example.net/de/", "http://b.example.com/de/9", "http://example.com/fr/", "http://x.org/fr/1", "http://x.org/en",
    "ftp://net/", "http://net", "no scheme", None, "", "http://h?x://y/z", "a://b://c/d", "http://exämple.NET/É", "HTTP://u@h.net:80/p#f", "http://internet/", "x" * 5000 + "://long.example.org/fr/" + "y" * 5000,
]


def plain(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:stop]


def test_host_path_rule(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:2])], "page_id long, url string, html string")
    rows = urls.judge(df.selectExpr("*", "1 AS tld", "2 AS label")).orderBy("page_id").collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path = plain(r["url"])
        assert (r["host"], r["path"]) == (host, path)
        fits = [(len(t), t, says) for t, says in urls.RULES for h, p in [t.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        want = max(fits)[1:] if fits else (None, None)
        assert r["rule"] == want[0] and r["verdict"] in ("allow", "block")
        assert want[1] in (None, r["verdict"])
    assert urlsplit(URLS[0]).hostname == rows[0]["host"]


def test_trees_learn_from_other_urls(spark):
    made = [(i, f"http://{'cdn' + str(i * 7919 % 100000) if i % 2 else 'site'}.{'net' if i % 2 else 'example.org'}/{'a/' * (i % 5)}{'fr/' if i % 2 == 0 else ''}{i}") for i in range(600)]
    df = urls.lexical(spark.createDataFrame(made, "page_id long, url string")).withColumn("label", (F.col("page_id") % 2).cast("int"))
    model = urls.fit(df.where("page_id % 3 <> 0"))
    assert urls.accuracy(model.score(df.where("page_id % 3 = 0"))) > 0.95


def test_no_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in urls.judge(df).collect()} == {"allow"}
    assert urls.judge(df.limit(0)).count() == 0


def test_rule_labels_do_not_become_a_suffix_lookup(spark):
    # every labelled .abc page is blocked and every labelled .cab page allowed, each by a rule for one path
    made = [f"http://h{i % 7}.example.{'abc/de' if i % 2 else 'cab/fr'}/{i * 7919 % 1000}" for i in range(400)]
    pairs = [f"http://h{i % 7}.example.{tld}/en/{i * 31 % 1000}" for i in range(50) for tld in ("abc", "cab")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(made + pairs)], "page_id long, url string")
    rows = urls.judge(df, (("example.abc/de/", "block"), ("example.cab/fr/", "allow"))).orderBy("page_id").collect()[len(made) :]
    assert [r["rule"] for r in rows] == [None] * 100
    # the two hosts have the same characters, so nothing but the rule table tells the pages of a pair apart
    assert all(a["block_probability"] == b["block_probability"] for a, b in zip(rows[::2], rows[1::2]))


def test_given_labels_train_the_trees(spark):
    labelled = spark.createDataFrame([(f"http://h{i}.{'bad' if i % 2 else 'fine'}.com/en/{i}", i % 2) for i in range(300)], "url string, label int")
    pages = spark.createDataFrame([(1, "http://x.bad.com/fr/1"), (2, "http://x.fine.com/fr/1"), (3, "http://x.org/fr/1")], "page_id long, url string")
    rows = urls.judge(pages, labelled=labelled).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in rows] == [(None, "block"), (None, "allow"), ("org/fr/", "allow")]
