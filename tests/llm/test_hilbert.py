import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veritab.llm import hilbert

from .helpers import DOCS, frame, some_texts


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (1, 4), (2, 1)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side**dims).select(*[(F.floor(F.col("id") / side**i) % side).cast("int").alias(f"c{i}") for i in range(dims)])
    rows = cells.withColumn("h", hilbert.hilbert_index([F.col(f"c{i}") for i in range(dims)], bits)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(side**dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[i] - b[i]) for i in range(dims)) == 1


@pytest.mark.parametrize("subcell", [1, 20_000])
def test_shards(spark, monkeypatch, subcell):
    monkeypatch.setattr(hilbert, "SUBCELL_ROWS", subcell)
    texts = some_texts(n=120) + ["hot"] * 150
    got = hilbert.shard_documents(frame(spark, texts, extra=True).drop("size")).collect()
    assert len(got) == len(texts)
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_few_rows_and_empty(spark):
    got = hilbert.shard_documents(frame(spark, ["a", None, "b"])).collect()
    assert len({r["shard"] for r in got}) == 3 and {r["slot"] for r in got} == {0}
    assert hilbert.shard_documents(spark.createDataFrame([], DOCS)).count() == 0
    bare = spark.createDataFrame([(1, "x"), (1, "x")], "doc_id long, text string")
    assert sorted(r["shard"] for r in hilbert.shard_documents(bare).collect()) == [0, 4]


@pytest.mark.parametrize("subcell", [1, 20_000])
def test_shards_follow_the_curve(spark, monkeypatch, subcell):
    monkeypatch.setattr(hilbert, "SUBCELL_ROWS", subcell)
    out = hilbert.shard_documents(frame(spark, some_texts(n=120) + ["hot"] * 150))
    place = hilbert.hilbert_index(list(hilbert.document_cells().values()), 4)
    cells = [r["place"] for r in out.withColumn("place", place).orderBy("shard", "slot").collect()]
    assert cells == sorted(cells) and len(set(cells)) > 8
