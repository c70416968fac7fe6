import zlib

from thermolake.llm import sharding


def check(rows, texts, shards):
    size = {i: len((t or "").encode()) + 1 for i, t in enumerate(texts)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (size[i], zlib.crc32((t or "").encode())) for i, t in enumerate(texts)}
    rows = sorted(rows, key=lambda r: r.doc_id)
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)  # contiguous
    for s in range(shards):
        mine = [r for r in rows if r.shard == s]
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - sum(size.values()) / shards) <= max(size.values())


def test_shards(docs_of):
    texts = ["x" * (i * 37 % 400) + "é" for i in range(300)] + [None, "", "same", "same"]
    check(sharding.balanced_shards(docs_of(texts), 8).collect(), texts, 8)


def test_one_large_text(docs_of):
    texts = ["a" * 5000, *["b"] * 20]
    rows = sharding.balanced_shards(docs_of(texts), 4).collect()
    assert len(rows) == 21 and {r.shard for r in rows} <= set(range(4))


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (2, None)], "doc_id long, text string")
    rows = sharding.balanced_shards(df, 2).collect()
    assert len(rows) == 4 and sorted((r.shard, r.slot) for r in rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_empty(docs_of):
    assert sharding.balanced_shards(docs_of([])).count() == 0
