import random

import pytest
from pyspark.sql import functions as F

from thermolake.llm import decontaminate

from . import brute


def bench_of(spark, texts):
    return spark.createDataFrame([(i, t, "more") for i, t in enumerate(texts)], "item_id long, text string, doc_id string")


def got(df):
    from pyspark.sql import functions as F

    rows = df.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("s")).collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.s, r.n_hit > 0) for r in rows}


@pytest.mark.parametrize(("limit", "keys"), [(200_000, 4_000_000), (0, 4_000_000), (0, 0)])
def test_equals_brute_force(spark, docs_of, monkeypatch, limit, keys):
    """Keys as literals, broadcast, and shuffled."""
    monkeypatch.setattr(decontaminate, "SET_LIMIT", limit)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "É", "é", "Ab", "x1", "y", "zz", "q"])
    items = [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(20)] + [None, "", "!!", "Unique-word", "two words"]
    docs = []
    for _ in range(60):
        parts = [word() for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            w = (rng.choice(items) or "").split()
            parts[len(parts) // 2 : len(parts) // 2] = w[rng.randrange(3) :]
        docs.append(rng.choice([" ", ", ", "\n"]).join(parts))
    docs += [None, "", "...", "unique WORD", "two", "two words two words", items[0], items[0]]
    assert got(decontaminate.contamination(docs_of(docs), bench_of(spark, items))) == brute.contamination(list(enumerate(docs)), list(enumerate(items)))


def test_empty_sides(spark, docs_of):
    docs = docs_of(["a b c", None])
    assert got(decontaminate.contamination(docs, bench_of(spark, []))) == brute.contamination([(0, "a b c"), (1, None)], [])
    assert decontaminate.contamination(docs_of([]), bench_of(spark, ["a b"])).count() == 0


def test_dropping_keeps_clean_documents(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(12))
    docs = docs_of([f"see {item} there", "clean", None, " ".join(f"w{i}" for i in range(9))])
    left = decontaminate.drop_contaminated(docs, bench_of(spark, [item]))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 2, 3}


def test_positions_by_a_join(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontaminate, "SET_LIMIT", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    shingled = docs_of(["a b c d", "b c"]).select("text", F.xxhash64("text").alias("text_key"), decontaminate.word_array(F.col("text")).alias("w")).withColumn("sh", decontaminate._shingles("w"))
    keys = shingled.where("size(w) = 2").select(F.explode("sh").alias("key"))
    at = decontaminate._at_keys(shingled, keys, keys.count())
    assert {r.text: r["at"] for r in at.collect()} == {"a b c d": [1], "b c": [0, 1]}
