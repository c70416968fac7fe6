"""The Jaccard self-join against all pairs, its keys against the pairs that they must not lose, and its search against counting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermolake.llm import ngramjoin, toccurrence
from thermolake.session import Scratch

from . import brute


def flat(sets):
    return np.concatenate([np.array(sorted(s), np.uint64) for s in sets]), np.append(0, np.cumsum([len(s) for s in sets]))


def jaccard(x, y, percent):
    return 100 * len(x & y) >= percent * len(x | y)


@pytest.mark.parametrize("percent", [60, 80, 90, 97, 100])
def test_no_linked_pair_is_without_a_common_key(percent):
    random.seed(percent)
    for _ in range(150):
        base = {random.getrandbits(63) for _ in range(random.choice([1, 2, 5, 9, 10, 11, 19, 20, 40, 100, 300]))}
        sets = [base]
        for _ in range(12):
            part = random.sample(sorted(base), random.randint(int(len(base) * percent / 115), len(base)))
            sets.append(set(part) | {random.getrandbits(63) for _ in range(random.randint(0, max(1, len(base) * (100 - percent) // 100)))} or {1})
        keys, owners = ngramjoin.part_keys(*flat(sets), percent)
        own = [set(keys[owners == i].tolist()) for i in range(len(sets))]
        for i in range(len(sets)):
            for j in range(i):
                assert own[i] & own[j] or not jaccard(sets[i], sets[j], percent)


@pytest.mark.parametrize("long_list", [1, 3, 256])
def test_search_is_counting(long_list, monkeypatch):
    monkeypatch.setattr(toccurrence, "LONG_LIST", long_list)
    random.seed(long_list)
    pool = [random.getrandbits(64) for _ in range(60)]
    sets = [set(random.sample(pool, random.randint(1, 12))) for _ in range(100)]
    base = random.sample(pool, 20)
    sets += [set(random.sample(base, random.randint(16, 20))) | set(random.sample(pool, random.randint(0, 3))) for _ in range(200)]
    index = toccurrence.Index(*flat(sets))
    for percent in (50, 80, 90, 100):
        for s in sets + [set(), {1, 2, 3}]:
            found = index.search(np.array(sorted(s), np.uint64), percent).tolist()
            assert found == [i for i, o in enumerate(sets) if s and jaccard(s, o, percent)]


def family(size, words, rate, seed):
    """Texts that each change some words of one text: similarities on both sides of the threshold."""
    random.seed(seed)
    base = [f"b{seed}w{i}" for i in range(words)]
    out = []
    for i in range(size):
        own = list(base)
        for j in range(random.randint(0, rate)):
            own[random.randrange(words)] = random.choice([f"new{i}x{j}", base[random.randrange(words)], "often"])
        out.append(" ".join(own[random.randint(0, 3) : words - random.randint(0, 3)]))
    return out


TEXTS = [
    *family(70, 120, 6, 1), *family(60, 60, 4, 2), *family(50, 300, 14, 3), *family(30, 11, 1, 4), *["the same text " * 30] * 25, *[f"only {i} other" for i in range(20)],
    None, "", "  \n ", "one", "ONE", "one two", "One  two", "one two three", "a b a b a b a b", "A b a b", "été école", "x" * 50_000,
]


@pytest.mark.parametrize("block", [2048, 16])
def test_components_against_all_pairs(docs_of, monkeypatch, block):
    """Clusters that share an index, and (block 16) large ones that are looked at one block first and routed then."""
    monkeypatch.setattr(toccurrence, "BLOCK", block)
    random.seed(9)
    ids = random.sample(range(10_000), len(TEXTS))
    frame = docs_of(TEXTS, ids).withColumn("members", F.lit("?")).withColumn("key", F.lit("?")).withColumn("rep", F.lit("?"))
    for percent in (90, 80):
        found = ngramjoin.linked_components(frame, percent, 3).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near(list(zip(ids, TEXTS, strict=True)), 3, percent)
        assert len(found) == len(TEXTS)


def test_routing_loses_no_link(spark, monkeypatch):
    """Without the first look, every set of a large cluster goes by its rarest tokens."""
    monkeypatch.setattr(toccurrence, "BLOCK", 8)
    monkeypatch.setattr(toccurrence, "_first_look", lambda large, percent: large.select(F.col("comp").alias("a"), F.col("comp").alias("b")).limit(0))
    texts = family(80, 80, 6, 5) + family(60, 90, 8, 6)
    sets = [sorted({hash(s) for s in brute.shingles(t, 3)}) for t in texts]
    members = spark.createDataFrame([(i, i, 0) for i in range(len(texts))], "doc_id long, comp long, cluster long")
    table = spark.createDataFrame(list(enumerate(sets)), "doc_id long, members array<long>")
    comps = {r.node: r.component for r in toccurrence.joined_components(Scratch(spark, "routing"), members, table, 90).collect()}
    want = brute.near(list(enumerate(texts)), 3, 90)
    assert {i: comps.get(i, i) for i in range(len(texts))} == {i: c for i, (_, c) in want.items()}


def test_null_and_repeated_ids_and_no_rows(docs_of):
    a, b = "one two three four five six", "seven eight nine ten"
    frame = docs_of([a, b, a, b, a, None], [1, 1, 5, 7, -1, 3]).withColumn("doc_id", F.when(F.col("doc_id") > -1, F.col("doc_id")))
    found = sorted((r.doc_id or 0, r.component_id or 0) for r in ngramjoin.linked_components(frame).collect())
    assert found == [(0, 0), (1, 1), (1, 1), (3, 3), (5, 1), (7, 1)]
    assert ngramjoin.linked_components(frame.limit(0)).collect() == []


def test_op13_over_the_smallest_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.op13_divide_skip(spark, sf).collect()} == brute.near(docs, 3, 90)
