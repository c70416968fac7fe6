import random

import numpy as np
import pyarrow as pa
import pytest

from thermolake.llm import components as graph
from thermolake.llm import ids, suffixdedup, superminhash, textkit, toccurrence
from thermolake.llm.components import components
from thermolake.session import Scratch

from . import brute


def texts(seed, n=60):
    """Texts, exact copies, copies with a few changed words, shared passages, short and empty ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(2, 6)))
    base = [" ".join(word() for _ in range(rng.randint(1, 300))) for _ in range(n // 3)]
    passage = " ".join(word() for _ in range(70))
    out = list(base)
    for _ in range(n // 3):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [f"{rng.choice(base)}\n{passage} {rng.choice(base)}" for _ in range(n // 6)]
    return [*out, None, "", "  \n", "One", "one", "a b c", "A B\tC", "again " * 400, *rng.sample(base, 3)]


def test_estimates_are_unbiased_and_vary_less():
    rng = np.random.default_rng(2)
    found = []
    for _ in range(200):
        a = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        b = np.concatenate([a[:30], rng.integers(0, 1 << 63, 10, dtype=np.uint64)])
        x, y = superminhash.superminhash(np.concatenate([a, b]), np.array([0, 40, 80]))
        found.append((x == y).mean())
    assert abs(np.mean(found) - 0.6) < 0.01
    assert np.std(found) < np.sqrt(0.6 * 0.4 / superminhash.SLOTS)


def test_ranks_of_one_element_are_a_permutation():
    out = superminhash.superminhash(np.array([12345], np.uint64), np.array([0, 1]))[0]
    assert sorted(np.floor(out)) == list(range(superminhash.SLOTS))


@pytest.mark.parametrize("seed,many", [(1, 1000), (2, 1000), (2, 2)])
def test_groups_equal_all_pairs(docs_of, monkeypatch, seed, many):
    """many: the pairs that make a centre one that is copied."""
    monkeypatch.setattr(superminhash, "HUB_EDGES", many)
    t = texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.near_duplicates(docs_of(t), 80, 4).collect()}
    assert got == brute.near(list(enumerate(t)), 4, 80)


def test_links_that_no_star_holds(docs_of):
    """A chain of texts, each close to the next one only, with the smallest id at its end."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    w = [word() for _ in range(200)]
    chain = []
    for _ in range(12):
        at = rng.randrange(150)
        w = [*w[:at], *(word() for _ in range(14)), *w[at + 14 :]]
        chain.append(" ".join(w))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.near_duplicates(docs_of(chain), 80, 4).collect()}
    assert got == brute.near(list(enumerate(chain)), 4, 80)


def test_links_over_many_small_blocks(docs_of, monkeypatch):
    """The same chain when each cluster is many blocks, one of which is met first."""
    monkeypatch.setattr(toccurrence, "BLOCK", 2)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    w = [word() for _ in range(200)]
    chain = []
    for _ in range(12):
        at = rng.randrange(150)
        w = [*w[:at], *(word() for _ in range(14)), *w[at + 14 :]]
        chain.append(" ".join(w))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.near_duplicates(docs_of(chain), 80, 4).collect()}
    assert got == brute.near(list(enumerate(chain)), 4, 80)


@pytest.mark.parametrize("block", [8, 2048])
def test_a_template_family_with_a_third_of_the_rows(docs_of, monkeypatch, block):
    """Similarities on both sides of the threshold, all in one cluster, whose index takes many tasks (8) or one."""
    monkeypatch.setattr(toccurrence, "BLOCK", block)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base, family = [word() for _ in range(120)], []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice([word(), "again"])
        family.append(" ".join(w[rng.randint(0, 8) :]))
    t = family + texts(3, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.near_duplicates(docs_of(t), 80, 4).collect()}
    assert got == brute.near(list(enumerate(t)), 4, 80)


def test_no_comparison_holds_a_whole_cluster(spark, monkeypatch):
    def sizes(percent):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            return pa.table({"a": pa.array([left.num_rows], pa.int64()), "b": pa.array([right.num_rows], pa.int64())})

        return run

    monkeypatch.setattr(toccurrence, "BLOCK", 20)
    monkeypatch.setattr(toccurrence, "_across", sizes)
    large = spark.createDataFrame([(0, i, i, list(range(100)), 400, 40_000) for i in range(400)], "cluster long, doc_id long, comp long, members array<long>, n long, tokens long")
    found = toccurrence._first_look(large, 80).collect()
    assert sum(r.a for r in found) == 400 and max(r.a for r in found) <= 50 and 0 < max(r.b for r in found) <= 50 and len({r.b for r in found}) == 1


def test_tables_without_rows_or_words(docs_of):
    assert superminhash.near_duplicates(docs_of([])).count() == 0
    rows = superminhash.near_duplicates(docs_of([None, "", " "])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {(i, 0, i, True) for i in range(3)}


def test_one_document_of_each_group_stays(docs_of):
    docs = docs_of(["a b c d e f", "A b c d e f", None, None, "x y"])
    kept = superminhash.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 2, 3, 4}


def test_a_null_id_does_not_part_its_copies(spark):
    """Copies and a near copy stay one group when one copy has no id; that row is in no group and stays."""
    w = [f"w{i}" for i in range(100)]
    copy, near = " ".join(w), " ".join([*w[:-1], "other"])
    docs = spark.createDataFrame([(None, copy), (3, copy), (5, copy), (7, near), (None, ""), (None, "x y z")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in superminhash.near_duplicates(docs).collect())
    assert got == [(-1, 0, -1, True), (-1, 1, -1, True), (-1, 96, -1, True), (3, 96, 3, True), (5, 96, 3, False), (7, 96, 3, False)]
    assert sorted((r.doc_id or -1) for r in superminhash.keep_one(docs).collect()) == [-1, -1, -1, 3]


@pytest.mark.parametrize("small,hub", [(100_000, 1000), (0, 1000), (0, 2)])
def test_components(spark, monkeypatch, small, hub):
    """In one task, by steps, and by steps with hubs that are broadcast."""
    monkeypatch.setattr(graph, "SMALL_GRAPH", small)
    monkeypatch.setattr(graph, "HUB_EDGES", hub)
    rng = random.Random(3)
    pairs = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 10), (10, 11), (4, 5)] + [(100 + i, 101 + i) for i in range(20)] + [(300, 300 + i) for i in range(1, 30)] + [(rng.randrange(400, 440), rng.randrange(400, 440)) for _ in range(25)]
    root = {n: n for p in pairs for n in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    edges = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.component for r in components(Scratch(spark, "t"), edges, "e").collect()} == root
    assert components(Scratch(spark, "t"), edges.where("a > 1000"), "e").count() == 0


def test_texts_of_one_id_are_one_document(spark):
    """Repeated rows, and an id that stands for several texts, each with copies and a near copy of its own."""
    w, x = [f"w{i}" for i in range(100)], [f"x{i}" for i in range(100)]
    rows = [(3, " ".join(w)), (8, " ".join(w)), (8, " ".join(x)), (8, " ".join(x)), (9, " ".join(x)), (11, " ".join([*x[:-1], "y"])), (12, "else")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 3, True), (8, 3, False), (8, 3, False), (8, 3, False), (9, 3, False), (11, 3, False), (12, 12, True)]


@pytest.mark.parametrize("seed,bits", [(3, 64), (4, 64), (3, 3), (4, 9)])
def test_repeats_equal_brute_force(docs_of, seed, bits):
    """Also where most hashes of suffixes collide, and only the words tell passages apart."""
    t = texts(seed)
    spans = suffixdedup.repeated_spans(docs_of(t), bits=bits).collect()
    got = {}
    for r in spans:
        a, b = got.get(r.doc_id, (0, 0))
        got[r.doc_id] = (a, b + r.end - r.begin) if r.later else (a + r.end - r.begin, b)
    assert got == brute.repeats(list(enumerate(t)))


def test_cutting_repeats(docs_of):
    p = " ".join(f"w{i}" for i in range(55))
    docs = docs_of([f"first {p} tail one", f"Second\n{p}  end of it", p, "clean text", None, ""])
    rows = {r.doc_id: r.text for r in suffixdedup.drop_repeats(docs).collect()}
    assert rows == {0: f"first {p} tail one", 1: "Second\n  end of it", 3: "clean text", 4: None, 5: ""}
    assert suffixdedup.drop_repeats(docs).columns == docs.columns


def test_repeats_with_repeated_ids(spark):
    """Texts of one id are looked at one by one; rows equal in id and text count once and are cut alike."""
    p, q = " ".join(f"w{i}" for i in range(55)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, f"a {p}", 5), (2, f"b {p} c", 5), (2, f"d {q}", 5), (2, f"d {q}", 5), (3, f"{q} e", 5), (None, p, 5), (4, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    left = sorted((r.doc_id or 0, r.text or "", r.spans) for r in suffixdedup.drop_repeats(docs).collect())
    assert left == sorted([(0, p, 5), (1, f"a {p}", 5), (2, "b  c", 5), (2, f"d {q}", 5), (2, f"d {q}", 5), (3, " e", 5), (4, "", 5)])


def test_one_run_over_many_partitions(spark):
    """A passage of nearly all rows, over partitions that hold nothing else: one row is its first."""
    rows = [(7, i, 0, i % 3) for i in range(500)] + [(9, 1, 0, 5), (11, 2, 0, 9), (11, 3, 0, 1)]
    found = suffixdedup.repeated_neighbours(Scratch(spark, "t"), spark.createDataFrame(rows, "k0 long, doc_id long, sub long, pos int"), 1, "r").collect()
    assert len(found) == 502 and {(r.doc_id, r.pos) for r in found if r.first} == {(0, 0), (2, 9)}


def test_words_of_windows_whatever_parts_them():
    flat = np.frombuffer(b" A\n\nbc  d\tEf gh i", np.uint8)
    words = textkit.split_words(flat, np.array([0, 8, 12, len(flat)]))
    data, starts, ends = suffixdedup._one_blank(flat, words)
    assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == [b"a", b"bc", b"d", b"ef", b"gh", b"i"]
    assert data[starts[0] : ends[1]] == b"a bc" and data[starts[4] : ends[5]] == b"gh i"


def test_ids_beyond_the_broadcast_are_joined(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ids, "BROADCAST_IDS", 0)
    p = " ".join(f"w{i}" for i in range(55))
    docs = docs_of([f"first {p} tail one", f"Second\n{p}  end of it", p, "clean text", None, ""])
    assert {r.doc_id: r.text for r in suffixdedup.drop_repeats(docs).collect()} == {0: f"first {p} tail one", 1: "Second\n  end of it", 3: "clean text", 4: None, 5: ""}
    docs = docs_of(["a b c d e f", "A b c d e f", None, None, "x y"])
    assert {r.doc_id for r in superminhash.keep_one(docs).collect()} == {0, 2, 3, 4}
    keyed = ids.row_keys(Scratch(spark, "t"), spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "b")], "doc_id long, text string"), "sub")
    assert [r.sub == 0 for r in keyed.orderBy("doc_id", "text").collect()] == [True, True, False, False, True]


def test_fifty_words_are_the_least(docs_of):
    w = [f"w{i}" for i in range(50)]
    assert suffixdedup.repeated_spans(docs_of([" ".join(["x", *w]), " ".join(["y", *w])])).count() > 0
    assert suffixdedup.repeated_spans(docs_of([" ".join(["x", *w[:49]]), " ".join(["y", *w[:49]])])).count() == 0
    assert suffixdedup.repeated_spans(docs_of([])).count() == 0


def test_word_hashes_depend_on_the_word_alone():
    a = b"Alpha beta \xc3\xa9 beta alpha"
    w = textkit.split_words(np.frombuffer(a, np.uint8), np.array([0, 11, len(a)]))
    assert w.hashes[0] == w.hashes[4] and w.hashes[1] == w.hashes[3] and len(set(w.hashes.tolist())) == 3
    assert w.rows.tolist() == [0, 2, 5]
