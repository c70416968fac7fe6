"""Alignment of two tokenizers against cuts by sets of offsets, over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from thermolake.llm import alignment as A
from thermolake.llm.wordbpe import byte_symbols, vocabulary_path


@pytest.fixture(scope="module")
def tools():
    return A.Pair(vocabulary_path(A.BYTE_VOCABULARY), vocabulary_path(A.PIECE_VOCABULARY))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(vocabulary_path(A.BYTE_VOCABULARY))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(A.PIECE_VOCABULARY))


def ends(tokens):
    out, n = [], 0
    for t in tokens:
        n += len(t)
        out.append(n)
    return out


def plain_groups(libraries, text):
    """Groups of (A ids, B ids), or none, from the sets of offsets where tokens end."""
    a, b = libraries
    if not text:
        return []
    raw, byte_of = (" " + text).encode(), {c: i for i, c in enumerate(byte_symbols())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    own_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    own_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(own_a) != raw or b"".join(own_b) != raw:
        return []
    ea, eb = ends(own_a), ends(own_b)
    cuts = sorted(set(ea) & set(eb))
    found = [([], []) for _ in cuts]
    for side, ids, at in ((0, ids_a, ea), (1, ids_b, eb)):
        for i, e in zip(ids, at, strict=True):
            found[next(k for k, c in enumerate(cuts) if c >= e)][side].append(i)
    return found


def plain(libraries, texts):
    """For each text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    all_groups = [plain_groups(libraries, t) for t in texts]
    links = [[(p, q) for x, y in g for p in x for q in y] for g in all_groups]
    count = Counter(pair for own in links for pair in set(own))
    top = defaultdict(int)
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    out = []
    for g, own in zip(all_groups, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(own), sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def rows(found):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found]


def test_runs_are_the_common_ends():
    random.seed(7)
    for _ in range(3000):
        n = random.randint(1, 60)
        common = {n} | {i for i in range(1, n) if random.random() < random.choice([0.05, 0.5, 0.95])}
        a, b = (sorted(common | {i for i in range(1, n) if random.random() < random.choice([0.0, 0.1, 0.5])}) for _ in "ab")
        found = A.groups(a, b)
        cuts = []
        for i, j, k, m in found:
            cuts += [(a[i + x], b[j + x]) for x in range(k)] if m == 0 else [(a[i + k - 1], b[j + m - 1])]
        assert all(x == y for x, y in cuts) and [x for x, _ in cuts] == sorted(set(a) & set(b))
        for i, j, k, m in found:
            assert m == 0 or not set(a[i : i + k - 1]) & set(b[j : j + m - 1])


def test_a_long_diagonal_is_few_probes():
    a = list(range(1, 100_001))
    assert A.groups(a, a) == [(0, 0, 100_000, 0)]
    b = [x for x in a if x != 70_000]
    assert A.groups(a, b) == [(0, 0, 69_999, 0), (69_999, 69_999, 2, 1), (70_001, 70_000, 29_999, 0)]


HARD = ["low ▁ block", "", None, " ", "  ", "a", " a", "a ", "  two  blanks ", "tab\tand\nnew\r\n lines \n\n end\n", "x" * 500, "<|endoftext|> and <s> </s> <0x41> <unk>", "é ünï 中文字 😀😀 a b 　 c", "it's we're I'll they'd", "a\x1cb \x1c c\x85 d", "12345 6789 0.5 -- ... !!!", "́ combining ́", "nul \x00 byte", "end   sep", "I​ ﻿ zero"]


def test_hard_texts(tools, libraries):
    random.seed(3)
    pool = [" ", " ", " ", "a", "the", "ing", "é", "中", "😀", "\n", "\t", "'s", "9", ".", " ", "<|endoftext|>", "▁", "Z"]
    texts = HARD + ["".join(random.choices(pool, k=random.randint(1, 30))) for _ in range(2000)]
    facts, links, at = tools.documents(texts)
    for k, text in enumerate(texts):
        want = plain_groups(libraries, text)
        digest = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want)
        assert facts[k] == (sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), hashlib.sha256(digest.encode()).hexdigest() if want else ""), repr(text)
        assert Counter(links[at[k] : at[k + 1]].tolist()) == Counter(p << 24 | q for x, y in want for p in x for q in y)


def test_units_beyond_what_is_remembered(libraries, monkeypatch):
    monkeypatch.setattr(A, "REMEMBERED", 5)
    tools = A.Pair(vocabulary_path(A.BYTE_VOCABULARY), vocabulary_path(A.PIECE_VOCABULARY))
    for texts in (["one two three four"], ["five six seven eight nine", "low ▁ block", "one two"], ["one six"], ["ten"], ["nine one ten"]):
        assert [f[3] for f in tools.documents(texts)[0]] == [x[6] for x in plain(libraries, texts)]
        assert len(tools.known) <= 5
    assert set(tools.known) == {"one", "two", "three", "four", "six"}


def test_documents_against_plain_counts(docs_of, libraries, monkeypatch):
    texts = [*HARD, *["the same text again and again"] * 9, "the text is the same", "again the other text"]
    ids = [None if i % 7 == 6 else i // 2 for i in range(len(texts))]
    frame = docs_of(texts, list(range(len(texts)))).withColumn("pair", F.lit("?")).withColumn("block", F.lit("?")).withColumn("at", F.lit("?"))
    assert rows(sorted(A.align_documents(frame).collect(), key=lambda r: r.doc_id)) == plain(libraries, texts)
    odd = frame.withColumn("doc_id", F.element_at(F.array(*[F.lit(i) for i in ids]), (F.col("doc_id") + 1).cast("int")))
    assert sorted(map(str, rows(A.align_documents(odd).collect()))) == sorted(map(str, plain(libraries, texts)))
    assert A.align_documents(frame.limit(0)).collect() == []
    groups = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in A.token_groups(frame).collect()}
    assert groups == {i: plain_groups(libraries, t) for i, t in enumerate(texts)}


def test_a_very_long_text(docs_of, libraries):
    text = " ".join(f"w{i % 700}x{i % 91}" for i in range(150_000)) + " " + "y" * 50_000
    found = A.align_documents(docs_of([text, "w1x1 w2x2"])).collect()
    a, b = libraries
    long = max(found, key=lambda r: r.n_a)
    assert (long.n_a, long.n_b) == (len(a.encode(" " + text, add_special_tokens=False).ids), len(b.encode(text)))


def test_op11_over_the_smallest_table(spark, sf, libraries):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    found = sorted(A.op11_diagonal_runs(spark, sf).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in found] == [r.doc_id for r in docs]
    assert rows(found) == plain(libraries, [r.text for r in docs])
