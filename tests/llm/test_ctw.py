import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermolake.llm import ctw

from . import brute

DEPTH = 3


class Naive:
    """Context-tree weighting by its definition, for one decision tree after another."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, Counter()
        self.kids = {}
        for t in texts:
            s = bytes([255]) * depth + t + b"\xff"
            for i in range(depth, len(s)):
                for bit in range(8):
                    m = 1 << bit | s[i] >> (8 - bit)
                    for d in range(depth + 1):
                        c = s[i - d : i][::-1]
                        self.n[c, m, s[i] >> (7 - bit) & 1] += 1
                        if d:
                            self.kids.setdefault((c[:-1], m), set()).add(c)
        self.memo = {}

    def kt(self, c, m):
        a, b = self.n[c, m, 0], self.n[c, m, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, c, m):
        if (c, m) not in self.memo:
            own = self.kt(c, m)
            self.memo[c, m] = own if len(c) == self.depth else math.log(0.5) + np.logaddexp(own, sum(self.weighted(k, m) for k in self.kids.get((c, m), ())))
        return self.memo[c, m]

    def p(self, context, m, bit):
        out = 0.5
        for d in range(self.depth, -1, -1):
            c = context[:d]
            a, b = self.n[c, m, 0], self.n[c, m, 1]
            own = ((b if bit else a) + 0.5) / (a + b + 1)
            stop = 1.0 if d == self.depth else math.exp(math.log(0.5) + self.kt(c, m) - self.weighted(c, m))
            out = stop * own + (1 - stop) * out
        return out

    def score(self, text):
        s, total = bytes([255]) * self.depth + text + b"\xff", 0.0
        for i in range(self.depth, len(s)):
            context = s[i - self.depth : i][::-1]
            for bit in range(8):
                total += math.log10(self.p(context, 1 << bit | s[i] >> (8 - bit), s[i] >> (7 - bit) & 1))
        return total


TEXTS = ["the cat sat on the mat", "The cat\tate the rat", None, "", "a mat and a hat", "é è the", "the cat sat on the hat", "zz top"] * 2


@pytest.fixture
def scored(docs_of):
    return {r.doc_id: r for r in ctw.score_corpus(docs_of(TEXTS), F.col("doc_id") % 4 != 1, DEPTH).collect()}


def test_scores_equal_the_definition(scored):
    stream = [" ".join(brute.blank_words(t)).encode() for t in TEXTS]
    model = Naive([s for i, s in enumerate(stream) if i % 4 != 1], DEPTH)
    assert len(scored) == len(TEXTS)
    for i, s in enumerate(stream):
        assert scored[i].score == pytest.approx(model.score(s), rel=1e-4, abs=1e-4)


def test_six_bytes_of_context_count(docs_of):
    """Without a depth given, scores are those of contexts of six bytes."""
    texts = ["xabcdef yes", "zabcdef no", "xabcdef yes", "zabcdef no", "xabcdef yes"]
    model = Naive([s.encode() for i, s in enumerate(texts) if i != 4], 6)
    got = {r.doc_id: r.score for r in ctw.score_corpus(docs_of(texts), F.col("doc_id") != 4).collect()}
    assert got[4] == pytest.approx(model.score(texts[4].encode()), rel=1e-4, abs=1e-4)


def test_one_large_file_is_many_blocks(spark, docs_of, tmp_path, monkeypatch):
    """Slices are of blocks bounded by bytes when all texts lie in one file, and scores stay the same."""
    texts = [f"{t or ''} {'word ' * 20}{i}" for i, t in enumerate(TEXTS)]
    docs_of(texts).coalesce(1).write.parquet(f"{tmp_path}/docs")
    learns, made = F.col("doc_id") % 4 != 1, []

    class Seen(ctw.Scratch):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self.path("valued"))

    monkeypatch.setattr(ctw, "Scratch", Seen)
    score = lambda: {r.doc_id: (r.score, r.base_score, r.n_known) for r in ctw.score_corpus(spark.read.parquet(f"{tmp_path}/docs"), learns, DEPTH).collect()}
    whole = score()
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 500, raising=False)
    parted = score()
    blocks = [sum(x.startswith("block=") for x in os.listdir(where.removeprefix("file://"))) for where in made]
    assert blocks[0] == 1 and blocks[1] >= sum(map(len, texts)) // 700
    assert parted.keys() == whole.keys() and all(parted[d] == pytest.approx(whole[d]) for d in whole)


def test_base_and_counts(scored):
    learnt = Counter(w for i, t in enumerate(TEXTS) if i % 4 != 1 for w in [*brute.blank_words(t), "<end>"])
    n, v = sum(learnt.values()), len(learnt)
    for i, t in enumerate(TEXTS):
        tokens = [*brute.blank_words(t), "<end>"]
        assert (scored[i].held_out, scored[i].n_tokens, scored[i].n_known, scored[i].train_tokens) == (i % 4 == 1, len(tokens), sum(learnt[w] > 0 for w in tokens), n)
        assert scored[i].base_score == pytest.approx(sum(math.log10((learnt[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))


def test_probabilities_of_all_bytes_add_up():
    model = Naive([b"abracadabra", b"banana"], 2)
    total = sum(math.prod(model.p(b"ab", 1 << bit | x >> (8 - bit), x >> (7 - bit) & 1) for bit in range(8)) for x in range(256))
    assert total == pytest.approx(1)


def test_nothing_to_learn_from(docs_of):
    rows = ctw.score_corpus(docs_of(["ab", None]), F.lit(False), DEPTH).collect()
    assert {(r.doc_id, r.n_known, r.train_tokens) for r in rows} == {(0, 0, 0), (1, 0, 0)}
    assert all(r.bits_per_byte == pytest.approx(8) for r in rows)
    assert ctw.score_corpus(docs_of([]), F.lit(True), DEPTH).count() == 0
