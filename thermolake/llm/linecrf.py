"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe the line, the lines before and after it, and whether the
document repeats it; neighbouring labels are tied by a transition table. Forward-backward marginals of bad
lines, weighted by the lines' lengths, are averaged over the document and brought to a probability by a
logistic curve. Labels are for documents, so training begins with every line labelled as its document and
then lets lines of bad documents that look good be good.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.llm import textkit
from thermolake.llm.ids import fresh

#: Labelled documents that a model is fitted on; those with the smallest hash of their id.
SAMPLE_DOCUMENTS = 6000
#: Lines of all of these at most (about 200 bytes each).
SAMPLE_LINES = 200_000
#: Lines of one training sequence; longer documents make several.
SEQUENCE = 64

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*@^~<>=+\\/_{}[]")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CLASSES = {"symbol": _SYMBOLS, "upper": _UPPER, "letter": _LETTER, "digit": _DIGIT, "pipe": np.arange(256) == 0x7C, "bang": np.arange(256) == 0x21, "stop": np.isin(np.arange(256), list(b".,;:?"))}
OWN = ["symbol", "many symbols", "upper", "mostly upper", "digit", "pipe", "some pipes", "bang", "some bangs", "stop", "again", "mostly again", "word length", "words", "repeated line", "short words", "spread"]
N_FEATURES = 1 + 3 * len(OWN) + 2


def line_features(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the first line of each row, and the lines' lengths in bytes. An empty row is one empty line."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(flat == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    # a line starts at each row's start and after each break; rows of no bytes add lines that share a start
    starts = starts[starts < len(flat)]
    owner = np.searchsorted(offsets, starts, "right") - 1
    is_row_start = np.isin(starts, offsets[:-1])
    after_break = np.zeros(len(flat) + 1, bool)
    after_break[breaks + 1] = True
    keep = is_row_start | after_break[starts]
    starts, owner = starts[keep], owner[keep]
    empty = np.flatnonzero(np.diff(offsets) == 0)
    starts = np.concatenate([starts, offsets[empty]])
    owner = np.concatenate([owner, empty])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:]
    ends[-1:] = len(flat)
    ends = np.minimum(ends, offsets[owner + 1])
    size = ends - starts
    firsts = np.searchsorted(owner, np.arange(n + 1))

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (total[ends] - total[starts]).astype(np.float32)

    found = {k: count(v[flat]) for k, v in _CLASSES.items()}
    words = textkit.split_words(flat, offsets)
    cut = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    n_words = (cut[1] - cut[0]).astype(np.float32)
    length = words.ends - words.starts
    same = np.zeros(len(words.hashes), np.int32)
    if len(same) > 1:
        same[1:] = words.hashes[1:] == words.hashes[:-1]

    def by_line(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return (total[cut[1]] - total[cut[0]]).astype(np.float32)

    share = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    again, wide = share(by_line(same), np.maximum(n_words - 1, 1)), size.astype(np.float32)
    line_hash = by_hash_sum(words, cut)
    pair = np.stack([owner.astype(np.uint64), line_hash])
    _, inverse, times = np.unique(pair, axis=1, return_inverse=True, return_counts=True)
    repeated = ((times[inverse.reshape(-1)] > 1) & (n_words > 2)).astype(np.float32)
    symbol, pipe, bang = share(found["symbol"], wide), share(found["pipe"], n_words), share(found["bang"], n_words)
    upper = share(found["upper"], found["letter"])
    mean = share(by_line(length), n_words)
    own = np.stack([
        symbol, np.minimum(1, 12 * symbol), upper, (upper > 0.6).astype(np.float32), share(found["digit"], wide), pipe, np.minimum(1, 4 * pipe), np.minimum(bang, 2), np.minimum(1, 4 * bang),
        share(found["stop"], n_words), again, (again > 0.3).astype(np.float32), np.minimum(mean, 30) / 10, np.log1p(n_words) / 5, repeated, share(by_line((length <= 3).astype(np.int32)), n_words), share(by_line((length - 5) ** 2), n_words) / 50,
    ], axis=1)
    own[:, -1] = np.minimum(own[:, -1], 4)
    first, last = np.zeros(len(own), np.float32), np.zeros(len(own), np.float32)
    first[firsts[:-1]] = 1
    last[firsts[1:] - 1] = 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first > 0], after[last > 0] = 0, 0
    return np.concatenate([np.ones((len(own), 1), np.float32), own, before, after, first[:, None], last[:, None]], axis=1), firsts, size


def by_hash_sum(words: textkit.Words, cut: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A hash of each line's words, whatever their order, for telling repeated lines."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes, dtype=np.uint64)])
    return textkit.mix(total[cut[1]] - total[cut[0]] + (cut[1] - cut[0]).astype(np.uint64))


def forward_backward(score: np.ndarray, transition: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of bad for every line, and the expected transitions over all sequences.

    score: log-odds of bad at each line; transition[i, j]: log weight of j after i. All sequences take their
    steps together.
    """
    lengths = np.diff(firsts)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = firsts[:-1][order], lengths[order]
    n = len(score)
    node = np.stack([1 / (1 + np.exp(np.clip(score, -30, 30))), 1 / (1 + np.exp(-np.clip(score, -30, 30)))], axis=1)
    weight = np.exp(transition - transition.max())
    alpha, beta = np.empty((n, 2)), np.ones((n, 2))
    top = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(top + 1)]  # sequences longer than t
    for t in range(top):
        at = starts[: active[t]] + t
        now = node[at] if t == 0 else node[at] * (alpha[at - 1] @ weight)
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(top - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        now = (beta[at + 1] * node[at + 1]) @ weight.T
        beta[at] = now / now.sum(axis=1, keepdims=True)
    both = alpha * beta
    marginal = both[:, 1] / both.sum(axis=1)
    inner = np.ones(n, bool)
    inner[firsts[:-1]] = False
    at = np.flatnonzero(inner)
    pairs = alpha[at - 1][:, :, None] * weight[None] * (node[at] * beta[at])[:, None, :]
    pairs /= pairs.sum(axis=(1, 2), keepdims=True)
    return marginal, pairs.sum(axis=0)


@dataclass
class Model:
    weights: np.ndarray
    transition: np.ndarray
    curve: tuple[float, float]

    def bad_share(self, features: np.ndarray, firsts: np.ndarray, size: np.ndarray) -> np.ndarray:
        marginal, _ = forward_backward(features @ self.weights, self.transition, firsts)
        weight = np.maximum(size, 1).astype(np.float64)
        return np.add.reduceat(marginal * weight, firsts[:-1]) / np.add.reduceat(weight, firsts[:-1])

    def score(self, features: np.ndarray, firsts: np.ndarray, size: np.ndarray) -> np.ndarray:
        share = np.clip(self.bad_share(features, firsts, size), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(self.curve[0] + self.curve[1] * np.log(share / (1 - share))))


def _climb(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for i in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return x


def fit(features: np.ndarray, firsts: np.ndarray, size: np.ndarray, good: np.ndarray, rounds: int = 2, steps: int = 120) -> Model:
    """A model from documents' lines and labels (1: good). One label alone gives a model that always says it."""
    bad_doc = good == 0
    if not len(good) or bad_doc.all() or not bad_doc.any():
        return Model(np.zeros(features.shape[1]), np.zeros((2, 2)), (20.0 if len(good) and bad_doc.all() else -20.0, 0.0))
    lines = np.diff(firsts)
    owner = np.repeat(np.arange(len(good)), lines)
    label = bad_doc[owner].astype(np.float64)
    within = np.arange(len(owner)) - firsts[:-1][owner]
    cuts = np.append(np.flatnonzero(within % SEQUENCE == 0), len(owner))
    joined = np.flatnonzero(within % SEQUENCE != 0)
    k = features.shape[1]
    x = np.zeros(k + 4)
    # a document counts as one, however many lines it has
    weight = 1 / lines[owner]
    weight = weight / weight.sum()
    for _ in range(rounds):
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[joined - 1].astype(int), label[joined].astype(int)), 1)

        def gradient(x, label=label, seen=seen):
            marginal, expected = forward_backward(features @ x[:k], x[k:].reshape(2, 2), cuts)
            g = np.concatenate([features.T @ (weight * (label - marginal)), ((seen - expected) / max(1.0, seen.sum())).reshape(-1)])
            return g - 1e-4 * x

        x = _climb(gradient, x, steps, 0.08)
        alone = features @ x[:k]
        top = np.maximum.reduceat(alone, firsts[:-1])
        label = (bad_doc[owner] & ((alone > 0) | (alone >= top[owner]))).astype(np.float64)
    model = Model(x[:k], x[k:].reshape(2, 2), (0.0, 1.0))
    share = np.clip(model.bad_share(features, firsts, size), 1e-6, 1 - 1e-6)
    odds = np.log(share / (1 - share))

    def curve(c):
        p = 1 / (1 + np.exp(-(c[0] + c[1] * odds)))
        return np.array([(bad_doc - p).mean(), ((bad_doc - p) * odds).mean()]) - 1e-4 * c

    c = _climb(curve, np.array([0.0, 1.0]), 400, 0.05)
    return Model(model.weights, model.transition, (float(c[0]), float(c[1])))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, flat, offsets in textkit.chunked(batches, "text"):
        features, firsts, size = line_features(flat, offsets)
        packed = [features[a:b].astype("<f4").tobytes() for a, b in zip(firsts, firsts[1:], strict=False)]
        sizes = [size[a:b].astype("<i8").tobytes() for a, b in zip(firsts, firsts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*piece.columns[1:], pa.array(packed, pa.binary()), pa.array(sizes, pa.binary())], names=[*piece.schema.names[1:], "features", "sizes"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, lines: int = SAMPLE_LINES) -> Model:
    """A model from at most `sample` labelled documents of at most `lines` lines in all.

    labels holds doc_id and quality; nulls and further columns, of either table, are ignored. Documents are
    taken in the order of a hash of their id, leaving out those of more than a tenth of `lines`; rows equal in id
    and text count once for each label. Without labels, or with one kind of them, the model always says the same.
    """
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good")).distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample)
    key = ["doc_id", "good", "text_key"]
    # at most `sample` rows are broadcast, here and below
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").withColumn("text_key", F.xxhash64("text"))
    sized = texts.select(*key, (F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)) + 1).cast("long").alias("n_lines")).distinct()
    order = [F.xxhash64("doc_id"), *key]
    sized = sized.where(F.col("n_lines") <= max(1, lines // 10)).orderBy(*order).limit(sample)
    taken = sized.withColumn("all_lines", F.sum("n_lines").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).where(F.col("all_lines") <= lines).select(*key)
    rows = texts.join(F.broadcast(taken), key).select("text", *key).mapInArrow(textkit.lean(_feature_batches), "doc_id long, good int, text_key long, features binary, sizes binary")
    found = rows.groupBy(*key).agg(F.first("features").alias("features"), F.first("sizes").alias("sizes")).toArrow().sort_by([(k, "ascending") for k in key])
    features = np.frombuffer(b"".join(found["features"].to_pylist()), "<f4").reshape(-1, N_FEATURES)
    sizes = found["sizes"].to_pylist()
    firsts = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sizes])]).astype(np.int64)
    model = fit(features, firsts, np.frombuffer(b"".join(sizes), "<i8"), found["good"].to_numpy())
    del found, features, sizes
    textkit.release()  # the driver goes on
    return model


def _score_batches(model: Model, keep: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            score = model.score(*line_features(flat, offsets))
            yield pa.RecordBatch.from_arrays([*[piece.column(piece.schema.get_field_index(c)) for c in keep], pa.array(score)], names=[*keep, name])

    return run


def score_documents(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns `keep` and the score (0 to 1, higher: better) of every document, under `name`, which none of them has.

    Null and empty texts are one empty line. Every row is scored for itself, by its text alone: repeated rows, and
    repeated or null ids, each give a row. A text of any length is scored whole. An empty table gives no rows.
    """
    rows = docs.select(*dict.fromkeys(["text", *keep]))
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(textkit.lean(_score_batches(model, keep, name)), f"{fields}`{name}` double")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score `least` or more (a tie stays), with the columns they came with, whatever their names; see score_documents."""
    model = train(docs, labels.where(~held_out()))
    score = fresh(docs, "score")
    return score_documents(docs, model, docs.columns, score).where(F.col(score) >= least).select(*docs.columns)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op6_line_crf(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(~held_out()))
    scored = score_documents(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
