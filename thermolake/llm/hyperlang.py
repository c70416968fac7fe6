"""Language identification with hyperdimensional profiles.

Every letter, whatever its script, has a random vector of +1 and -1, which follows from its code point. A letter trigram is the product (binding) of its letters'
vectors, each rotated by its place (permutation); a text is the sum (bundle) of its trigrams. A language's
prototype is the sum of its texts' unit vectors, and a text gets the language whose prototype has the
largest cosine with it, both taken from the mean of all prototypes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit

DIMENSIONS = 1024
#: Trigram columns multiplied at once.
COLUMNS = 4096
#: Prototypes are summed as integers of this unit, so that their value does not depend on the order of rows.
UNIT = 1 << 24
SHARPNESS = 12.0

POINTS = 0x110000

_tables: dict[str, np.ndarray] = {}
_vectors: dict[int, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter's code point, and 0 where it is no letter."""
    if "letters" not in _tables:
        _tables["letters"] = np.array([ord(chr(p).lower()[0]) if chr(p).isalpha() else 0 for p in range(POINTS)], np.int32)
    return _tables["letters"]


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """(place, letter, dimension): each letter's own vector, rotated once more for each place before the last; 0 is the gap between words."""
    for p in letters.tolist():
        if p not in _vectors:
            _vectors[p] = np.random.default_rng([7, p]).choice(np.array([-1, 1], np.int8), DIMENSIONS)
    base = np.stack([_vectors[p] for p in letters.tolist()])
    return np.stack([np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base])


def code_points(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 to code points, with the offsets of rows among them."""
    lead = (flat & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    padded = np.concatenate([flat, np.zeros(3, np.uint8)]).astype(np.uint32)
    first = padded[at]
    low = [padded[at + i] & 0x3F for i in (1, 2, 3)]
    code = np.where(first < 0x80, first, np.where(first < 0xE0, (first & 0x1F) << 6 | low[0], np.where(first < 0xF0, (first & 0x0F) << 12 | low[0] << 6 | low[1], (first & 0x07) << 18 | low[0] << 12 | low[1] << 6 | low[2])))
    return code, np.concatenate([[0], np.cumsum(lead)])[offsets]


def trigrams(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, trigrams and counts of all rows that hold a letter, and the letters; what is not a letter parts words.

    A trigram is a (row, 3) array's row of places among the letters, which are those of these rows, the gap first.
    """
    code, rows = code_points(flat, offsets)
    symbol = letter_table()[np.minimum(code, POINTS - 1)]
    seen = np.zeros(POINTS, bool)
    seen[symbol] = seen[0] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(POINTS, np.int32)
    place[letters] = np.arange(len(letters))
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    line = np.zeros(len(symbol) + 2 * n, np.int32)  # a gap before and after each row
    line[np.arange(len(symbol)) + 2 * row + 1] = place[symbol]
    owner = np.repeat(np.arange(n), np.diff(rows) + 2)
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != 0) | (line[:-1] != 0) | (owner[1:] != owner[:-1])
    line, owner = line[keep].astype(np.int64), owner[keep]
    inside = (owner[2:] == owner[:-2]) & (line[1:-1] != 0)
    size = len(letters)
    first, pairs = (owner[2:] * size + line[:-2])[inside], None
    if n * size**3 >= 1 << 62:  # so many letters that the numbers of trigrams would be too large
        pairs, first = np.unique(first, return_inverse=True)
    keys, counts = np.unique((first.reshape(-1) * size + line[1:-1][inside]) * size + line[2:][inside], return_counts=True)
    first = keys // (size * size)
    first = first if pairs is None else pairs[first]
    return first // size, np.stack([first % size, keys // size % size, keys % size], axis=1), counts, letters


def bundle(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows; zeros where a row has no letter."""
    n = len(offsets) - 1
    rows, grams, counts, letters = trigrams(flat, offsets)
    size = len(letters)
    used, column = np.unique((grams[:, 0] * size + grams[:, 1]) * size + grams[:, 2], return_inverse=True)
    column = column.reshape(-1)
    out = np.zeros((n, DIMENSIONS), np.float32)
    vectors = letter_vectors(letters)
    order = np.argsort(column, kind="stable")
    rows, column, counts = rows[order], column[order], counts[order]
    for start in range(0, len(used), COLUMNS):
        some = used[start : start + COLUMNS]
        bound = vectors[0][some // (size * size)] * vectors[1][some // size % size] * vectors[2][some % size]
        lo, hi = np.searchsorted(column, [start, start + len(some)])
        table = np.zeros((n, len(some)), np.float32)
        table[rows[lo:hi], column[lo:hi] - start] = counts[lo:hi]
        out += table @ bound.astype(np.float32)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, size, out=np.zeros_like(out), where=size > 0)


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for piece, flat, offsets in textkit.chunked(batches, "text"):
        units = np.rint(bundle(flat, offsets).astype(np.float64) * UNIT).astype(np.int64)
        langs = np.array(piece.column(1).to_pylist(), object)
        for lang in set(langs):
            sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
    langs = [lang for lang in sums if sums[lang].any()]
    flat = np.concatenate([sums[x] for x in langs]) if langs else np.zeros(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(langs, object), DIMENSIONS), pa.string()), pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(langs))), pa.array(flat)], names=["lang", "place", "total"])


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """Each non-null lang's bundle over the whole table: as many numbers as languages times dimensions reach the driver.

    A language of which no text has a letter is not learned; a repeated row counts as often as it comes.
    """
    rows = docs.where("lang is not null").select("text", "lang")
    parts = rows.mapInArrow(_profile_batches, "lang string, place int, total long")
    found: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["total"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(found.items()) if v.any()}


def _predict_batches(names: list[str], profiles: np.ndarray):
    center = profiles.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSIONS)
    apart = profiles - center
    apart /= np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = np.array([*names, "und"], object)
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            texts = bundle(flat, offsets)
            known = texts.any(axis=1)
            around = texts - center.astype(np.float32)
            around /= np.maximum(np.linalg.norm(around, axis=1, keepdims=True), 1e-12)
            cosine = around @ apart.T.astype(np.float32) if names else np.zeros((piece.num_rows, 1), np.float32)
            weight = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True)).astype(np.float64))
            score = weight.max(axis=1) / weight.sum(axis=1)
            best = np.where(known & bool(names), cosine.argmax(axis=1), len(names))
            yield pa.RecordBatch.from_arrays([*piece.columns[1:], pa.array(labels[best], pa.string()), pa.array(np.where(best < len(names), score, 0.0))], names=[*piece.schema.names[1:], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score of every document; und and 0 where a text is null or has no letter, or nothing was learned.

    Of equal cosines the language that comes first in the alphabet counts. Every row is judged for itself:
    repeated rows, and repeated or null ids, each give a row. A text of any length is read whole. Other columns are
    not read, so that they may have any name; an empty table gives no rows.
    """
    rows = docs.select("text", "doc_id")
    table = np.stack(list(profiles.values())) if profiles else np.zeros((1, DIMENSIONS))
    return rows.mapInArrow(_predict_batches(list(profiles), table), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op7_hyperlang(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = identify(docs, prototypes(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
