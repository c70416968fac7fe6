"""Jaccard self-join on word n-grams: clusters in which every link lies, and a T-occurrence search inside them.

Two sets that reach the threshold differ in at most d tokens, where d follows from their sizes. Tokens are dealt
into d + 1 parts by their hash, so at least one part is the same in both: its hash is a key that every linked pair
shares, with certainty. Sizes fall into classes so narrow that a linked pair lies in one class or in two
neighbouring ones; a set has the keys of its own class, and those of the one below for smaller partners. What
keys chain together is a cluster; inside it, inverted lists are searched (see toccurrence).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit
from thermolake.llm.components import components
from thermolake.llm.ids import by_ids
from thermolake.llm.superminhash import _bridges, _distinct_sets, _set_batches
from thermolake.llm.toccurrence import joined_components
from thermolake.session import Scratch

_SECOND = np.uint64(0x5851F42D4C957F2D)


def size_classes(most: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first size of each class up to `most`, and for each the parts that its pairs need (with sizes of the next one too)."""
    first = [1]
    while first[-1] <= most:
        first.append(first[-1] * 100 // percent + 1)
    parts = [(h + h * 100 // percent) * (100 - percent) // (100 + percent) + 1 for h in (x - 1 for x in first[1:])]
    return np.array(first[:-1]), np.array(parts, np.int64)


def part_keys(flat: np.ndarray, firsts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of sets of distinct hashes, and the set that each is of."""
    sizes = np.diff(firsts)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts, parts = size_classes(int(sizes.max()), percent)
    own = np.searchsorted(starts, sizes, "right") - 1
    row = np.repeat(np.arange(len(sizes)), sizes)
    value = textkit.mix(flat ^ _SECOND)
    keys, owners = [], []
    for label in (own, own - 1):
        k = np.where((label >= 0) & (sizes > 0), parts[np.maximum(label, 0)], 0)
        base = np.cumsum(k) - k
        in_label = (label >= 0)[row]
        r = row[in_label]
        part = textkit.mix(flat[in_label] + label[r].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        place = base[r] + (part * k[r].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(int(k.sum()), np.uint64)
        np.add.at(total, place, value[in_label])
        owner = np.repeat(np.arange(len(sizes)), k)
        name = label[owner].astype(np.uint64) << np.uint64(32) | (np.arange(len(total)) - base[owner]).astype(np.uint64)
        keys.append(textkit.mix(total + textkit.mix(name + np.uint64(1))))
        owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def _flat_sets(flat: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    sets = list(_distinct_sets(textkit.split_words(flat, offsets), k))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)


def _mark_batches(k: int):
    """What tells sets apart: size, and two sums of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            tokens, firsts = _flat_sets(flat, offsets, k)
            marks = [np.diff(np.append(np.uint64(0), np.cumsum(x))[firsts]).view(np.int64) for x in (tokens, textkit.mix(tokens ^ _SECOND))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(firsts)), *map(pa.array, marks)], names=["doc_id", "n_shingles", "mark_a", "mark_b"])

    return run


def _key_batches(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            keys, owners = part_keys(*_flat_sets(flat, offsets, k), percent)
            yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(owners)), pa.array(keys.view(np.int64))], names=["doc_id", "key"])

    return run


def linked_components(docs: DataFrame, percent: int = 90, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    Documents are linked when 100 * intersection >= percent * union of their sets of k-word shingles (fewer words:
    one shingle of all of them); the join is exact but for equal 64-bit hashes. Null and empty texts have an empty set
    and no links. Rows of one id are one document: repeated rows are copies, and where their texts differ, what is
    linked with one of them is linked with all. A row whose id is null is linked with nothing, and its
    component_id is null. A text of any length is one row of a task's memory. An empty table gives no rows. Other
    columns are not read, so that they may have any name.
    """
    scratch = Scratch(docs.sparkSession, "ngram")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = scratch.table(texts.mapInArrow(textkit.lean(_mark_batches(k)), "doc_id long, n_shingles long, mark_a long, mark_b long"), "sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    marks = ["mark_a", "mark_b", "n_shingles"]
    # copies: the smallest id stands for all
    reps = scratch.table(full.groupBy(*marks).agg(F.min("doc_id").alias("rep")), "reps")
    own = by_ids(scratch, texts, reps.select(F.col("rep").alias("doc_id")), "left_semi", "chosen")
    keyed = own.mapInArrow(textkit.lean(_key_batches(k, percent)), "doc_id long, key long")
    centers = keyed.groupBy("key").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last")).where("center < last").select("key", "center")
    stars = scratch.table(keyed.join(centers, "key").where("doc_id <> center").select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct(), "stars")
    clusters = scratch.table(components(scratch, stars, "cluster"), "clusters")
    chosen = by_ids(scratch, texts, clusters.select(F.col("node").alias("doc_id")), "left_semi", "wanted")
    sets = chosen.mapInArrow(textkit.lean(_set_batches(k)), "doc_id long, members array<long>").withColumn("of", F.xxhash64("members"))
    sets = scratch.table(sets.dropDuplicates(["doc_id", "of"]).drop("of"), "sets")
    bridges = _bridges(scratch, full, reps)
    members = clusters.select(F.col("node").alias("doc_id"), F.col("node").alias("comp"), F.col("component").alias("cluster"))
    comps = joined_components(scratch, members, sets, percent)
    links = bridges if comps is None else bridges.unionByName(comps.toDF("a", "b"))
    last = components(scratch, links, "whole").toDF("rep", "component")
    named = scratch.table(reps.join(last, "rep", "left").select(*marks, F.coalesce("component", "rep").alias("component")), "named")
    scratch.keep("sketch", "named")
    out = sketch.join(named, marks, "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def op13_divide_skip(spark, sf_dir: str) -> DataFrame:
    return linked_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 90, 3)
