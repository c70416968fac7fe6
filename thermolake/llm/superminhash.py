"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

Every shingle's hash drives a random permutation of the signature's slots. At step j all shingles of a
document write (j + fraction) to the j-th slot of their own permutation, and the document is done once no
slot holds more than j, which for most documents is after one or two steps. Ranks of one shingle in
different slots are a permutation and so correlated, which is what lowers the variance against MinHash.

Texts with the same shingle set are one representative from the start. Representatives that share a band
are compared with the smallest id in that band (a star, not all pairs). What a star leaves in more than
one component goes through an exact second look, in which a cluster's documents are found by what they share
(see toccurrence): all of a small cluster, and of a large one those whose rarest shared shingles allow a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit
from thermolake.llm.components import HUB_EDGES, MOST_HUBS, components
from thermolake.llm.ids import by_ids
from thermolake.llm.toccurrence import joined_components
from thermolake.session import Scratch

#: 32 bands of 4 slots: a pair at 0.8 shares no band with probability (1 - 0.8^4)^32, about 5e-8.
BANDS, BAND_SLOTS = 32, 4
SLOTS = BANDS * BAND_SLOTS
#: Copies of a centre that is compared with many.
COPIES = 32


def superminhash(hashes: np.ndarray, firsts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures of sets of distinct 64-bit hashes; set i lies from firsts[i] to firsts[i + 1]. Empty sets: infinity.

    All sets take their steps together; those that are done leave.
    """
    sets = len(firsts) - 1
    out = np.full(sets * slots, np.inf, np.float32)
    table = out.reshape(sets, slots)
    row = np.repeat(np.arange(sets), np.diff(firsts))
    picks: list[np.ndarray] = []
    order = None
    for j in range(slots):
        if not len(row):
            break
        r = textkit.mix(hashes + np.uint64(((j + 1) * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))
        pick = j + ((r >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        value = j + (r & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(1 / (1 << 24))
        if j == 0:
            slot = pick
        elif j == 1:  # what stood in slot 0 is where the first pick was
            slot = np.where(pick == picks[0], 0, pick)
        else:
            every = np.arange(len(row))
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(row), 1))
                for i, p in enumerate(picks):
                    order[every, p], order[every, i] = order[every, i], order[every, p]
            slot = order[every, pick].astype(np.int64)
            order[every, pick] = order[:, j]
        np.minimum.at(out, row * slots + slot, value.astype(np.float32))
        if j < 2:
            picks.append(pick)
        going = (table.max(axis=1) > j + 1)[row]
        if not going.all():
            hashes, row = hashes[going], row[going]
            picks = [p[going] for p in picks]
            order = None if order is None else order[going]
    return table


def _distinct_sets(words: textkit.Words, k: int) -> Iterator[np.ndarray]:
    shingles, firsts = textkit.row_shingles(words, k)
    for i in range(len(firsts) - 1):
        own = np.sort(shingles[firsts[i] : firsts[i + 1]])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        yield own


_BAND_MIX = np.array([[pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(BAND_SLOTS)]], np.uint64)


def _sketch_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            n = piece.num_rows
            marks = np.zeros((n, 2), np.uint64)
            bands = np.zeros((n, BANDS), np.uint64)
            words = textkit.split_words(flat, offsets)
            sets = list(_distinct_sets(words, k))
            sizes = np.array([len(s) for s in sets], np.int64)
            firsts = np.concatenate([[0], np.cumsum(sizes)])
            flat_sets = np.concatenate(sets)
            some = sizes > 0
            if some.any():
                at = firsts[:-1][some]
                marks[some, 0] = np.add.reduceat(flat_sets, at)
                marks[some, 1] = np.add.reduceat(textkit.mix(flat_sets ^ np.uint64(0x5851F42D4C957F2D)), at)
                bits = superminhash(flat_sets, firsts).view(np.uint32).astype(np.uint64).reshape(n, BANDS, BAND_SLOTS)
                bands = textkit.mix((textkit.mix(bits) * _BAND_MIX).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([piece.column(0).cast(pa.int64()), pa.array(sizes), pa.array(marks[:, 0].view(np.int64)), pa.array(marks[:, 1].view(np.int64)), lists], names=["doc_id", "n_shingles", "mark_a", "mark_b", "bands"])

    return run


def _set_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            sets = list(_distinct_sets(textkit.split_words(flat, offsets), k))
            firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            flat_sets = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([piece.column(0).cast(pa.int64()), textkit.long_list(flat_sets, firsts)], names=["doc_id", "members"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents are linked when 100 * intersection >= percent * union of their sets of k-word shingles
    (fewer words: one shingle of all of them). Null and empty texts have an empty set and no links. Rows
    of one id are one document: repeated rows are copies of each other, and where their texts differ, what is
    linked with one of them is linked with all. A row whose id is null is in no group: its component_id is
    null, it is kept, and it has no say in the groups of the others. A text of any length is one row of a
    task's memory. An empty table gives no rows. Other columns are not read, so that they may have any name.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = scratch.table(texts.mapInArrow(textkit.lean(_sketch_batches(k)), "doc_id long, n_shingles long, mark_a long, mark_b long, bands array<long>"), "sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    # copies: the smallest id stands for all, and brings its bands along
    reps = full.groupBy("mark_a", "mark_b", "n_shingles").agg(F.min(F.struct("doc_id", "bands")).alias("r"))
    reps = scratch.table(reps.select("mark_a", "mark_b", "n_shingles", F.col("r.doc_id").alias("rep"), F.col("r.bands").alias("bands")), "reps")
    banded = reps.select("rep", F.explode("bands").alias("band"))
    centers = banded.groupBy("band").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center < last").select("band", "center")
    stars = scratch.table(banded.join(centers, "band").where("rep <> center").select("center", "rep").distinct(), "stars")

    wanted = scratch.table(stars.select(F.col("rep").alias("doc_id")).union(stars.select(F.col("center").alias("doc_id"))).distinct(), "wanted")
    chosen = by_ids(scratch, texts, wanted, "left_semi", "chosen")
    # one set for each id, or for each text where an id has several
    sets = chosen.mapInArrow(textkit.lean(_set_batches(k)), "doc_id long, members array<long>").withColumn("of", F.xxhash64("members"))
    sets = scratch.table(sets.dropDuplicates(["doc_id", "of"]).drop("of"), "sets")

    of_rep = sets.select(F.col("doc_id").alias("rep"), F.col("members").alias("x"))
    # a centre of many is copied, so that its pairs do not meet in one task; of such centres there are MOST_HUBS at most
    many = max(HUB_EDGES, -(-stars.count() // MOST_HUBS))
    hubs = F.broadcast(stars.groupBy("center").agg(F.count("*").alias("n")).where(F.col("n") >= many).select("center", F.lit(COPIES).alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    of_center = sets.select(F.col("doc_id").alias("center"), F.col("members").alias("y")).join(hubs, "center", "left").select("center", "y", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    spread = stars.join(hubs, "center", "left").select("center", "rep", F.pmod(F.xxhash64("rep"), copies).cast("int").alias("copy"))
    shared = F.size(F.array_intersect("x", "y"))
    pairs = spread.join(of_rep, "rep").join(of_center, ["center", "copy"])
    links = scratch.table(pairs.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct(), "links")

    comps = scratch.table(components(scratch, links.unionByName(_bridges(scratch, full, reps)), "first"), "comps")
    # what follows sees each component as one node
    whole = lambda edges: edges.join(comps.toDF("a", "x"), "a", "left").join(comps.toDF("b", "y"), "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    crossing = scratch.table(whole(stars.toDF("a", "b")).where("a <> b").distinct(), "crossing")
    joined = None
    if crossing.limit(1).count():
        members = wanted.join(comps, wanted["doc_id"] == comps["node"], "left").select("doc_id", F.coalesce("component", "doc_id").alias("comp"))
        clusters = components(scratch, crossing, "cluster").select(F.col("node").alias("comp"), F.col("component").alias("cluster"))
        members = scratch.table(members.join(clusters, "comp"), "members")
        joined = joined_components(scratch, members, sets, percent)
    named = reps.join(comps, reps["rep"] == comps["node"], "left").select("mark_a", "mark_b", "n_shingles", F.coalesce("component", "rep").alias("component"))
    if joined is not None:
        named = named.join(joined.toDF("component", "last"), "component", "left").select("mark_a", "mark_b", "n_shingles", F.coalesce("last", "component").alias("component"))
    named = scratch.table(named, "named")
    scratch.keep("sketch", "named")
    out = sketch.join(named, ["mark_a", "mark_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _bridges(scratch: Scratch, full: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of different texts of one id."""
    marks = ["mark_a", "mark_b", "n_shingles"]
    several = full.groupBy("doc_id").agg(F.min(F.struct(*marks)).alias("x"), F.max(F.struct(*marks)).alias("y")).where("x <> y").select("doc_id")
    several = scratch.table(several, "several")
    if not several.limit(1).count():
        return reps.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    texts = full.join(several, "doc_id", "left_semi").select("doc_id", *marks).distinct().join(reps.select(*marks, "rep"), marks)
    least = texts.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return scratch.table(texts.join(least, "doc_id").select("a", F.col("rep").alias("b")).distinct(), "bridges")


def keep_one(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """One document of each group, with the columns it came with, whatever their names; texts without words all stay, as do rows without an id.

    A document is all rows of its id: see near_duplicates.
    """
    scratch = Scratch(docs.sparkSession, "near")
    gone = near_duplicates(docs, percent, k, scratch=scratch).where("not kept")
    left = by_ids(Scratch(docs.sparkSession, "copies"), docs, gone, "left_anti", "gone")
    scratch.keep()
    return left


def op2_superminhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, 80, 4)
