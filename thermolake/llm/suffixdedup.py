"""Repeated passages by a sparse suffix array.

Of all word suffixes only those at minimiser positions are kept: the position of the least five-word hash
among any `REACH` neighbours. Which position that is depends on the words alone, so the copies of a passage
keep the same suffixes. Kept suffixes are sorted over the cluster in the order of their words (16 bits of each
of the first eight, then one hash of the others up to the `prefix` that counts) and compared with their
neighbours; those that share the prefix with a neighbour stay.

Matches are then extended to the left and right, to each `width`-word window around such a suffix that its
minimiser stands for. Windows are sorted by a cryptographic digest of their words (128 bits of BLAKE2b, over the
words' bytes themselves) and compared with their neighbours in the same way: what is found to be equal, and so
may be cut, never rests on the hashes that led there. The first of a run of equal windows, in the order of
(document, position), is the passage's first occurrence.

Any window of `width` words has its minimiser among its first REACH positions, and REACH - 1 + prefix words
fit into it, so equal windows always come together: no repeated passage of `width` words or more is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.llm import textkit
from thermolake.llm.ids import by_ids, fresh, row_keys
from thermolake.session import Scratch

WIDTH = 50
SHINGLE = 5
REACH = 20
#: What tells texts apart: the id, and a number where texts share one.
ROW = ["doc_id", "sub"]
PLACE = "doc_id long, sub long, pos int"
#: Bits of the hashes that lead to windows; fewer of them lead to more windows, and to the same results.
BITS = 64


def _anchors(hashes: np.ndarray, rows: np.ndarray, width: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The word positions at which windows of `width` words begin, and each one's minimiser position."""
    shingles = textkit.shingle_hashes(hashes, SHINGLE)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    best, where = shingles[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, reach):
        other = shingles[j : j + n]
        less = other < best
        np.copyto(best, other, where=less)
        where[less] = j
    begin = np.arange(n)
    end = rows[np.searchsorted(rows, begin, "right").clip(max=len(rows) - 1)]
    begin = begin[begin + width <= end]
    return begin, begin + where[begin]


def _four_words(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16 bits of each of four words, so that the numbers' order is the words' one by one."""
    out = np.zeros(len(at), np.uint64)
    for j in range(4):
        out = out << np.uint64(16) | hashes[at + j] >> np.uint64(48)
    return (out ^ np.uint64(1 << 63)).view(np.int64)


def _placed(piece: pa.RecordBatch, words: textkit.Words, at: np.ndarray) -> list[pa.Array]:
    """Keys of the rows that words are in, and the words' positions there."""
    row = np.searchsorted(words.rows, at, "right") - 1
    return [piece.column(0).take(pa.array(row)), piece.column(1).take(pa.array(row)), pa.array((at - words.rows[row]).astype(np.int32))]


def _suffix_batches(width: int, reach: int, bits: int):
    prefix, shift = width - reach + 1, np.int64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            words = textkit.split_words(flat, offsets)
            _, anchor = _anchors(words.hashes, words.rows, width, reach)
            anchor = np.unique(anchor)
            keys = _four_words(words.hashes, anchor), _four_words(words.hashes, anchor + 4), textkit.shingle_hashes(words.hashes, prefix - 8)[anchor + 8].view(np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(k >> shift) for k in keys), *_placed(piece, words, anchor)], names=["k0", "k1", "k2", *ROW, "pos"])

    return run


def _one_blank(flat: np.ndarray, words: textkit.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with A-Z lowered and one blank after each, and where each begins and ends."""
    inside = np.zeros(len(flat) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    low = np.append(np.where(np.cumsum(inside[:-1]) > 0, textkit.LOWER[flat], 0x20), 0x20).astype(np.uint8)
    keep = np.append(np.cumsum(inside[:-1]) > 0, False)
    keep[words.ends] = True  # what stands after a word, be it another row's first byte
    place = np.cumsum(keep) - 1
    return low[keep].tobytes(), place[words.starts], place[words.ends - 1] + 1


def _window_batches(width: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            words = textkit.split_words(flat, offsets)
            begin, anchor = _anchors(words.hashes, words.rows, width, reach)
            kept = np.zeros(len(words.hashes) + 1, bool)
            places = piece.column(3)
            owner = np.repeat(np.arange(piece.num_rows), np.diff(places.offsets.to_numpy()))
            kept[words.rows[owner] + places.flatten().to_numpy()] = True
            begin = begin[kept[anchor]]
            data, starts, ends = _one_blank(flat, words)
            view, digest = memoryview(data), hashlib.blake2b
            found = b"".join([digest(view[a:b], digest_size=16).digest() for a, b in zip(starts[begin].tolist(), ends[begin + width - 1].tolist(), strict=True)])
            keys = np.frombuffer(found, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *_placed(piece, words, begin)], names=["k0", "k1", *ROW, "pos"])

    return run


def _neighbour_batches(n_keys: int):
    """Compares each row of a sorted partition with its neighbours: first of a run, last of a run; the partition's edges are marked.

    Runs of one row are left out, but for edges.
    """
    names = [*[f"k{i}" for i in range(n_keys)], *ROW, "pos", "first", "last", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that has no next one yet: its columns, whether it is first, whether it is an edge

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            first, edge = True, True
            if held is not None:
                columns = [np.append(h, c) for h, c in zip(held[0], columns, strict=True)]
                first, edge = held[1:]
            same = np.ones(len(columns[0]) - 1, bool)
            for k in columns[:n_keys]:
                same &= k[1:] == k[:-1]
            first, last = np.append(first, ~same), np.append(~same, True)
            edge = np.append(edge, np.zeros(len(same), bool))
            keep = edge | ~(first & last)
            keep[-1] = False
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (*columns, first, last, edge)], names=names)
            held = [c[-1:] for c in columns], bool(first[-1]), bool(edge[-1])
        if held is not None:
            yield pa.RecordBatch.from_arrays([*map(pa.array, held[0]), *(pa.array([f]) for f in (held[1], True, True))], names=names)

    return run


def repeated_neighbours(scratch: Scratch, rows: DataFrame, n_keys: int, label: str) -> DataFrame:
    """doc_id, sub, pos, first of the rows (keys k0.., doc_id, sub, pos) whose keys occur more than once.

    Rows are range-partitioned by all columns, so that a key with a third of all rows spreads over
    partitions; only the two outermost rows of each partition meet in one place.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"k{i}" for i in range(n_keys)]
    order = [*keys, *ROW, "pos"]
    ranked = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kinds = ", ".join([*[f"{k} long" for k in keys], PLACE, "first boolean, last boolean, edge boolean"])
    compared = scratch.table(ranked.select(*order).mapInArrow(textkit.lean(_neighbour_batches(n_keys)), kinds), label)
    beside, key = Window.orderBy(*order), F.struct(*keys)  # two rows for each partition
    edges = compared.where("edge").withColumn("first", F.col("first") & ~F.coalesce(F.lag(key).over(beside) == key, F.lit(False))).withColumn("last", F.col("last") & ~F.coalesce(F.lead(key).over(beside) == key, F.lit(False)))
    return compared.where("not edge").unionByName(edges).where("not (first and last)").select(*ROW, "pos", "first")


def _span_batches(width: int):
    """Merges a text's windows, sorted by text and position, into spans; those that hold a first occurrence apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, rows = None, []

        def emit():
            pos, first = (np.concatenate(c) for c in zip(*rows, strict=True))
            cover = np.zeros((2, int(pos[-1]) + width + 1), np.int32)
            for k, some in enumerate((pos, pos[first])):
                np.add.at(cover[k], some, 1)
                np.add.at(cover[k], some + width, -1)
            covered = np.cumsum(cover, axis=1) > 0
            found = []
            for mask in (covered[0], covered[0] & ~covered[1]):
                found.append(np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).reshape(-1, 2))
            both, n = np.concatenate(found).astype(np.int32), sum(map(len, found))
            return pa.RecordBatch.from_arrays([*(pa.array(np.full(n, k)) for k in text), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.repeat([False, True], [len(f) for f in found]))], names=[*ROW, "begin", "end", "later"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, subs, *rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cuts = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]) | (subs[1:] != subs[:-1])) + 1, [len(ids)]])
            for a, b in zip(cuts, cuts[1:], strict=False):
                if (ids[a], subs[a]) != text:
                    if rows:
                        yield emit()
                    text, rows = (ids[a], subs[a]), []
                rows.append([c[a:b] for c in rest])
        if rows:
            yield emit()

    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id, sub, begin, end, later: spans of words (white space parts them, A-Z lowered) that lie in repeated windows.

    Spans with later = false are all that repeats. Spans with later = true are the parts of them that occur
    earlier, in the order of (doc_id, sub, position), and that no first occurrence needs: what a clean-up drops.
    Repeats within a text count. Null, empty and shorter texts have no spans, nor have rows without an id. sub
    tells the texts of one id apart (0 where it has only one); rows equal in id and text count once. Texts
    of any length are looked at whole. Other columns are not read, so that they may have any name; an empty
    table gives no rows. bits: see BITS.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    keyed = row_keys(scratch, texts, "sub")
    return spans_of(scratch, keyed, width, bits)


def spans_of(scratch: Scratch, keyed: DataFrame, width: int, bits: int = BITS) -> DataFrame:
    """repeated_spans of a table doc_id, sub, text with keys by row_keys."""
    again = keyed.where("sub <> 0").dropDuplicates(ROW)
    texts = keyed.where("sub = 0").unionByName(again).select(*ROW, "text")
    suffixes = scratch.table(texts.mapInArrow(textkit.lean(_suffix_batches(width, REACH, bits)), f"k0 long, k1 long, k2 long, {PLACE}"), "suffixes")
    seeds = repeated_neighbours(scratch, suffixes, 3, "compared")
    places = scratch.table(seeds.groupBy(*ROW).agg(F.collect_set("pos").alias("places")), "places")
    scratch.drop("suffixes")
    scratch.drop("compared")
    chosen = by_ids(scratch, texts, places, "left_semi", "chosen", ROW).join(places, ROW).select(*ROW, "text", "places")
    windows = scratch.table(chosen.mapInArrow(textkit.lean(_window_batches(width, REACH)), f"k0 long, k1 long, {PLACE}"), "windows")
    repeated = repeated_neighbours(scratch, windows, 2, "matched")
    scratch.keep("matched")
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return repeated.repartition(parts, *ROW).sortWithinPartitions(*ROW, "pos").mapInArrow(textkit.lean(_span_batches(width)), "doc_id long, sub long, begin int, end int, later boolean")


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        last = batch.num_columns - 1
        texts = []
        for text, spans in zip(batch.column(last - 1).to_pylist(), batch.column(last).to_pylist(), strict=True):
            if spans and text:
                data = text.encode()
                starts, ends, _ = textkit.find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                kept, at = [], 0
                for s in sorted(spans, key=lambda s: s["begin"]):
                    kept.append(data[at : int(starts[s["begin"]])])
                    at = int(ends[s["end"] - 1])
                text = b"".join([*kept, data[at:]]).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns[: last - 1], pa.array(texts, pa.string())], names=[*batch.schema.names[: last - 1], "text"])


def drop_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without their later occurrences of passages, with the columns they came with.

    A text that was nothing else is gone. Rows without an id, and null and empty texts, stay as they are; rows
    equal in id and text are each cut like the first of them; see repeated_spans. Further columns may have any
    name; n_chars, where there is one, follows the text.
    """
    scratch = Scratch(docs.sparkSession, "later")
    sub, spans = fresh(docs, "sub"), fresh(docs, "spans")
    keyed = row_keys(scratch, docs, sub)
    plain = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(sub).alias("sub"), "text").where("doc_id is not null")
    own = Scratch(docs.sparkSession, "suffixes")
    later = spans_of(own, plain, width).where("later").groupBy(*ROW).agg(F.collect_list(F.struct("begin", "end")).alias(spans))
    later = scratch.table(later.withColumnRenamed("sub", sub), "spans")
    own.keep()
    rest = [c for c in docs.columns if c != "text"]
    key = ["doc_id", sub]
    marked = by_ids(scratch, keyed, later, "left_semi", "marked", key).join(later, key).select(*rest, "text", spans)
    cut = marked.mapInArrow(textkit.lean(_cut_batches), docs.select(*rest, "text").schema).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in rest:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    whole = by_ids(scratch, keyed, later, "left_anti", "whole", key).select(*docs.columns)
    return whole.unionByName(cut.select(*docs.columns))


def op3_sparse_suffixes(spark, sf_dir: str) -> DataFrame:
    spans = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    words = F.col("end") - F.col("begin")
    found = spans.groupBy(*ROW).agg(
        F.sum(F.when(~F.col("later"), words).otherwise(0)).cast("long").alias("repeated_words"),
        F.sum(F.when(F.col("later"), words).otherwise(0)).cast("long").alias("later_words"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("later"), F.struct("begin", "end")))), lambda s: F.concat_ws("-", s["begin"], s["end"])), ",").alias("spans"),
    )
    return found.drop("sub")
