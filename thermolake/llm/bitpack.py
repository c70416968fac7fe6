"""Token ids in files of fixed-width bits, with block offsets for random access.

A file holds, in this order: the packed blocks, each of `block_ids` ids (the last one fewer) and beginning
at a byte; the document table (id, ids) as two rows of 64-bit integers; the block offsets from the file's
start; and a footer of 56 bytes with the counts and the magic. Every id takes the fewest bits that the
vocabulary needs, least significant bit first.

Writers name files themselves and report them as rows; only the rows of tasks that succeeded reach the
manifest, so a task that runs twice does no harm.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.llm import textkit
from thermolake.llm.wordbpe import LONGEST_REMEMBERED, vocabulary_path
from thermolake.session import Scratch

MAGIC = b"IDPACK01"
FOOTER = struct.Struct("<QQQQQQ8s")  # bits, ids in a block, documents, ids, where the document table and the offsets begin
BLOCK_IDS = 65536
#: Bytes of text encoded at once: the more, the fewer words are looked up twice.
ENCODE_BYTES = 4 << 20
#: Words whose ids a worker remembers, the first that it meets; those beyond, and long ones, are forgotten after each chunk.
REMEMBERED = 2_500_000
#: Stands for a null document id in files.
NULL_ID = -(1 << 63)


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flags = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(flags.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    return (flags.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    def __init__(self, stream, vocabulary: int, block_ids: int = BLOCK_IDS) -> None:
        self.stream, self.bits, self.block_ids = stream, bits_for(vocabulary), block_ids
        self.at, self.offsets, self.docs, self.held, self.n_held, self.n_ids = 0, [], [], [], 0, 0

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint16)
        cut = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for i in range(0, cut, self.block_ids):
            self.offsets.append(self.at)
            self._put(pack(ids[i : min(i + self.block_ids, cut)], self.bits))
        self.held, self.n_held = [ids[cut:]], len(ids) - cut

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block_ids:
            self._blocks(last=False)

    def close(self) -> None:
        self._blocks(last=True)
        docs_at = self.at
        self._put(np.array(self.docs, "<i8").reshape(-1, 2).T.tobytes())
        offsets_at = self.at
        self._put(np.array(self.offsets, "<u8").tobytes())
        self._put(FOOTER.pack(self.bits, self.block_ids, len(self.docs), self.n_ids, docs_at, offsets_at, MAGIC))


class Reader:
    """Random access to one file: which(i) gives document i's ids, span(a, b) those from a to b."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        self.bits, self.block_ids, self.n_docs, self.n_ids, docs_at, offsets_at, magic = FOOTER.unpack(self._get(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        table = np.frombuffer(self._get(docs_at, 16 * self.n_docs), "<i8").reshape(2, self.n_docs)
        self.doc_ids, self.lengths = table[0], table[1]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        n_blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.append(np.frombuffer(self._get(offsets_at, 8 * n_blocks), "<u8").astype(np.int64), docs_at)

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def span(self, a: int, b: int) -> np.ndarray:
        if b <= a:
            return np.zeros(0, np.uint32)
        first, last = a // self.block_ids, (b - 1) // self.block_ids
        data = self._get(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        parts, at = [], 0
        for k in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - k * self.block_ids)
            size = int(self.offsets[k + 1] - self.offsets[k])
            parts.append(unpack(data[at : at + size], n, self.bits))
            at += size
        return np.concatenate(parts)[a - first * self.block_ids : b - first * self.block_ids]

    def which(self, i: int) -> np.ndarray:
        return self.span(int(self.starts[i]), int(self.starts[i + 1]))


_tokenizers: dict[str, WordIds] = {}
#: ASCII marks at a word's end after a letter; the tokenizer's pattern always parts the two.
END_MARKS = b".,!?;:|#$%&*"


class Memory:
    """Words and their ids in arrays: found by 64-bit hashes of the words, and compared byte by byte."""

    def __init__(self, kind: np.dtype) -> None:
        self.hashes, self.nth = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # in the order of hashes: which word it is
        self.text_at, self.ids_at = np.zeros(1, np.int64), np.zeros(1, np.int64)  # in the order of words, and the end of the last
        self.eight, self.ids = textkit.eights(np.zeros(0, np.uint8)), np.zeros(0, kind)

    def __len__(self) -> int:
        return len(self.hashes)

    def __iter__(self) -> Iterator[bytes]:
        return iter(textkit.span_bytes(self.eight.astype(np.uint8), self.text_at[:-1], self.text_at[1:]))

    def find(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which word each span is, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
            nth, size = self.nth[at], ends - starts
            some = np.flatnonzero((self.hashes[at] == hashes) & (size == self.text_at[nth + 1] - self.text_at[nth]))
            same = textkit.same_spans(textkit.eights(flat), starts[some], self.eight, self.text_at[nth[some]], size[some])
            out[some[same]] = nth[some[same]]
        return out

    def add(self, words: list[bytes], hashes: np.ndarray, entries: list[bytes], most: int) -> None:
        """Keeps words that it lacks, as far as there is room; of those that share a hash the first."""
        if len(self) >= most:
            return
        short = np.flatnonzero(np.fromiter((len(w) <= LONGEST_REMEMBERED for w in words), bool, len(words)))
        found, first = np.unique(hashes[short], return_index=True)
        if len(self):
            first = first[self.hashes[np.minimum(np.searchsorted(self.hashes, found), len(self) - 1)] != found]
        kept = np.sort(short[first])[: most - len(self)]
        if not len(kept):
            return
        own, new = hashes[kept], [words[i] for i in kept.tolist()]
        ids = [entries[i] for i in kept.tolist()]
        order = np.argsort(own)
        at = np.searchsorted(self.hashes, own[order])
        self.nth = np.insert(self.nth, at, (len(self) + order).astype(np.int32))
        self.hashes = np.insert(self.hashes, at, own[order])
        self.text_at = np.append(self.text_at, self.text_at[-1] + np.cumsum([len(w) for w in new]))
        self.ids_at = np.append(self.ids_at, self.ids_at[-1] + np.cumsum([len(e) for e in ids]) // self.ids.itemsize)
        self.ids = np.append(self.ids, np.frombuffer(b"".join(ids), self.ids.dtype))
        self.eight = textkit.eights(np.append(self.eight[:-1].astype(np.uint8), np.frombuffer(b"".join(new), np.uint8)))


class WordIds:
    """Ids of words by the tokenizers library, as bytes; words that come again are remembered.

    Words between ASCII blanks are encoded on their own, since no token crosses a blank. Unknown ones go to
    the library together, parted by a special token. Where the file's pattern parts letters from marks,
    marks at a word's end are words of their own, and lower-case Latin words, which normalisation and
    pattern leave as they are, skip these two steps.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.part = special[0] if special else None
        self.marks = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.memory = Memory(self.kind)
        self.plain = self._without_steps(path)

    @staticmethod
    def _without_steps(path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [c.get("type") for c in cuts] != ["Split", "ByteLevel"] or r"|[\p{L}]+|" not in cuts[0]["pattern"].get("Regex", ""):
            return None
        bare = Tokenizer.from_file(path)
        bare.no_padding()
        bare.no_truncation()
        bare.normalizer = None
        bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return bare

    def _learn(self, words: set[bytes], marked: bool) -> dict[bytes, bytes]:
        apart = {w for w in words if not self.part or any(m in w for m in self.marks)} if marked or not self.part else set()
        simple, other = [], []
        for w in words.difference(apart):
            (simple if self.plain and (w.isalpha() and w.islower() or _latin(w.decode())) else other).append(w)
        found: dict[bytes, bytes] = {}
        for tokenizer, some in ((self.plain, simple), (self.tokenizer, other)):
            for start in range(0, len(some), 2000):
                self._learn_joined(tokenizer, some[start : start + 2000], found)
        for w in apart:
            found[w] = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, self.kind).tobytes()
        return found

    def _learn_joined(self, tokenizer, words: list[bytes], into: dict[bytes, bytes]) -> None:
        found = tokenizer.encode_batch_fast([self.part[1].encode().join(words).decode()], add_special_tokens=False)
        ids = np.array(found[0].ids, np.uint32)
        at = np.flatnonzero(ids == self.part[0])
        data, size = ids.astype(self.kind).tobytes(), self.kind.itemsize
        for w, a, b in zip(words, (np.append(0, at + 1) * size).tolist(), (np.append(at, len(ids)) * size).tolist(), strict=True):
            into[w] = data[a:b]

    def _unknown(self, unknown: list[bytes], hashes: np.ndarray, marked: bool) -> list[bytes]:
        """The ids of words that the memory lacks, which gets them and what they are put together from."""
        ends = {}
        for w in unknown if self.plain else ():
            if not 97 <= w[-1] <= 122:
                head = w.rstrip(END_MARKS)
                if len(head) < len(w) and head and 97 <= head[-1] <= 122:
                    ends[w] = (head, w[len(head) :])
        parts = list(set().union(*ends.values()).difference(unknown))
        spans = textkit.spans_of(parts)
        held = self.memory.find(*spans)
        known, pool = np.flatnonzero(held >= 0), self.memory.ids
        at, to = self.memory.ids_at[held[known]].tolist(), self.memory.ids_at[held[known] + 1].tolist()
        learned = {parts[i]: pool[a:b].tobytes() for i, a, b in zip(known.tolist(), at, to, strict=True)}
        learned |= self._learn(set(unknown).difference(ends).union(*ends.values()).difference(learned), marked)
        for w, (head, tail) in ends.items():
            learned[w] = learned[head] + learned[tail]
        found = [learned[w] for w in unknown]
        self.memory.add([*unknown, *parts], np.append(hashes, spans[3]), [*found, *map(learned.__getitem__, parts)], REMEMBERED)
        return found

    def texts(self, flat: np.ndarray, offsets: np.ndarray, end_id: int) -> pa.Array:
        """The ids of each text and `end_id` after them, as bytes.

        Words are told apart by 64-bit hashes and compared byte by byte; each distinct one is looked up once, and texts
        are put together from them by one gather.
        """
        data = flat.tobytes()
        marked = any(m[:2] in data for m in self.marks)  # an added token may stand inside a word, in its own case
        spans = None if marked else textkit.distinct_spans(flat, offsets)
        if spans is None:
            words, which, firsts = textkit.distinct_words(flat if marked else textkit.LOWER[flat], offsets, True)
            low, starts, ends, hashes = textkit.spans_of([w if any(m[:2] in w for m in self.marks) else w.lower() for w in words])
        else:
            low, distinct, which = spans
            starts, ends, hashes, firsts = distinct.starts, distinct.ends, distinct.hashes, distinct.rows
        held = self.memory.find(low, starts, ends, hashes)
        pool, known, new = self.memory.ids, self.memory.ids_at, np.flatnonzero(held < 0)
        entries = [*(self._unknown(textkit.span_bytes(low, starts[new], ends[new]), hashes[new], marked) if len(new) else ()), np.array([end_id], self.kind).tobytes()]
        own = np.array([len(e) for e in entries], np.int64) // self.kind.itemsize
        # where each word's ids lie: in the memory, or behind it; last the end id
        at, sizes = np.append(known[held], 0), np.append(known[np.minimum(held + 1, len(known) - 1)] - known[held], 0)
        behind = np.append(new, len(held))
        at[behind], sizes[behind] = len(pool) + np.cumsum(own) - own, own
        pool = np.concatenate([pool, np.frombuffer(b"".join(entries), self.kind)])
        after = firsts[1:] + np.arange(1, len(firsts))  # with an end after each row
        ids, cuts = textkit.gathered_ids(pool, at, sizes, np.insert(which, firsts[1:], len(held)), np.append(0, after))
        cuts = np.append(0, cuts) * self.kind.itemsize
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids.tobytes())])


def _latin(word: str) -> bool:
    """Lower-case letters that normalisation leaves alone and the pattern keeps together."""
    return word.isalpha() and max(word) < "\u0250" and word == word.lower()


def _load(path: str) -> WordIds:
    """A worker's own encoder: a function of the module, since one inside another takes copies of the module's tables along to each task."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def _encode_batches(path: str, end_id: int, bounds: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _load(path)
        cuts = np.array(bounds, np.int64)
        for piece, flat, offsets in textkit.chunked(batches, "text", ENCODE_BYTES):
            ids = encoder.texts(flat, offsets, end_id)
            doc_ids = piece.column(0).cast(pa.int64()).fill_null(NULL_ID)
            part = np.searchsorted(cuts, doc_ids.to_numpy(zero_copy_only=False), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), doc_ids, ids], names=["part", "doc_id", "ids"])

    return run


def _write_batches(folder: str, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
        part, writer, stream, path, done = None, None, None, "", []

        def finish():
            writer.close()
            stream.close()
            done.append((part, path, len(writer.docs), writer.n_ids))

        for batch in batches:
            for p, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if p != part:
                    if writer is not None:
                        finish()
                    part = p
                    path = f"{root}/ids-{p:06d}-{TaskContext.get().attemptNumber()}-{uuid.uuid4().hex}.idpack"
                    stream = files.open_output_stream(path)
                    writer = Writer(stream, vocabulary)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), kind))
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.int64()), pa.array([d[3] for d in done], pa.int64())], names=["part", "path", "n_docs", "n_ids"])

    return run


def _read_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.open_input_file(path) as f:
                    reader = Reader(f)
                    i = 0
                    while i < reader.n_docs:  # some blocks at once, at least one document
                        j = max(i + 1, int(np.searchsorted(reader.starts, reader.starts[i] + 16 * reader.block_ids, "right")) - 1)
                        ids = reader.span(int(reader.starts[i]), int(reader.starts[j]))
                        at = reader.starts[i : j + 1] - reader.starts[i]
                        crc = [zlib.crc32(ids[at[k] : at[k + 1]].astype("<u4").data) for k in range(j - i)]
                        doc_ids = reader.doc_ids[i:j]
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(base + reader.starts[i:j]), pa.array(reader.lengths[i:j]), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        i = j

    return run


def write_ids(docs: DataFrame, path: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Writes the ids of all documents in ascending order of id; gives the manifest (part, path, n_docs, n_ids) and the folder.

    Null and empty texts have the end id alone. Null document ids come first. Rows of one id stay next to each
    other, in any order, and all of them are written. A text of any length is written whole. Other columns are not
    read, so that they may have any name. An empty table gives no files.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    scratch = Scratch(spark, "bitpack")
    path = path or vocabulary_path()
    vocabulary = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # as many cut points as there are files, from the ids alone: texts are read and encoded once
    quantiles = rows.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20 * parts)).first()[0] or []
    encoded = rows.mapInArrow(textkit.lean(_encode_batches(path, end_id, sorted(set(quantiles)))), "part int, doc_id long, ids binary")
    ordered = encoded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id")
    folder = scratch.path("files")
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jvm_path)
    manifest = scratch.table(ordered.mapInArrow(_write_batches(folder, vocabulary), "part int, path string, n_docs long, n_ids long"), "manifest")
    return manifest, folder


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartition(parts).mapInArrow(_read_batches(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_bit_packing(spark, sf_dir: str) -> DataFrame:
    return read_ids(*write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet")))
