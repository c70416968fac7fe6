"""Context-tree weighting over bytes: code lengths from a mixture of Krichevsky-Trofimov estimates at all depths.

Every byte is eight binary decisions, and each decision (a node of the byte's binary tree) has a context
tree of its own over the preceding bytes, DEPTH of them at most. A context's weighted probability is half
its own estimate and half the product over its longer contexts, so the weight of each depth follows from
the counts alone, and the probability of a byte is a fixed function of its DEPTH predecessors.

What is modelled is the sequence of lower-cased words: parted by one blank, ended by a byte that UTF-8 does
not use. Over the cluster:

1. each block of documents (a run of rows of one file) counts its distinct contexts and words;
2. counts are summed over all blocks; contexts that share their three nearest bytes are weighted together, of
   which there are 256^4 rows at most whatever the corpus;
3. what they send is summed by the two nearest bytes and weighted there; the two top levels, at most 65,536 rows,
   are weighted on the driver;
4. each level answers the one below, and the lowest one each block: code lengths of the block's own contexts;
5. documents are scored against the answers to their block.

Rows carry thousands of keys as compressed bytes, since most of the work is to move them. No table of the whole
model is sent anywhere: a task holds its block's slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit
from thermolake.session import Scratch, from_files

DEPTH = 6
END = 0xFF
#: Weighted log probabilities are summed as integers of this unit, so that the order of rows does not matter.
UNIT = 1 << 20
#: Chunks whose distinct keys a task holds before it merges them, and keys that it holds before it sums them.
MERGE_AT, MERGE_ROWS = 6, 1_000_000
#: Bytes of text in a block at about.
BLOCK_BYTES = 32 << 20
#: Context bytes that keys of one task share at least; the levels below are weighted together.
NEAR = 3
#: Kinds of rows, in the order in which a task needs them.
NGRAM, WORD, COUNT, SENT, ASK, CHANCE, DISTINCT, WANTED, WORDS, WANTED_WORDS = range(10)
#: Packed rows: `n` sorted keys and a number, or several, for each. piece tells the parts of one block apart.
ROWS = "kind int, part int, block long, piece long, n int, keys binary, data binary"
COLUMNS = [f.split()[0] for f in ROWS.split(", ")]
_CODEC = pa.Codec("zstd", compression_level=1)


def streams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array, each with `depth` end bytes before it and one after it, and where each begins."""
    gap = bytes([END]) * depth
    parts = [gap + b" ".join(t.lower().split()) + b"\xff" for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def context_keys(stream: np.ndarray, firsts: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte: its predecessors from the nearest on, then the byte itself; and each text's first key."""
    n = len(stream) - depth
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(firsts), np.int64)
    key = np.zeros(n, np.int64)
    for j in range(1, depth + 1):
        key |= stream[depth - j : depth - j + n].astype(np.int64) << np.int64(8 * (depth - j + 1))
    key |= stream[depth:]
    keep = np.ones(n, bool)
    for j in range(depth):  # those whose byte is in the gap before a text
        at = firsts[1:-1] + j - depth
        keep[at[at >= 0]] = False
    return key[keep], firsts - depth * np.arange(len(firsts))


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    low = x < 8
    y = np.where(low, x + 8, x)
    for i in range(8):
        shift += np.where(low, np.log(x + i), 0.0)
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def _level(key: np.ndarray, count: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one decision over sorted (context, byte) keys: each row's node, and the counts of zeros and ones."""
    node = np.concatenate([[0], np.cumsum((key[1:] >> (8 - bit)) != (key[:-1] >> (8 - bit)))])
    one = (key >> (7 - bit)) & 1
    total = np.bincount(node, count)
    ones = np.bincount(node, count * one)
    return node, total - ones, ones


def _rows_by_level(key: np.ndarray, count: np.ndarray, depth: int, top: int) -> list[tuple]:
    """(keys, counts, row in this level of each row of the level before) from `depth` to `top`; the farthest byte goes first."""
    rows = [(key, count, None)]
    for _ in range(depth - top):
        k, c, _ = rows[-1]
        unique, inverse = np.unique(k >> 16 << 8 | (k & 0xFF), return_inverse=True)
        rows.append((unique, np.bincount(inverse, c), inverse))
    return rows


def _path(rows: list[tuple], bit: int, below: np.ndarray | None) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """For each level: estimate of the row's bit, and the weight of ending here.

    below: what longer contexts send to each row's node of the first level, which else is the last of the tree.
    Also gives each top row's node and the nodes' log weighted probabilities.
    """
    key = rows[0][0]
    where = np.arange(len(key))
    path, weighted, heads = [], None, None
    for level, (k, c, inverse) in enumerate(rows):
        node, zeros, ones = _level(k, c, bit)
        own = _log_kt(zeros, ones)
        if level == 0 and below is None:
            weighted, stop = own, np.ones(len(own))
        else:
            if level == 0:
                sent = np.zeros(len(own))
                sent[node] = below
            else:
                sent = np.bincount(node[heads], weighted, len(own))
            weighted = np.log(0.5) + np.logaddexp(own, sent)
            stop = np.exp(np.log(0.5) + own - weighted)
        if level:
            where = inverse[where]
        at = node[where]
        hit = np.where((key >> (7 - bit)) & 1, ones[at], zeros[at])
        seen = (zeros + ones)[at]
        path.append(((hit + 0.5) / (seen + 1), stop[at]))
        if level + 1 < len(rows):
            heads = rows[level + 1][2][np.concatenate([[True], node[1:] != node[:-1]])]
    return path, node, weighted


def _mix(path: list[tuple], p: np.ndarray | float = 0.5) -> np.ndarray:
    """P(bit) at the last level of a path, p being that of the longer contexts; a context never seen says a half."""
    for estimate, stop in path:
        p = stop * estimate + (1 - stop) * p
    return p


def _nodes(key: np.ndarray, bit: int) -> np.ndarray:
    """The node of a row's own context that decides its byte's bit."""
    return key >> 8 << 8 | 1 << bit | (key & 0xFF) >> (8 - bit)


def weigh(key: np.ndarray, count: np.ndarray, below: np.ndarray | None, depth: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(bit) at level `top` of each row's eight decisions; and what its nodes send to the level above: (context, node) keys, log probabilities.

    below: what longer contexts send to each row's nodes; without it, level `depth` is the last.
    """
    rows = _rows_by_level(key, count, depth, top)
    p = np.empty((len(key), 8), np.float32)
    sent_keys, sent = [], []
    for bit in range(8):
        path, node, weighted = _path(rows, bit, None if below is None else below[:, bit])
        p[:, bit] = _mix(path)
        k = rows[-1][0][np.concatenate([[True], node[1:] != node[:-1]])]
        sent_keys.append(k >> 16 << 8 | 1 << bit | (k & 0xFF) >> (8 - bit))
        sent.append(weighted)
    return p, np.concatenate(sent_keys), np.concatenate(sent)


def chances(key: np.ndarray, count: np.ndarray, below: np.ndarray, depth: int, top: int) -> np.ndarray:
    """(row, bit, 2): a and b, where P(bit) at level `top` is a + b * P at the level below `depth`."""
    rows = _rows_by_level(key, count, depth, top)
    out = np.empty((len(key), 8, 2))
    for bit in range(8):
        path, _, _ = _path(rows, bit, below[:, bit])
        out[:, bit, 0] = _mix(path, 0.0)
        out[:, bit, 1] = np.prod([1 - stop for _, stop in path], axis=0)
    return out


def compose(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The chances of the lower rows, seen from the top of the upper ones."""
    a, b = upper[:, :, 0], upper[:, :, 1]
    return np.stack([a + b * lower[:, :, 0], b * lower[:, :, 1]], axis=2)


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return _CODEC.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpack(data: bytes, n: int, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(_CODEC.decompress(data, n * kind.itemsize), np.uint8).reshape(kind.itemsize, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.int64(0)))


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.int64))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=COLUMNS)


def _unbatch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _spread(x: np.ndarray, parts: int) -> np.ndarray:
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _by_part(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Each part's number and its rows of all columns, in their order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]) if len(part) else [0]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(part[a]), *(c[order[a:b]] for c in columns)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, inverse, np.concatenate([p[1] for p in parts]).astype(np.int64))
    return key, total


def _distinct(key: np.ndarray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct keys, and how often the documents that are learned from hold each."""
    unique = np.unique(key)
    taught, times = np.unique(key[learns], return_counts=True)
    count = np.zeros(len(unique), np.int64)
    count[np.searchsorted(unique, taught)] = times
    return unique, count


def _pieces(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple]:
    """For each chunk of one block: its rows (text, block, learns, ...), context keys, first keys, word hashes, first words."""
    for batch in batches:
        block = batch.column(1).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]) if len(block) else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for piece, flat, offsets in textkit.chunked(iter([batch.slice(a, b - a)]), "text"):
                data = flat.tobytes()
                stream, firsts = streams([data[offsets[i] : offsets[i + 1]] for i in range(piece.num_rows)], depth)
                key, key_firsts = context_keys(stream, firsts, depth)
                words = textkit.split_words(flat, offsets)
                yield int(block[a]), piece, key, key_firsts, words.hashes.view(np.int64), words.rows


def _cut_batches(limit: int):
    """Rows (text, learns, doc_id) with the number of their block: a run of a task's rows, of about `limit` bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = held + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first + (ends - sizes) // limit), *batch.columns[1:]], names=["text", "block", "learns", "doc_id"])
            held = int(ends[-1]) if len(ends) else held

    return run


def _count_batches(depth: int, parts: int):
    """Each block's distinct context keys and words, with their counts in what is learned from, by the task that will sum them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, {NGRAM: [], WORD: []}

        def emit():
            piece = uuid.uuid4().int >> 65
            for kind, some in held.items():
                if some:
                    key, count = _merge(some)
                    part = _spread(key >> (8 * (depth - NEAR + 1)) if kind == NGRAM else key, parts)
                    rows = [(kind, p, block, piece, len(k), pack_keys(k), pack(c)) for p, k, c in _by_part(part, key, count)]
                    for i in range(0, len(rows), 256):
                        yield _batch(rows[i : i + 256])
                    some.clear()

        for at, rows, key, key_firsts, words, word_firsts in _pieces(batches, depth):
            if at != block:
                yield from emit()
                block = at
            learns = rows.column(2).to_numpy(zero_copy_only=False)
            held[NGRAM].append(_distinct(key, np.repeat(learns, np.diff(key_firsts))))
            held[WORD].append(_distinct(words, np.repeat(learns, np.diff(word_firsts))))
            for kind in held:
                if len(held[kind]) >= MERGE_AT:
                    held[kind] = [_merge(held[kind])]
        yield from emit()

    return run


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for all of a kind and part of rows sorted by these: its distinct keys and their sums."""
    at, held, size = None, [], 0
    for kind, part, _, _, n, keys, data in _unbatch(batches):
        if (kind, part) != at:
            if held:
                key, total = _merge(held)
                yield _batch([(*at, -1, 0, len(key), pack_keys(key), pack(total))])
            at, held, size = (kind, part), [], 0
        held.append((unpack_keys(keys, n), unpack(data, n, np.int64)))
        size += n
        if len(held) > 1 and size > max(MERGE_ROWS, 2 * len(held[0][0])):
            held = [_merge(held)]
            size = len(held[0][0])
    if held:
        key, total = _merge(held)
        yield _batch([(*at, -1, 0, len(key), pack_keys(key), pack(total))])


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _merge([(key, value)])


def _deep_batches(depth: int, parts: int):
    """From a part's summed keys: counts and sent log probabilities for the level above, and which of its keys the part will ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, _, _, n, keys, data in _unbatch(batches):
            key, count = unpack_keys(keys, n), unpack(data, n, np.int64)
            _, nodes, sent = weigh(key, count, None, depth, NEAR)
            above, total = _sums(key >> (8 * (depth - NEAR + 2)) << 8 | (key & 0xFF), count)
            nodes, sent = _sums(nodes, np.rint(sent * UNIT).astype(np.int64))
            rows = [(COUNT, p, part, 0, len(k), pack_keys(k), pack(c)) for p, k, c in _by_part(_spread(above >> 8, parts), above, total)]
            rows += [(SENT, p, part, 0, len(k), pack_keys(k), pack(c)) for p, k, c in _by_part(_spread(nodes >> 8, parts), nodes, sent)]
            for i in range(0, len(rows), 256):
                yield _batch(rows[i : i + 256])

    return run


def _below(key: np.ndarray, nodes: np.ndarray, sent: np.ndarray) -> np.ndarray:
    """What each row's eight nodes were sent, as log probabilities; 0 where nothing was."""
    out = np.zeros((len(key), 8))
    for bit in range(8 if len(nodes) else 0):
        wanted = _nodes(key, bit)
        at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
        out[:, bit] = np.where(nodes[at] == wanted, sent[at] / UNIT, 0.0)
    return out


def _joint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each part of the middle level: keys, and for each of them its count and what its eight nodes were sent."""
    part_at, held = None, {COUNT: [], SENT: []}

    def out():
        key, count = _merge(held[COUNT])
        nodes, sent = _merge(held[SENT])
        return _batch([(COUNT, part_at, -1, 0, len(key), pack_keys(key), pack(np.concatenate([count[:, None].astype(np.float64), _below(key, nodes, sent)], axis=1)))])

    for kind, part, _, _, n, keys, data in _unbatch(batches):
        if part != part_at:
            if held[COUNT]:
                yield out()
            part_at, held = part, {COUNT: [], SENT: []}
        held[kind].append((unpack_keys(keys, n), unpack(data, n, np.int64)))
        if sum(len(k) for k, _ in held[kind]) > max(MERGE_ROWS, 2 * len(held[kind][0][0])) and len(held[kind]) > 1:
            held[kind] = [_merge(held[kind])]
    if held[COUNT]:
        yield out()


def _middle(n: int, keys: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = unpack(data, 9 * n, np.float64).reshape(n, 9)
    return unpack_keys(keys, n), table[:, 0], table[:, 1:]


def _top_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, value) for the two top levels: counts of (nearest byte, byte) and what its nodes are sent."""
    for _, _, _, _, n, keys, data in _unbatch(batches):
        key, count, below = _middle(n, keys, data)
        _, nodes, sent = weigh(key, count, below, NEAR - 1, NEAR - 1)
        for kind, (k, v) in ((SENT, _sums(nodes, np.rint(sent * UNIT).astype(np.int64))), (COUNT, _sums(key >> 16 << 8 | (key & 0xFF), count))):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(v)], names=["kind", "key", "value"])


def _lookup(key: np.ndarray, table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return table[np.searchsorted(key, wanted)]


def _chance_batches(top_keys: np.ndarray, top: np.ndarray):
    """Answers each asking part with (a, b) of its keys and decisions: P is a + b * P at level NEAR."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, table = None, None
        for kind, _, asking, _, n, keys, data in _unbatch(batches):
            if kind == COUNT:
                key, count, below = _middle(n, keys, data)
                table = chances(key, count, below, NEAR - 1, NEAR - 1)
                table = compose(_lookup(top_keys, top, key >> 16 << 8 | (key & 0xFF)), table).astype(np.float32)
            else:
                wanted = unpack_keys(keys, n)
                yield _batch([(CHANCE, asking, -1, 0, n, keys, pack(_lookup(key, table, wanted)))])

    return run


def _answer_batches(depth: int):
    """For each part of rows sorted by part and kind: log10 P of its keys, handed out to the blocks that hold them; words get their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chance, key, value = None, [], None, None
        for kind, part, block, piece, n, keys, data in _unbatch(batches):
            if part != at:
                at, chance = part, []
            mine = unpack_keys(keys, n)
            if kind == CHANCE:
                chance.append((mine, unpack(data, 16 * n, np.float32).reshape(n, 8, 2)))
            elif kind == DISTINCT:
                order = np.argsort(np.concatenate([c[0] for c in chance]))
                above, table = (np.concatenate([c[i] for c in chance])[order] for i in (0, 1))
                p, _, _ = weigh(mine, unpack(data, n, np.int64), None, depth, NEAR)
                a, b = np.moveaxis(_lookup(above, table, mine >> (8 * (depth - NEAR + 2)) << 8 | (mine & 0xFF)).astype(np.float64), 2, 0)
                key, value = mine, np.log10(a + b * p).sum(axis=1).astype(np.float32)
            elif kind == WORDS:
                key, value = mine, unpack(data, n, np.int64).astype(np.float64)
            else:
                yield _batch([(NGRAM if kind == WANTED else WORD, part, block, piece, n, b"", pack(_lookup(key, value, mine)))])

    return run


class Slice:
    """A block's keys and values with a table of first guesses; what the table misses is searched for."""

    def __init__(self, key: np.ndarray, value: np.ndarray) -> None:
        self.key, first = np.unique(key, return_index=True)
        self.value = value[first]
        self.bits = np.uint64(64 - max(4, (4 * len(self.key)).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.bits)), np.int32)
        self.table[self._slot(self.key)] = np.arange(len(self.key))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        if not len(key):
            return np.zeros(0)
        at = self.table[self._slot(key)]
        missed = np.flatnonzero(self.key[at] != key)
        at[missed] = np.searchsorted(self.key, key[missed])
        return self.value[at].astype(np.float64)


_slices: dict[str, tuple[Slice, Slice]] = {}


def _slice(counted: str, valued: str, block: int) -> tuple[Slice, Slice]:
    where = f"{valued}/block={block}"
    if where not in _slices:
        _slices.clear()

        def read(folder: str, column: str) -> Iterator[dict]:
            files, path = pafs.FileSystem.from_uri(f"{folder}/block={block}")
            yield from pads.dataset(path, filesystem=files, format="parquet").to_table(columns=["kind", "part", "piece", "n", column]).to_pylist()

        keys = {(r["kind"], r["part"], r["piece"]): unpack_keys(r["keys"], r["n"]) for r in read(counted, "keys")}
        found: dict[int, list] = {NGRAM: [(np.zeros(0, np.int64), np.zeros(0, np.float32))], WORD: [(np.zeros(0, np.int64), np.zeros(0))]}
        for r in read(valued, "data"):
            found[r["kind"]].append((keys.pop((r["kind"], r["part"], r["piece"])), unpack(r["data"], r["n"], np.float32 if r["kind"] == NGRAM else np.float64)))
        _slices[where] = tuple(Slice(*(np.concatenate(c) for c in zip(*found[k], strict=True))) for k in (NGRAM, WORD))
    return _slices[where]


def _score_batches(counted: str, valued: str, depth: int, tokens: int, distinct: int, ends: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bottom = np.log10(tokens + 0.1 * (distinct + 1))
        for block, piece, key, key_firsts, words, word_firsts in _pieces(batches, depth):
            ngrams, vocabulary = _slice(counted, valued, block)
            score = np.add.reduceat(ngrams.get(key), key_firsts[:-1])
            count = vocabulary.get(words)
            total = lambda v, word_firsts=word_firsts: (c := np.concatenate([[0.0], np.cumsum(v)]))[word_firsts[1:]] - c[word_firsts[:-1]]
            n = np.diff(word_firsts)
            base = np.array([v.sum() for v in np.split(np.log10(count + 0.1) - bottom, word_firsts[1:-1])]) + np.log10(ends + 0.1) - bottom
            known = np.rint(total(count > 0)).astype(np.int64) + (ends > 0)
            learns = piece.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [piece.column(3), pa.array(~learns), pa.array(n + 1), pa.array(known), pa.array(np.full(len(n), tokens)), pa.array(base), pa.array(score), pa.array(-score / np.log10(2) / np.diff(key_firsts))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
            )

    return run


def _blocks(scratch: Scratch, docs: DataFrame, learns: Column) -> DataFrame:
    """text, block, learns, doc_id: a block is a run of rows of one file, of about BLOCK_BYTES of text.

    A row's place in its parquet file names its block, so that it is the same whenever the files are read. Rows
    that are not from files are written once, with the number of their block.
    """
    taught = F.coalesce(learns, F.lit(False)).alias("learns")
    if not from_files(docs):
        doc_type = docs.schema["doc_id"].dataType.simpleString()
        return scratch.table(docs.select("text", taught, "doc_id").mapInArrow(_cut_batches(BLOCK_BYTES), f"text string, block long, learns boolean, doc_id {doc_type}"), "rows")
    placed = docs.select("text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nth"), taught, "doc_id")
    # rows of a block: as many as give BLOCK_BYTES in the file of the longest texts
    mean = placed.groupBy("file").agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0))).alias("m")).agg(F.max("m")).first()[0]
    run = max(1, int(BLOCK_BYTES / max(1.0, mean or 0.0)))
    return placed.select("text", F.xxhash64("file", F.floor(F.col("nth") / run)).alias("block"), "learns", "doc_id")


def score_corpus(docs: DataFrame, learns: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every document.

    learns: which documents are learned from (null: not). depth: context bytes, NEAR to 6. Scores are log10
    probabilities; base_score is that of the words as single tokens. Null and empty texts are the end alone.
    A text of any length is scored whole, by one task. Every row is scored for itself: repeated rows, repeated
    and null ids each give a row, and rows with equal texts equal scores. An empty table gives no rows. No
    columns but doc_id, text and those of `learns` are read, so that others may have any name.
    """
    if not NEAR <= depth <= 6:
        raise ValueError(f"depth must lie in {NEAR}..6")
    spark = docs.sparkSession
    scratch = Scratch(spark, "ctw")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _blocks(scratch, docs, learns)
    counted, valued = scratch.path("counted"), scratch.path("valued")
    rows.select("text", "block", "learns").mapInArrow(textkit.lean(_count_batches(depth, parts)), ROWS).write.partitionBy("block").option("compression", "uncompressed").parquet(counted)
    held = spark.read.schema(ROWS).parquet(counted).select(*COLUMNS)

    def dealt(df: DataFrame, *order: str) -> DataFrame:
        return df.repartition(parts, "part").sortWithinPartitions("part", *order)

    # sorted by part first, then merged by kind and part
    merged = scratch.table(held.repartition(parts, "part").sortWithinPartitions("part", "kind").mapInArrow(textkit.lean(_merge_batches), ROWS), "merged")
    ngrams, words = merged.where(F.col("kind") == NGRAM), merged.where(F.col("kind") == WORD)
    sent = scratch.table(ngrams.mapInArrow(textkit.lean(_deep_batches(depth, parts)), ROWS), "sent")
    middle = scratch.table(dealt(sent).mapInArrow(textkit.lean(_joint_batches), ROWS), "middle")
    # at most 256 * 256 rows of either kind reach the driver
    tops = middle.mapInArrow(_top_batches, "kind int, key long, value long").groupBy("kind", "key").agg(F.sum("value").alias("value")).collect()
    counts = sorted((r["key"], r["value"]) for r in tops if r["kind"] == COUNT)
    top_keys, top_counts = (np.array([c[i] for c in counts], np.int64) for i in (0, 1))
    nodes = sorted((r["key"], r["value"]) for r in tops if r["kind"] == SENT)
    below = _below(top_keys, *(np.array([c[i] for c in nodes], np.int64) for i in (0, 1)))
    top = chances(top_keys, top_counts, below, 1, 0) if counts else np.zeros((0, 8, 2))

    asked = sent.where(F.col("kind") == COUNT).withColumn("kind", F.lit(ASK))
    chance = dealt(middle.unionByName(asked), "kind").mapInArrow(textkit.lean(_chance_batches(top_keys, top)), ROWS)
    known = lambda df, ngram, word: df.withColumn("kind", F.when(F.col("kind") == NGRAM, ngram).otherwise(word))
    everything = chance.unionByName(known(merged, DISTINCT, WORDS)).unionByName(known(held.withColumn("data", F.lit(b"")), WANTED, WANTED_WORDS))
    answers = dealt(everything, "kind").mapInArrow(textkit.lean(_answer_batches(depth)), ROWS)
    answers.repartition(parts, "block").write.partitionBy("block").option("compression", "uncompressed").parquet(valued)

    scratch.drop("sent")
    scratch.drop("middle")
    size = words.mapInArrow(_word_totals, "total long, known long").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    ends = rows.where("learns").count()
    tokens, distinct = int(size[0]) + ends, int(size[1]) + (ends > 0)
    out = f"doc_id {doc_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return rows.mapInArrow(textkit.lean(_score_batches(counted, valued, depth, tokens, distinct, ends)), out)


def _word_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, _, _, n, _, data in _unbatch(batches):
        count = unpack(data, n, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([int(count.sum())]), pa.array([int((count > 0).sum())])], names=["total", "known"])


def op1_context_tree(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_corpus(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
