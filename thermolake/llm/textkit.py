"""Vectorised word splitting and hashing over Arrow text columns.

A chunk of rows is one byte buffer with row offsets; words are found and hashed with numpy over the
whole chunk, so that the cost per row is a few array calls. Hashes have 64 bits and are a fixed
function of the word's bytes after A-Z are lowered.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20
#: Bytes hashed at once: a worker keeps two powers (16 bytes) for each of them as long as it lives.
HASH_BYTES = 1 << 16

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those that only a longer word needs are not kept."""
    if not _powers or len(_powers[0]) < n:
        p = np.full((2, max(n, HASH_BYTES + 1)), [[_BASE], [_INVERSE]], np.uint64)
        p[:, 0] = 1
        up, down = np.cumprod(p, axis=1, dtype=np.uint64, out=p)
        if n > HASH_BYTES + 1:
            return up, down
        _powers[:] = [up, down]
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the offsets of each; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunked(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about `limit` bytes of text, each with its byte buffer and offsets."""
    for batch in batches:
        flat, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(start, end - start), flat[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
            start = end
    release()


def lean(run):
    """A function over batches that, once it has given its last one, leaves no freed memory behind in its worker."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def release() -> None:
    """Gives freed memory back to the system: a worker outlives its task, and the next stage may not need what this one did."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """starts, ends: byte positions; rows: the first word of each row, and the count of all at the end."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def find_words(flat: np.ndarray, offsets: np.ndarray, space: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~space[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(flat):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte spans in ascending order, from prefix sums over pieces that end between spans."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _power(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_CODE[flat[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def split_words(flat: np.ndarray, offsets: np.ndarray, space: np.ndarray = ASCII_SPACE) -> Words:
    starts, ends, rows = find_words(flat, offsets, space)
    return Words(starts, ends, rows, hash_spans(flat, starts, ends))


def eights(flat: np.ndarray) -> np.ndarray:
    """The eight bytes from each one on, with zeros beyond the last."""
    return np.ndarray(len(flat) + 1, "<u8", np.append(flat, np.zeros(8, np.uint8)), strides=(1,))


def same_spans(a: np.ndarray, starts: np.ndarray, b: np.ndarray, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which spans of one buffer have the same bytes as those of another one; both buffers as `eights`, eight bytes of all spans at once."""
    same = np.ones(len(sizes), bool)
    some, x, y, left = np.arange(len(sizes)), starts, others, sizes
    while len(some):
        unlike = (a[x] ^ b[y]) << (8 * np.maximum(8 - left, 0)).astype(np.uint64)  # what lies beyond a span's end does not count
        same[some[unlike != 0]] = False
        more = (left > 8) & (unlike == 0)
        some, x, y, left = some[more], x[more] + 8, y[more] + 8, left[more] - 8
    return same


def _same_words(low: np.ndarray, words: Words, other: np.ndarray) -> bool:
    """Whether each word has the same bytes as another one."""
    n = words.ends - words.starts
    if (n != n[other]).any():
        return False
    some = np.flatnonzero(words.starts != words.starts[other])
    eight = eights(low)
    return bool(same_spans(eight, words.starts[some], eight, words.starts[other[some]], n[some]).all())


def distinct_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words, np.ndarray] | None:
    """The bytes of all rows with A-Z lowered, the distinct words as spans of them (rows: the first place of each row), and each place's word.

    Words are grouped by 64-bit hashes, in whose order they are given, and every one is compared with its group's first; nothing where two
    words share a hash.
    """
    found = split_words(flat, offsets)
    hashes, example, which = np.unique(found.hashes, return_index=True, return_inverse=True)
    low, which = LOWER[flat], which.reshape(-1)
    if not _same_words(low, found, example[which]):
        return None
    return low, Words(found.starts[example], found.ends[example], found.rows, hashes), which


def distinct_words(flat: np.ndarray, offsets: np.ndarray, exact: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of all rows, each place's word among them, and the first place of each row.

    Words are given with A-Z lowered, or with their bytes as they are (exact). They are told apart as in distinct_spans;
    should two words share a hash, all are told apart without it.
    """
    if exact:
        data = flat.tobytes()
        rows = [data[a:b].split() for a, b in zip(offsets, offsets[1:], strict=False)]
        words = list(set().union(*rows))
        code = {w: i for i, w in enumerate(words)}
        return words, np.array([code[w] for r in rows for w in r], np.int64), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    found = distinct_spans(flat, offsets)
    if found is None:
        return distinct_words(LOWER[flat], offsets, True)
    low, words, which = found
    return span_bytes(low, words.starts, words.ends), which, words.rows


def span_bytes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data = flat.tobytes()
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def spans_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Some words as spans of one buffer: the buffer, starts, ends and hashes."""
    flat, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = np.append(0, ends)[:-1]
    return flat, starts, ends, hash_spans(flat, starts, ends)


def joined_ids(entries: list[bytes], which: np.ndarray, firsts: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows, put together from those of their words by one gather, and where each row's end."""
    sizes = np.array([len(e) for e in entries], np.int64) // kind.itemsize
    return gathered_ids(np.frombuffer(b"".join(entries), kind), np.cumsum(sizes) - sizes, sizes, which, firsts)


def gathered_ids(pool: np.ndarray, at: np.ndarray, sizes: np.ndarray, which: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As joined_ids, of words whose ids lie in a pool from `at` on."""
    n = sizes[which]
    before = np.cumsum(n) - n
    ids = pool[np.repeat(at[which] - before, n) + np.arange(int(n.sum()))]
    return ids, np.append(before, len(ids))[firsts[1:]]


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of k consecutive words from each word on; the last k-1 entries are not there."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * _PLACE[j]
    return mix(total)


def row_shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows and the first of each row; a row of fewer words, but not none, has one of all its words."""
    counts = np.diff(words.rows)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(firsts[-1], np.uint64)
    full = shingle_hashes(words.hashes, k)
    if len(full):
        keep = np.ones(len(full), bool)
        for j in range(1, k):  # those that begin in the last k-1 words of a row reach into the next one
            at = words.rows[1:-1] - j
            at = at[(at >= words.rows[:-2]) & (at < len(full))]
            keep[at] = False
        long = counts >= k
        place = np.ones(len(out), bool)
        place[firsts[:-1][(counts > 0) & ~long]] = False
        out[place] = full[keep]
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        h = words.hashes[words.rows[r] : words.rows[r + 1]]
        out[firsts[r]] = mix(np.array([(h * _PLACE[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64))[0]
    return out, firsts


def long_list(values: np.ndarray, firsts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(values.view(np.int64)))
