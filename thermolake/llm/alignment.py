"""Cross-tokenizer alignment: which tokens of one tokenizer cover the same bytes as which of another.

Two token sequences over the same bytes are two ascending arrays of end offsets. Where both have an end, the text
is cut, and what lies between two cuts is a group. Most groups are one token to one token, so that the ends agree
along a diagonal: place i of one array and place i + shift of the other. The diagonal is probed by stretches that
double in length, and by halves where a stretch no longer agrees; one irregular group is then resolved token by
token, which gives a new shift, and probing starts again.

Neither tokenizer has a token across a blank that follows a word, so that a text is encoded and aligned unit by
distinct unit; a text with a unit whose bytes do not come back is encoded and aligned whole. How many documents
hold an id pair is counted over the whole corpus in blocks of text: a block keeps its distinct pairs once, sends
them to be counted, and gets their counts back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit
from thermolake.llm.wordbpe import byte_symbols, vocabulary_path
from thermolake.session import Scratch

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose distinct pairs are kept together; the last text of a block is whole.
BLOCK_BYTES = 16 << 20
#: Distinct units that a worker remembers, the first that it meets; those beyond are forgotten after each chunk.
REMEMBERED = 600_000
#: Blanks before which units are cut: after what no tokenizer takes for white space, and before a word.
_CUT = re.compile(r"(?<=\S) (?=\s*\S)")
#: White space before a blank; where a text has none of it, blanks alone are where units are cut.
_BEFORE_BLANK = [f"{chr(c)} " for c in range(0x3001) if chr(c).isspace()]
_ASCII_BEFORE_BLANK = [x for x in _BEFORE_BLANK if x.isascii()]
#: B ids take so many bits of a pair's number.
_B_BITS = 24


# -- aligning ----------------------------------------------------------------------------------------------
def agreeing(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many ends agree from a[i] and b[j] on, by stretches of doubling length and halves of the last one."""
    most, n, step = min(len(a) - i, len(b) - j), 0, 1
    while n < most:
        step = min(step, most - n)
        if a[i + n : i + n + step] != b[j + n : j + n + step]:
            break
        n += step
        step *= 2
    else:
        return n
    low, high = n, n + step  # agrees up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[i + low : i + middle] == b[j + low : j + middle]:
            low = middle
        else:
            high = middle
    return low


def groups(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """Stretches (i, j, n, m) of end arrays over the same bytes: n one-to-one groups from i and j on (m = 0), or one group of n and m tokens."""
    out, i, j = [], 0, 0
    while i < len(a):
        if a[i] == b[j]:
            n = agreeing(a, b, i, j)
            out.append((i, j, n, 0))
            i, j = i + n, j + n
            continue
        p, q = i, j
        while a[p] != b[q]:
            if a[p] < b[q]:
                p += 1
            else:
                q += 1
        out.append((i, j, p + 1 - i, q + 1 - j))
        i, j = p + 1, q + 1
    return out


@dataclass
class Aligned:
    """Texts aligned one after the other: for each one its counts of tokens and groups, its groups as text, and the pairs of its links (A id << 24 | B id) up to `ends`."""

    counts: np.ndarray
    texts: list[str]
    pairs: np.ndarray
    ends: np.ndarray


def aligned(ids_a: list[list[int]], size_a: np.ndarray, ids_b: list[list[int]], size_b: np.ndarray, decimal: list[str]) -> Aligned:
    """Aligns texts whose ids of both kinds cover the same bytes. They are taken as one run of bytes, which both cut wherever a text ends. decimal: ids as text."""
    n = [np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b)]
    a, b = (np.array(list(chain.from_iterable(ids)), np.int64) for ids in (ids_a, ids_b))
    runs = np.array(groups(np.cumsum(size_a[a]).tolist(), np.cumsum(size_b[b]).tolist()), np.int64).reshape(-1, 4)
    one = runs[:, 3] == 0
    times = np.where(one, runs[:, 2], 1)
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    i, j = (np.repeat(runs[:, k], times) + nth for k in (0, 1))
    wide_a, wide_b = (np.repeat(np.where(one, 1, runs[:, k]), times) for k in (2, 3))
    # every A token of a group with every B token of it
    links = wide_a * wide_b
    group = np.repeat(np.arange(len(links)), links)
    at = np.arange(len(group)) - (np.cumsum(links) - links)[group]
    pairs = a[i[group] + at // wide_b[group]] << _B_BITS | b[j[group] + at % wide_b[group]]
    first = np.searchsorted(i, np.append(0, np.cumsum(n[0])))  # groups before each text
    say_a, say_b = (list(map(decimal.__getitem__, x.tolist())) for x in (a, b))
    words = [f"{say_a[x]}|{say_b[y]}" if p == q == 1 else f"{','.join(say_a[x : x + p])}|{','.join(say_b[y : y + q])}" for x, y, p, q in zip(i.tolist(), j.tolist(), wide_a.tolist(), wide_b.tolist(), strict=True)]
    cuts = first.tolist()
    texts = [";".join(words[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
    return Aligned(np.stack([*n, np.diff(first)], axis=1), texts, pairs, np.append(0, np.cumsum(links))[first])


class Pair:
    """Both tokenizers of a worker, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: i for i, c in enumerate(byte_symbols())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.decimal = list(map(str, range(max(len(self.size_a), len(self.size_b)))))
        #: whether no piece holds a blank after something else, so that units can be encoded one by one
        self.by_units = not any(re.search("[^▁]▁", p) for _, p in pieces)
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts = np.zeros((0, 3), np.int64)
        self.pool = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, Aligned]:
        """Which of the texts, each with a blank before it, come back from both tokenizers byte by byte, and these aligned."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        raw = [b" " + t.encode() for t in texts]
        spell_a, spell_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        fine, all_raw, sizes = np.ones(len(raw), bool), b"".join(raw), np.array([len(r) for r in raw])
        for ids, spell, size in ((a, spell_a, self.size_a), (b, spell_b, self.size_b)):
            # all texts at once, if each one's tokens are as long as it is
            flat = list(chain.from_iterable(ids))
            ends = np.append(0, np.cumsum(size[np.array(flat, np.int64)]))[np.cumsum([len(x) for x in ids])] if flat else np.zeros(len(ids), np.int64)
            if not np.array_equal(ends, np.cumsum(sizes)) or b"".join(map(spell, flat)) != all_raw:
                fine &= np.array([b"".join(map(spell, x)) == r for x, r in zip(ids, raw, strict=True)], bool)
        if not fine.all():
            a, b = ([x for x, f in zip(ids, fine.tolist(), strict=True) if f] for ids in (a, b))
        return fine, aligned(a, self.size_a, b, self.size_b, self.decimal)

    def whole(self, text: str | None) -> Aligned | None:
        """A text's alignment by encoding it whole; none for null and empty ones, and where bytes do not come back."""
        if not text:
            return None
        fine, found = self.encoded([text])
        return found if fine[0] else None

    def units(self, text: str) -> list[str]:
        if not self.by_units:
            return [text]
        odd = any(x in text for x in (_ASCII_BEFORE_BLANK if text.isascii() else _BEFORE_BLANK))
        if odd or text[0] == " " or (text[-1].isspace() and " " in text[len(text.rstrip()) :]):
            return _CUT.split(text)
        return text.split(" ")

    def learn(self, units: set[str]) -> list[str]:
        """Aligns units that are not known, and returns them; one whose bytes do not come back has the place -1."""
        new = [u for u in units if u not in self.known]
        counts, pools, ends = [self.counts], [self.pool], [self.at]
        for start in range(0, len(new), 8192):
            part = new[start : start + 8192]
            fine, found = self.encoded(part)
            places = np.where(fine, len(self.texts) + np.cumsum(fine) - 1, -1)
            self.known.update(zip(part, places.tolist(), strict=True))
            self.texts += found.texts
            counts.append(found.counts)
            pools.append(found.pairs)
            ends.append(ends[-1][-1] + found.ends[1:])
        self.counts, self.pool, self.at = map(np.concatenate, (counts, pools, ends))
        return new

    def forget(self, units: list[str], n: int) -> None:
        """Forgets the units that were learned last, so that n places are left."""
        for u in units:
            del self.known[u]
        del self.texts[n:]
        self.counts, self.pool, self.at = self.counts[:n], self.pool[: self.at[n]], self.at[: n + 1]

    def documents(self, texts: list[str | None]) -> tuple[list[tuple[int, int, int, str]], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, digest) of each text, all their links' pairs, and where those of each text begin and end."""
        split = [self.units(t) if t else [] for t in texts]
        held = len(self.texts)
        new = self.learn(set().union(*split))
        known, facts, links, ends = self.known, [], [], [0]
        for text, units in zip(texts, split, strict=True):
            places = [known[u] for u in units]
            fact, own = (0, 0, 0, ""), np.zeros(0, np.int64)
            if -1 in places:
                if found := self.whole(text):
                    fact, own = (*found.counts[0].tolist(), _digest(found.texts[0])), found.pairs
            elif places:
                where = np.array(places)
                n = self.at[where + 1] - self.at[where]
                before = np.cumsum(n) - n
                own = self.pool[np.repeat(self.at[where] - before, n) + np.arange(int(n.sum()))]
                fact = (*self.counts[where].sum(axis=0).tolist(), _digest(";".join(map(self.texts.__getitem__, places))))
            facts.append(fact)
            links.append(own)
            ends.append(ends[-1] + len(own))
        if len(known) > REMEMBERED:
            self.forget(new, held)
        return facts, np.concatenate(links) if links else np.zeros(0, np.int64), np.array(ends)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_loaded: dict[tuple[str, str], Pair] = {}


def _load(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Pair(path_a, path_b)
    return _loaded[path_a, path_b]


# -- over a corpus -----------------------------------------------------------------------------------------
_DOC = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<int>"
_SEEN = f"{_DOC}, pairs array<long>, holders array<int>"


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones, ascending, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


class _Block:
    """Documents of a run of text, and their pairs by place in the block's own sorted list."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes, self.ids, self.facts, self.sizes, self.pairs, self.times = number, 0, [], [], [], [], []

    def add(self, ids: list, facts: list, links: np.ndarray, ends: np.ndarray) -> None:
        values, code = np.unique(links, return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), np.diff(ends))
        keys, times = _distinct(owner * max(len(values), 1) + code.reshape(-1))
        self.sizes.append(np.bincount(keys // max(len(values), 1), minlength=len(ids)))
        self.pairs.append(values[keys % max(len(values), 1)] if len(keys) else np.zeros(0, np.int64))
        self.times.append(times.astype(np.int32))
        self.ids += ids
        self.facts += [(*f, int(n)) for f, n in zip(facts, np.diff(ends), strict=True)]

    def batches(self) -> Iterator[pa.RecordBatch]:
        pairs, times = np.concatenate(self.pairs), np.concatenate(self.times)
        values, holders = _distinct(pairs)
        at, n = np.searchsorted(values, pairs).astype(np.int32), len(self.ids)
        firsts = np.append(0, np.cumsum(np.concatenate(self.sizes))).astype(np.int64)
        start = 0
        while start < n:  # some thousand documents, or few million pairs, at once
            end = max(start + 1, min(start + 4096, int(np.searchsorted(firsts, firsts[start] + (1 << 20), "right")) - 1))
            end = min(end, n)
            lo, hi, m = firsts[start], firsts[end], end - start
            offsets = pa.array((firsts[start : end + 1] - lo).astype(np.int32))
            facts = self.facts[start:end]
            columns = [pa.array([self.number] * m, pa.int64()), pa.array(self.ids[start:end], pa.int64()), *(pa.array([f[k] for f in facts], pa.int64()) for k in (0, 1, 2, 4)), pa.array([f[3] for f in facts], pa.string())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(x[lo:hi])) for x in (at, times)]
            columns += [pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SEEN.split(", ")])
            start = end
        empty = [pa.nulls(1, t) for t in (*[pa.int64()] * 5, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
        lists = [pa.array([values], pa.list_(pa.int64())), pa.array([holders.astype(np.int32)], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), *empty, *lists], names=[c.split()[0] for c in _SEEN.split(", ")])


def _align_batches(path_a: str, path_b: str):
    """A row for each document, and one for each block with its distinct pairs and how many of its documents hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, number = _load(path_a, path_b), TaskContext.get().partitionId() << 24
        block = _Block(number)
        for piece, flat, _ in textkit.chunked(batches, "text", 1 << 20):
            block.add(piece.column(0).to_pylist(), *tools.documents(piece.column(1).to_pylist()))
            block.bytes += len(flat)
            if block.bytes >= BLOCK_BYTES:
                yield from block.batches()
                number += 1
                block = _Block(number)
        if block.ids:
            yield from block.batches()

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _weigh(key, docs: pa.Table, slice_: pa.Table) -> pa.Table:
    """A block's documents with what their links weigh."""
    order = np.argsort(slice_.column("pair").to_numpy())
    count, best = (slice_.column(c).to_numpy(zero_copy_only=False)[order] for c in ("count", "best"))
    lists = docs.column("at").combine_chunks()
    at, times = lists.flatten().to_numpy(), docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
    ends = np.append(0, np.cumsum(np.diff(lists.offsets.to_numpy())))
    total = lambda v: np.diff(np.append(0, np.cumsum(v))[ends])
    n_best, count_sum = (total(times * best[at]), total(times * count[at])) if len(at) else (np.zeros(docs.num_rows, np.int64),) * 2
    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(out | {"n_best": pa.array(n_best.astype(np.int64)), "count_sum": pa.array(count_sum.astype(np.int64)), "groups_sha256": docs.column("groups_sha256")})


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    A pair's count is how many rows hold it linked; n_best are a document's links whose pair has the highest count
    of its A id, ties included. Null and empty texts, and those whose bytes do not come back from both tokenizers,
    give zeros and an empty digest. Each row is a document: repeated rows, and repeated or null ids, count and are
    given each. A text of any length is one row of a task's memory. An empty table gives no rows. Other columns
    are not read, so that they may have any name.
    """
    scratch = Scratch(docs.sparkSession, "align")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    run = _align_batches(path_a or vocabulary_path(BYTE_VOCABULARY), path_b or vocabulary_path(PIECE_VOCABULARY))
    seen = scratch.table(rows.mapInArrow(textkit.lean(run), _SEEN), "seen")
    held = seen.where("pairs is not null").select("block", F.inline(F.arrays_zip("pairs", "holders"))).toDF("block", "pair", "holders")
    held = scratch.table(held, "held")
    counts = held.groupBy("pair").agg(F.sum("holders").alias("count")).withColumn("a", F.shiftright("pair", _B_BITS))
    counts = scratch.table(counts, "counts")
    # one row for each id of A: no more than its vocabulary has
    top = counts.groupBy("a").agg(F.max("count").alias("most"))
    told = counts.join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = held.select("block", "pair").join(told, "pair")
    found = seen.where("pairs is null").select(*[c.split()[0] for c in _DOC.split(", ")]).groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_weigh, _RESULT)
    return found


def _group_batches(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _load(path_a, path_b)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for piece, _, _ in textkit.chunked(batches, "text", 1 << 20):
            found = []
            for text in piece.column(1).to_pylist():
                whole = tools.whole(text)
                parts = [g.split("|") for g in whole.texts[0].split(";")] if whole else []
                found.append([{"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in parts])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, kind)], names=["doc_id", "groups"])

    return run


def token_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, groups (arrays a and b of ids that cover the same bytes, in order) of every document; no groups where align_documents gives zeros."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    run = _group_batches(path_a or vocabulary_path(BYTE_VOCABULARY), path_b or vocabulary_path(PIECE_VOCABULARY))
    return rows.mapInArrow(textkit.lean(run), "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def op11_diagonal_runs(spark, sf_dir: str) -> DataFrame:
    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
