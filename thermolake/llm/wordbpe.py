"""BPE as a streaming transducer with bounded lookahead, and decoding by an incremental state machine.

The vocabulary is a tokenizers-library BPE file with an end-of-word suffix. A word's byte symbols go in one
by one. For each position the transducer keeps the one token that ends there in the encoding of what was
read so far: a token fits after another if the two, put together, are encoded as just these two. How far the
reader must look beyond a token before it is stable is a property of the merge list, its sufficient lookahead:
tokens that end `lookahead` symbols back are emitted, and no more than twice the lookahead and the longest
token are ever held.

Decoding is a machine that takes ids step by step and holds back what a later id may still change: the bytes of
an unfinished character, and the blank after a word. Texts are encoded word by distinct word of a few
megabytes, and decoded from their ids.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Words, and pairs of tokens, that a worker remembers, the first that it meets. The smaller number is
#: for workers that share an executor with what earlier stages left in its heap.
REMEMBERED = 400_000
REMEMBERED_AMID_STAGES = 50_000
#: Longer words are not remembered.
LONGEST_REMEMBERED = 64
#: Bytes of text encoded at once: the more, the fewer words are looked up twice.
ENCODE_BYTES = 4 << 20
ENCODE_BYTES_AMID_STAGES = 1 << 20
#: Ids that go to a decoder at once.
DECODE_IDS = 1 << 16
_INT = np.dtype("<i4")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies, by its rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[b] = chr(256 + n)
    return out


class WordBpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_text = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            left, right, both = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.pair[left, right] = (rank, both)
            self.parts.setdefault(both, (rank, left, right))
        self.symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(self.symbols)}
        from tokenizers import Tokenizer

        # beyond ASCII it is the library's own tables that say what a letter is, and what its lower case
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.from_symbols = {ord(c): chr(b) for b, c in enumerate(self.symbols)}
        pretokenizers = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(next(p["pattern"]["Regex"] for p in pretokenizers if p["type"] == "Split"))
        self.split_added = regex.compile("(" + "|".join(regex.escape(t) for t in self.added) + ")") if self.added else None
        self._states()
        self._fits: dict[tuple[int, int], bool] = {}
        self.most_pairs = REMEMBERED
        self.window = max(self.length.values())
        self.lookahead = self._sufficient_lookahead()

    # -- the merge list ------------------------------------------------------------------------------
    def _states(self) -> None:
        """Tokens that the merges make, as states that symbols lead through."""
        self.length: dict[int, int] = {}
        spelled: dict[int, tuple[int, ...]] = {}
        for c in self.symbols:
            for text in (c, c + self.suffix) if self.suffix else (c,):
                if text in self.vocab:
                    spelled[self.vocab[text]] = (self.vocab[text],)
        for token, (_, a, b) in sorted(self.parts.items(), key=lambda x: x[1][0]):
            if a in spelled and b in spelled:
                spelled[token] = spelled[a] + spelled[b]
        self.spelled = {t: len(x) for t, x in spelled.items()}
        usable = {}
        for token, symbols in spelled.items():
            if len(symbols) == 1 or self.merge(list(symbols)) == [token]:  # else no text is ever encoded with it
                self.length[token] = len(symbols)
                usable[symbols] = token
        # states: spelled prefixes; ending: the tokens that end in a state, longest first
        self.next: list[dict[int, int]] = [{}]
        self.fail = [0]
        own: list[int | None] = [None]
        for symbols, token in usable.items():
            at = 0
            for s in symbols:
                if s not in self.next[at]:
                    self.next[at][s] = len(self.next)
                    self.next.append({})
                    self.fail.append(0)
                    own.append(None)
                at = self.next[at][s]
            own[at] = token
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.next]
        queue = list(self.next[0].values())
        for at in queue:
            shorter = self.ending[self.fail[at]]
            self.ending[at] = shorter if own[at] is None else [(self.length[own[at]], own[at]), *shorter]
            for s, child in self.next[at].items():
                f = self.fail[at]
                while f and s not in self.next[f]:
                    f = self.fail[f]
                to = self.next[f].get(s, 0)
                self.fail[child] = to if to != child else 0
                queue.append(child)

    def merge(self, symbols: list[int]) -> list[int]:
        """The definition: join the pair of the lowest rank, leftmost first, until none is left."""
        while len(symbols) > 1:
            best = min((self.pair[p] for p in zip(symbols, symbols[1:]) if p in self.pair), default=None)
            if best is None:
                break
            rank, out, i = best[0], [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and self.pair.get((symbols[i], symbols[i + 1]), (-1,))[0] == rank:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def fits(self, left: int, right: int) -> bool:
        """Whether `left` then `right` is how their joint text is encoded.

        The last merges of both sides are undone, latest rank first; if the tokens that touch could have
        merged before the merge undone last, the text would be encoded in another way.
        """
        found = self._fits.get((left, right))
        if found is None:
            a, b, limit, found = left, right, 1 << 60, True
            while True:
                touch = self.pair.get((a, b))
                if touch is not None and touch[0] < limit:
                    found = False
                    break
                pa_, pb = self.parts.get(a) if self.length.get(a, 1) > 1 else None, self.parts.get(b) if self.length.get(b, 1) > 1 else None
                if pa_ is None and pb is None:
                    break
                # undo the later of the two merges; of equal ranks the right one, as merging goes from the left
                if pb is None or (pa_ is not None and pa_[0] > pb[0]):
                    limit, a = pa_[0], pa_[2]
                    if (t := self.pair.get((a, b))) is not None and t[0] < limit:
                        found = False
                        break
                else:
                    limit, b = pb[0] + 1, pb[1]
            if len(self._fits) < self.most_pairs:
                self._fits[left, right] = found
        return found

    def _sufficient_lookahead(self) -> int:
        """Symbols beyond a token's end after which it cannot change any more, whatever follows.

        Whether a merge of `left` and `right` comes about depends on `right`: any token inside it, or `right` itself,
        may be taken before by a merge of lower rank with what touches it on its right, and that one depends in turn
        on its own right side. Ranks along such a chain of touching tokens fall strictly, so that it is followed
        through the merge list in the order of ranks: beyond[t] is how far from the end of t the merges seen so far
        that have t as their left part can depend on what follows, inside[t] the same from the beginning of t for
        all tokens within it. A token stays once no merge that has it, or a token in it, as left part is open.
        """
        beyond: dict[int, int] = {}
        inside: dict[int, int] = {}
        size = {}
        most = 0
        for (a, b), (_, both) in sorted(self.pair.items(), key=lambda x: x[1][0]):
            long_a, long_b = size.setdefault(a, self.spelled.get(a, 1)), size.setdefault(b, self.spelled.get(b, 1))
            reach = max(long_b, inside.get(b, 0), long_b + beyond.get(b, 0))
            within = max(inside.get(a, 0), long_a + beyond.get(a, 0), long_a + reach)
            inside[both] = max(inside.get(both, 0), within)
            beyond[a] = max(beyond.get(a, 0), reach)
            most = max(most, reach)
        return most

    # -- encoding ------------------------------------------------------------------------------------
    def _step(self, at: int, s: int, last: list[int], before: int) -> tuple[int, int]:
        """The state after one more symbol, and the token that ends with it (-2: none). last[i]: the token that ends i symbols after the stable start, where `before` ends."""
        states, fail, tail, known = self.next, self.fail, len(last), self._fits
        while at and s not in states[at]:
            at = fail[at]
        at = states[at].get(s, 0)
        for size, token in self.ending[at]:
            if size > tail:
                continue
            left = last[tail - size] if tail > size else before
            if left == -1 or (left >= 0 and (ok if (ok := known.get((left, token))) is not None else self.fits(left, token))):
                return at, token
        return at, -2

    def stream_word(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of one word's symbols, each as soon as it is stable; keeps a number of positions that does not grow."""
        last, before, at = [-1], -1, 0
        for s in symbols:
            at, found = self._step(at, s, last, before)
            last.append(found)
            if len(last) > 2 * (self.lookahead + self.window):
                stable = self._emit(last)
                yield from stable
                before = stable[-1]
        yield from self._path(last, len(last) - 1)

    def encode_words(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Tokens of each word; what a word shares with the beginning of the one before is not read again, so that sorted words go fast."""
        read, ats, last = [], [0], [-1]
        for word in words:
            symbols = self.word_symbols(word)
            if len(symbols) > self.lookahead + self.window:  # as a stream
                yield list(self.stream_word(symbols))
                continue
            n, most = 0, min(len(symbols), len(read))
            while n < most and symbols[n] == read[n]:
                n += 1
            del ats[n + 1 :], last[n + 1 :]
            at = ats[n]
            for s in symbols[n:]:
                at, found = self._step(at, s, last, -1)
                ats.append(at)
                last.append(found)
            read = symbols
            yield self._path(last, len(last) - 1)

    def _path(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= self.length[last[end]]
        return out[::-1]

    def _emit(self, last: list[int]) -> list[int]:
        """Cuts off and returns the tokens that end `lookahead` symbols back or more: whatever follows, they stay."""
        end = next(i for i in range(len(last) - 1, 0, -1) if last[i] >= 0)
        while end > len(last) - 1 - self.lookahead:
            end -= self.length[last[end]]
        out = self._path(last, end)
        last[: end + 1] = [-1]
        return out

    def word_symbols(self, word: str) -> list[int]:
        chars = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        if self.suffix and chars:
            chars[-1] += self.suffix
        return [self.vocab[c] for c in chars if c in self.vocab]

    def encode_word(self, word: str) -> list[int]:
        return list(self.stream_word(self.word_symbols(word)))

    def text_words(self, text: str) -> Iterator[str | int]:
        """Words of a text after normalisation, and the ids of added tokens as they stand."""
        pieces = self.split_added.split(text) if self.split_added and "<|" in text else (text,)
        for piece in pieces:
            if piece in self.added:
                yield self.added[piece]
            elif piece.isascii():
                yield from self.words.findall(piece.lower())
            elif piece:
                for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece)):
                    yield word.translate(self.from_symbols).encode("latin-1").decode()

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for w in self.text_words(text or ""):
            out.extend([w] if isinstance(w, int) else self.encode_word(w))
        return out

    # -- decoding ------------------------------------------------------------------------------------
    def pieces(self, tokens: bool) -> list[bytes]:
        """What each id adds to a text: its bytes, and a blank after a word; or (tokens) its string and a blank, as the library decodes a file without a decoder."""
        out = [b""] * (max(self.token_text) + 1)
        for i, text in self.token_text.items():
            if tokens:
                out[i] = text.encode() + b" "
            elif i in self.added.values():
                out[i] = text.encode()
            else:
                word = self.suffix and text.endswith(self.suffix)
                out[i] = bytes(self.byte_of[c] for c in (text[: -len(self.suffix)] if word else text)) + (b" " if word else b"")
        return out


class TextMachine:
    """Token ids to text, step by step: holds back the bytes of an unfinished character, and the blank after the last piece."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces, self.utf8, self.blank = pieces, codecs.getincrementaldecoder("utf-8")("replace"), False

    def push(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.pieces.__getitem__, ids))
        if not data:
            return ""
        if self.blank:
            data = b" " + data
        self.blank = data.endswith(b" ")
        return self.utf8.decode(data[:-1] if self.blank else data)

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


def _forget(memory: dict, learned: Iterable[str | int | bytes], most: int) -> None:
    """Of what was just learned, long words go, and all of it that there is no room for: the first words stay for good."""
    for w in learned:
        if len(memory) > most or isinstance(w, str | bytes) and len(w) > LONGEST_REMEMBERED:
            del memory[w]


class Codec:
    """A worker's vocabulary, the words that it remembers, and what ids look like as numbers and as text."""

    def __init__(self, path: str) -> None:
        self.bpe = WordBpe(path)
        self.memory: dict[bytes, bytes] = {}
        self.words: dict[str | int, bytes] = {}

    @cached_property
    def decimal(self) -> list[bytes]:
        return [str(i).encode() for i in range(max(self.bpe.token_text) + 1)]

    @cached_property
    def tokens(self) -> list[bytes]:
        return self.bpe.pieces(True)

    @cached_property
    def plain(self) -> list[bytes]:
        return self.bpe.pieces(False)

    def remember(self, most: int) -> Codec:
        self.most = self.bpe.most_pairs = most
        return self

    def ids(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and where each one's begin, and the last one's end."""
        # an added token may stand inside a word, in its own case
        words, which, firsts = textkit.distinct_words(flat, offsets, b"<|" in flat.tobytes())
        unknown = [w for w in words if w not in self.memory]
        if unknown:
            self._learn(unknown)
        entries = [self.memory[w] for w in words]
        _forget(self.memory, unknown, self.most)
        ids, ends = textkit.joined_ids(entries, which, firsts, _INT)
        return ids, np.append(0, ends)

    def _learn(self, runs: list[bytes]) -> None:
        """Remembers the ids of what stands between two ASCII blanks, which no token crosses, by way of the words in it."""
        parts = [list(self.bpe.text_words(r.decode())) for r in runs]
        new = {w for p in parts for w in p}.difference(self.words)
        texts = sorted(w for w in new if isinstance(w, str))
        self.words.update(zip(texts, (array("i", ids).tobytes() for ids in self.bpe.encode_words(texts)), strict=True))
        self.words.update((i, array("i", [i]).tobytes()) for i in new if isinstance(i, int))
        self.memory.update(zip(runs, (b"".join([self.words[w] for w in p]) for p in parts), strict=True))
        _forget(self.words, new, self.most)

    def decoded_digest(self, ids: list[int]) -> str:
        machine, digest = TextMachine(self.tokens), hashlib.sha256()
        for i in range(0, len(ids), DECODE_IDS):
            digest.update(machine.push(ids[i : i + DECODE_IDS]).encode())
        digest.update(machine.finish().encode())
        return digest.hexdigest()

    def ids_digest(self, ids: list[int]) -> str:
        return hashlib.sha256(b" ".join(map(self.decimal.__getitem__, ids))).hexdigest()


_loaded: dict[str, Codec] = {}


def _load(path: str, most: int = REMEMBERED) -> Codec:
    if path not in _loaded:
        _loaded[path] = Codec(path)
        textkit.release()  # what building took
    return _loaded[path].remember(most)


def _digest_batches(path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _load(path, most)
        for piece, flat, offsets in textkit.chunked(batches, "text", ENCODE_BYTES):
            ids, cuts = codec.ids(flat, offsets)
            ids_hash, text_hash = [], []
            for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                own = ids[a:b].tolist()
                ids_hash.append(codec.ids_digest(own))
                text_hash.append(codec.decoded_digest(own))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(cuts)), pa.array(ids_hash), pa.array(text_hash)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encode_batches(path: str, most: int):
    """All columns but the last, the text, and then: count of tokens, ids, digest of the decoded tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _load(path, most)
        for piece, flat, offsets in textkit.chunked(batches, "text", ENCODE_BYTES_AMID_STAGES):
            ids, cuts = codec.ids(flat, offsets)
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))
            decoded = [codec.decoded_digest(ids[a:b].tolist()) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(np.diff(cuts)), lists, pa.array(decoded)], names=[*piece.schema.names[:-1], "n_tokens", "ids", "decoded_sha256"])

    return run


def _decode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _load(path)
        for batch in batches:
            texts = []
            for ids in batch.column(batch.num_columns - 1):
                machine = TextMachine(codec.plain)
                texts.append(machine.push(ids.as_py() or []) + machine.finish())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "decoded"])

    return run


def encode_documents(docs: DataFrame, keep: list[str], path: str | None = None, text_col: str = "text") -> DataFrame:
    """The columns `keep` (not the text), n_tokens, ids and decoded_sha256 of every document.

    Null and empty texts have no ids. Every row is encoded for itself, so that repeated rows and repeated or
    null ids each give a row; a text of any length is encoded whole. Columns that are not kept may have any
    name. An empty table gives no rows.
    """
    rows = docs.select(*keep, F.col(text_col).alias("text"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(textkit.lean(_encode_batches(path or vocabulary_path(), REMEMBERED_AMID_STAGES)), f"{fields}, n_tokens long, ids array<int>, decoded_sha256 string")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, decoded: lower-case text, words parted by blanks. Null and empty lists give an empty text; every row is decoded for itself."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(textkit.lean(_decode_batches(path or vocabulary_path())), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")


def encode_and_check(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what these decode to, of every document; rows as in encode_documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(textkit.lean(_digest_batches(path or vocabulary_path(), REMEMBERED)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_word_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_and_check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
