"""The transducer over merge lists of any kind, and every code point, against the tokenizers library."""

import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from thermolake.llm import textkit, wordbpe

PATH = wordbpe.vocabulary_path()
LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def spec():
    with open(PATH, encoding="utf-8") as f:
        return json.load(f)


def made(spec, folder, merges, letters=LETTERS):
    """A vocabulary of letters, with and without the end of a word, and merges in the order of their ranks."""
    tokens = list(dict.fromkeys([*letters, *(f"{c}</w>" for c in letters), *(a + b for a, b in merges)]))
    body = {**spec, "added_tokens": [], "post_processor": None, "model": {**spec["model"], "unk_token": None, "vocab": {t: i for i, t in enumerate(tokens)}, "merges": [f"{a} {b}" for a, b in merges]}}
    path = f"{folder}/vocabulary.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(body, f)
    return wordbpe.WordBpe(path), Tokenizer.from_file(path)


def agree(bpe, library, words):
    for word, found in zip(words, bpe.encode_words(words), strict=True):
        symbols = bpe.word_symbols(word)
        want = bpe.merge(list(symbols))
        assert want == library.encode(word, add_special_tokens=False).ids
        assert list(bpe.stream_word(iter(symbols))) == want == found


@pytest.mark.parametrize("step", [1, 2, 3])
def test_chains_of_falling_rank(spec, tmp_path, step):
    """The last letters merge first, so that what the first ones do hangs on how long the word is."""
    chain = [(LETTERS[i], LETTERS[i + 1]) for i in range(len(LETTERS) - 1)][::-1]
    bpe, library = made(spec, tmp_path, chain[::step] + chain[1::step] if step > 1 else chain)
    if step == 1:
        assert bpe.lookahead >= 24
    agree(bpe, library, [LETTERS[:n] for n in range(1, 27)] + ["".join(LETTERS[(i * k) % 26] for i in range(700)) for k in (1, 3, 25)] + [LETTERS[a:] * 30 + LETTERS[:b] for a in (0, 1, 2) for b in (0, 3, 8)])


@pytest.mark.parametrize("seed", range(40))
def test_random_merge_lists(spec, tmp_path, seed):
    rng = random.Random(seed)
    letters = LETTERS[: rng.choice([2, 3, 5])]
    tokens, merges = [*letters], []
    for _ in range(rng.choice([3, 8, 25, 60])):
        a, b = rng.choice(tokens), rng.choice(tokens + [f"{c}</w>" for c in letters] * (rng.random() < 0.3))
        if len(a) + len(b) < 12 and (a, b) not in merges and not a.endswith("</w>"):
            merges.append((a, b))
            if a + b not in tokens and not b.endswith("</w>"):
                tokens.append(a + b)
    bpe, library = made(spec, tmp_path, merges, letters)
    words = ["".join(rng.choices(letters, k=rng.choice([1, 2, 5, 20, 60, 400]))) for _ in range(60)]
    words += ["".join(rng.choices(tokens, k=rng.choice([3, 30, 100]))) for _ in range(60)]
    agree(bpe, library, sorted(words))


@pytest.mark.parametrize("seed", range(20))
def test_a_token_beyond_the_lookahead_stays(spec, tmp_path, seed):
    """The lookahead itself, by all ways to go on: what ends so far back is the same in every longer word."""
    rng = random.Random(seed)
    merges = [(LETTERS[i], LETTERS[i + 1]) for i in range(8)]
    rng.shuffle(merges)
    merges += [(a + b, c) for (a, b), c in zip(merges, LETTERS[:9], strict=False)]
    bpe, _ = made(spec, tmp_path, merges, LETTERS[:9])
    for _ in range(60):
        word = bpe.word_symbols("".join(rng.choices(LETTERS[:9], k=40)) + LETTERS[:9] * 4)[:-1]
        n = rng.randrange(bpe.lookahead, len(word))
        short = bpe.merge(list(word[:n]))
        ends = np.cumsum([bpe.spelled[t] for t in short])
        stable = [t for t, e in zip(short, ends, strict=True) if e <= n - bpe.lookahead]
        for more in ([], *[rng.choices(word, k=rng.randint(1, 30)) for _ in range(8)]):
            assert bpe.merge(word[:n] + more)[: len(stable)] == stable


def test_every_code_point(spec):
    """Alone, between letters, and between a digit and signs: letters, digits and lower case are the library's own."""
    bpe, library = wordbpe.WordBpe(PATH), Tokenizer.from_file(PATH)
    for start in range(0, 0x110000, 2048):
        points = [chr(c) for c in range(start, start + 2048) if not 0xD800 <= c < 0xE000]
        if points and (start < 0x34000 or start % 0x10000 == 0 or 0xE0000 <= start < 0xE1000):
            text = " ".join(f"{c} a{c}b 1{c}?!" for c in points)
            assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_words_that_share_a_hash(monkeypatch):
    """With hashes that do not tell words apart, bytes do."""
    data = np.frombuffer(b"one two ONE three two four", np.uint8)
    want = [b"one", b"two", b"one", b"three", b"two", b"four"]
    long = np.frombuffer(b"0123456789abcdeX 0123456789abcdeY 0123456789abcdeX 01234567 01234568", np.uint8)
    monkeypatch.setattr(textkit, "hash_spans", lambda flat, starts, ends: (ends - starts).astype(np.uint64))
    words, which, _ = textkit.distinct_words(long, np.array([0, len(long)]), False)
    assert len(words) == 4 and [words[i] for i in which] == long.tobytes().lower().split()
    monkeypatch.undo()
    for hashed in (textkit.hash_spans, lambda flat, starts, ends: np.zeros(len(starts), np.uint64), lambda flat, starts, ends: (ends - starts).astype(np.uint64)):
        monkeypatch.setattr(textkit, "hash_spans", hashed)
        words, which, firsts = textkit.distinct_words(data, np.array([0, 8, len(data)]), False)
        assert [words[i] for i in which] == want and firsts.tolist() == [0, 2, 6]
