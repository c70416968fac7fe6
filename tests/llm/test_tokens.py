import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs as pafs
from tokenizers import Tokenizer

from thermolake.llm import bitpack, textkit, wordbpe

PATH = wordbpe.vocabulary_path()
CODEC = wordbpe.Codec(PATH).remember(1000)
BPE = CODEC.bpe
LIBRARY = Tokenizer.from_file(PATH)
POOL = ["the", "ing", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "É", "é", "ß", "Σ", "İ", "中文", "😀", "12", "½", " ", "　", "ﬁ", "!?", "​", "\x00", "\x1c", "ñ", "한국", "ि", "<|", " ", "\n", "haha", "$$$", "..."]


def wanted(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(POOL), st.text("abcdeghilnorstu ", max_size=12)), max_size=12).map("".join))
def test_encoding_equals_the_library(text):
    assert BPE.encode(text) == wanted(text)
    data = np.frombuffer(text.encode(), np.uint8)
    ids, cuts = CODEC.ids(np.concatenate([data, data]), np.array([0, len(data), len(data), 2 * len(data)]))
    assert ids.tolist() == wanted(text) * 2 and cuts.tolist() == [0, len(ids) // 2, len(ids) // 2, len(ids)]


def test_long_words_take_constant_memory():
    rng = random.Random(1)
    for text in ["a" * 20000, "ha" * 9000, "the" * 5000, "".join(rng.choices("abcdeghilnorst", k=20000)), "!" * 20000]:
        assert BPE.encode(text) == wanted(text)
    most, stream = 0, BPE.stream_word(iter(BPE.word_symbols("ha" * 5000)))
    for _ in stream:
        most = max(most, len(stream.gi_frame.f_locals["last"]) if stream.gi_frame else 0)
    assert most <= 2 * (BPE.lookahead + BPE.window) + 1


def test_tokens_do_not_change_beyond_the_lookahead():
    rng = random.Random(2)
    for _ in range(200):
        word = "".join(rng.choices("abcdeghilnorstu", k=150))
        symbols = BPE.word_symbols(word)
        cut = rng.randrange(BPE.lookahead, 149)
        whole, part = list(BPE.stream_word(symbols)), list(BPE.stream_word(symbols[:cut]))
        at, same = 0, 0
        for a, b in zip(whole, part, strict=False):
            if a != b:
                break
            at += BPE.length[a]
            same += 1
        assert at >= cut - BPE.lookahead


def test_decoding():
    for text in ["the cat's 12 hats !", "naïve café", "日本 😀"]:
        ids = wanted(text)
        for pieces in (CODEC.plain, CODEC.tokens):  # in steps of any size
            whole, machine = wordbpe.TextMachine(pieces), wordbpe.TextMachine(pieces)
            assert whole.push(ids) + whole.finish() == "".join([*(machine.push([i]) for i in ids), machine.finish()])
        machine = wordbpe.TextMachine(CODEC.plain)
        assert BPE.encode(machine.push(ids) + machine.finish()) == ids
        machine = wordbpe.TextMachine(CODEC.tokens)
        assert machine.push(ids) + machine.finish() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_decoder_holds_back_unfinished_characters():
    ids = wanted("😀")
    machine = wordbpe.TextMachine(CODEC.plain)
    out = [machine.push([i]) for i in ids]
    assert "".join(out) + machine.finish() == "😀" and "�" not in "".join(out)


def test_documents_round_trip(docs_of):
    texts = ["The cat", None, "", "  ", "naïve café 😀", "x" * 3000, "<|endoftext|> a"]
    encoded = wordbpe.encode_documents(docs_of(texts), ["doc_id"])
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: wanted(t or "") for i, t in enumerate(texts)}
    decoded = {r.doc_id: r.decoded for r in wordbpe.decode_documents(encoded).collect()}
    assert decoded[0] == "the cat" and decoded[1] == decoded[2] == "" and decoded[4] == "naïve café 😀"
    assert wordbpe.encode_documents(docs_of([]), ["doc_id"]).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, (1 << bits) - 1), max_size=40)), np.uint32)
    assert (bitpack.unpack(bitpack.pack(ids, bits), len(ids), bits) == ids).all()


def test_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 5000, n).astype(np.uint32) for n in (0, 1, 99, 100, 101, 1000, 3)]
    local = pafs.LocalFileSystem()
    with local.open_output_stream(f"{tmp_path}/f") as stream:
        writer = bitpack.Writer(stream, 5000, block_ids=100)
        for i, d in enumerate(docs):
            writer.add(10 * i, d)
        writer.close()
    with local.open_input_file(f"{tmp_path}/f") as f:
        reader = bitpack.Reader(f)
        assert reader.bits == 13 and reader.doc_ids.tolist() == [0, 10, 20, 30, 40, 50, 60]
        assert all((reader.which(i) == d).all() for i, d in enumerate(docs))
        assert (reader.span(150, 420) == np.concatenate(docs)[150:420]).all()


def test_files_of_ids(docs_of, spark):
    texts = ["The cat, the hat.", None, "", "café", "x" * 500, "Uni <|endoftext|> it's", "THE CAT,"] * 3
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in bitpack.read_ids(*bitpack.write_ids(docs_of(texts))).collect()}
    start, want = 0, {}
    for i, t in enumerate(texts):
        ids = [*wanted(t or ""), 1]
        want[i] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert rows == want
    assert bitpack.read_ids(*bitpack.write_ids(docs_of([]))).count() == 0


def test_null_id_comes_first(spark):
    df = spark.createDataFrame([(3, "a"), (None, "b c")], "doc_id long, text string")
    assert {r.doc_id: r.start for r in bitpack.read_ids(*bitpack.write_ids(df)).collect()} == {None: 0, 3: 3}


@pytest.mark.parametrize("text", ["ha, ha!", "<|x", "a<|endoftext|>b", "É.", "x1."])
def test_words_by_the_library(text):
    found = bitpack.WordIds(PATH)
    data = np.frombuffer(text.encode() * 2, np.uint8)
    rows = found.texts(data, np.array([0, len(data) // 2, len(data)]), 1).to_pylist()
    assert [np.frombuffer(r, found.kind).tolist() for r in rows] == [[*wanted(text), 1]] * 2


def test_words_beyond_what_is_remembered(monkeypatch):
    monkeypatch.setattr(bitpack, "REMEMBERED", 6)
    encoder = bitpack.WordIds(PATH)
    for text in ["one two three four five", "six, seven. eight! nine", "one Two <|endoftext|> ten", "É ß one"] * 2:
        data = np.frombuffer(text.encode(), np.uint8)
        ids = np.frombuffer(encoder.texts(data, np.array([0, len(data)]), 1)[0].as_py(), encoder.kind)
        assert ids.tolist() == [*wanted(text), 1]
        assert len(encoder.memory) <= 6
    assert set(encoder.memory) >= {b"one", b"two", b"three", b"four", b"five"}


def test_known_words_are_found_in_arrays(monkeypatch):
    """Words met before are neither encoded nor made into Python objects again; long ones are not kept."""
    encoder, built = bitpack.WordIds(PATH), []
    inner = textkit.span_bytes
    monkeypatch.setattr(textkit, "span_bytes", lambda flat, starts, ends: built.append(len(starts)) or inner(flat, starts, ends))
    for text, new in [("one two, É " + "x" * 70, 4), ("TWO, one é two\n\nx one", 2), ("x two é", 0), ("", 0)]:
        data = np.frombuffer(text.encode(), np.uint8)
        ids = np.frombuffer(encoder.texts(data, np.array([0, len(data)]), 1)[0].as_py(), encoder.kind)
        assert ids.tolist() == [*wanted(text), 1] and sum(built) == new
        built.clear()
    assert set(encoder.memory) == {b"one", b"two", b"two,", b",", "É".encode(), "é".encode(), b"x"}


def test_words_that_share_a_hash_have_their_own_ids(monkeypatch):
    monkeypatch.setattr(textkit, "hash_spans", lambda flat, starts, ends: (ends - starts).astype(np.uint64))
    encoder = bitpack.WordIds(PATH)
    for text in ["one", "two", "one two", "Two six. <|endoftext|> ONE", "three seven", "three. six one"] * 2:
        data = np.frombuffer(text.encode(), np.uint8)
        ids = np.frombuffer(encoder.texts(data, np.array([0, len(data)]), 1)[0].as_py(), encoder.kind)
        assert ids.tolist() == [*wanted(text), 1]
    assert b"one" in set(encoder.memory) and b"two" not in set(encoder.memory)


def test_a_worker_keeps_its_words_between_tasks(spark):
    """What a task gets by value must not hold the encoder's table, else every task begins with an empty one."""
    run = bitpack._encode_batches(PATH, 1, [])

    def sizes(batches):
        for _ in run(batches):
            pass
        yield pa.RecordBatch.from_arrays([pa.array([len(bitpack._tokenizers[PATH].memory) if PATH in bitpack._tokenizers else 0])], names=["n"])

    rows = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string").coalesce(1)
    assert rows.mapInArrow(lambda batches: sizes(batches), "n long").first()[0] >= 3


def test_a_codec_keeps_the_first_words():
    codec = wordbpe.Codec(PATH).remember(6)
    for text in ["one two three four five", "six, seven. eight! nine", "one Two <|endoftext|> ten", "É ß one " + "x" * 70] * 2:
        data = np.frombuffer(text.encode(), np.uint8)
        assert codec.ids(data, np.array([0, len(data)]))[0].tolist() == wanted(text)
        assert max(len(codec.memory), len(codec.words), len(codec.bpe._fits)) <= 6
    assert set(codec.memory) >= {b"one", b"two", b"three", b"four", b"five"}


def test_hashing_keeps_little_in_a_worker():
    """Hashes do not depend on what is hashed at once; long words leave nothing behind."""
    word, long = b"word", b"x" * (3 << 20)
    data = np.frombuffer(b" ".join([word, long, b"y " * (1 << 19), long, word]), np.uint8)
    found = textkit.split_words(data, np.array([0, len(data)]))
    alone = [textkit.split_words(np.frombuffer(w, np.uint8), np.array([0, len(w)])).hashes[0] for w in (word, long, b"y")]
    assert found.hashes[[0, 1, 2, -3, -2, -1]].tolist() == [alone[i] for i in (0, 1, 2, 2, 1, 0)]
    assert sum(p.nbytes for p in textkit._powers) <= 2 << 20
