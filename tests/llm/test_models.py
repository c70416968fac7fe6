import hashlib
import itertools

import numpy as np
import pytest

from thermolake.llm import hyperlang, linecrf, telephony


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    score, transition, firsts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 1, 5, 9])
    marginal, pairs = linecrf.forward_backward(score, transition, firsts)
    want, want_pairs = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(firsts, firsts[1:], strict=False):
        ways = list(itertools.product((0, 1), repeat=b - a))
        weight = np.array([np.exp(sum(score[a + i] * y for i, y in enumerate(w)) + sum(transition[p, q] for p, q in zip(w, w[1:], strict=False))) for w in ways])
        weight /= weight.sum()
        for w, p in zip(ways, weight, strict=True):
            want[a:b] += p * np.array(w)
            for x, y in zip(w, w[1:], strict=False):
                want_pairs[x, y] += p
    assert marginal == pytest.approx(want) and pairs == pytest.approx(want_pairs)


def test_lines_of_rows():
    data = [b"one line", b"", b"a\nb\n", b"\n\nlast", b""]
    flat = np.frombuffer(b"".join(data), np.uint8)
    features, firsts, size = linecrf.line_features(flat, np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    assert features.shape[1] == linecrf.N_FEATURES
    assert np.diff(firsts).tolist() == [1, 1, 2, 3, 1] and size.sum() == len(flat)


def test_quality(docs_of, spark):
    good = [f"This is line {i} of a plain text.\nIt goes on for some words, number {i * 7}." for i in range(60)]
    bad = [f"BUY{i}!! NOW{i}!! CHEAP!! {'#$% ' * 9}" for i in range(60)]
    texts = [*good, *bad, None, "", "###"]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(texts)
    model = linecrf.train(docs, labels)
    score = {r.doc_id: r.score for r in linecrf.score_documents(docs, model, ["doc_id"]).collect()}
    assert len(score) == len(texts) and all(0 <= s <= 1 for s in score.values())
    assert np.mean([(score[i] >= 0.5) == (i < 60) for i in range(120)]) > 0.95
    kept = linecrf.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(60))


def test_scores_equal_all_label_sequences(docs_of, spark):
    """The whole way from texts to scores, by summing over every way to label a text's lines."""
    texts = ["One line of words.\nBUY!! NOW!! #$%\nand more words, plain ones", "# # #\n\n# # #", None, "", "plain words only here", "A\nb\nA\nb b b\nA", "é ü\n1 2 3 4"]
    rng = np.random.default_rng(6)
    model = linecrf.Model(rng.normal(size=linecrf.N_FEATURES), rng.normal(size=(2, 2)), (0.3, 1.4))
    got = {r.doc_id: r.score for r in linecrf.score_documents(docs_of(texts), model, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        data = np.frombuffer((t or "").encode(), np.uint8)
        features, _, size = linecrf.line_features(data, np.array([0, len(data)]))
        score, n = features @ model.weights, len(features)
        ways = list(itertools.product((0, 1), repeat=n))
        weight = np.array([np.exp(sum(score[k] * y for k, y in enumerate(w)) + sum(model.transition[a, b] for a, b in zip(w, w[1:], strict=False))) for w in ways])
        bad = (weight / weight.sum()) @ np.array(ways)
        share = (bad * np.maximum(size, 1)).sum() / np.maximum(size, 1).sum()
        assert got[i] == pytest.approx(1 / (1 + np.exp(0.3 + 1.4 * np.log(share / (1 - share)))), rel=1e-5)


def test_quality_with_one_label_or_none(docs_of, spark):
    docs = docs_of(["a b", None])
    schema = "doc_id long, quality int"
    assert all(r.score > 0.5 for r in linecrf.score_documents(docs, linecrf.train(docs, spark.createDataFrame([(0, 1)], schema)), ["doc_id"]).collect())
    assert linecrf.score_documents(docs, linecrf.train(docs, spark.createDataFrame([], schema)), ["doc_id"]).count() == 2


def test_code_points():
    text = "aé中😀ß"
    code, rows = hyperlang.code_points(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert code.tolist() == [ord(c) for c in text] and rows.tolist() == [0, 5]


def test_bundle_equals_binding_by_hand():
    vector = lambda place, letter: hyperlang.letter_vectors(np.array([letter]))[place][0].astype(int)
    for text in ("abca", "AbÇa", "中文ab", "ԱբΩЖ", "𐐀𐐨a"):
        total = np.zeros(hyperlang.DIMENSIONS)
        line = [0, *(ord(c.lower()) for c in text), 0]
        for a, b, c in zip(line, line[1:], line[2:], strict=False):
            total += vector(0, a) * vector(1, b) * vector(2, c)
        data = text.encode()
        got = hyperlang.bundle(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
        assert got == pytest.approx(total / np.linalg.norm(total), abs=1e-6)


def test_letters_of_all_scripts_have_vectors_of_their_own():
    letters = np.array([c for c in (*range(97, 123), *range(0x3B1, 0x3C9), *range(0x430, 0x450), *range(0x4E00, 0x4F00), 0x10428)])
    v = hyperlang.letter_vectors(letters)[2].astype(int)
    near = v @ v.T
    np.fill_diagonal(near, 0)
    assert np.abs(near).max() < 0.25 * hyperlang.DIMENSIONS


def test_rows_of_very_many_letters():
    """So many letters that trigrams cannot be numbered in one go."""
    texts = ["".join(chr(0x4E00 + (i * 37 + k * 11) % 20_000) for k in range(40)) for i in range(600)] + ["".join(map(chr, range(0xAC00, 0xD7A4))), "".join(map(chr, range(0x20000, 0x2A6D0)))] + ["a"] * 60_000
    data = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(d) for d in data]))
    flat = np.frombuffer(b"".join(data), np.uint8)
    whole = hyperlang.bundle(flat, offsets)
    for i in (0, 1, 599):
        assert whole[i] == pytest.approx(hyperlang.bundle(np.frombuffer(data[i], np.uint8), np.array([0, len(data[i])]))[0], abs=1e-6)


def test_languages(docs_of, spark):
    en, de = "the weather is good and the water was there with other things", "der wetter ist gut und das wasser war nicht immer mit anderen dingen da"
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(en, "en"), (de, "de"), (en[:30], "en"), (de[:30], "de"), ("anything", None)])]
    model = hyperlang.prototypes(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in hyperlang.identify(docs_of(["the other things", "und das nicht immer", None, "", "12 ?!", "x"]), model).collect()}
    assert found[0][0] == "en" and found[1][0] == "de"
    assert found[2] == found[3] == found[4] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in found.values())
    assert {r.lang_pred for r in hyperlang.identify(docs_of(["a", None]), {}).collect()} == {"und"}


def test_languages_by_hand(docs_of, spark):
    """Profiles, cosines and scores of whole texts, letter by letter."""
    taught = [("der die das und", "de"), ("the and of with", "en"), ("das ist nicht", "de"), ("this is not it", "en"), ("el la los con", "es"), ("12 !", "es")]
    texts = ["die und das", "of the with this", "los con la", "Das, THE and!", "x", None, "7"]
    vector = lambda place, letter: hyperlang.letter_vectors(np.array([letter]))[place][0].astype(int)

    def unit(text):
        total, line = np.zeros(hyperlang.DIMENSIONS), [0, *(ord(c.lower()) if c.isalpha() else 0 for c in text or ""), 0]
        for a, b, c in zip(line, line[1:], line[2:], strict=False):
            total += vector(0, a) * vector(1, b) * vector(2, c) * (b != 0)
        return total / max(np.linalg.norm(total), 1e-9)

    names = ["de", "en", "es"]
    profiles = np.stack([sum(unit(t) for t, lang in taught if lang == name) for name in names])
    profiles /= np.linalg.norm(profiles, axis=1, keepdims=True)
    center = profiles.mean(axis=0)
    apart = (profiles - center) / np.linalg.norm(profiles - center, axis=1, keepdims=True)
    model = hyperlang.prototypes(spark.createDataFrame(taught, "text string, lang string"))
    assert list(model) == names
    for r in hyperlang.identify(docs_of(texts), model).collect():
        u = unit(texts[r.doc_id])
        if not u.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosine = apart @ (u - center) / np.linalg.norm(u - center)
        weight = np.exp(hyperlang.SHARPNESS * (cosine - cosine.max()))
        assert r.lang_pred == names[int(cosine.argmax())] and r.score == pytest.approx(weight.max() / weight.sum(), rel=1e-4)


def test_companding_tables():
    mu, a = telephony.mulaw_table(), telephony.alaw_table()
    assert mu[0x00] == -32124 and mu[0x80] == 32124 and mu[0xFF] == 0 and mu[0x7F] == 0
    assert a[0xD5] == 8 and a[0x55] == -8 and a[0xAA] == 32256 and a[0x2A] == -32256


def test_adpcm_equals_sample_by_sample():
    rng = np.random.default_rng(2)
    blocks = rng.integers(0, 256, (7, telephony.BLOCK)).astype(np.uint8)
    got = telephony.adpcm_blocks(blocks)
    for block, row in zip(blocks, got, strict=True):
        value, index = int(block[:2].view("<i2")[0]), min(int(block[2]), 88)
        want = [value]
        for byte in block[4:]:
            for nibble in (byte & 15, byte >> 4):
                step = int(telephony.STEPS[index])
                change = ((2 * (int(nibble) & 7) + 1) * step) >> 3
                value = max(-32768, min(32767, value - change if nibble & 8 else value + change))
                index = max(0, min(88, index + int(telephony.INDEX_MOVES[nibble])))
                want.append(value)
        assert row.tolist() == want


def test_containers():
    for codec in (telephony.MULAW, telephony.ALAW, telephony.ADPCM):
        payload = bytes(range(192)) * 2
        found, rate, data = telephony.unwav(telephony.wav(payload, codec))
        assert (found, rate, bytes(data)) == (codec, telephony.RATE, payload)
    with pytest.raises(ValueError):
        telephony.unwav(b"nothing")


def test_resampling():
    pcm, firsts = np.array([0, 10, 20, -7, 5], np.int16), np.array([0, 3, 5])
    up, starts = telephony.resample(pcm, firsts, 8000, 16000)
    assert up.tolist() == [0, 5, 10, 15, 20, 20, -7, -1, 5, 5] and starts.tolist() == [0, 6, 10]
    down, starts = telephony.resample(pcm, firsts, 16000, 8000)
    assert down.tolist() == [5, 20, -1] and starts.tolist() == [0, 2, 3]
    other, starts = telephony.resample(pcm, firsts, 8000, 12000)
    assert other.tolist() == [0, 6, 13, 20, 20, -7, 1, 5] and starts.tolist() == [0, 5, 8]


def plain_feature(payload, codec):
    """What a recording's samples sound like, one sample after another."""
    pcm = []
    if codec == telephony.ADPCM:
        for i in range(0, len(payload), 192):
            block = payload[i : i + 192]
            value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
            pcm.append(value)
            for byte in block[4:]:
                for nibble in (byte & 15, byte >> 4):
                    change = ((2 * (nibble & 7) + 1) * int(telephony.STEPS[index])) >> 3
                    value = max(-32768, min(32767, value - change if nibble & 8 else value + change))
                    index = max(0, min(88, index + int(telephony.INDEX_MOVES[nibble])))
                    pcm.append(value)
    else:
        pcm = [int(telephony.TABLES[codec][b]) for b in payload]
    pcm = [(a + b) // 2 for a, b in zip(pcm[::2], pcm[1::2] + pcm[-1:] * (len(pcm) % 2), strict=True)]
    turns = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:], strict=False))
    return f"{telephony.NAMES[codec]}@8000:rms={(sum(x * x for x in pcm) / len(pcm)) ** 0.5:.2f},peak={max(map(abs, pcm))},turns={turns}"


def test_recordings(docs_of):
    texts = ["hello", None, "", "x" * 192, "y" * 193, "hello", "é" * 700, *[f"text {i} " * i for i in range(20)]]
    media = telephony.media_column(docs_of(texts))
    rows = {r.doc_id: r for r in media.collect()}
    found = {r.doc_id: r for r in telephony.features(telephony.resampled(media)).collect()}
    codecs = set()
    for i, t in enumerate(texts):
        data = (t or "").encode()
        codec, rate, payload = telephony.unwav(bytes(rows[i].media))
        codecs.add(codec)
        assert rows[i].n_bytes == len(data) and bytes(payload) == data.ljust(max(192, -(-len(data) // 192) * 192)) and rate == 16000
        assert found[i].feature == plain_feature(bytes(payload), codec)
        assert (found[i].media_bytes, found[i].media_sha256) == (len(rows[i].media), hashlib.sha256(rows[i].media).hexdigest())
    assert codecs == {telephony.MULAW, telephony.ALAW, telephony.ADPCM} and found[0].feature == found[5].feature
    pcm = {r.doc_id: r.pcm for r in telephony.resampled(telephony.media_column(docs_of(texts), telephony.ALAW, 8000), 16000).collect()}
    assert len(pcm[0]) == 4 * 192 and pcm[0] == pcm[5] and len(pcm[4]) == 4 * 384
    assert telephony.media_column(docs_of([])).count() == 0
