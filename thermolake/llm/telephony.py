"""Telephony audio columns: mu-law, A-law and IMA ADPCM payloads in WAV containers, decoded with numpy.

Companded bytes are expanded by 256-entry tables; ADPCM is decoded one nibble position at a time across
all blocks of a chunk of rows. PCM is brought to the rate wanted in integers, by means of whole numbers of
samples or by linear interpolation, so that equal payloads give equal samples wherever they are decoded, and
stored in a column of its own.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit
from thermolake.session import Scratch

BLOCK = 192
#: Samples a second in recordings, and in the PCM that is kept of them.
RATE, PCM_RATE = 16000, 8000
MULAW, ALAW, ADPCM = 7, 6, 17
NAMES = {MULAW: "mulaw", ALAW: "alaw", ADPCM: "adpcm"}
#: zstd level of the stored tables.
LEVEL = 12

# Quantiser steps of IMA ADPCM.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143,
    157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552,
    1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487,
    12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
# How a nibble moves the step index in IMA ADPCM.
INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8, -1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code & 0x70) >> 4)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    segment, low = (code & 0x70) >> 4, (code & 0x0F) << 4
    size = np.where(segment == 0, low + 8, (low + 0x108) << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


TABLES = {MULAW: mulaw_table(), ALAW: alaw_table()}


def adpcm_blocks(blocks: np.ndarray) -> np.ndarray:
    """Samples of IMA ADPCM blocks (rows of bytes): the header's predictor, then two samples a byte."""
    head = np.ascontiguousarray(blocks[:, :4])
    value = head[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(head[:, 2], 88).astype(np.int32)
    body = blocks[:, 4:]
    out = np.empty((1 + 2 * body.shape[1], len(blocks)), np.int16)
    out[0] = value
    columns = np.ascontiguousarray(body.T)
    for i in range(len(columns)):
        for half in (0, 1):
            nibble = (columns[i] >> 4) if half else (columns[i] & 15)
            step = STEPS[index]
            change = ((2 * (nibble & 7).astype(np.int32) + 1) * step) >> 3
            value = np.clip(np.where(nibble & 8, value - change, value + change), -32768, 32767)
            index = np.clip(index + INDEX_MOVES[nibble], 0, 88)
            out[1 + 2 * i + half] = value
    return np.ascontiguousarray(out.T)


def resample(pcm: np.ndarray, firsts: np.ndarray, rate: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples of all rows at another rate, and each row's first. Whole factors down are means; else neighbours are interpolated, the last one with itself."""
    if rate == to:
        return pcm, firsts
    sizes = np.diff(firsts)
    new = -(-sizes * to // rate)
    starts = np.concatenate([[0], np.cumsum(new)])
    nth = np.arange(starts[-1]) - np.repeat(starts[:-1], new)
    base, last = np.repeat(firsts[:-1], new), np.repeat(firsts[1:] - 1, new)
    if rate % to == 0:
        total = np.zeros(len(nth), np.int64)
        for j in range(rate // to):  # the last sample stands for those that a row lacks
            total += pcm[np.minimum(base + nth * (rate // to) + j, last)]
        return (total // (rate // to)).astype(np.int16), starts
    at, part = np.divmod(nth * rate, to)
    left = np.minimum(base + at, last)
    mixed = pcm[left].astype(np.int64) * (to - part) + pcm[np.minimum(left + 1, last)].astype(np.int64) * part
    return (mixed // to).astype(np.int16), starts


def wav(payload: bytes, codec: int = MULAW, rate: int = RATE) -> bytes:
    """A WAV container around 8-bit companded samples or 192-byte ADPCM blocks."""
    samples = len(payload) if codec != ADPCM else len(payload) // BLOCK * (1 + 2 * (BLOCK - 4))
    extra = struct.pack("<HH", 2, 1 + 2 * (BLOCK - 4)) if codec == ADPCM else struct.pack("<H", 0)
    align, bits, pace = (BLOCK, 4, rate * BLOCK // (1 + 2 * (BLOCK - 4))) if codec == ADPCM else (1, 8, rate)
    fmt = struct.pack("<HHIIHH", codec, 1, rate, pace, align, bits) + extra
    chunks = b"".join(name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2) for name, data in ((b"fmt ", fmt), (b"fact", struct.pack("<I", samples)), (b"data", payload)))
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def unwav(media: bytes) -> tuple[int, int, memoryview]:
    """Codec, rate and payload of a WAV container."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV container")
    view, at, codec, rate = memoryview(media), 12, 0, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            codec, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data":
            return codec, rate, view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data in the container")


def pad(data: bytes, block: int = BLOCK) -> bytes:
    return data.ljust(max(block, -(-len(data) // block) * block), b" ")


def codec_of(payload: bytes) -> int:
    """The codec that a payload is taken to be in, where none is asked for: each of the three for a third of all texts."""
    return (MULAW, ALAW, ADPCM)[zlib.crc32(payload) % 3]


def _store_batches(codec: int | None, rate: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, flat, offsets in textkit.chunked(batches, "text"):
            data = flat.tobytes()
            payloads = [pad(data[offsets[i] : offsets[i + 1]]) for i in range(piece.num_rows)]
            media = [wav(p, codec or codec_of(p), rate) for p in payloads]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return run


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[int], list[int], list[memoryview]]]:
    """For about a megabyte of recordings at a time: rows, media, codecs, rates, payloads."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held, size, start = [], 0, at
            while at < batch.num_rows and (not held or size < textkit.CHUNK_BYTES):
                media = batch.column(2)[at].as_py()
                held.append((media, *unwav(media)))
                size += len(media)
                at += 1
            yield batch.slice(start, at - start), *map(list, zip(*held, strict=True))


def decode(payloads: list[memoryview], codecs: list[int], rates: list[int], to: int) -> list[bytes]:
    """16-bit little-endian samples of each payload at one rate; those of one codec and rate are decoded together."""
    out = [b""] * len(payloads)
    for kind in sorted(set(zip(codecs, rates, strict=True))):
        rows = [i for i, k in enumerate(zip(codecs, rates, strict=True)) if k == kind]
        flat = np.frombuffer(b"".join(payloads[i] for i in rows), np.uint8)
        firsts = np.concatenate([[0], np.cumsum([len(payloads[i]) for i in rows])])
        if kind[0] == ADPCM:
            blocks = adpcm_blocks(flat.reshape(-1, BLOCK))
            pcm, firsts = blocks.reshape(-1), firsts // BLOCK * blocks.shape[1]
        else:
            pcm = TABLES[kind[0]][flat]
        pcm, firsts = resample(pcm, firsts, kind[1], to)
        data, cuts = pcm.astype("<i2").tobytes(), (2 * firsts).tolist()
        for i, a, b in zip(rows, cuts, cuts[1:], strict=False):
            out[i] = data[a:b]
    return out


PCM = "doc_id {}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, codec int, pcm_rate int, pcm binary"


def _pcm_batches(to: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, media, codecs, rates, payloads in _payloads(batches):
            columns = [
                piece.column(0), piece.column(1), pa.array([len(p) for p in payloads], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in payloads]), pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                pa.array([len(m) for m in media], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in media]), pa.array(codecs, pa.int32()), pa.array([to] * len(media), pa.int32()), pa.array(decode(payloads, codecs, rates, to), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in PCM.split(", ")])

    return run


def describe(pcm: np.ndarray, firsts: np.ndarray) -> list[tuple[float, int, int]]:
    """Root mean square, peak and sign changes of each row's samples; a row without samples has none of them."""
    some = np.flatnonzero(np.diff(firsts))
    out = [(0.0, 0, 0)] * (len(firsts) - 1)
    if len(some):
        at, wide = firsts[:-1][some], pcm.astype(np.int32)
        turns = np.zeros(len(pcm), np.int64)
        turns[1:] = (pcm[1:] < 0) != (pcm[:-1] < 0)
        turns[at] = 0
        found = np.sqrt(np.add.reduceat(wide.astype(np.int64) * wide, at) / np.diff(firsts)[some]), np.maximum.reduceat(np.abs(wide), at), np.add.reduceat(turns, at)
        for i, rms, peak, changes in zip(some.tolist(), *(f.tolist() for f in found), strict=True):
            out[i] = (rms, peak, changes)
    return out


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but codec, pcm_rate and pcm, the last three, and then what the samples sound like."""
    for batch in batches:
        size = max(1, batch.num_rows * textkit.CHUNK_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, size):
            piece = batch.slice(start, size)
            samples = piece.column(piece.num_columns - 1).to_pylist()
            firsts = np.concatenate([[0], np.cumsum([len(x) // 2 for x in samples])])
            sounds = describe(np.frombuffer(b"".join(samples), "<i2"), firsts)
            codecs, rates = (piece.column(piece.num_columns - i).to_pylist() for i in (3, 2))
            feature = [f"{NAMES[c]}@{r}:rms={rms:.2f},peak={peak},turns={turns}" for c, r, (rms, peak, turns) in zip(codecs, rates, sounds, strict=True)]
            yield pa.RecordBatch.from_arrays([*piece.columns[:-3], pa.array(feature, pa.string())], names=[*piece.schema.names[:-3], "feature"])


def media_column(docs: DataFrame, codec: int | None = None, rate: int = RATE) -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes as a telephony recording in a WAV container, by codec_of where no codec is given.

    Null and empty texts are one block of blanks. Every row is a recording of its own, so that repeated rows and
    repeated or null ids each give one; a text of any length (to 2 GB) is one recording. Other columns are not
    read, so that they may have any name; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(textkit.lean(_store_batches(codec, rate)), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def resampled(media: DataFrame, rate: int = PCM_RATE) -> DataFrame:
    """The columns of PCM: each recording's digests and its 16-bit little-endian samples at one rate."""
    rows = media.select("doc_id", "n_bytes", "media")
    return rows.mapInArrow(textkit.lean(_pcm_batches(rate)), PCM.format(rows.schema["doc_id"].dataType.simpleString()))


def features(pcm: DataFrame) -> DataFrame:
    """The digests of stored recordings, and the feature that their stored samples give."""
    kept = [f for f in PCM.format(pcm.schema["doc_id"].dataType.simpleString()).split(", ")][:-3]
    return pcm.select(*[f.split()[0] for f in PCM.split(", ")]).mapInArrow(_feature_batches, ", ".join([*kept, "feature string"]))


def recordings(docs: DataFrame, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """The recordings of media_column and the PCM of resampled, stored as the tables media and pcm of a scratch folder (scratch.path), where they stay."""
    scratch = scratch or Scratch(docs.sparkSession, "telephony")
    stored = scratch.table(media_column(docs), "media", LEVEL)
    return stored, scratch.table(resampled(stored), "pcm", LEVEL)


def op8_telephony(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return features(recordings(docs)[1])
