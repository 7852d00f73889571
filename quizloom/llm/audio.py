"""Media columns: audio features of 8-bit samples, as fixed-shape tensors with time spans.

Bytes are stored as the samples of a RIFF/WAVE file (8-bit unsigned, mono), which is lossless,
and features are computed from what is read back: polyphase resampling by UP/DOWN, overlapped
log-mel filterbanks, and segmentation by energy with hysteresis. Features come in tensors of
TENSOR_FRAMES frames by MELS bands (the last is padded with the floor), each with its span of
seconds. Signals are resampled and analysed in blocks; beside its samples a text takes memory for
its features alone, about half its size. Tensors are stored as an Arrow stream.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.ipc  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import blocks, map_arrow

RATE, UP, DOWN, TAPS = 16_000, 3, 4, 16
FRAME, HOP, MELS, TENSOR_FRAMES = 256, 128, 24, 16
#: The payload is padded with PAD to a positive multiple of UNIT; its last TAIL bytes have a checksum of their own.
UNIT, PAD, TAIL = 576, 255, 32
#: A segment opens where the level is OPEN decibels above the signal's floor, and closes where it falls below CLOSE.
OPEN_DB, CLOSE_DB, MIN_FRAMES = 6.0, 3.0, 2
FLOOR = -120.0
_BLOCK, _FRAMES = 1 << 17, 512


def pack(data: bytes) -> bytes:
    """Padded payload as a WAVE file."""
    payload = data + bytes([PAD]) * (-len(data) % UNIT or (0 if data else UNIT))
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def unpack(media: bytes) -> bytes:
    """Samples of a WAVE file of pack()'s format: the data chunk, wherever it stands."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at = 12
    while at + 8 <= len(media):
        kind, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"fmt " and struct.unpack_from("<HH", media, at + 8) + struct.unpack_from("<H", media, at + 22) != (1, 1, 8):
            raise ValueError("not 8-bit mono samples")
        if kind == b"data":
            return media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no samples")


@cache
def _filter() -> np.ndarray:
    """Low-pass of UP * TAPS * 2 + 1 taps, one row for each of the UP phases."""
    n = 2 * TAPS * max(UP, DOWN) + 1
    t = np.arange(n) - n // 2
    h = np.sinc(t / max(UP, DOWN)) * np.hanning(n + 2)[1:-1]
    h *= UP / h.sum()
    rows = -(-n // UP)
    return np.pad(h, (0, rows * UP - n)).reshape(rows, UP).T.astype(np.float32)


def _level(samples: np.ndarray) -> np.ndarray:
    """8-bit samples as numbers from -1 to 1; others as they are."""
    return (samples.astype(np.float32) - 127.5) / 127.5 if samples.dtype == np.uint8 else samples.astype(np.float32)


def resampled_size(n: int) -> int:
    return -(-n * UP // DOWN)


def resample(samples: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Outputs first to last - 1 of polyphase resampling by UP / DOWN: each is one phase's dot product, at the output rate only. Beyond its ends a signal is silent."""
    phases = _filter()
    taps, half = phases.shape[1], (2 * TAPS * max(UP, DOWN) + 1) // 2
    at = np.arange(first, resampled_size(len(samples)) if last is None else last) * DOWN + half
    if not len(at):
        return np.zeros(0, np.float32)
    low, high = int(at[0]) // UP - taps + 1, int(at[-1]) // UP + 1
    part = _level(samples[max(low, 0) : max(min(high, len(samples)), 0)])
    part = np.pad(part, (max(-low, 0), high - low - max(-low, 0) - len(part)))
    windows = np.lib.stride_tricks.sliding_window_view(part, taps)
    out = np.empty(len(at), np.float32)
    for phase in range(UP):
        mine = np.flatnonzero(at % UP == phase)
        for s in range(0, len(mine), _BLOCK):
            k = mine[s : s + _BLOCK]
            out[k] = windows[at[k] // UP - taps + 1 - low] @ phases[phase][::-1]
    return out


@cache
def _mel() -> np.ndarray:
    rate = RATE * UP / DOWN
    hz = lambda m: 700 * (10 ** (m / 2595) - 1)
    edges = hz(np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), MELS + 2)) * FRAME / rate
    bins = np.arange(FRAME // 2 + 1)
    up = (bins - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - bins) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


def log_mel(samples: np.ndarray) -> np.ndarray:
    """Decibels of mel bands, (frames, MELS): frames of FRAME resampled samples every HOP, worked out _FRAMES at a time. A short signal is one frame."""
    n = resampled_size(len(samples))
    frames = 1 + max(0, n - FRAME) // HOP
    out, window = np.empty((frames, MELS), np.float32), np.hanning(FRAME).astype(np.float32)
    for a in range(0, frames, _FRAMES):
        b = min(frames, a + _FRAMES)
        signal = resample(samples, a * HOP, min(n, (b - 1) * HOP + FRAME))
        signal = np.pad(signal, (0, (b - 1 - a) * HOP + FRAME - len(signal)))
        power = np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP] * window)) ** 2
        out[a:b] = np.maximum(FLOOR, 10 * np.log10(power @ _mel().T + 1e-12))
    return out


def segments(level: np.ndarray) -> list[tuple[int, int]]:
    """Frames [a, b) that are active: from OPEN_DB above the 20th percentile until below CLOSE_DB."""
    floor = np.percentile(level, 20)
    high, low = level >= floor + OPEN_DB, level < floor + CLOSE_DB
    state = np.where(high, 1, np.where(low, 0, -1))
    known = np.flatnonzero(state >= 0)
    if not len(known):
        return []
    held = np.searchsorted(known, np.arange(len(level)), "right") - 1
    on = (held >= 0) & (state[known[np.maximum(held, 0)]] == 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a >= MIN_FRAMES]


def extract(samples: bytes) -> tuple[np.ndarray, list[tuple[float, float]], list[tuple[float, float]]]:
    """Tensors (n, TENSOR_FRAMES, MELS), the span of seconds of each, and the active spans."""
    mel = log_mel(np.frombuffer(samples, np.uint8))
    second = HOP / (RATE * UP / DOWN)
    n = -(-len(mel) // TENSOR_FRAMES)
    tensors = np.full((n * TENSOR_FRAMES, MELS), FLOOR, np.float32)
    tensors[: len(mel)] = mel
    spans = [(i * TENSOR_FRAMES * second, min(len(mel), (i + 1) * TENSOR_FRAMES) * second) for i in range(n)]
    active = [(a * second, b * second) for a, b in segments(mel.mean(1))]
    return tensors.reshape(n, TENSOR_FRAMES, MELS), spans, active


def tensor_table(tensors: np.ndarray, spans: list[tuple[float, float]]) -> pa.Table:
    """An Arrow table with a fixed-shape tensor column and its time spans."""
    col = pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(tensors))
    return pa.table({"start_s": pa.array([a for a, _ in spans], pa.float64()), "end_s": pa.array([b for _, b in spans], pa.float64()), "log_mel": col})


def store(tensors: np.ndarray, spans: list[tuple[float, float]]) -> bytes:
    """tensor_table() as an Arrow stream."""
    table, sink = tensor_table(tensors, spans), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def load(stream: bytes) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """Tensors and time spans of a stored stream."""
    back = pa.ipc.open_stream(stream).read_all()
    return back["log_mel"].combine_chunks().to_numpy_ndarray(), list(zip(back["start_s"].to_pylist(), back["end_s"].to_pylist(), strict=True))


def summary(tensors: np.ndarray, active: list[tuple[float, float]]) -> str:
    """Frames, active spans, the mean of each band in whole decibels, and a digest of all features in half decibels."""
    flat = tensors.reshape(-1, MELS)
    rounded = np.round(flat * 2).astype("<i2")
    means = ",".join(str(int(round(float(x)))) for x in flat.mean(0, dtype=np.float64))
    spans = ";".join(f"{a:.3f}-{b:.3f}" for a, b in active)
    return f"tensors={len(tensors)}|active={len(active)}:{spans}|mel={means}|sha={hashlib.sha256(rounded.tobytes()).hexdigest()[:16]}"


def audio_features(docs: DataFrame, full: bool = False) -> DataFrame:
    """doc_id, n_bytes, payload and media digests, the feature summary and tensors of every row of docs(doc_id, text).

    tensors is an Arrow stream of fixed-shape tensors with their time spans, which load() reads; the
    summary is made from what was read back. full=True adds media (binary) and active spans. A null or empty
    text is one unit of padding. Equal texts give equal values; repeated rows stay; other columns
    are ignored; an empty table gives no rows. Each text is read in blocks, however long.
    """

    def run(batches):
        for part, texts in blocks(batches):
            rows, extra = [], []
            for t in texts:
                media = pack(t)
                payload = unpack(media)
                tensors, spans, active = extract(payload)
                stream = store(tensors, spans)
                tensors, spans = load(stream)
                rows.append((len(t), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]), len(media), hashlib.sha256(media).hexdigest(), summary(tensors, active), stream))
                if full:
                    extra.append((media, [list(x) for x in active]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tensors"]
            cols = [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))]
            if full:
                kinds = [pa.binary(), pa.list_(pa.list_(pa.float64()))]
                cols += [pa.array(c, k) for c, k in zip(zip(*extra, strict=True), kinds, strict=True)]
                names += ["media", "active"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tensors binary"
    schema += ", media binary, active array<array<double>>" * full
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
