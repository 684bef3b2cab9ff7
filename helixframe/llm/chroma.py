"""Chroma fingerprints of single recordings, in numpy."""

from __future__ import annotations

import io
import wave

import numpy as np

RATE = 3000
WINDOW, HOP = 1024, 128
CLASSES = 12
SMOOTH = np.array([0.25, 0.75, 1.0, 0.75, 0.25])
LOWEST, HIGHEST = 60.0, 1400.0
#: Frames that a filter looks at.
SPAN = 16
#: log ratios of two areas that part the four levels of a filter.
LEVELS = np.array([-0.2, 0.0, 0.2])


def filters(span: int = SPAN) -> list[tuple[list, list]]:
    """16 filters, each two lists of rectangles (frame, class, frames, classes) to be compared.

    For four places of the pitch classes: lower against upper half of three classes each, first
    against second half of the frames, the crossed halves, and middle third against outer thirds.
    """
    found = []
    for low in range(0, CLASSES, 3):
        h, half, third = 3, span // 2, span // 4
        upper = (low + h) % CLASSES
        found += [
            ([(0, low, span, h)], [(0, upper, span, h)]),
            ([(0, low, half, h)], [(half, low, half, h)]),
            ([(0, low, half, h), (half, upper, half, h)], [(0, upper, half, h), (half, low, half, h)]),
            ([(third, low, 2 * third, h)], [(0, low, third, h), (3 * third, low, third, h)]),
        ]
    return found


_FILTERS = filters()
_BIN = np.fft.rfftfreq(WINDOW, 1 / RATE)
_USED = np.flatnonzero((_BIN >= LOWEST) & (_BIN <= HIGHEST))
_PITCH = np.rint(12 * np.log2(_BIN[_USED] / 440.0)).astype(int) % CLASSES
_TO_CLASS = np.zeros((len(_USED), CLASSES))
_TO_CLASS[np.arange(len(_USED)), _PITCH] = 1.0
_TAPER = np.hanning(WINDOW)


def samples(audio: bytes | None) -> np.ndarray:
    """PCM WAV bytes of 8 or 16 bits as mono samples at RATE; empty if there is no such audio."""
    if not audio:
        return np.empty(0)
    try:
        with wave.open(io.BytesIO(audio)) as w:
            width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
            raw = w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return np.empty(0)
    if width not in (1, 2) or not rate:
        return np.empty(0)
    raw = raw[: len(raw) // (width * channels) * width * channels]
    x = np.frombuffer(raw, np.uint8) / 128.0 - 1 if width == 1 else np.frombuffer(raw, "<i2") / 32768.0
    x = x.reshape(-1, channels).mean(1)
    if rate != RATE and len(x):
        x = np.interp(np.arange(0, len(x), rate / RATE), np.arange(len(x)), x)
    return x


def pitch_classes(x: np.ndarray) -> np.ndarray:
    """Smoothed, normalised energies of the 12 pitch classes, one row for each frame."""
    if len(x) < WINDOW:
        return np.empty((0, CLASSES))
    frames = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[::HOP]
    parts = [np.abs(np.fft.rfft(frames[i : i + 256] * _TAPER, axis=1)[:, _USED]) ** 2 @ _TO_CLASS for i in range(0, len(frames), 256)]
    chroma = np.concatenate(parts)
    if len(chroma) >= len(SMOOTH):
        chroma = sum(w * chroma[i : len(chroma) - len(SMOOTH) + 1 + i] for i, w in enumerate(SMOOTH))
    norm = np.sqrt((chroma**2).sum(1, keepdims=True))
    return np.where(norm > 1e-6, chroma / np.maximum(norm, 1e-6), 0.0)


def fingerprint(x: np.ndarray) -> np.ndarray:
    """One packed unsigned 32-bit integer for each place of the filters: 16 levels of 2 Gray-coded bits."""
    chroma = pitch_classes(x)
    n = len(chroma) - SPAN + 1
    if n < 1:
        return np.empty(0, np.uint32)
    wide = np.concatenate([chroma, chroma], axis=1)  # rectangles may go on from the last class to the first
    image = np.zeros((len(wide) + 1, 2 * CLASSES + 1))
    image[1:, 1:] = wide.cumsum(0).cumsum(1)
    packed = np.zeros(n, np.uint32)

    def area(t, c, frames, classes):
        return image[t + frames : t + frames + n, c + classes] - image[t : t + n, c + classes] - image[t + frames : t + frames + n, c] + image[t : t + n, c]

    for first, second in _FILTERS:
        ratio = np.log((1 + sum(area(*r) for r in first)) / (1 + sum(area(*r) for r in second)))
        level = np.searchsorted(LEVELS, ratio, "right").astype(np.uint32)
        packed = packed << np.uint32(2) | (level ^ level >> np.uint32(1))
    return packed


def bit_error(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """(share of differing bits, places) where ``b`` is laid over ``a`` from a's place ``offset``."""
    low, high = max(0, offset), min(len(a), offset + len(b))
    if high <= low:
        return 1.0, 0
    differ = a[low:high] ^ b[low - offset : high - offset]
    return float(np.bitwise_count(differ).sum()) / (32 * (high - low)), high - low
