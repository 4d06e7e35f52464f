"""Numpy kernels over one signal: framing, spectra, onset strength, tempo and beats. They run inside Arrow batches on the executors."""

from __future__ import annotations

import numpy as np

N_FFT, HOP, N_MELS, N_MFCC = 2048, 512, 40, 13


def fft_size(n: int) -> tuple[int, int]:
    """Frame and hop for n samples: the largest power of two not above n, 2048 at most, and a quarter of it, 512 at most."""
    size = max(2, min(N_FFT, 1 << max(0, n.bit_length() - 1)))
    return size, max(1, min(HOP, size // 4))


def frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Centred frames, zero-padded at both ends."""
    x = np.pad(np.asarray(x, float), size // 2)
    n = 1 + (len(x) - size) // hop
    return np.lib.stride_tricks.as_strided(x, (n, size), (x.strides[0] * hop, x.strides[0])).copy()


def spectrum(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Magnitudes (frame, bin) under a periodic Hann window."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    return np.abs(np.fft.rfft(frames(x, size, hop) * window, axis=1))


def centroid_bandwidth_rolloff(s: np.ndarray, sr: int, share: float = 0.85) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    freq = np.linspace(0, sr / 2, s.shape[1])
    total = s.sum(1)
    safe = np.where(total > 0, total, 1)
    centroid = (s * freq).sum(1) / safe
    bandwidth = np.sqrt((s * (freq - centroid[:, None]) ** 2).sum(1) / safe)
    return centroid, bandwidth, freq[(np.cumsum(s, 1) >= share * total[:, None]).argmax(1)]


def mel_filters(sr: int, size: int, n_mels: int = N_MELS) -> np.ndarray:
    """Triangles of unit area on the mel scale 2595 log10(1 + f / 700)."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(sr / 2), n_mels + 2) / 2595) - 1)
    freq = np.linspace(0, sr / 2, size // 2 + 1)[None, :]
    low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.maximum(0, np.minimum((freq - low) / (mid - low), (high - freq) / (high - mid))) * 2 / (high - low)


def mfcc(s: np.ndarray, sr: int, n: int = N_MFCC) -> np.ndarray:
    """Cosine transform of log mel energies (frame, n)."""
    db = mel_db(s, sr, 2 * (s.shape[1] - 1))
    return mfcc_of(db, db.max(), n)


def mfcc_of(db: np.ndarray, top: float, n: int = N_MFCC) -> np.ndarray:
    """Cosine transform of mel decibels, those more than 80 below ``top`` cut off."""
    db = np.maximum(db, top - 80)
    k = np.arange(db.shape[1])
    basis = np.cos(np.pi / db.shape[1] * (k[:, None] + 0.5) * np.arange(n)) * np.sqrt(2 / db.shape[1])
    basis[:, 0] /= np.sqrt(2)
    return db @ basis


def chroma(s: np.ndarray, sr: int) -> np.ndarray:
    """Energy of the twelve pitch classes from C (frame, 12), each frame's greatest at 1."""
    freq = np.linspace(0, sr / 2, s.shape[1])
    out = np.zeros((len(s), 12))
    keep = freq >= 27.5
    at = np.rint(12 * np.log2(freq[keep] / 440) + 69).astype(int) % 12
    np.add.at(out.T, at, (s[:, keep] ** 2).T)
    top = out.max(1, keepdims=True)
    return out / np.where(top > 0, top, 1)


def zero_crossings(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    f = frames(x, size, hop) < 0
    return (f[:, 1:] != f[:, :-1]).sum(1) / size


def frame_features(x: np.ndarray, sr: int, size: int = N_FFT, hop: int = HOP) -> tuple[np.ndarray, ...]:
    """Centroid, bandwidth, rolloff, zero-crossing rate, MFCC and chroma of every frame of a signal."""
    s = spectrum(x, size, hop)
    c, b, r = centroid_bandwidth_rolloff(s, sr)
    return c, b, r, zero_crossings(x, size, hop), mfcc(s, sr), chroma(s, sr)


def features(x: np.ndarray, sr: int) -> dict:
    """One record of a signal's features; an empty one gives zeros."""
    x = np.asarray(x, float)
    names = ("rms", "zcr", "energy", "spectral_centroid_mean", "spectral_centroid_std", "spectral_rolloff_mean", "spectral_rolloff_std", "spectral_bandwidth_mean")
    if not len(x):
        return dict.fromkeys(names, 0.0) | {"mfcc_mean": [0.0] * N_MFCC, "mfcc_std": [0.0] * N_MFCC, "chroma_mean": [0.0] * 12}
    size, hop = fft_size(len(x))
    s = spectrum(x, size, hop)
    c, b, r = centroid_bandwidth_rolloff(s, sr)
    m = mfcc(s, sr)
    values = (np.sqrt(np.mean(x * x)), zero_crossings(x, size, hop).mean(), np.sum(x * x), c.mean(), c.std(), r.mean(), r.std(), b.mean())
    return dict(zip(names, map(float, values), strict=True)) | {"mfcc_mean": m.mean(0).tolist(), "mfcc_std": m.std(0).tolist(), "chroma_mean": chroma(s, sr).mean(0).tolist()}


VARIANT_FIELDS = (
    "tempo_bpm", *(f"chroma_mean_{k:02d}" for k in range(12)), *(f"mfcc_{k:02d}_{s}" for k in range(N_MFCC) for s in ("mean", "std")),
    *(f"{c}_{s}" for c in ("spectral_centroid", "spectral_bandwidth", "spectral_rolloff", "zcr") for s in ("mean", "std", "min", "max")),
)


def variant_features(x: np.ndarray, sr: int) -> dict:
    """The other variant's record of a signal: its own tempo, and mean, deviation, least and greatest value of each feature; an empty one gives zeros."""
    x = np.asarray(x, float)
    if not len(x):
        return dict.fromkeys(VARIANT_FIELDS, 0.0)
    size, hop = fft_size(len(x))
    s = spectrum(x, size, hop)
    m, h = mfcc(s, sr), chroma(s, sr).mean(0)
    rows = (*centroid_bandwidth_rolloff(s, sr), zero_crossings(x, size, hop))
    values = [tempo_and_beats(x, sr)[0], *h, *(v for k in range(N_MFCC) for v in (m[:, k].mean(), m[:, k].std())), *(f(r) for r in rows for f in (np.mean, np.std, np.min, np.max))]
    return dict(zip(VARIANT_FIELDS, map(float, values), strict=True))


def resample(x: np.ndarray, sr: int, to: int, taps: int = 32, block: int = 1 << 16) -> np.ndarray:
    """Windowed-sinc resampling, in blocks: the arrays of one hold 2 * taps values a sample."""
    if sr == to or not len(x):
        return np.asarray(x, float)
    n, cut = int(round(len(x) * to / sr)), min(1.0, to / sr)
    x, out = np.asarray(x, float), np.empty(n)
    for k in range(0, n, block):
        at = np.arange(k, min(k + block, n)) * sr / to
        near = np.floor(at).astype(int)[:, None] + np.arange(-taps + 1, taps + 1)
        t = at[:, None] - near
        kernel = cut * np.sinc(cut * t) * (0.5 + 0.5 * np.cos(np.pi * np.clip(t / taps, -1, 1)))
        out[k : k + len(at)] = (x[np.clip(near, 0, len(x) - 1)] * ((near >= 0) & (near < len(x))) * kernel).sum(1)
    return out


def trim(x: np.ndarray, sr: int, threshold_db: float = -40.0, keep_ms: int = 80, window_ms: int = 100, step_ms: int = 10) -> tuple[np.ndarray, float]:
    """The signal without silence at both ends, and the seconds cut from the front; an all-silent one stays."""
    x = np.asarray(x, float)
    size, step = max(1, sr * window_ms // 1000), max(1, sr * step_ms // 1000)
    total = np.concatenate([[0], np.cumsum(x * x)])
    starts = np.arange(0, max(1, len(x) - size + 1), step)
    level = np.sqrt((total[np.minimum(starts + size, len(x))] - total[starts]) / size)
    loud = np.flatnonzero(20 * np.log10(np.maximum(level, 1e-12)) > threshold_db)
    if not len(x) or not len(loud):
        return x, 0.0
    keep = sr * keep_ms // 1000
    a, b = max(0, starts[loud[0]] - keep), min(len(x), starts[loud[-1]] + size + keep)
    return x[a:b], a / sr


def mel_db(s: np.ndarray, sr: int, n_fft: int = N_FFT) -> np.ndarray:
    """Decibels of mel energies (frame, band) of magnitudes (frame, bin)."""
    return 10 * np.log10(np.maximum(s**2 @ mel_filters(sr, n_fft).T, 1e-10))


def onset_strength(db: np.ndarray) -> np.ndarray:
    """Mean rise of mel decibels per frame, those more than 80 below the greatest cut off."""
    db = np.maximum(db, db.max() - 80)
    return np.concatenate([[0], np.maximum(0, np.diff(db, axis=0)).mean(1)])


def tempo_and_beats(x: np.ndarray, sr: int, start_bpm: float = 120.0, tightness: float = 100.0) -> tuple[float, list[float]]:
    """``track`` of a whole signal."""
    if len(x) < N_FFT:
        return 0.0, []
    return track(onset_strength(mel_db(spectrum(np.asarray(x, float), N_FFT, HOP), sr)), sr / HOP, start_bpm, tightness)


def track(onset: np.ndarray, rate: float, start_bpm: float = 120.0, tightness: float = 100.0) -> tuple[float, list[float]]:
    """Tempo from the autocorrelation of onset strength (``rate`` values a second) under a log-normal prior, beats by dynamic programming; 0 and none without onsets."""
    if onset.max() < 1e-3 or onset.std() < 0.05 * onset.max() * 0.1:
        return 0.0, []
    flat = onset - onset.mean()
    n = len(flat)
    auto = np.fft.irfft(np.abs(np.fft.rfft(flat, 2 * n)) ** 2)[:n]
    lag = np.arange(max(2, int(np.ceil(rate * 60 / 320))), min(n, int(rate * 4)))
    if not len(lag):
        return 0.0, []
    bpm = 60 * rate / lag
    best = lag[int(np.argmax(auto[lag] * np.exp(-0.5 * np.log2(bpm / start_bpm) ** 2)))]
    around = np.arange(max(1, best - 1), min(n - 1, best + 2))
    weight = np.maximum(auto[around], 0)
    period = float((around * weight).sum() / weight.sum()) if weight.sum() > 0 else float(best)
    local = onset / max(1e-12, onset.std())
    score, back = local.copy(), np.full(n, -1)
    gaps = np.arange(max(1, int(period / 2)), int(2 * period) + 1)
    cost = -tightness * np.log(gaps / period) ** 2
    for t in range(gaps[0], n):
        g = gaps[gaps <= t]
        s = score[t - g] + cost[: len(g)]
        k = int(np.argmax(s))
        if s[k] > 0:
            score[t] += s[k]
            back[t] = t - g[k]
    t, path = max(0, n - int(period)) + int(np.argmax(score[-int(period):] if period < n else score)), []
    while t >= 0:
        path.append(t)
        t = back[t]
    beats = [b for b in path[::-1] if local[max(0, b - 2) : b + 3].max() > 0.1]
    return 60 * rate / period, [b / rate for b in beats]


class KFilter:
    """The two K-weighting filters of ITU-R BS.1770 for any rate, as one linear system of four states: s' = A s + B x, y = C s + D x.

    A run of samples is worked on in rows: within a row by the impulse response, from row to row by the states, so that a block can be filtered from any state
    and the state after it is A^n s plus the one it reaches from zero."""

    ROW = 256

    def __init__(self, sr: int):
        # fixed values of the standard's analogue prototypes: a shelf of 4 dB at 1682 Hz and a high pass at 38 Hz
        shelf = self._biquad(sr, 1681.974450955533, 0.7071752369554196, 3.999843853973347)
        high = self._biquad(sr, 38.13547087602444, 0.5003270373238773, None)
        (a1, b1, c1, d1), (a2, b2, c2, d2) = map(self._states, (shelf, high))
        self.a = np.block([[a1, np.zeros((2, 2))], [b2 @ c1, a2]])
        self.b, self.c, self.d = np.vstack([b1, b2 * d1]), np.hstack([d2 * c1, c2]), d2 * d1
        n, powers = self.ROW, [np.eye(4)]
        for _ in range(n):
            powers.append(self.a @ powers[-1])
        self.leap, seen = powers[n], np.array([(self.c @ p)[0] for p in powers[:n]])
        impulse = np.concatenate([[self.d], (seen @ self.b)[: n - 1, 0]])
        lag = np.arange(n)[None, :] - np.arange(n)[:, None]
        self.spread = np.where(lag >= 0, impulse[np.maximum(lag, 0)], 0.0)  # a row's samples to its own outputs
        self.reach, self.heard = np.hstack([p @ self.b for p in powers[n - 1 :: -1]]).T, seen.T  # samples to the next state, a state to outputs

    @staticmethod
    def _biquad(sr: int, f: float, q: float, gain_db: float | None) -> tuple[np.ndarray, np.ndarray]:
        k = np.tan(np.pi * f / sr)
        a = np.array([1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k])
        if gain_db is None:
            b = np.array([1.0, -2.0, 1.0]) * a[0]
        else:
            vh = 10 ** (gain_db / 20)
            vb = vh**0.4996667741545416
            b = np.array([vh + vb * k / q + k * k, 2 * (k * k - vh), vh - vb * k / q + k * k])
        return b / a[0], a / a[0]

    @staticmethod
    def _states(filter_: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        (b0, b1, b2), (_, a1, a2) = filter_
        return np.array([[-a1, 1.0], [-a2, 0.0]]), np.array([[b1 - a1 * b0], [b2 - a2 * b0]]), np.array([[1.0, 0.0]]), b0

    def after(self, n: int, state: np.ndarray) -> np.ndarray:
        """The state after n samples of silence."""
        return np.linalg.matrix_power(self.a, n) @ state

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The filtered samples and the state after them."""
        x, n = np.asarray(x, float), len(x)
        rows = np.pad(x, (0, -n % self.ROW)).reshape(-1, self.ROW)
        states, ends = np.empty((len(rows), 4)), rows @ self.reach
        for i in range(len(rows)):
            states[i] = state
            state = self.leap @ state + ends[i]
        y = (rows @ self.spread + states @ self.heard).ravel()[:n]
        if n % self.ROW:  # the last row isn't whole
            state = states[-1]
            rest = x[n - n % self.ROW :]
            state = np.linalg.matrix_power(self.a, len(rest)) @ state + self.reach[self.ROW - len(rest) :].T @ rest
        return y, state


def power_frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Squared magnitudes (frame, bin) under a periodic Hann window of the whole frames of a signal."""
    x = np.asarray(x, float)
    if len(x) < size:
        return np.zeros((0, size // 2 + 1))
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    rows = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    return np.abs(np.fft.rfft(rows * window, axis=1)) ** 2
