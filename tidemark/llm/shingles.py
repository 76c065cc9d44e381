"""Word-shingle sets and HyperMinHash registers, computed over byte arrays with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U = np.uint64
CHUNK = 2 << 20
_BASE = U(0x9E3779B97F4A7C15)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LONG = 64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2 ** 64."""
    size = 1 << max(12, int(n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = U(pow(int(_BASE), -1, 1 << 64))
        _powers[size] = tuple(np.cumprod(np.concatenate([np.ones(1, U), np.full(size - 1, b, U)])) for b in (_BASE, inverse))
    return _powers[size]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a short text: words are what stands between blanks, A-Z lower-cased."""
    a = _LOW[np.frombuffer(data, np.uint8)]
    word = ~_BLANK[a]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _pow(len(a) + 1)
    total = np.concatenate([np.zeros(1, U), np.cumsum((a.astype(U) + U(1)) * up[: len(a)])])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(end - start > _LONG):  # polynomial hashes are for words
        h[i] = xxhash.xxh3_64_intdigest(a[start[i] : end[i]].tobytes())
    return h, start


def _cut(text: bytes) -> Iterator[bytes]:
    """Pieces of about CHUNK bytes that end between words."""
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def text_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of many texts one after another, and where each text's words begin (one more at the end)."""
    hashes, counts, held, size = [], [], [], 0

    def flush() -> None:
        if not held:
            return
        joined = b"\n".join(held)
        begins = np.cumsum([0] + [len(t) + 1 for t in held])
        h, start = word_hashes(joined)
        hashes.append(h)
        counts.extend(np.diff(np.searchsorted(start, begins)).tolist())
        held.clear()

    for t in texts:
        if len(t) > CHUNK:
            flush()
            size = 0
            parts = [word_hashes(p)[0] for p in _cut(t)]
            hashes.extend(parts)
            counts.append(sum(map(len, parts)))
            continue
        if size + len(t) > CHUNK:
            flush()
            size = 0
        held.append(t)
        size += len(t)
    flush()
    return np.concatenate([np.zeros(0, U), *hashes]), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def shingle_sets(texts: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; fewer words than ``width`` make one shingle of them all."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size > 2 * CHUNK or i == len(texts) - 1:
            yield from _sets(texts[at : i + 1], width)
            at, size = i + 1, 0


def _sets(texts: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    words, begins = text_words([t or b"" for t in texts])
    mult = [U((0xA0761D6478BD642F * (2 * i + 1) + 0xE7037ED1A0B428DB * i * i) % (1 << 64) | 1) for i in range(width)]
    n = len(words) - width + 1
    rolled = np.zeros(max(0, n), U)
    for i in range(width if n > 0 else 0):
        rolled += words[i : i + n] * mult[i]
    rolled = mix(rolled)
    for s, e in zip(begins[:-1], begins[1:]):
        k = e - s
        if k >= width:
            yield np.unique(rolled[s : e - width + 1])
        elif k:
            yield mix(np.array([sum((int(w) * int(m) for w, m in zip(words[s:e], mult)), int(k) * 0x2545F4914F6CDD1D) % (1 << 64)], U))
        else:
            yield np.zeros(0, U)


REGISTERS, MANTISSA = 128, 10


def registers(hashes: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """HyperMinHash: buckets by the top bits; of each bucket's least hash, the number of leading zeros (from 1,
    54 at most) above MANTISSA bits that follow its first one. 0: nothing fell into the bucket."""
    out = np.zeros(m, np.uint16)
    if not len(hashes):
        return out
    bits = int(m).bit_length() - 1
    bucket = (hashes >> U(64 - bits)).astype(np.int64)
    least = np.full(m, np.iinfo(np.uint64).max, U)
    np.minimum.at(least, bucket, hashes << U(bits))
    full = np.zeros(m, bool)
    full[bucket] = True
    v = least[full] | U(1 << bits - 1)
    lead = np.zeros(len(v), U)
    x = v.copy()
    for s in (32, 16, 8, 4, 2, 1):
        low = x < (U(1) << U(64 - s))
        lead[low] += U(s)
        x[low] <<= U(s)
    mant = (x << U(1)) >> U(64 - MANTISSA)
    out[full] = (((np.minimum(lead, U(53)) + U(1)) << U(MANTISSA)) | mant).astype(np.uint16)
    return out


def _probes(m: int) -> np.ndarray:
    """For each register, the order in which an empty one looks for a full one: itself, then all in a fixed random order."""
    rng = np.random.default_rng(20_23)
    return np.array([[j, *(x for x in rng.permutation(m) if x != j)] for j in range(m)])


_PROBES: dict[int, np.ndarray] = {}


def densify(reg: np.ndarray) -> np.ndarray:
    """Empty registers take that of the first full bucket in their own probing order, marked by the bucket. So
    each draws nearly at random, and two texts agree in a register as often as their sets do, short ones too."""
    m = len(reg)
    if m not in _PROBES:
        _PROBES[m] = _probes(m)
    probes = _PROBES[m]
    src = probes[np.arange(m), (reg != 0)[probes].argmax(1)]
    return reg[src].astype(np.int64) | (src << 16)


def band_keys(reg: np.ndarray, bands: int, rows: int) -> list[int]:
    """A 64-bit key for each band of ``rows`` registers."""
    d = densify(reg)
    step = len(reg) // rows
    return [xxhash.xxh3_64_intdigest(d[[(b + r * step) % len(reg) for r in range(rows)]].tobytes(), b) - (1 << 63) for b in range(bands)]


def collision(n_a: np.ndarray, n_b: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Chance that a bucket's registers agree for disjoint sets of these sizes."""
    i = np.arange(1, 54)[:, None]

    def seen(n):
        lam = np.maximum(n, 1) / m
        return (1 - 2.0 ** -i) ** lam - (1 - 2.0 ** (1 - i)) ** lam

    return (seen(n_a) * seen(n_b)).sum(0) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of paired register rows, and the number of registers they rest on."""
    some = ((a != 0) | (b != 0)).sum(1)
    same = ((a == b) & (a != 0)).sum(1)
    c = collision(n_a, n_b)
    j = (same / np.maximum(some, 1) - c) / (1 - c)
    return np.clip(j, 0, 1), some
