"""Words, word windows and their hashes for many documents at once, in numpy.

Documents are laid end to end with a line feed between them. Hashes are 64 bits: bytes through a
fixed random table into a polynomial modulo 2**64, then a bit mixer.
"""

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240611))
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
WINDOW_BASES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)

#: [\x20\x09-\x0D] separate words.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True

ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_BLOCK = 1 << 14
_powers = {}


def mix(x):
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n, inverse=False):
    """base**0 .. base**(n-1) modulo 2**64; kept and grown."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), _BASE_INVERSE if inverse else _BASE, dtype=np.uint64)
        steps[0] = 1
        have = _powers[inverse] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_sums(data):
    """sums[i]: the polynomial of data[:i]; a slice's hash is a difference, see slice_hashes."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    power = powers(len(data))
    for a in range(0, len(data), _BLOCK):  # what a block needs stays in the processor's cache
        terms = _BYTE_VALUES[data[a:a + _BLOCK]]
        terms *= power[a:a + _BLOCK]
        terms[:1] += sums[a:a + 1]
        np.cumsum(terms, out=sums[a + 1:a + 1 + len(terms)])
    return sums


def slice_hashes(sums, starts, ends):
    raw = (sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts]
    return mix(raw ^ (ends - starts).astype(np.uint64))


def joined(texts):
    """One byte array, and where each text starts in it (one entry more than texts)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8) if texts else np.zeros(0, np.uint8)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return data, starts


def word_spans(data, separators=SEPARATORS):
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~separators[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(texts, separators=SEPARATORS):
    """The hash of every word of all texts, and the text it belongs to."""
    data, at = joined(texts)
    starts, ends = word_spans(data, separators)
    hashes = slice_hashes(prefix_sums(data), starts, ends)
    return hashes, np.searchsorted(at, starts, side="right") - 1


def window_hashes(words, size, base=0):
    """The hash of each run of size words, by its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= WINDOW_BASES[base]
        out += words[k:n + k]
    return mix(out)


def text_list(column):
    """The texts of an Arrow column as UTF-8, null as empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
