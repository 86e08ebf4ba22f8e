"""SuperMinHash signatures of many sets at once.

Each element walks the slots of the signature in the order of its own random permutation; its value
in the slot of step j is j plus a fraction. A slot keeps the least value over all elements. Values of
a later step exceed those of all earlier ones, so a set whose slots are all filled stops: large sets
need few steps. The steps are run one after another over all elements of the sets still open.
"""

import math

import numpy as np

from .words import mix

_EMPTY = np.uint64(2**64 - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _walk(elements, step, slots, earlier):
    """The slot of each element in this step of its Fisher-Yates shuffle, its fraction, its draw."""
    drawn = mix(elements + np.uint64((int(_STEP) * (step + 1)) % 2**64))
    draw = np.uint8(step) + ((drawn >> np.uint64(40)) * np.uint64(slots - step) >> np.uint64(24)).astype(np.uint8)
    place = draw.copy()
    for before in range(step - 1, -1, -1):  # undo the swaps of the earlier steps
        place[place == earlier[before]] = before
    return place, mix(drawn ^ _STEP) >> np.uint64(8), draw


def signatures(sets, slots):
    """A row of slots integers (at most 255 of them) for each set; an empty set has no minimum."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    signature = np.full((len(sets), slots), _EMPTY, dtype=np.uint64)
    flat = signature.reshape(-1)
    if not sizes.sum():
        return signature
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    earlier, still, going_sets = [], np.arange(len(sets)), np.ones(len(sets), dtype=bool)
    for step in range(slots):
        place, fraction, draw = _walk(elements, step, slots, earlier)
        np.minimum.at(flat, owner * slots + place, fraction | np.uint64(step << 56))
        full = ~(signature[still] == _EMPTY).any(axis=1)
        going_sets[still[full]] = False
        still = still[~full]
        going = going_sets[owner]
        if not going.any():
            break
        elements, owner = elements[going], owner[going]
        earlier = [d[going] for d in [*earlier, draw]]
    return signature


def band_keys(signature, bands):
    """One 64-bit key for each band of a signature's rows; equal bands at equal places are equal."""
    rows = signature.shape[1] // bands
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=np.uint64)
        for column in range(band * rows, (band + 1) * rows):
            key = mix(key * _STEP ^ signature[:, column])
        keys[:, band] = key
    return keys.view(np.int64)


def sketches(signature):
    """Four bits of each slot, 16 slots to a 64-bit number; slots that differ mostly differ here."""
    low = signature & np.uint64(15)
    width = -(-signature.shape[1] // 16)
    out = np.zeros((len(signature), width), dtype=np.uint64)
    for slot in range(signature.shape[1]):
        out[:, slot // 16] |= low[:, slot] << np.uint64(4 * (slot % 16))
    return out.view(np.int64)


def parity_maps(sets, bits):
    """A row of bits (a multiple of 64, a power of two) for each set: how many elements fall on each
    bit, modulo 2. Two sets differ in at least as many elements as their rows differ in bits."""
    width = bits // 64
    out = np.zeros((len(sets), width), dtype=np.uint64)
    if sets:
        elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = mix(elements ^ _STEP) & np.uint64(bits - 1)
        np.bitwise_xor.at(out.reshape(-1), owner * width + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out.view(np.int64)


def variance_factor(slots, union):
    """The variance of the share of equal slots, for two sets of so many elements together, against
    that of independent slots: below 1, and near 1/2 for small sets (from the published analysis)."""
    def term(step, other):
        if not other:
            return 0.0
        return math.exp(union * (math.log(step) + math.log(other) - math.log(slots - 1) - math.log(slots)) + math.log(slots - 1))

    total = sum(term(k, k + 1) + term(k, k - 1) - 2 * term(k, k) for k in range(1, slots))
    return 1 - total / (union - 1)
