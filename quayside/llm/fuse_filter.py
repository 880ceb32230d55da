"""Static three-wise binary-fuse filters over 64-bit keys.

Built once over a whole key set and never changed. A key has one slot in each of
three neighbouring segments; the byte-wise XOR of its slots is its fingerprint.
No key of the set is ever missed; another key passes with a chance of 1/256. Nine to
ten bits a key for large sets.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QII")  # seed, segment length, segments a key may start in
_TRIES = 200


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser with xor-shifts and odd multipliers."""
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, length: int, starts: int) -> np.ndarray:
    """The three slots of each hash, one row a segment."""
    first = ((h >> np.uint64(32)) * np.uint64(length * starts)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def _shape(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of first segments for ``n`` keys."""
    n = max(n, 2)
    length = min(1 << int(np.floor(np.log(n) / np.log(3.33) + 2.25)), 1 << 18)
    room = n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    return length, max(1, int(np.ceil(room / length)) - 2)


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each has alone), or None where a core remains.
    All keys that have a slot to themselves go in one round."""
    n = slots.shape[1]
    held = np.zeros(size, np.int64)
    who = np.zeros(size, np.int64)
    numbers = np.arange(n)
    for row in slots:
        np.add.at(held, row, 1)
        np.bitwise_xor.at(who, row, numbers)
    rounds, left = [], n
    alone = np.flatnonzero(held == 1)
    while len(alone):
        keys, at = np.unique(who[alone], return_index=True)
        rounds.append((keys, alone[at]))
        left -= len(keys)
        touched = slots[:, keys]
        for row in touched:
            np.subtract.at(held, row, 1)
            np.bitwise_xor.at(who, row, keys)
        near = np.unique(touched)
        alone = near[held[near] == 1]
    return rounds if left == 0 else None


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of 64-bit keys (repeats count once; the empty set's
    filter passes nothing)."""
    keys = np.unique(np.asarray(keys).astype(np.uint64, copy=False))
    if not len(keys):
        return b""
    length, starts = _shape(len(keys))
    for seed in range(1, _TRIES):
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 % (1 << 64))
        slots = _slots(h, length, starts)
        rounds = _peel(slots, length * (starts + 2))
        if rounds is None:
            starts += seed // 10  # small sets may need more room
            continue
        prints, table = _prints(h), np.zeros(length * (starts + 2), np.uint8)
        for peeled, place in reversed(rounds):
            a, b, c = (table[row] for row in slots[:, peeled])
            table[place] = prints[peeled] ^ a ^ b ^ c  # the place itself is still 0
        return _HEAD.pack(seed * 0x9E3779B97F4A7C15 % (1 << 64), length, starts) + table.tobytes()
    raise RuntimeError(f"no binary-fuse filter for {len(keys)} keys in {_TRIES} tries")


def passes(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter's set; all that are in it."""
    if not filter_:
        return np.zeros(len(keys), bool)
    seed, length, starts = _HEAD.unpack_from(filter_)
    table = np.frombuffer(filter_, np.uint8, offset=_HEAD.size)
    h = _mix(np.asarray(keys).astype(np.uint64, copy=False), seed)
    a, b, c = (table[row] for row in _slots(h, length, starts))
    return _prints(h) == (a ^ b ^ c)
