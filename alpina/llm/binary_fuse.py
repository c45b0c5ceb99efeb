"""Static 3-wise binary-fuse filters (Graf & Lemire 2022) over 64-bit keys, built and probed with numpy."""

from __future__ import annotations

import math

import numpy as np

_U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over ``key + seed``."""
    h = keys + _U(seed)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _slots(h: np.ndarray, seg_len: int, seg_count: int) -> np.ndarray:
    """The three slots of each key, in three consecutive segments: shape (3, n)."""
    base = ((h >> _U(32)) * _U(seg_count * seg_len)) >> _U(32)
    mask = _U(seg_len - 1)
    s1 = (base + _U(seg_len)) ^ ((h >> _U(18)) & mask)
    s2 = (base + _U(2 * seg_len)) ^ (h & mask)
    return np.stack([base, s1, s2]).astype(np.int64)


def _print(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> _U(32))).astype(np.uint16)


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """``(seed, segment length, segment count, fingerprints)`` of distinct uint64 keys; none for no keys."""
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    n = len(keys)
    seg_len = 1 << max(2, min(18, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))))
    slots = int(round(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2))))) if n > 1 else 4
    for seed in range(1, 200):
        seg_count = max(1, -(-slots // seg_len) - 2)
        made = _construct(keys, seed, seg_len, seg_count)
        if made is not None:
            return seed, seg_len, seg_count, made.tobytes()
        if seed % 8 == 0:
            slots += slots // 8 + seg_len
    raise RuntimeError("no binary-fuse filter found")


def _construct(keys, seed, seg_len, seg_count):
    n, size = len(keys), (seg_count + 2) * seg_len
    h = _mix(keys, seed)
    at = _slots(h, seg_len, seg_count)
    degree = np.bincount(at.ravel(), minlength=size)
    # the xor of the key numbers in a slot is the key's number once one key is left there
    owner = np.zeros(size, np.int64)
    for k in range(3):
        np.bitwise_xor.at(owner, at[k], np.arange(n))
    rounds, left = [], n
    front = np.flatnonzero(degree == 1)
    while len(front):
        key, first = np.unique(owner[front], return_index=True)
        slot = front[first]
        rounds.append((key, slot))
        left -= len(key)
        touched = at[:, key].ravel()
        np.subtract.at(degree, touched, 1)
        np.bitwise_xor.at(owner, touched, np.tile(key, 3))
        touched = np.unique(touched)
        front = touched[degree[touched] == 1]
    if left:
        return None
    prints, out = _print(h), np.zeros(size, np.uint16)
    for key, slot in reversed(rounds):
        out[slot] = 0
        three = at[:, key]
        out[slot] = prints[key] ^ out[three[0]] ^ out[three[1]] ^ out[three[2]]
    return out


def probe(keys: np.ndarray, seed: int, seg_len: int, seg_count: int, prints: bytes) -> np.ndarray:
    """For each uint64 key whether the filter may hold it (no false negatives, about 1 in 65,536 false positives)."""
    table = np.frombuffer(prints, np.uint16)
    h = _mix(np.asarray(keys, dtype=np.uint64), seed)
    at = _slots(h, seg_len, seg_count)
    return _print(h) == (table[at[0]] ^ table[at[1]] ^ table[at[2]])
