"""Stream VByte (Lemire, Kurz & Rupp 2018): byte-aligned integers with separate control bytes, in numpy.

A value takes 1 to 4 data bytes; two bits of a control byte say how many, four
values to a control byte. Control and data bytes form two streams.
"""

from __future__ import annotations

import numpy as np

#: data bytes of the four values of each control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """``(control bytes, data bytes)`` of uint32 values."""
    v = np.ascontiguousarray(values, dtype="<u4")
    more = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = more
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4) <= more[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values; lengths come from the control-byte table."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    d = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    out = d[at] | d[at + 1] << np.uint32(8) | d[at + 2] << np.uint32(16) | d[at + 3] << np.uint32(24)
    return out & MASKS[lengths]
