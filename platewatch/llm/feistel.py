"""Keyed permutations of the numbers below any size: Feistel networks with cycle-walking."""

import hashlib

import numpy as np

ROUNDS = 8


def permute(value: int, size: int, key: bytes, tweak: bytes = b"") -> int:
    """A permutation of 0 .. size - 1 for each key and tweak, by Python's whole numbers."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            data = tweak + bytes([i]) + right.to_bytes(width, "big")
            noise = int.from_bytes(hashlib.blake2b(data, key=key, digest_size=width).digest(), "big")
            left, right = right, left ^ (noise & mask)
        value = left << half | right
        if value < size:
            return value


def permute_array(values: np.ndarray, size: int, key: int) -> np.ndarray:
    """The same construction over arrays of unsigned 64-bit numbers, with a multiplicative round."""
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)
    out = values.astype(np.uint64)
    walking = np.ones(len(out), bool)
    while walking.any():
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            noise = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            noise = (noise ^ noise >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ (noise >> np.uint64(20) & mask)
        out[walking] = left << half | right
        walking = out >= np.uint64(size)
    return out
