"""Hilbert orders of projected vectors (Skilling's transform, AIP Conf. Proc. 707, 2004), and codes of one byte a component.

An order projects vectors on a few random directions, brings every coordinate to the unit interval by the spread of a
sample, shifts it by an offset of its own, and numbers the cells of a grid along a Hilbert curve. The lowest bits of a
key are a hash of the id, so that rows of one cell fall on both sides of a border between ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from spendlens.llm import common

MOST_DIMENSIONS, CELL_BITS, TIE_BITS = 8, 32, 31
SHIFT = 0.25  # of the unit interval
SEED = 12


def along_curve(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates (n x dimensions, each below 2^bits)."""
    x = cells.T.astype(np.uint64)
    dimensions = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(dimensions):
            upper = (x[i] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(upper, below, 0) ^ swap
            x[i] ^= swap
    for i in range(1, dimensions):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint64(1 << level)) != 0, np.uint64((1 << level) - 1), 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dimensions):
            place = (place << one) | ((x[i] >> np.uint64(level)) & one)
    return place


@dataclass
class Orders:
    """Several orders, and the code, fitted to a sample of vectors (n x width)."""

    directions: np.ndarray  # orders x width x dimensions
    shifts: np.ndarray  # orders x dimensions
    middle: np.ndarray
    spread: np.ndarray
    bits: int
    low: np.ndarray  # of each component, for the codes
    step: np.ndarray

    @staticmethod
    def fitted(sample: np.ndarray, orders: int, seed: int = SEED) -> Orders:
        width = sample.shape[1]
        dimensions = min(MOST_DIMENSIONS, width)
        draw = np.random.default_rng(seed)
        directions = np.stack([np.linalg.qr(draw.normal(size=(width, width)))[0][:, :dimensions] for _ in range(orders)])
        along = np.einsum("nw,owd->ond", sample, directions)
        low, high = sample.min(axis=0), sample.max(axis=0)
        return Orders(
            directions, draw.uniform(0, SHIFT, (orders, dimensions)), along.mean(axis=1), along.std(axis=1) + 1e-12,
            min(16, CELL_BITS // dimensions), low, np.maximum(high - low, 1e-12) / 255,
        )

    def keys(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Keys (orders x n) of vectors (n x width)."""
        ties = common.mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - TIE_BITS)
        out = np.empty((len(self.directions), len(ids)), dtype=np.int64)
        for k, directions in enumerate(self.directions):
            z = np.clip((vectors @ directions - self.middle[k]) / self.spread[k], -8, 8)
            unit = (1 - SHIFT) / (1 + np.exp(-1.7 * z)) + self.shifts[k]  # about the normal distribution
            cells = np.minimum((unit * (1 << self.bits)).astype(np.int64), (1 << self.bits) - 1)
            out[k] = ((along_curve(cells, self.bits) << np.uint64(TIE_BITS)) | ties).view(np.int64)
        return out

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        return np.clip(np.rint((vectors - self.low) / self.step), 0, 255).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return codes.astype(np.float32) * self.step.astype(np.float32) + self.low.astype(np.float32)
