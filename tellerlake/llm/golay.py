"""The perfect (23, 12) binary Golay code on arrays of 23-bit words.

Every word is at most three bits from exactly one codeword. The code is cyclic:
its words are the multiples of a generator polynomial.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

BITS = 23
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101


def _remainders() -> np.ndarray:
    """x^i modulo the generator."""
    out, value = [], 1
    for _ in range(BITS):
        out.append(value)
        value <<= 1
        if value >> 11:
            value ^= GENERATOR
    return np.array(out, np.uint32)


class Golay:
    def __init__(self):
        powers = _remainders()
        low, high = np.zeros(1 << 12, np.uint32), np.zeros(1 << 11, np.uint32)
        for i in range(BITS):
            table, bit = (low, i) if i < 12 else (high, i - 12)
            table[(np.arange(len(table)) >> bit) & 1 == 1] ^= powers[i]
        self.low, self.high = low, high
        #: The error of weight three or less that leaves each remainder.
        self.error = np.zeros(1 << 11, np.uint32)
        for weight in (1, 2, 3):
            for bits in combinations(range(BITS), weight):
                self.error[np.bitwise_xor.reduce(powers[list(bits)])] = sum(1 << b for b in bits)

    def nearest(self, words: np.ndarray) -> np.ndarray:
        """The 12-bit index of the codeword nearest to each word."""
        remainder = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.error[remainder]) >> 11

    def nearby(self, words: np.ndarray) -> np.ndarray:
        """Per word a row of indices: of its own codeword and of those of its 23 neighbours, sorted.

        Words that differ in two bits or fewer have a neighbour in common, hence an index.
        """
        flips = np.concatenate([[0], 1 << np.arange(BITS)]).astype(np.uint32)
        return np.sort(self.nearest(words[:, None] ^ flips[None, :]), axis=1)
