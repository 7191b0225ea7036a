"""64-bit hashes of the words of a text, computed for all words at once."""

from __future__ import annotations

#: Odd multiplier of the polynomial and of the mixers.
BASE, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


class WordHasher:
    """Keeps the powers of the polynomial between texts; one per worker."""

    def __init__(self, seed: int = 11):
        import numpy as np

        self.np = np
        self.letters = np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64)
        self.power = self.inverse = np.ones(1, np.uint64)
        self.grow(4096)

    def grow(self, n: int) -> None:
        np = self.np
        if n >= len(self.power):
            size = 1 << n.bit_length()
            base, inv = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
            base[0] = inv[0] = 1
            self.power, self.inverse = np.cumprod(base), np.cumprod(inv)

    def mix(self, x):
        """A bijection that spreads every bit."""
        np = self.np
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
        return x ^ (x >> np.uint64(31))

    def words(self, words: list[bytes]):
        """One hash a word: a polynomial over random letters, modulo 2^64, mixed."""
        np = self.np
        if not words:
            return np.empty(0, np.uint64)
        line = b" ".join(words) + b" "
        self.grow(len(line))
        raw = np.frombuffer(line, np.uint8)
        sums = np.cumsum(self.letters[raw] * self.power[: len(raw)])
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        upto = sums[ends - 1]
        starts = np.concatenate([[0], ends[:-1] + 1])
        before = sums[starts - 1]
        before[0] = 0
        return self.mix((upto - before) * self.inverse[starts])

    def shingles(self, hashes, k: int):
        """One hash for every k words in a row; all words as one shingle, if fewer (none without words)."""
        np = self.np
        n = len(hashes)
        if n == 0:
            return hashes
        if n < k:
            return self.mix(np.array([self.row(hashes)]) + np.uint64(n))
        out = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            out = self.mix(out + hashes[i : n - k + 1 + i]) if i else hashes[: n - k + 1] * np.uint64(MIX_2)
        return out

    def row(self, hashes):
        """One hash of a sequence."""
        np = self.np
        self.grow(len(hashes))
        return (hashes * self.power[: len(hashes)]).sum(dtype=np.uint64)
