"""Min-wise signatures of hashed sets, in Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """A signature of chunks * width symbols of `bits` bits each, and how it is split for lookup.

    `distance` is the largest number of differing symbols that the pigeonhole guarantees to find: of two signatures that
    differ in at most that many, some chunk has at most `errors` of them."""

    chunks: int
    width: int
    errors: int
    bits: int = 15

    def __post_init__(self):
        if not 2 <= self.bits <= 31 or self.chunks < 1 or not 0 <= self.errors < self.width:
            raise ValueError(f"no such layout: {self}")

    @property
    def symbols(self) -> int:
        return self.chunks * self.width

    @property
    def distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1

    @property
    def keys(self) -> int:
        return self.chunks * comb(self.width, self.errors)

    def beyond(self, likeness: float) -> float:
        """The chance that two sets of that likeness differ in more symbols than `distance`."""
        n, p = self.symbols, (1 - likeness) * (1 - 2.0**-self.bits)
        return sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(self.distance + 1, n + 1))


def layout_for(threshold: float, kept: int = 3, bits: int = 15, miss: float = 2e-4) -> Layout:
    """The layout with the fewest keys, of `kept` symbols each, whose distance holds pairs of the threshold's likeness but
    for a chance of `miss`; more alike pairs are missed less."""
    best = None
    for errors in range(7):
        width = kept + errors
        if (errors + 1) / width <= (1 - threshold) * 1.1:  # the distance would lie within the expected differences
            continue
        found = next((x for x in (Layout(c, width, errors, bits) for c in range(1, 65)) if x.beyond(threshold) <= miss), None)
        if found and (best is None or found.keys < best.keys):
            best = found
    if best is None:
        raise ValueError(f"no layout for a likeness of {threshold} with {kept} symbols a key")
    return best


def _multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(values: np.ndarray, starts: np.ndarray, n: int, seed: int = 42, first: int = 0) -> np.ndarray:
    """For each run of values beginning at starts (none empty), its n symbols of 32 bits from the first on: shape (runs, n)."""
    out = np.empty((len(starts), n), dtype=np.uint64)
    mix = values.astype(np.uint64, copy=True)
    mix ^= mix >> np.uint64(31)
    for i, a in enumerate(_multipliers(first + n, seed)[first:]):
        h = mix * a
        h ^= h >> np.uint64(29)
        out[:, i] = np.minimum.reduceat(h * np.uint64(0x9E3779B97F4A7C15), starts)
    return out >> np.uint64(32)


def fold(columns: list[np.ndarray], tag: int) -> np.ndarray:
    """The columns of symbols and the tag as one hash of 64 bits."""
    h = np.full(len(columns[0]), (tag + 1) * 0x9E3779B97F4A7C15 % 2**64, dtype=np.uint64)
    for c in columns:
        h ^= c
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column without nulls and where each list starts."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0]


def multi_index_keys(symbols: np.ndarray, layout: Layout, which: slice = slice(None)) -> np.ndarray:
    """The lookup keys of each signature (or some of them): of each chunk, one for every way to ignore `errors` of its symbols.
    Two signatures that differ in at most layout.distance symbols share a key. symbols: those that are compared, of
    layout.bits bits."""
    ways = [(c * 1000 + j, kept) for c in range(layout.chunks) for j, kept in enumerate(combinations(range(c * layout.width, (c + 1) * layout.width), layout.width - layout.errors))]
    return np.stack([fold([symbols[:, i] for i in kept], tag) for tag, kept in ways[which]], axis=1)


def packed(symbols: np.ndarray, bits: int) -> list[np.ndarray]:
    """The signature as columns of 64 bits, the highest of which is never set."""
    per = 63 // bits
    out = []
    for i in range(0, symbols.shape[1], per):
        word = np.zeros(len(symbols), dtype=np.uint64)
        for j in range(i, min(i + per, symbols.shape[1])):
            word |= symbols[:, j] << np.uint64(bits * (j - i))
        out.append(word.view(np.int64))
    return out


def unpacked(words: list[np.ndarray], layout: Layout) -> np.ndarray:
    """The symbols of packed signatures: shape (rows, symbols)."""
    per, mask = 63 // layout.bits, np.uint64(2**layout.bits - 1)
    return np.stack([words[i // per].view(np.uint64) >> np.uint64(layout.bits * (i % per)) & mask for i in range(layout.symbols)], axis=1)


def columns(layout: Layout) -> list[str]:
    """Names for the columns of a packed signature."""
    return [f"s{i}" for i in range(-(-layout.symbols // (63 // layout.bits)))]


def _masks(bits: int) -> tuple[int, int]:
    """Of a packed word: each symbol's highest bit, and its other bits."""
    ones = sum(1 << (bits * i) for i in range(63 // bits))
    return ones << (bits - 1), ones * (2 ** (bits - 1) - 1)


def differences(pairs: list[tuple[np.ndarray, np.ndarray]], bits: int) -> np.ndarray:
    """differing, of arrays."""
    top, rest = _masks(bits)
    total = np.zeros(len(pairs[0][0]), np.int64)
    for a, b in pairs:
        x = a ^ b
        total += np.bitwise_count((((x & rest) + rest) | x) & top)
    return total


def differing(pairs: list[tuple[Column, Column]], bits: int) -> Column:
    """In how many symbols two packed signatures differ."""
    top, rest = _masks(bits)
    total = F.lit(0)
    for a, b in pairs:
        x = a.bitwiseXOR(b)
        carried = x.bitwiseAND(F.lit(rest)) + F.lit(rest)  # a symbol's highest bit is set if any of its lower ones was
        total = total + F.bit_count(carried.bitwiseOR(x).bitwiseAND(F.lit(top)))
    return total


def gram_hashes(items: Column, n: int) -> Column:
    """The distinct 64-bit hashes of each n consecutive items of an array of strings; empty if it has fewer than n."""

    def hashed(own: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(own) - (n - 1)), lambda i: F.xxhash64(*[F.element_at(own, i + k) for k in range(n)]))
        return F.when(F.size(own) >= n, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))

    return F.element_at(F.transform(F.array(items), hashed), 1)  # bound as a variable, the array is made once and not per gram


def similarity(a: Column, b: Column) -> Column:
    """Shared distinct elements over all distinct elements of two arrays without repeats."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)
