"""Character n-gram features of words, hashed into buckets, for whole arrays of words."""

from __future__ import annotations

import string

import numpy as np

from .arrays import Rolling, mix

EDGE = string.punctuation + string.digits


def plain_words(raw: list[bytes]) -> list[str]:
    """Lower case, without ASCII punctuation and digits at both ends ('' if nothing is left)."""
    if not raw:
        return []
    return [x.strip(EDGE) for x in b"\n".join(raw).decode().lower().split("\n")]


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of '<word>' for every word, end to end, and their bounds."""
    text = "".join([f"<{x}>" for x in words])
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), np.concatenate([[0], np.cumsum(size)])


def grams(words: list[str], low: int, high: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of all character n-grams of low to high characters, edge marks included."""
    code, bounds = codes(words)
    row = np.repeat(np.arange(len(words)), np.diff(bounds))
    roll = Rolling(mix(code.astype(np.uint64) + np.uint64(1)))
    feature, owner = [], []
    for n in range(low, high + 1):
        every = roll.every(n)
        if not len(every):
            continue
        ok = row[: len(every)] == row[n - 1:]
        feature.append((every[ok] % np.uint64(buckets)).astype(np.int64))
        owner.append(row[: len(every)][ok])
    if not feature:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(feature), np.concatenate(owner)


def whole_and_affixes(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of each word itself and of its prefixes and suffixes of the given sizes, each kind apart."""
    code, bounds = codes(words)
    roll = Rolling(mix(code.astype(np.uint64) + np.uint64(1)))
    start, end = bounds[:-1] + 1, bounds[1:] - 1
    every = np.arange(len(words))
    feature, owner = [roll.of(bounds[:-1], bounds[1:])], [every]
    for n in sizes:
        ok = end - start >= n
        for kind, (a, b) in enumerate(((start[ok], start[ok] + n), (end[ok] - n, end[ok]))):
            feature.append(roll.of(a, b) ^ np.uint64(0x9E3779B97F4A7C15 * (kind + 1) % 2**64))
            owner.append(every[ok])
    return (np.concatenate(feature) % np.uint64(buckets)).astype(np.int64), np.concatenate(owner)


def add_up(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of ``values`` by index, for one or more columns."""
    if values.ndim == 1:
        return np.bincount(at, values, n)
    return np.stack([np.bincount(at, values[:, k], n) for k in range(values.shape[1])], axis=1)


class Adam:
    """Adam steps for one array."""

    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, w: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        w -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)
