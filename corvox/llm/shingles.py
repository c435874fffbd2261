"""Sets of word shingles, hashed to 64 bits in numpy, whole batches of texts at a time.

Words are the runs of bytes other than blank and \\x09-\\x0D after lower-casing A-Z. A text's
set holds its distinct shingles of ``size`` words; with fewer words, the whole sequence as
one. Equal shingles have equal hashes. A word's hash mixes its bytes eight at a time by
bijections that aren't linear (words over ``LONG`` bytes go through XXH3), a shingle's
those of its words in order; with each of the two seeds, different shingles meet with odds
of about 2**-64 a pair, and independently of the other seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

BATCH_BYTES = 1 << 17
LONG = 32
U = np.uint64
PRIME, MIX1, MIX2 = U(0x9E3779B97F4A7C55), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
SEEDS = (U(0x243F6A8885A308D3), U(0x13198A2E03707344))
FACTORS = (PRIME, U(0xD1B54A32D192ED03))
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * MIX1
    h = (h ^ (h >> U(27))) * MIX2
    return h ^ (h >> U(31))


def word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each word ``joined[start:end]``; LONG + 8 bytes must follow the last start."""
    size = ends - starts
    eight = np.ndarray(len(joined) - 7, "<u8", joined, 0, (1,))  # the eight bytes from each byte on
    h = mix(size.astype(np.uint64) ^ SEEDS[seed])
    for at in range(0, LONG, 8):
        more = np.flatnonzero(size > at) if at else slice(None)
        if at and not len(more):
            break
        part = eight[starts[more] + at] & MASKS[np.minimum(size[more] - at, 8)]
        h[more] = mix((h[more] + SEEDS[seed]) ^ part)
    for k in np.flatnonzero(size > LONG).tolist():
        h[k] = xxhash.xxh3_64_intdigest(joined[starts[k] : ends[k]], int(SEEDS[seed]))
    return h


def _batch(raw: list[bytes], size: int, seeds: tuple[int, ...]) -> list:
    joined = b"\n".join(raw) + b"\n" * (LONG + 9)
    data = np.frombuffer(joined, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], SEPARATOR[data]]).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum([len(r) + 1 for r in raw])
    last = np.searchsorted(starts, bounds)
    first = np.concatenate([[0], last[:-1]])
    words = [word_hashes(joined, starts, ends, s) for s in seeds]
    shingles = []
    for word, s in zip(words, seeds, strict=True):
        shingle = np.zeros(max(0, len(word) - size + 1), np.uint64)
        for k in range(size):
            shingle = shingle * FACTORS[s] + word[k : k + len(shingle)]
        shingles.append(mix(shingle))
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= size:
            found = [s[a : b - size + 1] for s in shingles]
            if len(found) == 1:
                s = np.sort(found[0])
                found = [s[np.concatenate([[True], s[1:] != s[:-1]])]]
            else:
                _, at = np.unique(found[0], return_index=True)
                found = [s[at] for s in found]
        elif b > a:
            found = []
            for word, s in zip(words, seeds, strict=True):
                h = U(b - a)
                with np.errstate(over="ignore"):
                    for w in word[a:b]:
                        h = h * FACTORS[s] + w
                found.append(mix(np.array([h], np.uint64)))
        else:
            found = [np.zeros(0, np.uint64)] * len(seeds)
        out.append(found[0] if len(found) == 1 else tuple(found))
    return out


def shingle_sets(texts: list[str | None], size: int = 5, seeds: tuple[int, ...] = (0,)) -> Iterator:
    """The distinct shingle hashes of each text, sorted by the first seed's; null counts as empty.
    With two seeds a pair of arrays a text, one shingle at each place of both."""
    raw: list[bytes] = []
    held = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        raw.append(data)
        held += len(data)
        if held >= BATCH_BYTES:
            yield from _batch(raw, size, seeds)
            raw, held = [], 0
    if raw:
        yield from _batch(raw, size, seeds)
