"""Texts of Arrow batches as words, word hashes and n-gram hashes in numpy arrays.

Texts are handled as UTF-8 bytes. Both word classes below hold every byte over 0x7F, so words of
bytes are words of characters.
"""

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Lower-cases A-Z; separators of the class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ become spaces.
ALNUM = bytes(
    32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b
    for b in bytes(range(256)).lower()
)
#: Bytes that separate words of the class [^\x20\x09-\x0D]+.
SPACES = b" \t\n\r\x0b\x0c"

CHUNK_BYTES = 2 << 20
HASH_BYTES = 1 << 20
LONG_WORD = 1 << 12

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_PLACE = _random.integers(0, 1 << 64, LONG_WORD, dtype=np.uint64) | np.uint64(1)
_WORD = _random.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_SEPARATOR = np.isin(np.arange(256), list(SPACES))


class Words(NamedTuple):
    """Words of several texts: their bytes lie at ``data[start:end]``; ``first`` has one entry
    per text and one more: the words of text i are first[i] to first[i + 1]."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: list[bytes], table: bytes | None = None) -> Words:
    """Words between white space, after the bytes went through ``table``."""
    data = b" ".join(texts) + b" "
    if table:
        data = data.translate(table)
    separator = _SEPARATOR[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(separator, prepend=True))
    start, end = edge[::2], edge[1::2]
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, start, end, np.searchsorted(start, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hashes of the words, in slices, so that a long text takes little extra memory."""
    out = np.empty(len(words.start), np.uint64)
    data, at = np.frombuffer(words.data, np.uint8), 0
    long = np.flatnonzero(words.end - words.start > LONG_WORD)
    while at < len(out):
        to = max(at + 1, int(np.searchsorted(words.end, words.start[at] + HASH_BYTES)))
        start, length = words.start[at:to], words.end[at:to] - words.start[at:to]
        before = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(before, length)
        terms = _BYTE[data[np.repeat(start, length) + place]] * _PLACE[place & (LONG_WORD - 1)]
        out[at:to] = np.add.reduceat(terms, before)
        at = to
    for i in long:
        out[i] = int.from_bytes(blake2b(words.word(i), digest_size=8).digest(), "little")
    return mix(out)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of consecutive entries; n - 1 fewer than there are entries."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total += hashes[j : j + count] * _WORD[j]
    return mix(total)


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``most`` bytes of text, one row at least, and the texts
    (null: empty) of each.

    What Arrow keeps of batches that are done goes back to the system: a worker process lives on
    between tasks and stages, and shares the memory of its executor.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        lengths = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths), 0
        while at < len(ends):
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            part = batch.slice(at, to - at)
            yield part, [t or b"" for t in values.slice(at, to - at).to_pylist()]
            at = to
        batch = values = part = None
        pa.default_memory_pool().release_unused()


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """Tables of rows with equal keys, of a stream that is sorted by them."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for p in parts:
            new |= pc.not_equal(p[1:], p[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if kept and (
                a or any(kept[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
            ):
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(a, b - a))
    if kept:
        yield pa.Table.from_batches(kept)
