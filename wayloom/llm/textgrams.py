"""Hashes of words and word runs, for whole Arrow batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_128_digest

#: Bytes of text that are hashed at once.
SLICE_BYTES = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_slices(column: pa.Array):
    """(first row, data, offsets) of runs of rows of at most SLICE_BYTES, or of one longer row; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    ends = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE_BYTES, side="right")) - 1)
        yield row, whole[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of all words (runs without ASCII white space, A-Z as a-z), and the number of words of each row.

    Arrow cuts the texts and finds the distinct words; each is hashed once, by
    the two halves of XXH3's 128 bits.
    """
    texts = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data)])
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    words, ends = lists.values, np.asarray(lists.offsets)
    told = words.dictionary_encode()
    both = b"".join(map(xxh3_128_digest, told.dictionary.cast(pa.large_binary()).to_pylist()))
    hashes = np.frombuffer(both, _U).reshape(-1, 2)
    # the split leaves an empty word before white space that begins a text, and after such that ends it
    real = np.asarray(pc.binary_length(words)) > 0
    at = np.asarray(told.indices)[real]
    counts = np.diff(np.concatenate(([0], np.cumsum(real)))[ends])
    return hashes[at, 0], hashes[at, 1], counts


def _multipliers(width: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, width, dtype=_U) * _U(2) + _U(1)


def _runs(words: np.ndarray, width: int, odd: np.ndarray) -> np.ndarray:
    """Hashes of all runs of width words."""
    out = np.zeros(max(len(words) - width + 1, 0), dtype=_U)
    for j in range(width):
        out += words[j : j + len(out)] * odd[j]
    return mix(out)


def shingle_sets(column: pa.Array, width: int):
    """(row, sorted distinct hashes of its runs of width words, sum of their second hashes) for each row of a text column.

    A row with fewer words, but not none, has its whole sequence as one shingle.
    The sum is of the distinct runs' second hashes, which come from other halves
    of the words' hashes, so it tells sets apart whose first hashes agree.
    """
    odd, even = _multipliers(width, 7), _multipliers(width, 8)
    for first, data, offsets in text_slices(column):
        words, others, counts = word_hashes(data, offsets)
        runs, seconds = _runs(words, width, odd), _runs(others, width, even)
        at = 0
        for k, n in enumerate(counts.tolist()):
            if n >= width:
                mine = slice(at, at + n - width + 1)
                order = np.argsort(runs[mine])
                s = runs[mine][order]
                new = np.concatenate(([True], s[1:] != s[:-1]))
                s, total = s[new], int(seconds[mine][order[new]].sum(dtype=_U))
            elif n:
                short = [_U(sum(int(w) * int(o) for w, o in zip(x[at : at + n], m)) + n & (1 << 64) - 1) for x, m in ((words, odd), (others, even))]
                pair = mix(np.array(short, dtype=_U) ^ _U(0x5851F42D4C957F2D))
                s, total = pair[:1], int(pair[1])
            else:
                s, total = runs[:0], 0
            yield first + k, s, total
            at += n
