"""The binary Golay code of length 23 and the fuzzy keys it gives to segments of a fingerprint.

The code is perfect: each word of 23 bits lies within three bits of exactly one of 4096 codewords.
"Key" below is the index (12 bits) of a codeword near a word.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
GENERATOR = 0b110001110101
LENGTH, CHECK_BITS = 23, 11


@cache
def nearest() -> np.ndarray:
    """The key of the codeword nearest to each word."""
    data = np.arange(1 << (LENGTH - CHECK_BITS), dtype=np.uint32) << np.uint32(CHECK_BITS)
    rest = data.copy()
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        high = (rest >> np.uint32(bit)) & np.uint32(1)
        rest ^= high * np.uint32(GENERATOR << (bit - CHECK_BITS))
    codewords = data | rest
    single = [1 << i for i in range(LENGTH)]
    errors = [0] + single + [a | b for a in single for b in single if a < b]
    errors += [a | b | c for a in single for b in single if a < b for c in single if b < c]
    table = np.empty(1 << LENGTH, np.uint16)
    for error in errors:
        table[codewords ^ np.uint32(error)] = (codewords >> np.uint32(CHECK_BITS)).astype(np.uint16)
    return table


def keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of words of ``bits`` bits (23 at most): a matrix, and which of its entries count.

    The second result marks a set of keys of which two words at most two bits apart share one: the
    keys of all words one bit away.  The third marks a smaller set that does for one bit: a word's
    own key, and those of neighbours that are smaller, since of two adjacent words with different
    keys either has the other's among its neighbours'.
    """
    table = nearest()
    flips = np.append(0, 1 << np.arange(bits)).astype(np.uint32)
    own = table[words]
    found = np.sort(table[words.astype(np.uint32)[:, None] ^ flips], axis=1)
    far = np.ones(found.shape, bool)
    far[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, far, far & (found <= own[:, None])
