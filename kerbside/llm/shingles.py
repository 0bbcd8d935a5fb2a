"""Word shingles of many texts at once, as 64-bit hashes."""

import numpy as np

from kerbside.llm.wordcache import mix, piece_hashes

WORDS = 5
# Odd multipliers, one per word of a shingle, and a seed for texts of fewer words.
_STEP = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_SHORT = np.uint64(0x2545F4914F6CDD1D)


def shingles(texts):
    """``(owner, hashes)``: the distinct shingles of each text, by owner and then by hash.

    A-Z are lowered; words are runs of anything but blanks and the characters 9 to 13. A text of fewer than five
    words has its whole sequence as one shingle, one without words none.
    """
    raw = [t.encode() for t in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    upper = (data >= 65) & (data <= 90)
    data = data | (upper.astype(np.uint8) << 5)
    word = (data != 32) & ~((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = piece_hashes(data, starts, ends)
    owner = np.searchsorted(begins, starts, "right") - 1
    hashes, owners = [], []
    n = len(words) - WORDS + 1
    if n > 0:
        whole = owner[:n] == owner[WORDS - 1:]
        total = sum((words[k:k + n] * _STEP[k] for k in range(1, WORDS)), words[:n] * _STEP[0])
        hashes.append(mix(total[whole]))
        owners.append(owner[:n][whole])
    counts = np.bincount(owner, minlength=len(texts))
    few = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(few):
        first = np.searchsorted(owner, few)
        total = mix(counts[few].astype(np.uint64) + _SHORT)
        for k in range(WORDS - 1):
            has = counts[few] > k
            total[has] += words[first[has] + k] * _STEP[k]
        hashes.append(mix(total))
        owners.append(few)
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return owners[fresh], hashes[fresh]
