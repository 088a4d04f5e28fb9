import random
import zlib

import numpy as np

from plumage.llm import crc


def test_checksums_of_runs_and_of_joined_runs():
    r = random.Random(2)
    words = [bytes(r.randrange(256) for _ in range(r.choice([1, 2, 3, 5, 9, 63, 64, 65, 200]))) for _ in range(3000)]
    length = np.array([len(w) for w in words])
    end = np.cumsum(length)
    got = crc.crc_of_runs(np.frombuffer(b"".join(words), np.uint8), end - length, end)
    assert got.tolist() == [zlib.crc32(w) for w in words]
    assert crc.append(got[:-1], got[1:], length[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(words, words[1:])]
