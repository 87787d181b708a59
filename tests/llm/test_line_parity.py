"""Parity maps of lines: a lossless test before texts are compared."""

import numpy as np

from tidepool.llm import line_dedup


def test_parity_maps_never_differ_more_than_their_lines():
    rng = np.random.default_rng(4)
    base = "a rather long line about the weather in the mountains during the cold months of the year number"
    lines = [base] + [base[:i] + w + base[i + k:] for i in range(5, 60, 11) for w in ("x", "other", "") for k in (0, 3)]
    lines += ["".join(rng.choice(list("abcdé "), size=rng.integers(16, 200))) for _ in range(40)] + ["z" * 16, "z" * 500]
    size, maps = line_dedup.parities([x.encode() for x in lines])
    sets = [set(line_dedup.shingles(x).tolist()) for x in lines]
    assert size.tolist() == [len(s) for s in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differ = int(np.bitwise_count(maps[i] ^ maps[j]).sum())
            assert differ <= len(a ^ b)
            if line_dedup.alike(np.array(sorted(a), np.uint64), np.array(sorted(b), np.uint64)):
                assert 9 * differ <= len(a) + len(b)
