"""Pairs at the threshold of a rule share a band."""

import numpy as np
import pytest

from tidewatch.llm import minhash


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_become_candidates(percent):
    draw, places, missed = np.random.default_rng(percent), minhash.bands_of(percent), 0
    for _ in range(2000):
        every = draw.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)
        both, rest = every[: 10 * percent], every[10 * percent :]
        sides = [minhash.registers(np.sort(np.concatenate((both, x)))) for x in (rest[::2], rest[1::2])]
        keys = [set(minhash.band_keys(x, places)) for x in sides]
        missed += not keys[0] & keys[1]
    assert missed == 0
