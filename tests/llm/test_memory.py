"""Memory of the tasks that find repeated passages, by the bytes they hold."""

import random
import tracemalloc

import numpy as np

from ledgerlift.llm.bwtmerge import repeated_windows
from ledgerlift.llm.regions import Winnower


def peak_of(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_places_are_kept_in_32_bits():
    rng = random.Random(3)
    passage = rng.randbytes(4000)
    strings = [passage[a:a + 300] for a in (rng.randrange(3700) for _ in range(1200))]
    size = sum(map(len, strings))
    assert peak_of(lambda: repeated_windows(strings, np.ones(len(strings), np.int64), 200)) < 100 * size


def test_regions_are_found_a_few_windows_at_a_time():
    data = np.frombuffer(random.Random(4).randbytes(1 << 20), np.uint8)

    def work():
        for _ in Winnower(200).regions(data, np.array([len(data)])):
            pass

    assert peak_of(work) < 48 << 20
    whole = [x for part in Winnower(200).regions(data, np.array([len(data)])) for x in zip(*part, strict=True)]
    # pieces follow each other without a gap, so no window is lost where a part ends
    assert all(a + n == b for (a, n, _), (b, _, _) in zip(whole, whole[1:], strict=False))
    assert whole[0][0] == 0 and sum(n for _, n, _ in whole) == len(data) - 199
