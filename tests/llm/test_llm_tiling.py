"""Tiling on repetitive texts, and the hits of a block against brute force."""
import random
import time
import tracemalloc

import numpy as np
from test_llm_text import brute_tiles

from orderlens.llm import decontaminate


def test_hits_brute():
    random.seed(12)
    found = 0
    for round_ in range(150):
        few = [f"w{i}" for i in range(random.choice([2, 4, 30]))]
        items = [(i, " ".join(random.choice(few) for _ in range(random.randint(0, 16)))) for i in range(5)]
        block = decontaminate.Block(items, 5)
        source = " ".join(t for _, t in random.sample(items, 2)).split()
        cut = random.randint(0, len(source))
        words = source[cut:] + [random.choice(few + ["other"]) for _ in range(random.randint(0, 20))] + source[:cut]
        want = []
        for item_id, item in items:
            got = brute_tiles(words, item.split(), 5)
            share = sum(n for n, _, _ in got) / max(len(item.split()), 1)
            if share >= 0.8:
                want.append((item_id, share, len(got)))
        assert sorted(block.hits(" ".join(words), 0.8)) == sorted(want), round_
        found += len(want)
    assert found > 50


def test_repetitive_texts_stay_small():
    """A text of 100,000 equal words that an item repeats too, and one of two words."""
    random.seed(13)
    two = lambda n: " ".join(random.choice("ab") for _ in range(n))
    for item, text, share in (("spam " * 400, "spam " * 100000, 1.0), ("to be " * 200, "to be " * 50000, 1.0),
                              (two(400), two(100000), 0.8)):
        block = decontaminate.Block([(1, item)], 5)
        began = time.time()
        tracemalloc.start()
        hits = block.hits(text, 0.8)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert hits and hits[0][1] >= share and peak < 100e6 and time.time() - began < 30


def test_colliding_hashes_are_compared():
    """Windows of a Thue-Morse sequence and of its complement have equal hashes."""
    signs = [0]
    while len(signs) < 4096:
        signs += [1 - s for s in signs]
    x = np.array(signs, np.int64) + 1
    hashes = decontaminate.Windows(np.concatenate([x, 3 - x])).hashes(4096)
    assert hashes[0] == hashes[4096]
    assert decontaminate.tiles(x, 3 - x, 4096) == []
    a, b = x[:60], (3 - x)[:30]
    assert decontaminate.tiles(a, b, 5) == brute_tiles(a.tolist(), b.tolist(), 5)
