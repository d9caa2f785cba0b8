import random
from collections import Counter

import numpy as np

from turnout.llm.substring_dedup import dedup_substrings, repeated_windows, sliding_least


def brute(rows, window):
    count = Counter()
    split = [(t or "").encode().split() for _, t in rows]
    for words in split:
        for at in range(len(words) - window + 1):
            count[tuple(words[at : at + window])] += 1
    out = []
    for (doc_id, _), words in zip(rows, split):
        gone = set()
        for at in range(len(words) - window + 1):
            if count[tuple(words[at : at + window])] > 1:
                gone |= set(range(at, at + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((doc_id, len(words), len(gone), kept))
    return out


def check(documents, rows, window, m):
    found = dedup_substrings(documents(rows), window=window, m=m)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"]
    got = sorted([tuple(r) for r in found.collect()], key=repr)
    assert got == sorted(brute(rows, window), key=repr)
    return got


def test_random_texts_against_brute_force(documents):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "b", "é", "A."]) for _ in range(n))
    rows = [(i, text(rng.randrange(0, 40))) for i in range(80)]
    rows += [(None, None), (100, ""), (101, " \t\x0b "), (101, "x"), (102, "a " * 3000), (103, rows[7][1]), (7, rows[7][1])]
    assert any(r[2] for r in check(documents, rows, 7, 2))


def test_passages_of_production_length(documents):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, once = words(60), words(34)
    rows = [(i, " ".join(words(50) + shared[i % 9 : 50 + i % 9] + words(20))) for i in range(40)]
    rows += [(50, " ".join(words(9) + once)), (51, " ".join(once + words(9)))]
    twice = words(35)
    rows += [(52, "\n".join(twice + words(3) + twice)), (53, " ".join(words(400)))]
    got = {r[0]: r for r in check(documents, rows, 35, 4)}
    assert got[50][2] == 0 and got[52][2] == 70 and got[53][2] == 0


def test_empty_table(documents):
    assert dedup_substrings(documents([])).count() == 0


def test_helpers():
    keys = np.array([5, 1, 4, 2, 9, 3, 3], np.uint64)
    for width in range(1, 8):
        expected = [min(keys[i : i + width]) for i in range(len(keys) - width + 1)]
        assert sliding_least(keys, width).tolist() == expected
    strings = [b"a b c d", b"x b c y", b"q", b"a b"]
    assert repeated_windows(strings, np.array([1, 1, 1, 2]), 2) == [[(0, 2)], [(1, 2)], [], [(0, 1)]]
    assert repeated_windows([b"a"], np.array([1]), 2) == [[]]
