import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from turnout.llm.components import components
from turnout.llm.jaccard_join import (
    divide_skip,
    jaccard_components,
    least_overlap,
    one_of_each,
    t_occurrence,
)


def sets_of(rows):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        out.append(grams)
    return out


def brute(rows):
    sets, parent = sets_of(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return out


def edited(rng, words, share):
    return [w if rng.random() > share else f"e{rng.randrange(99)}" for w in words]


def cases():
    rng = random.Random(8)
    rows = []
    for family in range(6):
        base = [f"f{family}w{rng.randrange(40)}" for _ in range(rng.choice([6, 30, 120, 300]))]
        for k in range(14):
            # A chain of copies: its ends are not alike, but each is like its neighbour.
            base = edited(rng, base, rng.choice([0, 0.005, 0.02]))
            rows.append((1000 * family + rng.randrange(900), " ".join(base)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(7000 + i, f"{' '.join(edited(rng, ['z'] * 70, 1))} {passage}") for i in range(25)]
    rows += [(8000, rows[3][1]), (8001, rows[3][1].upper()), (rows[4][0], rows[4][1]), (None, rows[5][1])]
    rows += [(None, None), (9000, ""), (9001, " \n"), (9002, "one two"), (9003, "One\ttwo"), (9004, "two one")]
    rows += [(9005, "a " * 4000), (9006, "a a a a a"), (9007, "a a a a"), (None, "lonely text")]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(documents):
    rows = cases()
    found = jaccard_components(documents(rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_one_row_of_each_component_stays(documents):
    rows = cases()
    kept = [r.doc_id for r in one_of_each(documents(rows)).collect()]
    sets = sets_of(rows)
    expected = {(c, i if not s else None) for i, (s, (_, _, c)) in enumerate(zip(sets, brute(rows)))}
    assert len(kept) == len(expected)
    assert {k for k in kept if k is not None} == {c for c, _ in expected if c is not None}


def test_empty_table(documents):
    assert jaccard_components(documents([])).count() == 0
    assert one_of_each(documents([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12)), max_size=14), st.integers(1, 6))
def test_divide_skip_counts_like_a_plain_count(lists, least):
    lists = [sorted(x) for x in lists if x]
    need = [least + i % 3 for i in range(13)]
    expected = [n for n in range(13) if sum(n in x for x in lists) >= need[n]]
    assert sorted(divide_skip(lists, need)) == expected


def test_t_occurrence_is_the_jaccard_threshold():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 62, 100).astype(np.uint64))
    candidates = [np.unique(np.append(base[k:], rng.integers(0, 1 << 62, k % 7).astype(np.uint64))) for k in range(60)]
    candidates.append(np.empty(0, np.uint64))
    expected = [
        i for i, c in enumerate(candidates)
        if 100 * len(np.intersect1d(base, c)) >= 80 * len(np.union1d(base, c))
    ]
    assert sorted(t_occurrence(base, candidates, 80)) == expected
    assert least_overlap(100, 100, 80) == 89


def test_components_of_random_links(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    pairs += [(i, i + 1) for i in range(300, 400)] + [(500, i) for i in range(501, 600)] + [(None, 3), (4, 4)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    frame = spark.createDataFrame(pairs, "a long, b long")
    found = {tuple(r) for r in components(frame).collect()}
    assert found == {(i, root(i)) for i in parent if root(i) != i}
