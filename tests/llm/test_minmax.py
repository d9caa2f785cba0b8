import random

import numpy as np

from turnout.llm import minmax
from turnout.llm.minmax import alike, band_keys, confirmed, miss, near_copies, signatures


def sets_of(rows, n):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        count = max(1, len(words) - n + 1)
        out.append({tuple(words[i : i + n]) for i in range(count)} if words else set())
    return out


def brute(rows, n=2):
    sets, parent = sets_of(rows, n), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def got(frame, id="doc_id"):
    rows = frame.collect()
    return sorted([(r[id], r.n_shingles, r.component_id) for r in rows], key=repr), rows


def edited(rng, words, share):
    return [w if rng.random() > share else f"e{rng.randrange(99)}" for w in words]


def test_equals_brute_force(spark, documents):
    rng = random.Random(12)
    rows = []
    for family in range(6):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.choice([5, 30, 120, 300]))]
        for _ in range(14):
            base = edited(rng, base, rng.choice([0, 0.005, 0.04]))
            rows.append((1000 * family + rng.randrange(900), " ".join(base)))
    rows += [(9000, ""), (9001, None), (9002, " \t "), (9003, "One"), (9004, "one "), (9005, "two")]
    rows += [(None, "one"), (None, None), (9003, "One"), (9003, "one two three four"), (9006, "é É")]
    rows += [(9100 + i, "same text again and again") for i in range(40)]
    rows += [(9200, "w " * 60000 + "end"), (9201, "W " * 60000 + "end")]
    found, all_rows = got(near_copies(documents(rows)))
    assert found == brute(rows)
    firsts = [r for r in all_rows if r.is_first]
    # One row of each component; rows without a set are all alone.
    linked = [r.component_id for r in firsts if r.n_shingles and r.component_id != 9003]
    assert len(linked) == len(set(linked))
    assert {r.component_id for r in all_rows if r.n_shingles} == {*linked, 9003}


def test_templates_and_small_blocks(spark, documents, monkeypatch):
    """Texts near the border share buckets but few links: all pairs across components are met."""
    monkeypatch.setattr(minmax, "BLOCK", 3)
    monkeypatch.setattr(minmax, "MINORS", 3)
    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = [f"t{j}" for j in range(60)]
        for at in rng.sample(range(60), rng.randrange(5)):
            words[at] = f"own{rng.randrange(8)}"
        rows.append((i, " ".join(words)))
    found, _ = got(near_copies(documents(rows)))
    assert found == brute(rows)


def test_other_lengths_and_empty_table(spark, documents):
    rows = [(i, " ".join(f"w{(i // 3, j)[j > 1]}" for j in range(20))) for i in range(9)]
    assert got(near_copies(documents(rows), n=3, percent=90))[0]
    assert near_copies(documents([])).count() == 0
    assert got(near_copies(documents([(None, None)])))[0] == [(None, 0, None)]


def test_estimate_is_unbiased_and_varies_less():
    rng = np.random.default_rng(6)
    found, single = [], []
    for _ in range(150):
        entries = rng.integers(0, 1 << 64, 250, dtype=np.uint64)
        a, b = signatures([entries[:200], entries[50:]])  # 150 of 250
        found.append((a == b).mean())
        single.append((a == b)[: minmax.PERMUTATIONS].mean())
    assert abs(np.mean(found) - 0.6) < 0.006
    independent = 0.6 * 0.4 / (2 * minmax.PERMUTATIONS)
    assert np.var(found) < 1.3 * independent
    assert np.var(found) < 0.7 * np.var(single)
    assert miss(0.8) < 1e-6


def test_buckets_of_a_similarity():
    rng = np.random.default_rng(7)
    shared = 0
    for _ in range(400):
        entries = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
        keys = band_keys(signatures([entries[:54], entries[6:]]))  # 48 of 60
        shared += bool((keys[0] == keys[1]).any())
    assert shared == 400


def test_confirmed_and_alike_directly(spark):
    docs = spark.createDataFrame(
        [(i, bytearray(t.encode())) for i, t in enumerate(["a b c d", "A B C D", "a b c x", "q"])],
        "_row long, _text binary",
    )
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "a long, b long")
    assert [tuple(r) for r in confirmed(pairs, docs, 2, 80).collect()] == [(0, 1)]
    signature = bytearray(288)
    rows = [(1, 0, 0, 0, i, i // 2, 10, [7, 1, i % 2], signature) for i in range(4)]
    ddl = "bucket long, i long, j long, side int, _row long, part long, size long, buckets array<long>"
    found = alike(spark.createDataFrame(rows, f"{ddl}, signature binary"), 80).collect()
    assert found == []  # all share bucket 7 before
    rows = [(7, *row[1:]) for row in rows]
    found = alike(spark.createDataFrame(rows, f"{ddl}, signature binary"), 80).collect()
    assert sorted(tuple(r) for r in found) == [(0, 2), (0, 3), (1, 2), (1, 3)]


def test_large_group_with_strangers(spark, documents, monkeypatch):
    """Strangers meet a large group in many buckets; some are linked to one of its rows alone."""
    monkeypatch.setattr(minmax, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"b{j}" for j in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(80), 3 if i < 110 else rng.randrange(4, 9)):
            words[at] = f"own{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    found, _ = got(near_copies(documents(rows)))
    expected = brute(rows)
    assert found == expected and len({c for _, _, c in expected}) > 3
