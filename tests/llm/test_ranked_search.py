import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from turnout.llm import ranked_search as module
from turnout.llm.ranked_search import kept, ranked_search, term_owners, terms_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, k=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    size = [sum(c.values()) for _, c in held]
    n, total = sum(1 for x in size if x), sum(size)
    df = Counter(w for _, c in held for w in c)
    weight = {w: floor(1000 * log((2 * n + 2) / (2 * c + 1))) for w, c in df.items()}
    out = []
    for item, text in items:
        scores = []
        for (i, counts), x in zip(held, size):
            score = 0
            for w, times in Counter(words(text)).items():
                if w in counts:
                    m = 100 - 75 + (75 * x * n) // total
                    tf = counts[w]
                    score += times * weight[w] * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def got(frame):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()], key=repr)


def corpus(seed, count=300):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(400)] + ["Été", "ÉTÉ", "x9"]
    docs = [
        (i, rng.choice([" ", "\n", "--", "\x7f"]).join(rng.choices(vocabulary, k=rng.randrange(1, 60))))
        for i in range(count)
    ]
    docs += [(1000, None), (1001, ""), (1002, "?!"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (5, "w1 w2 w3")]
    docs += [(2000 + i, "W7 w8 w8") for i in range(30)]  # ties
    docs.append((3000, "w1 w2 " * 30000))
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "unknown words"), (103, "w7 W8 w8"), (103, "w7 W8 w8")]
    items.append((None, "w3"))
    return docs, items


def frames(spark, documents, docs, items):
    asked = spark.createDataFrame(items, "item_id long, text string")
    asked = asked.selectExpr("*", "1 as doc_id", "2 as rank", "3 as score", "4 as `group`")
    return documents(docs), asked


def test_equals_brute_force(spark, documents):
    docs, items = corpus(1)
    assert got(ranked_search(*frames(spark, documents, docs, items))) == brute(docs, items)


@pytest.mark.parametrize("stages", [1, 3, 7])
def test_shards_groups_blocks_and_stages(spark, documents, monkeypatch, stages):
    for name, value in (("SHARD", 40), ("GROUP", 4), ("ITEM_BYTES", 900)):
        monkeypatch.setattr(module, name, value)
    docs, items = corpus(stages)
    found = ranked_search(*frames(spark, documents, docs, items), k=3, stages=stages)
    assert got(found) == brute(docs, items, 3)


def test_empty_tables(spark, documents):
    docs, items = [(1, "a b")], [(1, "a")]
    assert got(ranked_search(*frames(spark, documents, docs, items))) == [(1, 1, 1, brute(docs, items)[0][3])]
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)])):
        assert got(ranked_search(*frames(spark, documents, docs, items))) == []


def test_term_in_all_documents_has_no_weight(spark, documents):
    docs = [(i, "all" + " more" * i) for i in range(2000)]
    items = [(1, "all"), (2, "all more")]
    assert got(ranked_search(*frames(spark, documents, docs, items))) == brute(docs, items)


def test_kept_loses_no_candidate():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = rng.integers(0, 30, 50) * rng.integers(0, 2, 50)
        rest = int(rng.integers(0, 20))
        final = scores + rng.integers(0, rest + 1, 50) * (scores >= 0)
        left = set(kept(scores, rest, 5).tolist())
        fifth = np.sort(scores)[-5]
        assert all(final[i] < fifth or not scores[i] for i in range(50) if i not in left)


def test_owners_are_by_weight_and_even():
    weights, holding = np.array([5, 9, 1, 7]), np.array([10, 1, 80, 9])
    owners = term_owners(weights, holding, 2)
    assert owners.tolist() == [0, 0, 0, 0] or owners[2] >= owners[0] >= owners[3] >= owners[1]
    assert terms_of(b"A-b_c~d\xc3\xa9 9") == [b"a", b"b", b"c", b"d\xc3\xa9", b"9"]
