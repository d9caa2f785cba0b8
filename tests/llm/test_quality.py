import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from turnout.llm import quality
from turnout.llm.queries import op7_quality
from turnout.llm.tables import table

SF_DIR = "/root/testdata/sf0.1"


def texts():
    rng = random.Random(2)
    clean = lambda: " ".join(rng.choice(["the", "of", "reed", "tion", "heat"]) for _ in range(60))
    good = [clean().encode() for _ in range(60)]
    bad = [t[:100] + b" !! ## $$ !! ##" * 6 + t[100:] for t in good]
    return good + bad, np.array([1] * 60 + [0] * 60)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    w = {k: x.astype(np.float64) for k, x in quality.initial(rng).items()}
    some, labels = texts()
    some, labels = some[50:70] + [b"", b"x" * 2000], np.append(labels[50:70], [1, 0])
    g, _ = quality.gradients(w, some, labels)
    for k, at in (("filters", (5, 3)), ("embed", (ord("e"), 1)), ("hidden", (4, 2)), ("chunk", (3, 0)), ("out", (0,))):
        loss = []
        for step in (1e-5, -1e-5):
            moved = {n: x.copy() for n, x in w.items()}
            moved[k][at] += step
            loss.append(quality.gradients(moved, some, labels)[1])
        assert abs((loss[0] - loss[1]) / 2e-5 - g[k][at]) < 1e-4


def test_learns_and_reads_whole_texts():
    some, labels = texts()
    w = quality.train(some, labels, epochs=12)
    assert ((quality.probabilities(w, some) > 0.5) == labels).mean() > 0.95
    long = some[0] * 300
    p = quality.probabilities(w, [long, long + b" !! ## $$ !! ##" * 200])
    assert p[0] > 0.5 > p[1]


def test_parts_do_not_change_the_score():
    w = quality.initial(np.random.default_rng(3))
    rng = random.Random(1)
    some = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 15, 511, 512, 513, 5000)]
    whole = quality.probabilities(w, some)
    for most in (1, 1024, 4096):
        assert np.allclose(quality.probabilities(w, some, most), whole, atol=1e-6)
    alone = np.concatenate([quality.probabilities(w, [t]) for t in some])
    assert np.allclose(alone, whole, atol=1e-6)


def naive_probability(w, text):
    """The network on one text, filter by filter and byte by byte, as its description says."""
    width, stride, chunk = quality.WIDTH, quality.STRIDE, quality.CHUNK
    size = max(chunk, -(-len(text) // (chunk // 2)) * (chunk // 2))
    data = text + bytes(size + chunk - len(text))
    scores = []
    for at in range(0, size - chunk + 1, chunk // 2):
        features = []
        for f in range(quality.FILTERS):
            seen = []
            for p in range(at, at + chunk, stride):
                parts = [w["embed"][data[p + j]] @ w["filters"][j * quality.EMBED : (j + 1) * quality.EMBED, f] for j in range(width)]
                seen.append(max(0.0, float(sum(parts) + w["bias"][f])))
            features.append((max(seen), sum(seen) / len(seen)))
        x = np.array([m for m, _ in features] + [a for _, a in features])
        hidden = [max(0.0, float(x @ w["hidden"][:, h] + w["hidden_bias"][h])) for h in range(quality.HIDDEN)]
        scores.append(float(np.dot(hidden, w["chunk"][:, 0])))
    logit = w["out"][0] * min(scores) + w["out"][1] * sum(scores) / len(scores) + w["out"][2]
    return 1 / (1 + np.exp(-logit))


def test_scores_are_those_of_a_naive_forward_pass():
    rng = random.Random(6)
    w = {k: x.astype(np.float64) for k, x in quality.initial(np.random.default_rng(4)).items()}
    w["bias"] += 0.05
    some = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 3, 256, 512, 513, 700, 769, 1500)]
    expected = [naive_probability(w, t) for t in some]
    assert len({round(p, 6) for p in expected}) == len(some)
    for most in (1 << 17, 1024):
        assert np.allclose(quality.probabilities(w, some, most), expected, atol=1e-6)


def test_odd_rows(spark, documents):
    rows = [(None, None), (1, ""), (1, "x" * 100_000), (2, "a b"), (2, "a b"), (3, "Ā\x00")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (3, None), (2, 0)], "doc_id long, quality int")
    docs = documents(rows)
    found = quality.score_quality(docs, quality.fit_quality(docs, labels))
    got = found.select("doc.doc_id", "doc.hash", "score", "predicted").collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    empty = quality.score_quality(documents([]), quality.fit_quality(documents([]), labels))
    assert empty.count() == 0


def test_texts_travel_once_within_their_rows(documents):
    w = quality.train(*texts())
    rows = [(i, t.decode()) for i, t in enumerate(texts()[0][50:70])] + [(20, None), (21, "")]
    docs = documents(rows)
    found = quality.score_quality(docs, w)
    assert "cast(text" not in found._jdf.queryExecution().executedPlan().toString()
    expected = quality.probabilities(w, [(t or "").encode() for _, t in rows])
    as_bytes = docs.withColumn("text", F.col("text").cast("binary"))
    for scored in (found, quality.score_quality(docs, w, "TEXT"), quality.score_quality(as_bytes, w)):
        got = {r.doc_id: r.score for r in scored.select("doc.doc_id", "score").collect()}
        assert np.allclose([got[i] for i, _ in rows], expected, atol=1e-6)


def test_held_out_accuracy(spark):
    found = op7_quality(spark, SF_DIR)
    assert found.count() == table(spark, SF_DIR, "documents").count()
    labels = table(spark, SF_DIR, "labels").select("doc_id", "quality", "toxic")
    rows = found.filter("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert len(bad) > 50
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_learns_only_from_rows_outside_the_fold(spark):
    docs = table(spark, SF_DIR, "documents")
    labels = table(spark, SF_DIR, "labels")
    other = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
    changed = labels.withColumn("quality", F.coalesce(other, "quality"))
    sample = [
        quality.labelled_sample(docs, frame, "doc_id", "text", "quality", 300, 1 << 14)
        for frame in (labels, changed)
    ]
    assert sample[0][0] == sample[1][0] and (sample[0][1] == sample[1][1]).all()
