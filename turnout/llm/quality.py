"""Quality classifier: a convolutional network over bytes, in numpy.

Each byte is a small vector. Learned filters of WIDTH bytes slide over the text in steps of STRIDE;
each chunk of CHUNK bytes (the next one begins half a chunk later, so that chunks overlap) keeps
the greatest and the mean response of every filter. A hidden layer turns a chunk into a score, and
the text's probability comes from the lowest and the mean score of its chunks, so that junk
anywhere in a long text counts. Every chunk of the whole text is read.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.llm.tables import whole_row
from turnout.llm.text import text_chunks

WIDTH, STRIDE, EMBED, FILTERS, HIDDEN = 16, 4, 4, 32, 24
CHUNK = 512
STEPS = CHUNK // STRIDE
HALF = STEPS // 2
SPAN = WIDTH // STRIDE
Weights = dict[str, np.ndarray]


def byte_steps(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in rows of STRIDE, and the first half chunk of each text and the end.

    Texts are filled with byte 0 to whole half chunks, at least two, so that each has a chunk. A
    filter reads over the end of its half chunk into the next one, at the end of a text into
    what follows it, so each text gets one more half chunk of byte 0, which is no part of it.
    """
    filled, first = [], [0]
    size = HALF * STRIDE
    for text in texts:
        halves = max(2, -(-len(text) // size))
        filled += [text, bytes((halves + 1) * size - len(text))]
        first.append(first[-1] + halves + 1)
    return np.frombuffer(b"".join(filled), np.uint8).reshape(-1, STRIDE), np.array(first)


def initial(rng: np.random.Generator) -> Weights:
    def normal(*shape: int, by: float) -> np.ndarray:
        return (rng.standard_normal(shape) * by).astype(np.float32)

    return {
        "embed": normal(256, EMBED, by=0.5),
        "filters": normal(WIDTH * EMBED, FILTERS, by=0.15),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": normal(2 * FILTERS, HIDDEN, by=0.15),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "chunk": normal(HIDDEN, 1, by=0.3),
        "out": np.array([0.7, 0.3, 0.5], np.float32),  # least, mean, constant
    }


def responses(w: Weights, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Response of each filter at each step, in half chunks, and the embedded steps.

    A filter spans SPAN steps: each step is multiplied with all parts of the filters at once, and
    the products of neighbouring steps are added. The last steps lack neighbours.
    """
    steps = w["embed"][codes].reshape(len(codes), STRIDE * EMBED)
    parts = w["filters"].reshape(SPAN, STRIDE * EMBED, FILTERS)
    products = steps @ parts.transpose(1, 0, 2).reshape(STRIDE * EMBED, SPAN * FILTERS)
    total = products[:, :FILTERS] + w["bias"]
    for j in range(1, SPAN):
        total[:-j] += products[j:, j * FILTERS : (j + 1) * FILTERS]
    return np.maximum(total, 0, out=total).reshape(-1, HALF, FILTERS), steps


def chunk_scores(w: Weights, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
    return (hidden @ w["chunk"])[:, 0], hidden


def chunk_features(
    top: np.ndarray, mean: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of chunks, the left half of each, and the first chunk of each text.

    A chunk is two neighbouring halves; the last half of a text and the filling begin none.
    """
    left = np.delete(np.arange(first[-1]), np.concatenate([first[1:] - 1, first[1:] - 2]))
    both = np.maximum(top[left], top[left + 1])
    return (
        np.concatenate([both, (mean[left] + mean[left + 1]) / 2], 1),
        left,
        first[:-1] - 2 * np.arange(len(first) - 1),
    )


def text_logits(
    w: Weights, score: np.ndarray, begin: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count = np.diff(np.append(begin, len(score)))
    low, mean = np.minimum.reduceat(score, begin), np.add.reduceat(score, begin) / count
    return w["out"][0] * low + w["out"][1] * mean + w["out"][2], low, mean


def probabilities(w: Weights, texts: list[bytes], most: int = 1 << 17) -> np.ndarray:
    """The probability of each text. Texts are read in parts of ``most`` bytes."""
    codes, first = byte_steps(texts)
    part = max(1, most // (HALF * STRIDE)) * HALF
    tops, means = [], []
    for at in range(0, len(codes), part):
        found, _ = responses(w, codes[at : at + part + SPAN - 1 + -(SPAN - 1) % HALF])
        found = found[: part // HALF]
        tops.append(found.max(1))
        means.append(found.mean(1))
    features, _, begin = chunk_features(np.concatenate(tops), np.concatenate(means), first)
    logit, _, _ = text_logits(w, chunk_scores(w, features)[0], begin)
    return 1 / (1 + np.exp(-logit.astype(np.float64)))


def gradients(w: Weights, texts: list[bytes], label: np.ndarray) -> tuple[Weights, float]:
    codes, first = byte_steps(texts)
    found, steps = responses(w, codes)
    top, place, mean = found.max(1), found.argmax(1), found.mean(1)
    features, left, begin = chunk_features(top, mean, first)
    score, hidden = chunk_scores(w, features)
    logit, low, average = text_logits(w, score, begin)
    p = 1 / (1 + np.exp(-logit))
    loss = -np.mean(np.where(label > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7)))
    d_logit = ((p - label) / len(texts)).astype(np.float32)
    g: Weights = {"out": np.array([d_logit @ low, d_logit @ average, d_logit.sum()], np.float32)}
    count = np.diff(np.append(begin, len(score)))
    of = np.repeat(np.arange(len(texts)), count)
    d_score = (d_logit * w["out"][1] / count)[of]
    lowest = np.flatnonzero(score == low[of])
    lowest = lowest[np.unique(of[lowest], return_index=True)[1]]
    d_score[lowest] += d_logit * w["out"][0]
    d_hidden = d_score[:, None] * w["chunk"][:, 0] * (hidden > 0)
    g["chunk"] = hidden.T @ d_score[:, None]
    g["hidden"], g["hidden_bias"] = features.T @ d_hidden, d_hidden.sum(0)
    d_features = d_hidden @ w["hidden"].T
    d_top, d_mean = np.zeros_like(top), np.zeros_like(mean)
    from_left = top[left] >= top[left + 1]
    np.add.at(d_top, left, d_features[:, :FILTERS] * from_left)
    np.add.at(d_top, left + 1, d_features[:, :FILTERS] * ~from_left)
    np.add.at(d_mean, left, d_features[:, FILTERS:] / 2)
    np.add.at(d_mean, left + 1, d_features[:, FILTERS:] / 2)
    d_response = np.repeat(d_mean / HALF, HALF, axis=0)
    rows = np.arange(len(top))[:, None] * HALF + place
    d_response[rows, np.arange(FILTERS)] += d_top
    d_response *= found.reshape(-1, FILTERS) > 0
    d_products = np.zeros((len(codes), SPAN * FILTERS), np.float32)
    for j in range(SPAN):
        d_products[j:, j * FILTERS : (j + 1) * FILTERS] = d_response[: len(codes) - j]
    d_parts = (steps.T @ d_products).reshape(STRIDE * EMBED, SPAN, FILTERS)
    g["filters"] = d_parts.transpose(1, 0, 2).reshape(WIDTH * EMBED, FILTERS)
    g["bias"] = d_response.sum(0)
    parts = w["filters"].reshape(SPAN, STRIDE * EMBED, FILTERS).transpose(1, 0, 2)
    d_steps = (d_products @ parts.reshape(STRIDE * EMBED, -1).T).reshape(-1, EMBED)
    flat = codes.ravel()
    g["embed"] = np.stack(
        [np.bincount(flat, d_steps[:, k], 256) for k in range(EMBED)], 1
    ).astype(np.float32)
    return g, float(loss)


def train(
    texts: list[bytes], labels: np.ndarray, epochs: int = 6, batch: int = 24, seed: int = 7
) -> Weights:
    """Weights fitted by Adam. Without texts of both labels, all texts get 1 or all 0."""
    rng = np.random.default_rng(seed)
    w = initial(rng)
    labels = np.asarray(labels, np.float32)
    if not len(texts) or labels.min() == labels.max():
        known = labels[0] if len(texts) else 1
        w["out"] = np.array([0, 0, 6 if known else -6], np.float32)
        return w
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            g, _ = gradients(w, [texts[i] for i in rows], labels[rows])
            step += 1
            rate = 6e-3 * (1 - step / (total + 1)) + 2e-4
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                scale = np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8
                w[k] = w[k] - (rate * m[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return w


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows: int, longest: int
) -> tuple[list[bytes], np.ndarray]:
    """At most ``rows`` labelled texts, both labels alike if there are enough, chosen by a hash.

    A text longer than ``longest`` bytes is no training text, but is scored like any other. Each
    id counts once; rows with a null id, text or label are left out.
    """
    number, marked = F.col(f"`{id}`").cast("long"), F.col(f"`{label}`").cast("int")
    known = (
        labels.select(number.alias("id"), marked.alias("label"))
        .filter("id is not null and label in (0, 1)")
        .filter(F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2)
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    # A top-k in each task; no more than these ids reach the driver.
    half = [known.filter(F.col("label") == k).orderBy(*order).limit(rows // 2) for k in (0, 1)]
    sample = half[0].unionAll(half[1]).select("id", "label").collect()
    chosen = docs.sparkSession.createDataFrame(sample, "id long, label int")
    texts = docs.select(number.alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    texts = texts.filter((F.length("text") <= longest) & F.col("text").isNotNull())
    found = texts.join(F.broadcast(chosen), "id").groupBy("id")
    found = found.agg(F.min("text").alias("text"), F.max("label").alias("label"))
    rows_found = sorted(found.collect(), key=lambda r: r.id)
    return [bytes(r.text) for r in rows_found], np.array([r.label for r in rows_found])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = 3000,
    longest: int = 1 << 14,
) -> Weights:
    """Weights learnt from at most ``rows`` labelled texts of at most ``longest`` bytes.

    The bound keeps what the driver holds under rows * longest bytes (48 MB), at any size of the
    corpus. Rows whose crc32 of the id as text leaves 2 modulo 4 are never learnt from.
    """
    texts, known = labelled_sample(docs, labels, id, text, label, rows, longest)
    return train(texts, known)


def score_quality(
    docs: DataFrame, weights: Weights, text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """All columns in a struct ``doc``, ``score`` from 0 to 1 and ``predicted``.

    A null or empty text is scored as a text of no bytes; equal texts get equal scores.
    """
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = pickle.loads(held.value)
        for part, texts in text_chunks(map(with_bytes, batches), "bytes", 1 << 20):
            p = pa.array(probabilities(w, texts))
            yield pa.RecordBatch.from_arrays([part.column(0), p], ["doc", "score"])

    def with_bytes(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows and their texts, which are read where they lie in the rows: a second column of
        texts would double what a task holds."""
        doc = batch.column(0)
        return pa.RecordBatch.from_arrays(
            [doc, pc.struct_field(doc, [place]).cast(pa.binary())], ["doc", "bytes"]
        )

    names = docs.columns
    place = names.index(text) if text in names else [n.lower() for n in names].index(text.lower())
    rows = docs.select(whole_row(docs).alias("doc"))
    schema = T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
