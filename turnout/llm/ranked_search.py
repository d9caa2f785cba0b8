"""Ranked lexical search by pipelined term partitioning.

Terms have owners, a few stages, the rarest terms in the first. A bundle for each item travels
through the stages and carries sparse accumulators, the documents met so far and their scores. At a
stage the bundles meet the postings of its terms (a cogroup), and the contributions, integers, are
added. After the last stage the best documents of each bundle are selected, then those of each item.

A bundle of all documents would grow with the corpus, so documents are dealt into shards of about
SHARD, and there is one bundle for each item and shard. A stage drops the documents that can no
longer be among the best of their bundle: the terms of later stages can add at most MOST_IMPACT times
their weights. Postings of items' terms alone are kept; they are made in one pass over the documents
for each block of items.
"""

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.tables import ROW, TEXT, numbered, stored
from turnout.llm.text import ALNUM, split_words, text_chunks

K = 10
STAGES = 4
#: Documents of a shard and items of a group: a stage's task adds up one table of these sizes.
SHARD, GROUP = 8192, 256
#: Bytes of items that the driver holds and one pass over the documents serves.
ITEM_BYTES = 8 << 20
#: What a term adds at most, but for its weight: (1000000000 * tf) div (1000 * tf + 8 * m) for any tf.
MOST_IMPACT = 1_000_000


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of the ``documents`` have."""
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """(id, terms) of the items that have terms, in blocks of about ITEM_BYTES, in the order of the
    ids; one block is held by the driver at a time."""
    names = items.select(
        F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    block, size = [], 0
    for row in names.filter("text is not null").sort("item", "text").toLocalIterator():
        terms = terms_of(bytes(row.text))
        if not terms:
            continue
        block.append((row.item, terms))
        size += len(row.text)
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Per row: number, id, count ``n`` of all terms, and places in ``terms`` (sorted) of those that
    it holds, with their occurrences."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(held.value, pa.binary())
        for part, texts in text_chunks(batches, TEXT):
            words = split_words(texts, ALNUM)
            per_text = np.diff(words.first)
            found = pa.array(words.data.split(), pa.binary())
            place = pc.index_in(found, value_set=wanted).fill_null(-1).to_numpy()
            known = np.flatnonzero(place >= 0)
            row = np.searchsorted(words.first, known, side="right") - 1
            pair, times = np.unique(row * len(wanted) + place[known], return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(texts) + 1) * len(wanted)).astype(np.int32)
            term = (pair % len(wanted)).astype(np.int32)
            columns = [
                part.column(part.schema.get_field_index(ROW)),
                part.column(part.schema.get_field_index("id")),
                pa.array(per_text, pa.int64()),
                pa.ListArray.from_arrays(ends, term),
                pa.ListArray.from_arrays(ends, times.astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [ROW, "id", "n", "terms", "times"])

    ddl = f"{ROW} long, id long, n long, terms array<int>, times array<long>"
    return docs.select(ROW, "id", TEXT).mapInArrow(count, ddl)


def term_owners(weights: np.ndarray, holding: np.ndarray, stages: int) -> np.ndarray:
    """The stage of each term: rarest terms first, about as many postings in each."""
    order = np.argsort(-weights, kind="stable")
    before = np.cumsum(holding[order]) - holding[order]
    out = np.empty(len(weights), np.int64)
    out[order] = before * stages // max(1, int(holding.sum()))
    return out


def contributions(
    held: DataFrame, weights: np.ndarray, owners: np.ndarray, documents: int, total: int
) -> DataFrame:
    """One row per document and stage in which it has terms: places of the terms and what each
    occurrence of it in an item adds to the document's score."""
    broadcast = held.sparkSession.sparkContext.broadcast((weights, owners))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, owner = broadcast.value
        for batch in batches:
            terms = batch.column(batch.schema.get_field_index("terms"))
            times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy()
            n = batch.column(batch.schema.get_field_index("n"))
            # Lengths times counts may pass 64 bits before the division: Python's integers do not.
            m = np.array([25 + 75 * x * documents // total if x else 25 for x in n.to_pylist()])
            size = pc.list_value_length(terms).to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            term = terms.flatten().to_numpy()
            impact = 1_000_000_000 * times // (1000 * times + 8 * m[row])
            order = np.lexsort((term, row, owner[term]))
            row, term, add = row[order], term[order], (weight[term] * impact)[order]
            key = owner[term] * len(size) + row
            cut = np.flatnonzero(np.diff(key, prepend=-1))
            ends = np.append(cut, len(key)).astype(np.int32)
            taken = batch.take(pa.array(row[cut]))
            columns = [
                taken.column(taken.schema.get_field_index("shard")),
                taken.column(taken.schema.get_field_index(ROW)),
                taken.column(taken.schema.get_field_index("id")),
                pa.array(owner[term[cut]].astype(np.int32)),
                pa.ListArray.from_arrays(ends, term.astype(np.int32)),
                pa.ListArray.from_arrays(ends, add),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["shard", ROW, "id", "stage", "terms", "adds"]
            )

    ddl = f"shard long, {ROW} long, id long, stage int, terms array<int>, adds array<long>"
    return held.mapInArrow(rate, ddl)


BUNDLE = (
    "group long, shard long, item int, terms array<int>, repeats array<long>, rest long, "
    "rows array<long>, ids array<long>, scores array<long>"
)


def kept(scores: np.ndarray, rest: int, k: int) -> np.ndarray:
    """Numbers of the documents that may still be among the ``k`` best when ``rest`` is the most
    that can be added to any."""
    met = np.flatnonzero(scores)
    if len(met) <= k:
        return met
    least = np.partition(scores[met], len(met) - k)[len(met) - k]
    return met[scores[met] + rest >= least]


def stage_step(weights: np.ndarray, owners: np.ndarray, stage: int, k: int):
    """The function of a stage: bundles and postings of a shard to bundles."""

    def add(bundles: pa.Table, found: pa.Table) -> pa.Table:
        if not bundles.num_rows:
            return bundles
        bundles = bundles.combine_chunks()
        old_rows = bundles["rows"].combine_chunks()
        rows = np.concatenate([found[ROW].to_numpy(), old_rows.flatten().to_numpy()])
        ids = pa.concat_arrays(
            [found["id"].combine_chunks(), bundles["ids"].combine_chunks().flatten()]
            if found.num_rows
            else [bundles["ids"].combine_chunks().flatten()]
        )
        docs, first, column = np.unique(rows, return_index=True, return_inverse=True)
        # Rows of a term: the documents that hold it and what it adds to each.
        if found.num_rows:
            lists = found["terms"].combine_chunks()
            size = pc.list_value_length(lists).to_numpy()
            term, adds = lists.flatten().to_numpy(), found["adds"].combine_chunks().flatten().to_numpy()
            at = np.repeat(column[: found.num_rows], size)
            order = np.argsort(term, kind="stable")
            term, adds, at = term[order], adds[order], at[order]
        else:
            term, adds, at = (np.empty(0, np.int64) for _ in range(3))
        old = np.cumsum(np.r_[0, pc.list_value_length(old_rows).to_numpy()]) + found.num_rows
        old_scores = bundles["scores"].combine_chunks().flatten().to_numpy()
        out_rows, out_ids, out_scores, out_rest = [], [], [], []
        asked = zip(*(bundles[c].to_pylist() for c in ("terms", "repeats", "rest")))
        for i, (terms, repeats, rest) in enumerate(asked):
            scores = np.zeros(len(docs), np.int64)
            scores[column[old[i] : old[i + 1]]] = old_scores[
                old[i] - found.num_rows : old[i + 1] - found.num_rows
            ]
            for t, times in zip(terms, repeats):
                if owners[t] != stage:
                    continue
                rest -= times * int(weights[t]) * MOST_IMPACT
                a, b = np.searchsorted(term, [t, t + 1])
                scores[at[a:b]] += times * adds[a:b]
            left = kept(scores, rest, k)
            out_rows.append(docs[left])
            out_ids.append(first[left])
            out_scores.append(scores[left])
            out_rest.append(rest)
        ends = np.cumsum([0, *map(len, out_rows)]).astype(np.int32)
        columns = {
            "rest": pa.array(out_rest, pa.int64()),
            "rows": pa.ListArray.from_arrays(ends, np.concatenate(out_rows)),
            "ids": pa.ListArray.from_arrays(ends, ids.take(pa.array(np.concatenate(out_ids)))),
            "scores": pa.ListArray.from_arrays(ends, np.concatenate(out_scores)),
        }
        for name, values in columns.items():
            bundles = bundles.set_column(bundles.schema.get_field_index(name), name, values)
        return bundles

    return add


def search_block(
    docs: DataFrame, block: list[tuple], k: int, stages: int, id_type: str
) -> DataFrame:
    """``ranked_search`` of one block of items."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    terms = sorted({t for _, words in block for t in words})
    held = stored(postings(docs, terms), "postings")
    documents, total, rows = held.agg(
        F.count(F.when(F.col("n") > 0, 1)), F.sum("n"), F.count("*")
    ).first()
    holding = np.zeros(len(terms), np.int64)
    for row in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holding[row.t] = row["count"]
    weights = np.array([weight(documents, int(h)) for h in holding])
    owners = term_owners(weights, holding, stages)

    shards = max(1, -(-rows // SHARD))
    groups = -(-len(block) // GROUP)
    shard = F.pmod(F.xxhash64(ROW), F.lit(shards)).cast("long")
    dealt = held.withColumn("shard", shard)
    rated = contributions(dealt, weights, owners, documents, total or 1)
    rated = stored(rated, "contributions")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))

    index = {t: i for i, t in enumerate(terms)}
    travel = []
    for number, (_, words) in enumerate(block):
        places, repeats = np.unique([index[w] for w in words], return_counts=True)
        rest = int((repeats * weights[places]).sum()) * MOST_IMPACT
        travel.append((number // GROUP, number, places.tolist(), repeats.tolist(), rest))
    ddl = "group long, item int, terms array<int>, repeats array<long>, rest long"
    all_shards = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    bundles = spark.createDataFrame(travel, ddl).select(
        "group",
        all_shards.alias("shard"),
        "item",
        "terms",
        "repeats",
        "rest",
        F.array().cast("array<long>").alias("rows"),
        F.array().cast("array<long>").alias("ids"),
        F.array().cast("array<long>").alias("scores"),
    )
    key = ["group", "shard"]
    for stage in range(stages):
        found = rated.filter(F.col("stage") == stage)
        found = found.select(each.alias("group"), "shard", ROW, "id", "terms", "adds")
        left, right = (x.repartition(parts, *key).groupBy(*key) for x in (bundles, found))
        bundles = left.cogroup(right).applyInArrow(stage_step(weights, owners, stage, k), BUNDLE)
    entries = bundles.select("item", F.explode(F.arrays_zip("ids", "scores")).alias("e"))
    entries = entries.select("item", F.col("e.ids").alias("id"), F.col("e.scores").alias("score"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = entries.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = spark.createDataFrame(
        [(number, name) for number, (name, _) in enumerate(block)], f"item int, name {id_type}"
    )
    return ranked.join(names, "item").select("name", "rank", "id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = K,
    stages: int = STAGES,
) -> DataFrame:
    """The ``k`` best documents of each item: its id, ``rank`` from 1, the document's id, ``score``.

    Terms are words of letters and digits, A-Z in lower case, and all of UTF-8 beyond ASCII. N is
    the number of documents with terms, L of their terms, n of one document's, df of the documents
    that hold a term, tf of its occurrences in one; a term weighs floor(1000 ln((2N+2)/(2df+1))), a
    document's m is 25 + (75 n N) div L, and each occurrence of a term in an item adds
    weight * ((1000000000 tf) div (1000 tf + 8 m)). Documents need a score above 0; equal scores
    go to the lesser id, null ids last. Repeated documents and items, also with the same id, are
    documents and items of their own. A null or empty text has no terms: such an item has no rows.
    Empty tables give no rows. Extra columns are not looked at.

    Scores are 64-bit numbers: an item may hold some hundred thousand terms.
    """
    spark = docs.sparkSession
    rows = numbered(docs, text, id=id).withColumn("id", F.col("id").cast("long"))
    id_type = items.schema[item].dataType.simpleString()
    out = None
    for block in item_blocks(items, item, item_text):
        found = search_block(rows, block, k, stages, id_type)
        out = found if out is None else out.unionAll(found)
    if out is None:
        out = spark.createDataFrame([], f"name {id_type}, rank int, id long, score long")
    return out.withColumnsRenamed({"name": item, "id": id})
