"""N-gram Jaccard join: texts whose sets of word n-grams overlap by 80 percent or more.

Sets are of 64-bit hashes of n-grams. Texts with equal sets form one class, and only one text of
each class goes on. Two sets that overlap enough share an entry among the first fifth of their
entries, in any order; the order here puts common entries last. Each class goes to the lists of
those entries, and each list proposes pairs:

1. the set in which the list's entry comes first with each other one (a star). That set has the
   fewest rarer entries, so in a group of copies it is the one nearest to the others, and finds
   most links without naming all pairs;
2. after the first round's links have been made components, the pairs of a list that lie in
   different components, of rows whose places admit a partner of the sizes in the list, and of
   like size. No possible link between two components stays untested.

A proposed set of pairs is answered by T-occurrence search: for a query set and its candidates,
every entry of the query has an inverted list of candidates. DivideSkip merges the short lists by
a heap, probes the long ones by binary search, and keeps candidates that occur often enough.
"""

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby
from math import log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm import sketch
from turnout.llm.components import components
from turnout.llm.tables import ROW, TEXT, bucketed, numbered, row_numbers, stored, whole_row
from turnout.llm.text import gram_hashes, sorted_groups, split_words, text_chunks, word_hashes

N = 5
PERCENT = 80
#: Candidates that one search holds.
BLOCK = 128
#: Candidates per list beyond which DivideSkip's cost model stops adding long lists (published
#: value of the model's constant).
MU = 0.0085


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text; a shorter text is one gram of all words."""
    words = split_words([t.lower() for t in texts])
    hashes = word_hashes(words)
    grams = gram_hashes(hashes, n)
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield gram_hashes(hashes[a:b], b - a)
        else:
            yield np.empty(0, np.uint64)


def least_overlap(a: int, b, percent: int):
    """Entries that sets of a and b entries must share: percent of their union."""
    return -(-percent * (a + b) // (100 + percent))


def divide_skip(lists: list[list[int]], need: dict[int, int] | list[int]) -> list[int]:
    """Numbers that occur in at least ``need[number]`` of the sorted lists.

    The longest lists are left out of the merge: a number that occurs often enough must be in
    enough of the short ones, and is then looked up in the long ones.
    """
    if not lists:
        return []
    least = min(need)
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    long = min(least - 1, int(least / (MU * log2(longest + 1) + 1)))
    short, probe = lists[: len(lists) - long], lists[len(lists) - long :]
    found = []
    for number, same in groupby(heapq.merge(*short)):
        count, wanted = sum(1 for _ in same), need[number]
        if count < wanted - long:
            continue
        for k, one in enumerate(probe):
            if count >= wanted or count + long - k < wanted:
                break
            at = bisect_left(one, number)
            count += at < len(one) and one[at] == number
        if count >= wanted:
            found.append(number)
    return found


def t_occurrence(query: np.ndarray, candidates: list[np.ndarray], percent: int) -> list[int]:
    """Numbers of the candidates that overlap the query by ``percent`` of the union."""
    if not len(query):
        return []
    size = np.array([len(c) for c in candidates])
    entries = np.concatenate(candidates)
    number = np.repeat(np.arange(len(candidates)), size)
    place = np.searchsorted(query, entries)
    place[place == len(query)] = 0
    shared = query[place] == entries
    place, number = place[shared], number[shared]
    order = np.lexsort((number, place))
    place, number = place[order], number[order].tolist()
    cuts = [*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(number)]
    lists = [number[a:b] for a, b in zip(cuts, cuts[1:])]
    need = least_overlap(len(query), size, percent).tolist()
    return divide_skip(lists, need)


def digest_of(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def class_rows(docs: DataFrame, n: int) -> DataFrame:
    """Row, id, size of the set, and a 128-bit digest of it (null: empty set)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, TEXT):
            sets = list(shingle_sets(texts, n))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index(ROW)),
                    part.column(part.schema.get_field_index("id")),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest_of(s) if len(s) else None for s in sets], pa.binary()),
                ],
                [ROW, "id", "size", "digest"],
            )

    return docs.mapInArrow(digest, f"{ROW} long, id long, size long, digest binary")


def prefix_entries(
    texts: DataFrame, table: np.ndarray, n: int, percent: int
) -> DataFrame:
    """One row per entry among the first fifth of a set: ``entry``, ``row`` and ``place``, which
    holds the entry's number in the set's order above the size of the set (32 bits each)."""
    held = texts.sparkSession.sparkContext.broadcast(table)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = held.value
        for part, chunk in text_chunks(batches, TEXT, 1 << 20):
            rows = part.column(part.schema.get_field_index(ROW)).to_pylist()
            out = []
            for row, found in zip(rows, shingle_sets(chunk, n)):
                size = len(found)
                first = size - -(-percent * size // 100) + 1 if size else 0
                order = np.lexsort((found, level[sketch.cells(found, len(level))]))[:first]
                place = (np.arange(len(order)) << 32) + size
                out.append((found[order].view(np.int64), np.full(len(order), row), place))
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["entry", "row", "place"])

    return texts.mapInArrow(entries, "entry long, row long, place long")


def possible(x: str, y: str, percent: int):
    """Whether two sets can overlap enough, by their sizes and the places of the shared entry.

    Held for the first entry that two sets share; a later one may fail, which loses no pair.
    """
    size = [F.col(f"{c}.place").bitwiseAND(0xFFFFFFFF) for c in (x, y)]
    rest = [n - F.shiftright(f"{c}.place", 32) for n, c in zip(size, (x, y))]
    sizes = 100 * F.least(*size) >= percent * F.greatest(*size)
    return sizes & ((100 + percent) * F.least(*rest) >= percent * (size[0] + size[1]))


def shared_lists(entries: DataFrame) -> DataFrame:
    """Rows of lists of two or more, each with the ``head`` of its list and the ``least`` size in it.

    Heads are found within tasks first, and joined back: a common entry is no single task's work.
    """
    size = F.col("place").bitwiseAND(0xFFFFFFFF)
    heads = entries.groupBy("entry").agg(
        F.min(F.struct("place", "row")).alias("first"),
        F.min(size).alias("least"),
        F.count("*").alias("n"),
    )
    head = F.struct(F.col("first.row").alias("row"), F.col("first.place").alias("place"))
    heads = heads.filter("n > 1").select("entry", head.alias("head"), "least")
    return entries.join(heads, "entry")


def admits_partner(percent: int):
    """Whether the place of a row in its list admits any partner of the sizes in the list.

    What is left of a set from the shared entry on bounds the overlap, so it bounds the size of a
    partner: rows of templated texts, which share only entries that come late, have none.
    """
    size = F.col("place").bitwiseAND(0xFFFFFFFF)
    rest = size - F.shiftright("place", 32)
    return (100 + percent) * rest >= percent * (size + F.col("least"))


def size_band(size, percent: int):
    """Bands such that sets that overlap enough are in the same or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / F.lit(-log(percent / 100))).cast("int")


def search_pairs(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of rows whose sets overlap enough; a is the query.

    The candidates of a query are dealt into blocks, so that a query with a third of all rows is
    many searches; each block gets the query's text.
    """
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    members = pairs.join(blocks, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), F.col("b").alias(ROW)
    )
    queries = blocks.select(
        "a",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.col("a").alias(ROW),
    )
    rows = members.unionAll(queries).hint("merge").join(docs, ROW)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["a", "block"]):
            query, rows = group["a"][0].as_py(), group[ROW].to_pylist()
            sets = [s for t in group[TEXT].to_pylist() for s in shingle_sets([t], n)]
            own = rows.index(query)
            found = t_occurrence(sets[own], sets[:own] + sets[own + 1 :], percent)
            others = rows[:own] + rows[own + 1 :]
            pairs = [[query] * len(found), [others[i] for i in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs], ["a", "b"])

    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = rows.repartition(int(parts), "a", "block").sortWithinPartitions("a", "block")
    return dealt.select("a", "block", ROW, TEXT).mapInArrow(search, "a long, b long")


def class_links(reps: DataFrame, table: np.ndarray, n: int, percent: int) -> DataFrame:
    """Links (a, b) of the rows ``reps`` that connect what all links would connect."""
    shared = stored(shared_lists(prefix_entries(reps, table, n, percent)), "lists")
    star = shared.select("head", F.struct("row", "place").alias("x")).filter("head.row != x.row")
    pairs = star.filter(possible("head", "x", percent))
    pairs = pairs.select(F.col("head.row").alias("a"), F.col("x.row").alias("b"))
    pairs = stored(pairs.distinct(), "pairs")
    links = stored(search_pairs(pairs, reps, n, percent), "found")

    of = components(links).select(F.col("a").alias("row"), F.col("b").alias("part"))
    placed = shared.filter(admits_partner(percent)).drop("head", "least").join(of, "row", "left")
    placed = placed.withColumn("part", F.coalesce("part", "row"))
    parts = placed.groupBy("entry").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    rest = placed.join(parts.filter("p != q").select("entry"), "entry")
    band = size_band(F.col("place").bitwiseAND(0xFFFFFFFF), percent)
    near = F.explode(F.array(band - 1, band, band + 1)).alias("band")
    left = rest.select(
        "entry", band.alias("band"), F.struct("row", "place").alias("x"), F.col("part").alias("p")
    )
    right = rest.select("entry", near, F.struct("row", "place").alias("y"), F.col("part").alias("q"))
    across = left.join(right, ["entry", "band"]).filter("p != q and x.row < y.row")
    more = across.filter(possible("x", "y", percent))
    more = more.select(F.col("x.row").alias("a"), F.col("y.row").alias("b"))
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(more.distinct().join(tested, ["a", "b"], "anti"), "pairs")
    if more.isEmpty():
        return links
    return links.unionAll(stored(search_pairs(more, reps, n, percent), "found"))


def jaccard_components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, and ``is_first``: whether the row is
    the one of its component to keep, and ``_row``, its number in the table.

    Words are what white space separates, A-Z in lower case. Two rows are linked if their sets
    overlap by ``percent`` of the union; a component is what links connect, and its id the least
    id in it (nulls are never least; null if all are null). A null or empty text has no set and is
    alone. Rows with equal texts, and equal rows, are linked; of rows with the least id, the first
    by number is kept (see ``tables.row_numbers``).
    """
    return row_components(numbered(docs, text, id=id), n, percent).withColumnRenamed("id", id)


def row_components(rows: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``jaccard_components`` of rows with a number, an ``id`` and the text as bytes."""
    rows = rows.withColumn("id", F.col("id").cast("long"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, texts in text_chunks(batches, TEXT):
            yield np.concatenate(list(shingle_sets(texts, n)))

    found = stored(class_rows(rows, n), "classes")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)
    classes = (
        found.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min(ROW).alias("rep"), F.min(place).alias("first"))
    )
    classes = stored(classes, "classes")
    # The ids grow with the corpus, so the texts are shuffled; later joins find them in buckets.
    ids = classes.select(F.col("rep").alias(ROW)).hint("merge")
    reps = bucketed(rows.select(ROW, TEXT).join(ids, ROW, "semi"), ROW)
    bits = sketch.cell_bits(found.agg(F.sum("size")).first()[0] or 0)
    table = sketch.levels(rows.select(ROW, TEXT), grams, bits)
    links = class_links(reps, table, n, percent)
    of = components(links).select(F.col("a").alias("rep"), F.col("b").alias("part"))
    placed = classes.join(of, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    firsts = placed.groupBy("part").agg(F.min("first").alias("first"))
    labels = placed.drop("first").join(firsts, "part").select("digest", "first")
    known = found.join(labels, "digest", "left")
    alone = F.col("digest").isNull()
    return known.select(
        ROW,
        "id",
        F.col("size").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        (alone | (F.col(ROW) == F.col(f"first.{ROW}"))).alias("is_first"),
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but one of each component of near copies."""
    rows = row_numbers(docs, whole_row(docs).alias("doc"))
    texts = rows.select(
        ROW, F.col(f"doc.`{text}`").cast("binary").alias(TEXT), F.col(f"doc.`{id}`").alias("id")
    )
    kept = row_components(texts).filter("is_first").select(ROW)
    return rows.join(kept, ROW, "semi").select("doc.*")
