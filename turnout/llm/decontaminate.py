"""Benchmark decontamination: Wu-Manber search for many word sequences at once.

The alphabet is words. A pattern is WINDOW consecutive words of a benchmark item, or all words of
a shorter item. Patterns of one length are searched together: a shift table, indexed by the hash
of a block of words, says how far a search may skip; where it says 0, the hash of the block, which
is the suffix of the window, selects a bucket of patterns, and the words themselves are compared.

Texts are cut into lanes of equal length, which advance side by side in numpy: a very long text is
many lanes. Lanes only set where a search starts; a window that begins in one lane may end in the
next.
"""

import pickle
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.llm.tables import ROW, TEXT, row_numbers, whole_row
from turnout.llm.text import ALNUM, Words, gram_hashes, split_words, text_chunks, word_hashes

WINDOW = 13
BLOCK = 3
SHIFT_BITS = 18
LANE = 256
#: Benchmark text that one search holds, in bytes; more is searched block by block.
MOST_BYTES = 8 << 20

Pattern = tuple[bytes, ...]


class WuManber:
    """Search tables of patterns of one length, in words."""

    def __init__(self, patterns: list[Pattern]) -> None:
        self.length = len(patterns[0])
        self.block = min(BLOCK, self.length)
        self.patterns = patterns
        words = split_words([b" ".join(p) for p in patterns])
        blocks = gram_hashes(word_hashes(words), self.block)
        per = self.length - self.block
        starts = np.arange(len(patterns)) * self.length
        self.shift = np.full(1 << SHIFT_BITS, per + 1, np.int64)
        for j in range(per + 1):
            cells = self.cell(blocks[starts + j])
            np.minimum.at(self.shift, cells, per - j)
        buckets = defaultdict(list)
        for i, suffix in enumerate(blocks[starts + per].tolist()):
            buckets[suffix].append(i)
        self.buckets = dict(buckets)
        self.suffixes = np.array(sorted(buckets), np.uint64)

    @staticmethod
    def cell(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    def candidates(self, blocks: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where windows may start: lanes of starts begin <= i < stop advance in step."""
        found, per = [], self.length - self.block
        at, stop = begin[begin < stop], stop[begin < stop]
        while len(at):
            block = blocks[at + per]
            shift = self.shift[self.cell(block)]
            hit = shift == 0
            place = np.searchsorted(self.suffixes, block[hit])
            place[place == len(self.suffixes)] = 0
            found.append(at[hit][self.suffixes[place] == block[hit]])
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def search(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """First word and pattern of every occurrence within a text."""
        first, last = words.first[:-1], words.first[1:] - self.length + 1
        lanes = np.maximum(0, -(-(last - first) // LANE))
        if not lanes.sum():
            return
        number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = np.repeat(first, lanes) + number * LANE
        stop = np.minimum(begin + LANE, np.repeat(last, lanes))
        blocks = gram_hashes(hashes, self.block)
        suffix = self.length - self.block
        for at in self.candidates(blocks, begin, stop).tolist():
            seen = tuple(words.word(i) for i in range(at, at + self.length))
            for i in self.buckets[int(blocks[at + suffix])]:
                if self.patterns[i] == seen:
                    yield at, i


def item_patterns(items: list[tuple[str | None, bytes]]) -> dict[Pattern, set[str | None]]:
    """The windows of the items, each with the ids of the items that hold it."""
    patterns: dict[Pattern, set[str | None]] = defaultdict(set)
    for item, text in items:
        words = text.translate(ALNUM).split()
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            patterns[tuple(words[i : i + WINDOW])].add(item)
    return patterns


def searches(items: list[tuple[str | None, bytes]]) -> list[tuple[WuManber, list[set[str | None]]]]:
    by_length = defaultdict(list)
    patterns = item_patterns(items)
    for pattern in patterns:
        by_length[len(pattern)].append(pattern)
    return [(WuManber(group), [patterns[p] for p in group]) for group in by_length.values()]


def item_blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list]:
    """The items in blocks of about ``most`` bytes of text: no more is on the driver at once."""
    rows = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    ).filter("text is not null")
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row.item, bytes(row.text)))
        size += len(row.text)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def spans(covered: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(covered, prepend=False, append=False))
    return edges[::2].tolist(), edges[1::2].tolist()


SPANS = "starts array<long>, ends array<long>, items array<string>"


def search_block(docs: DataFrame, block: list) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(block))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engines = searches(pickle.loads(held.value))
        for part, texts in text_chunks(batches, TEXT):
            words = split_words(texts, ALNUM)
            hashes = word_hashes(words)
            covered, items = np.zeros(len(hashes), bool), [set() for _ in texts]
            for engine, names in engines:
                for at, pattern in engine.search(words, hashes):
                    covered[at : at + engine.length] = True
                    items[np.searchsorted(words.first, at, side="right") - 1] |= names[pattern]
            marks = [
                spans(covered[a:b]) if found else ([], [])
                for a, b, found in zip(words.first, words.first[1:], items)
            ]
            named = [sorted(i for i in x if i is not None) for x in items]
            carried = [n for n in part.schema.names if n not in (ROW, TEXT)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index(ROW)),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.array([m[0] for m in marks], pa.list_(pa.int64())),
                    pa.array([m[1] for m in marks], pa.list_(pa.int64())),
                    pa.array(named, pa.list_(pa.string())),
                    *(part.column(part.schema.get_field_index(n)) for n in carried),
                ],
                names=[ROW, "n_words", "starts", "ends", "items", *carried],
            )

    rest = [f for f in docs.schema.fields if f.name not in (ROW, TEXT)]
    ddl = f"{ROW} long, n_words long, {SPANS}"
    schema = docs.sparkSession.createDataFrame([], ddl).schema
    for field in rest:
        schema = schema.add(field)
    return docs.mapInArrow(search, schema)


SPAN = T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])


@F.arrow_udf(T.ArrayType(SPAN))
def merged_spans(starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Union of spans [start, end) that several searches found, in order; spans that touch are one.

    All rows of a batch are merged at once: each row's places are moved behind those of the row
    before, sorted, and a span begins where a start lies behind all ends so far.
    """
    s, e = (column.flatten().to_numpy().astype(np.int64) for column in (starts, ends))
    row = np.repeat(np.arange(len(starts)), pc.list_value_length(starts).to_numpy())
    move = (e.max(initial=0) + 1) * row
    order = np.argsort(s + move, kind="stable")
    row, move = row[order], move[order]
    s, reach = s[order] + move, np.maximum.accumulate(e[order] + move)
    new = np.flatnonzero(np.append(True, s[1:] > reach[:-1])[: len(s)])
    last = np.append(new[1:], len(s))[: len(new)] - 1
    edges = [pa.array(s[new] - move[new]), pa.array(reach[last] - move[last])]
    offsets = np.append(0, np.cumsum(np.bincount(row[new], minlength=len(starts))))
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(edges, ["s", "e"])
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    most: int = MOST_BYTES,
) -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, ``n_words``, the covered word ``spans``
    (start, end after the last), the ``items`` found, sorted, ``n_hit`` and ``contaminated``.

    A text is contaminated if at least a twentieth of its words, and one at least, lie in a
    window. Null and empty texts have no words; items without words match nothing. Items with a
    null id count as hits but are not named. Repeated items, and items that share a window, are
    each named once. The documents are read once if the items fit one block, else once for each
    block, and joined by number (see ``tables.row_numbers``).
    """
    columns = (
        F.col(f"`{text}`").cast("binary").alias(TEXT),
        whole_row(docs).alias("doc"),
    )
    blocks = item_blocks(benchmark, item, item_text, most)
    block, second = next(blocks, []), next(blocks, None)
    if second is None:
        rows = docs.select(F.lit(0).cast("long").alias(ROW), *columns)  # nothing is joined
    else:
        rows = row_numbers(docs, *columns)
    found = search_block(rows, block)
    if second is not None:
        texts = rows.select(ROW, TEXT)
        more = [search_block(texts, block) for block in chain([second], blocks)]
        union = reduce(DataFrame.unionAll, more).filter(F.size("starts") > 0)
        other = union.groupBy(ROW).agg(
            F.flatten(F.collect_list("starts")).alias("more_starts"),
            F.flatten(F.collect_list("ends")).alias("more_ends"),
            F.flatten(F.collect_list("items")).alias("more_items"),
        )
        none = F.expr("cast(array() as array<bigint>)")
        no_items = F.expr("cast(array() as array<string>)")
        all_items = F.concat("items", F.coalesce("more_items", no_items))
        found = (
            found.join(other, ROW, "left")
            .withColumn("starts", F.concat("starts", F.coalesce("more_starts", none)))
            .withColumn("ends", F.concat("ends", F.coalesce("more_ends", none)))
            .withColumn("items", F.array_sort(F.array_distinct(all_items)))
        )
        found = found.withColumn("spans", merged_spans(F.col("starts"), F.col("ends")))
    else:
        edges = F.arrays_zip(F.col("starts").alias("s"), F.col("ends").alias("e"))
        found = found.withColumn("spans", edges)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return found.select("doc", "n_words", "spans", "items", hit.alias("n_hit")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


