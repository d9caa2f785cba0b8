"""Substring dedup: remove words covered by passages that occur more than once.

A window is WINDOW consecutive words. Its minimiser is the least of its M-word grams, in an order
that puts common grams last. Consecutive windows of a text with one minimiser form a super-k-mer,
which travels as one packed string, its words joined by single spaces, to the bucket of the
minimiser. Equal windows have equal minimisers, so each bucket counts its windows exactly:

1. Minimisers are counted without their strings; one that occurs once holds no repeated window, so
   its string need not travel.
2. Equal strings are counted before they are dealt to buckets, for some megabytes of text at a
   time: a passage that many texts share arrives as few strings with counts. What shares only
   part of it has rarer grams elsewhere, which come first, so no bucket gathers all texts with
   the passage.
3. A bucket sorts the windows of its strings and marks those that occur twice or more.
4. Marked strings are joined with the places where they stand, and the words go.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm import sketch
from turnout.llm.tables import ROW, TEXT, numbered, stored
from turnout.llm.text import (
    Words,
    gram_hashes,
    mix,
    split_words,
    text_chunks,
    word_hashes,
)

WINDOW = 35
M = 4
#: Windows of one packed string.
LONGEST = 1024
CHUNK = 2 << 20


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys."""
    least, span = keys, 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def gram_keys(hashes: np.ndarray, level: np.ndarray, m: int) -> np.ndarray:
    """Sort keys of all m-grams: the level of how common they are, then their hash."""
    grams = gram_hashes(hashes, m)
    common = level[sketch.cells(grams, len(level))].astype(np.uint64)
    return (common << np.uint64(56)) | (mix(grams) >> np.uint64(8))


def super_kmers(
    words: Words, hashes: np.ndarray, level: np.ndarray, window: int, m: int
) -> tuple[np.ndarray, ...]:
    """Minimiser, how often it stands in the string, text, first word and number of windows of
    each super-k-mer."""
    none = (np.empty(0, np.int64),) * 5
    if len(hashes) < window:
        return none
    keys = gram_keys(hashes, level, m)
    least = sliding_least(keys, window - m + 1)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    begin = np.flatnonzero(text[: len(least)] == text[window - 1 :])
    if not len(begin):
        return none
    new = np.ones(len(begin), bool)
    same = (np.diff(begin) == 1) & (least[begin[1:]] == least[begin[:-1]])
    new[1:] = ~(same & (text[begin[1:]] == text[begin[:-1]]))
    run = np.flatnonzero(new)
    place = np.arange(len(begin)) - np.repeat(run, np.diff(np.append(run, len(begin))))
    at = np.flatnonzero(place % LONGEST == 0)
    count = np.diff(np.append(at, len(begin)))
    key, start = least[begin[at]], begin[at]
    order = np.argsort(keys, kind="stable")
    low = np.searchsorted(keys, key, sorter=order)
    high = np.searchsorted(keys, key, side="right", sorter=order)
    times = np.ones(len(at), np.int64)
    for i in np.flatnonzero(high - low > 1).tolist():
        places = order[low[i] : high[i]]
        end = start[i] + count[i] + window - m
        times[i] = np.searchsorted(places, end) - np.searchsorted(places, start[i])
    return key.view(np.int64), times, text[start], start, count


def find_super_kmers(rows: DataFrame, table: np.ndarray, window: int, m: int) -> DataFrame:
    """``key`` (minimiser), its times in the string, row, first word and number of windows."""
    held = rows.sparkSession.sparkContext.broadcast(table)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, TEXT, CHUNK):
            words = split_words(texts)
            found = super_kmers(words, word_hashes(words), held.value, window, m)
            key, times, text, start, count = found
            row = part.column(part.schema.get_field_index(ROW)).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array(times),
                    pa.array(row[text]),
                    pa.array((start - words.first[text]).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                ["key", "times", ROW, "start", "windows"],
            )

    return rows.mapInArrow(find, f"key long, times long, {ROW} long, start int, windows int")


def packed_strings(texts: DataFrame, window: int, with_string: bool) -> DataFrame:
    """The super-k-mers in ``runs`` of each text: the places where they stand, by digest, or the
    packed strings, equal ones of a part of the texts once with their ``times``."""

    def strings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, chunk in text_chunks(batches, TEXT, CHUNK):
            rows = part.column(part.schema.get_field_index(ROW)).to_pylist()
            runs = part.column(part.schema.get_field_index("runs")).to_pylist()
            places, times = [], {}
            for row, text, found in zip(rows, chunk, runs):
                words = text.split()
                for run in found:
                    a, key = run["start"], run["key"]
                    string = b" ".join(words[a : a + run["windows"] + window - 1])
                    if with_string:
                        times[key, string] = times.get((key, string), 0) + 1
                    else:
                        places.append((digest_of(string), row, a))
            if with_string:
                strings = [string for _, string in times]
                columns = [
                    pa.array([key for key, _ in times], pa.int64()),
                    pa.array([digest_of(string) for string in strings], pa.binary()),
                    pa.array(strings, pa.binary()),
                    pa.array(list(times.values()), pa.int64()),
                ]
            else:
                kinds = [pa.binary(), pa.int64(), pa.int32()]
                columns = [pa.array([p[i] for p in places], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    if with_string:
        names = ["key", "digest", "packed", "times"]
        ddl = "key long, digest binary, packed binary, times long"
    else:
        names, ddl = ["digest", ROW, "start"], f"digest binary, {ROW} long, start int"
    return texts.mapInArrow(strings_of, ddl)


def digest_of(string: bytes) -> bytes:
    return blake2b(string, digest_size=16).digest()


def repeated_windows(
    strings: list[bytes], times: np.ndarray, window: int
) -> list[list[tuple[int, int]]]:
    """For each string, the runs (first, last + 1) of its windows that occur twice or more in all,
    where string i occurs ``times[i]`` times.

    Windows are sorted by hash, and those of one hash compared as bytes.
    """
    words = split_words(strings)
    grams = gram_hashes(word_hashes(words), window)
    count = np.maximum(0, np.diff(words.first) - window + 1)
    first = np.cumsum(count) - count
    of = np.repeat(np.arange(len(strings)), count)
    begin = words.first[of] + np.arange(len(of)) - first[of]
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    if not len(of):
        return out
    order = np.argsort(grams[begin], kind="stable")
    ordered = grams[begin[order]]
    cuts = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1], append=~ordered[-1:]) != 0)
    repeated = np.zeros(len(begin), bool)
    sizes = np.diff(cuts)
    alone = order[cuts[:-1][sizes == 1]]
    repeated[alone] = times[of[alone]] > 1
    for a, b in zip(cuts[:-1][sizes > 1].tolist(), cuts[1:][sizes > 1].tolist()):
        seen: dict[bytes, list[int]] = {}
        for i in order[a:b].tolist():
            at = begin[i]
            seen.setdefault(words.data[words.start[at] : words.end[at + window - 1]], []).append(i)
        for same in seen.values():
            if len(same) > 1 or times[of[same[0]]] > 1:
                repeated[same] = True
    edges = np.diff(repeated, prepend=False, append=False)
    edges[first] = True
    edge = np.flatnonzero(edges)
    for a, b in zip(edge.tolist(), edge[1:].tolist()):
        if a < len(repeated) and repeated[a]:
            out[of[a]].append((int(a - first[of[a]]), int(b - first[of[a]])))
    return out


def whole_buckets(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of about ``most`` bytes of strings that end where a bucket ends."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at, keys = 0, batch.column(0).to_numpy()
        lengths = np.cumsum([len(s) for s in batch.column(2).to_pylist()])
        ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
        if kept and len(keys) and kept[-1].column(0)[-1].as_py() != keys[0] and size >= most:
            yield pa.Table.from_batches(kept)
            kept, size = [], 0
        for end in ends[:-1].tolist():
            have = size + int(lengths[end - 1]) - (int(lengths[at - 1]) if at else 0)
            if have >= most:
                yield pa.Table.from_batches([*kept, batch.slice(at, end - at)])
                kept, size, at = [], 0, end
        if at < len(keys):
            kept.append(batch.slice(at))
            size += int(lengths[-1]) - (int(lengths[at - 1]) if at else 0)
    if kept:
        yield pa.Table.from_batches(kept)


def marked_strings(strings: DataFrame, window: int) -> DataFrame:
    """Digest and runs of repeated windows of the strings that have any."""
    parts = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by key, so that neither the grouping nor the sort shuffles them again.
    dealt = strings.repartition(parts, "key")
    merged = dealt.groupBy("key", "digest", "packed").agg(F.sum("times").alias("times"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in whole_buckets(batches, CHUNK):
            runs = repeated_windows(
                bucket["packed"].to_pylist(), bucket["times"].to_numpy(), window
            )
            hit = [i for i, r in enumerate(runs) if r]
            digest = bucket["digest"].combine_chunks().take(pa.array(hit, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    digest,
                    pa.array([[a for a, _ in runs[i]] for i in hit], pa.list_(pa.int32())),
                    pa.array([[b for _, b in runs[i]] for i in hit], pa.list_(pa.int32())),
                ],
                ["digest", "first", "last"],
            )

    buckets = merged.sortWithinPartitions("key").select("key", "digest", "packed", "times")
    return buckets.mapInArrow(mark, "digest binary, first array<int>, last array<int>")


def remove_words(texts: DataFrame, window: int) -> DataFrame:
    """``id``, ``n_words``, ``n_removed`` and ``kept``, the other words joined by spaces."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, chunk in text_chunks(batches, TEXT, CHUNK):
            spans = part.column(part.schema.get_field_index("spans")).to_pylist()
            total, gone, kept = [], [], []
            for text, marks in zip(chunk, spans):
                words = text.split()
                stay = np.ones(len(words), bool)
                for mark in marks or ():
                    for a, b in zip(mark["first"], mark["last"]):
                        stay[mark["start"] + a : mark["start"] + b + window - 1] = False
                total.append(len(words))
                left = [w for w, s in zip(words, stay.tolist()) if s] if marks else words
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("id")),
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["id", "n_words", "n_removed", "kept"],
            )

    found = texts.mapInArrow(remove, "id long, n_words long, n_removed long, kept binary")
    return found.withColumn("kept", F.col("kept").cast("string"))


def dedup_substrings(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, m: int = M
) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_removed`` and the text ``kept``.

    Words are what white space separates, unchanged. Every word goes that is covered by a window
    which starts anywhere else too, in the same text, in another, or in an equal row; all windows
    are judged on the input, so all copies of a passage go. Null and empty texts have no words;
    texts of fewer words than a window stay.
    """
    rows = numbered(docs, text, id=id).withColumn("id", F.col("id").cast("long"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, texts in text_chunks(batches, TEXT, CHUNK):
            yield gram_hashes(word_hashes(split_words(texts)), m)

    # About six bytes a word.
    size = rows.agg(F.sum(F.octet_length(TEXT))).first()[0] or 0
    table = sketch.levels(rows.select(ROW, TEXT), grams, sketch.cell_bits(size // 6))
    found = stored(find_super_kmers(rows.select(ROW, TEXT), table, window, m), "runs")
    # A window can occur twice only where its minimiser does, be it in one string.
    twice = found.groupBy("key").agg(F.sum("times").alias("n")).filter("n > 1").select("key")
    runs = found.join(twice, "key").groupBy(ROW).agg(
        F.collect_list(F.struct("key", "start", "windows")).alias("runs")
    )
    texts = rows.select(ROW, TEXT).join(runs, ROW)
    marked = marked_strings(packed_strings(texts, window, True), window)
    places = packed_strings(texts, window, False).join(marked, "digest")
    span = F.struct("start", "first", "last")
    spans = places.groupBy(ROW).agg(F.collect_list(span).alias("spans"))
    # Ids and spans meet first, so that the texts are the same as above and shuffled once.
    marks = rows.select(ROW, "id").join(spans, ROW, "left")
    marked_texts = rows.select(ROW, TEXT).join(marks, ROW)
    return remove_words(marked_texts, window).withColumnRenamed("id", id)
