"""Near copies by min-max hashing: texts whose sets of word n-grams overlap by 80 percent or more.

Under one permutation of all hashes, two sets have the same least element with a chance that is
their Jaccard similarity, and the same greatest element with that chance too. Both are kept, so
PERMUTATIONS evaluations per entry give twice as many values, and as the least and the greatest of
one permutation are hardly ever the same entry, their mean estimates the similarity with less
variance than as many independent least elements. The values are cut into BANDS of ROWS; texts that
agree in a whole band share a bucket.

Texts with equal sets form one class first, and one text of each class goes on. At a similarity of
0.8 a pair shares no bucket with a chance of 5e-7 (``miss``); above that, with less. Buckets propose
pairs in two rounds, and every proposed pair is confirmed on the full sets:

1. the first row of a bucket with each other one (a star);
2. after these links have been made components, rows of one bucket in different components. A row
   that meets a bucket's largest component is compared with all of it, once, wherever they meet, and
   the rows of that component not with each other: n copies with few strangers cost n comparisons
   for each stranger. The other rows of a bucket are compared with each other, each pair in the first
   bucket that it shares. This is done block against block within tasks, by sizes and signatures
   first; no pair is emitted that these rule out.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.components import components
from turnout.llm.jaccard_join import class_rows, shingle_sets
from turnout.llm.tables import ROW, TEXT, bucketed, numbered, stored
from turnout.llm.text import mix, sorted_groups, text_chunks

N = 2
PERCENT = 80
ROWS, BANDS = 6, 48
PERMUTATIONS = ROWS * BANDS // 2
#: Least share of equal values at which a pair of PERCENT is still looked at: seven standard
#: deviations of 2 * PERMUTATIONS independent values below 0.8; a link is lost to it once in 1e12.
ADMITTED = 0.635
#: Partners of a row, or rows of a component and their strangers, whose texts meet in a task, and the
#: entries of their sets.
BLOCK, BLOCK_ENTRIES = 256, 1 << 20
#: Rows of a bucket whose signatures meet in a task.
MINORS = 1024
HASH_BYTES = 1 << 19

_random = np.random.Generator(np.random.PCG64(20250612))
_FLIP = _random.integers(0, 1 << 64, PERMUTATIONS, dtype=np.uint64)
_STEP = _random.integers(0, 1 << 64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_PLACE = _random.integers(0, 1 << 64, ROWS, dtype=np.uint64) | np.uint64(1)


def miss(similarity: float) -> float:
    """Chance that two sets of this similarity share no bucket."""
    return (1 - similarity**ROWS) ** BANDS


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, 2 * PERMUTATIONS): the least elements under each permutation, then the greatest.

    No set is empty. A permutation flips bits of the hashes and multiplies by an odd number.
    """
    entries = np.concatenate(sets)
    size = np.array([len(s) for s in sets])
    first = np.cumsum(size) - size
    out, moved = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64), np.empty_like(entries)
    for p in range(PERMUTATIONS):
        np.bitwise_xor(entries, _FLIP[p], out=moved)
        np.multiply(moved, _STEP[p], out=moved)
        out[:, p] = np.minimum.reduceat(moved, first)
        out[:, PERMUTATIONS + p] = np.maximum.reduceat(moved, first)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """One bucket for each set and band. The values of a band belong to different permutations."""
    cut = found.reshape(len(found), BANDS, ROWS)
    key = (cut * _PLACE).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    return mix(key)


def signed(reps: DataFrame, n: int) -> DataFrame:
    """Row, size of the set, the buckets, and the lowest byte of each value of the signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, TEXT, HASH_BYTES):
            sets = list(shingle_sets(texts, n))
            found = signatures(sets)
            keys = band_keys(found).view(np.int64)
            short = mix(found).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index(ROW)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(list(keys), pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in short], pa.binary()),
                ],
                [ROW, "size", "buckets", "signature"],
            )

    return reps.select(ROW, TEXT).mapInArrow(
        sign, f"{ROW} long, size long, buckets array<long>, signature binary"
    )


def admitted_sizes(x: str, y: str, percent: int):
    """Whether sets of these sizes can overlap enough."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def overlapping(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Numbers of the sets that overlap a set by ``percent`` of the union. None is empty."""
    size = np.array([len(s) for s in others])
    entries = np.concatenate(others)
    place = np.searchsorted(own, entries)
    place[place == len(own)] = 0
    shared = np.add.reduceat(own[place] == entries, np.cumsum(size) - size, dtype=np.int64)
    return np.flatnonzero(100 * shared >= percent * (size + len(own) - shared))


def confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of rows whose full sets overlap enough.

    The partners of a row are dealt into blocks, each with the row's own text, so that a row with a
    third of all others is many comparisons.
    """
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    partners = pairs.join(blocks, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), F.col("b").alias(ROW)
    )
    own = blocks.select(
        "a",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.col("a").alias(ROW),
    )
    rows = partners.unionAll(own).hint("merge").join(docs, ROW)
    rows = rows.withColumn("other", F.col(ROW) != F.col("a"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["a", "block"]):
            names = group[ROW].to_pylist()  # the row itself comes first
            if len(names) == 1:
                continue
            sets = [s for t in group[TEXT].to_pylist() for s in shingle_sets([t], n)]
            found = overlapping(sets[0], sets[1:], percent).tolist()
            links = [[names[0]] * len(found), [names[1 + i] for i in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in links], ["a", "b"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "a", "block").sortWithinPartitions("a", "block", "other", ROW)
    return dealt.select("a", "block", ROW, TEXT).mapInArrow(confirm, "a long, b long")


def byte_rows(group: pa.Table) -> np.ndarray:
    held = b"".join(group["signature"].to_pylist())
    return np.frombuffer(held, np.uint8).reshape(group.num_rows, -1)


def admitted(x: int, y: np.ndarray, size: np.ndarray, values: np.ndarray, percent: int) -> np.ndarray:
    """Those of the rows ``y`` whose size and signature admit a link with the row ``x``."""
    y = y[100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])]
    return y[(values[y] == values[x]).mean(1) >= ADMITTED]


def alike(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of rows that meet in a task (bucket, i, j), of different ``part``, whose sizes
    and signatures admit a link, each in the first of the ``buckets`` it shares. ``side`` 0 is
    compared with 1, or with itself if alone."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket", "i", "j"]):
            names, size = group[ROW].to_numpy(), group["size"].to_numpy()
            part, side = group["part"].to_numpy(), group["side"].to_numpy()
            values, here = byte_rows(group), group["bucket"][0].as_py()
            keys = group["buckets"].combine_chunks().flatten().to_numpy().reshape(len(names), -1)
            left = np.flatnonzero(side == 0)
            alone = len(left) == len(side)
            right = left if alone else np.flatnonzero(side == 1)
            for n, x in enumerate(left.tolist()):
                y = right[n + 1 :] if alone else right
                y = admitted(x, y[part[y] != part[x]], size, values, percent)
                shared = keys[y] == keys[x]
                y = y[keys[x][shared.argmax(1)] == here] if len(y) else y
                if len(y):
                    pair = np.sort(np.stack([np.full(len(y), names[x]), names[y]]), 0)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in pair], ["a", "b"])

    task = ["bucket", "i", "j"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, *task).sortWithinPartitions(*task)
    columns = [*task, "side", ROW, "part", "size", "buckets", "signature"]
    return dealt.select(*columns).mapInArrow(compare, "a long, b long")


def linked(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between rows of ``side`` 0 and 1 that meet in a task (part, i, j)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["part", "i", "j"]):
            names, size = group[ROW].to_numpy(), group["size"].to_numpy()
            side, values = group["side"].to_numpy(), byte_rows(group)
            right = np.flatnonzero(side == 1)
            pairs = [(x, admitted(x, right, size, values, percent)) for x in np.flatnonzero(side == 0)]
            pairs = [(x, y) for x, y in pairs if len(y)]
            if not pairs:
                continue
            used = np.unique(np.concatenate([[x for x, _ in pairs], *(y for _, y in pairs)]))
            texts = group[TEXT].take(pa.array(used)).to_pylist()
            sets = dict(zip(used.tolist(), shingle_sets(texts, n)))
            for x, y in pairs:
                found = y[overlapping(sets[int(x)], [sets[k] for k in y.tolist()], percent)]
                if len(found):
                    both = np.full(len(found), names[x]), names[found]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in both], ["a", "b"])

    task = ["part", "i", "j"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, *task).sortWithinPartitions(*task)
    columns = [*task, "side", ROW, "size", "signature", TEXT]
    return dealt.select(*columns).mapInArrow(compare, "a long, b long")


def up_to(first, last):
    """One row for each number from ``first`` to ``last``, none if there is none."""
    return F.explode(F.filter(F.sequence(first, F.greatest(first, last)), lambda x: x <= last))


def among_minors(minors: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows of one bucket that may be linked; rows of its largest component are left out."""
    counted = minors.groupBy("bucket").agg(
        F.ceil(F.count("*") / MINORS).alias("blocks"),
        F.min("part").alias("p"),
        F.max("part").alias("q"),
    )
    rows = minors.join(counted.filter("p != q").select("bucket", "blocks"), "bucket")
    rows = rows.withColumn("own", F.pmod(F.xxhash64(ROW), F.col("blocks"))).join(known, ROW)
    zero, own = F.lit(0).cast("long"), F.col("own")

    def tasks(side, i, j):
        columns = ["bucket", i.alias("i"), j.alias("j"), F.lit(side).alias("side"), ROW, "part"]
        return rows.select(*columns, "size", "buckets", "signature")

    upper, lower = up_to(own, F.col("blocks") - 1), up_to(zero, own - 1)
    return alike(tasks(0, own, upper).unionAll(tasks(1, lower, own)), percent)


def with_largest(
    minors: DataFrame, of: DataFrame, known: DataFrame, reps: DataFrame, n: int, percent: int
) -> DataFrame:
    """Links of rows with the largest components of their buckets. Each row and component meet once,
    whatever the number of buckets that they share."""
    known = known.select(ROW, "size", "signature")
    asks = minors.filter("is_met").select(F.col("largest").alias("part"), ROW).distinct()
    whole = of.unionAll(of.select(F.col("part").alias(ROW), "part").distinct())
    members = whole.select("part", ROW).join(asks.select("part").distinct(), "part", "semi")
    sides = [stored(side.join(known, ROW), "sides") for side in (asks, members)]
    counts = [
        side.groupBy("part").agg(
            F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_ENTRIES)).alias(name)
        )
        for side, name in zip(sides, ("asked", "held"))
    ]
    blocks = counts[0].join(counts[1], "part")
    zero = F.lit(0).cast("long")

    def tasks(side, own, other):
        rows = sides[side].join(blocks, "part")
        mine = F.pmod(F.xxhash64(ROW), F.col(own))
        each = up_to(zero, F.col(other) - 1)
        i, j = (each, mine) if side else (mine, each)
        return rows.select(
            "part", i.alias("i"), j.alias("j"), F.lit(side).alias("side"), ROW, "size", "signature"
        )

    both = tasks(0, "asked", "held").unionAll(tasks(1, "held", "asked"))
    return linked(both.hint("merge").join(reps, ROW), n, percent)


def minor_rows(members: DataFrame, of: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, but those of the bucket's largest one.

    ``is_met``: whether that one has several rows in the bucket. If it has not, all are alike, and
    none is left out.
    """
    placed = members.join(of, ROW, "left").withColumn("part", F.coalesce("part", ROW))
    placed = stored(placed, "placed")
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "part")).alias("most"), F.count("*").alias("parts")
    )
    plan = largest.filter("parts > 1").select(
        "bucket", F.col("most.part").alias("largest"), (F.col("most.n") > 1).alias("is_met")
    )
    rows = placed.join(plan, "bucket").filter("part != largest or not is_met")
    return stored(rows, "minors")


def class_links(reps: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) of the rows ``reps`` that connect what all links would connect."""
    made = stored(signed(reps, n), "signed")
    held = made.select(ROW, "size", F.explode("buckets").alias("bucket"))
    # Counted within tasks first: a common bucket sends one row from each.
    shared = held.groupBy("bucket").agg(
        F.min(F.struct(ROW, "size")).alias("head"), F.count("*").alias("n")
    )
    shared = shared.filter("n > 1").select("bucket", "head")
    members = stored(held.join(shared, "bucket"), "buckets")
    star = members.filter(f"{ROW} != head.{ROW}").filter(admitted_sizes("head.size", "size", percent))
    pairs = star.select(F.col(f"head.{ROW}").alias("a"), F.col(ROW).alias("b"))
    pairs = stored(pairs.distinct(), "pairs")
    links = stored(confirmed(pairs, reps, n, percent), "found")

    of = components(links).select(F.col("a").alias(ROW), F.col("b").alias("part"))
    minors = minor_rows(members.select("bucket", ROW), of)
    if minors.isEmpty():
        return links
    links = links.unionAll(stored(with_largest(minors, of, made, reps, n, percent), "found"))
    more = among_minors(minors, made, percent)
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(more.join(tested, ["a", "b"], "anti"), "pairs")
    return links.unionAll(stored(confirmed(more, reps, n, percent), "found"))


def near_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """Per row: the id, ``n_shingles``, ``component_id``, and ``is_first``, whether the row is the
    one of its component to keep.

    Words are what white space separates, A-Z in lower case; a text of fewer than ``n`` words is one
    n-gram of all of them. Two rows are linked if their sets overlap by ``percent`` of the union, 80
    or more; a component is what links connect, and its id the least id in it (nulls are never
    least; null if all are null). A null or empty text has no set and is alone. Equal texts are
    linked, however many; of rows with the least id, one is kept. An empty table gives no rows;
    other columns, whatever their names, are not looked at.
    """
    rows = numbered(docs, text, id=id).withColumn("id", F.col("id").cast("long"))
    found = stored(class_rows(rows, n), "classes")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)
    classes = (
        found.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min(ROW).alias("rep"), F.min(place).alias("first"))
    )
    classes = stored(classes, "classes")
    ids = classes.select(F.col("rep").alias(ROW)).hint("merge")
    reps = bucketed(rows.select(ROW, TEXT).join(ids, ROW, "semi"), ROW)
    of = components(class_links(reps, n, percent))
    of = of.select(F.col("a").alias("rep"), F.col("b").alias("part"))
    placed = classes.join(of, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    firsts = placed.groupBy("part").agg(F.min("first").alias("first"))
    labels = placed.drop("first").join(firsts, "part").select("digest", "first")
    known = found.join(labels, "digest", "left")
    alone = F.col("digest").isNull()
    return known.select(
        F.col("id").alias(id),
        F.col("size").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        (alone | (F.col(ROW) == F.col(f"first.{ROW}"))).alias("is_first"),
    )
