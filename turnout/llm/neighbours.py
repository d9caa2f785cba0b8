"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled so that the largest inner product is the least distance: each is divided by a
length and gets one more component, which makes all lengths 1. Vectors are in bands by length, each
half as long as the one before, and divided by the longest length of their band, so that one long
vector does not press the others together; a query visits all bands. A table's hash is a few
projections on normal (2-stable) vectors, cut into steps of WIDTH. A query visits its own bucket
and those that differ by single steps of some projections, in the order of their estimated chance
to hold a near vector: the sum of squared distances to the borders that are crossed.

Vectors are equal in groups: one row stands for each distinct vector, with its rows of the least ids,
as no more than those can be among the nearest. Buckets are split into blocks of about BLOCK distinct
vectors; a block is searched by exact inner products, its best go on, and the best of all tables
are kept for each query. Queries that meet too few vectors are searched against all of them, block
by block.

The numbers of tables and hashes and the width can be fitted (FITTED): TRIAL queries are compared
with all vectors, and of the choices that find TARGET of their nearest, the one that visits the
fewest of SAMPLE vectors is taken. So the share visited falls where the vectors have structure.
"""

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.tables import stored
from turnout.llm.text import sorted_groups

K = 20
BLOCK = 4096
QUERY_BLOCK = 1024
#: Queries that a block is searched for at once when all blocks are.
SHARE = 16384
VECTORS_AT_ONCE = 256
#: Queries and vectors that parameters are fitted on, at any size, and the recall asked for there.
TRIAL, SAMPLE = 64, 1024
TARGET = 0.95
#: What a fit chooses from.
TABLES, HASHES, WIDTHS = (1, 2, 4, 8), (1, 2, 3, 4, 6, 8, 12), (0.5, 1.0, 2.0, 4.0)
#: Arguments of ``nearest`` that leave all three to the fit.
FITTED = {"tables": None, "hashes": None, "width": None}
#: The last band holds all shorter vectors.
MOST_BAND = 60


@dataclass
class Tables:
    """The hash of each table: projections (tables, hashes, dimensions + 1), shifts, width; the
    bands that have vectors, sorted, and the logarithm (base 2) of the longest length in each."""

    projections: np.ndarray
    shifts: np.ndarray
    width: float
    bands: np.ndarray
    longest: np.ndarray

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Steps (vectors, tables, hashes) and the place of each vector within its step."""
        place = np.einsum("vd,thd->vth", vectors, self.projections) / self.width + self.shifts
        step = np.floor(place)
        return step.astype(np.int64), place - step

    def own(self, vectors: np.ndarray, band: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        longest = self.longest[np.searchsorted(self.bands, band)]
        return bucket_keys(self.keys(lengthened(vectors, longest))[0])

    def first(self, tables: int) -> "Tables":
        projections, shifts = self.projections[:tables], self.shifts[:tables]
        return Tables(projections, shifts, self.width, self.bands, self.longest)


def made_tables(
    dimensions: int,
    tables: int,
    hashes: int,
    width: float,
    bands: np.ndarray,
    longest: np.ndarray,
    seed: int = 11,
) -> Tables:
    rng = np.random.default_rng(seed)
    return Tables(
        rng.standard_normal((tables, hashes, dimensions + 1)),
        rng.random((tables, hashes)),
        width,
        bands,
        longest,
    )


def lengthened(vectors: np.ndarray, longest: np.ndarray | None) -> np.ndarray:
    """Vectors of length 1 whose distances order as inner products do: queries (None), or vectors
    by the longest lengths of their bands, given as logarithms. No length overflows or vanishes."""
    if longest is None:
        scaled = vectors / np.abs(vectors).max(1, keepdims=True)
        scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
        rest = np.zeros(len(vectors))
    else:
        whole = np.floor(longest)
        scaled = np.ldexp(vectors, -whole.astype(np.int64)[:, None]) / 2 ** (longest - whole)[:, None]
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1)))
    return np.concatenate([scaled, rest[:, None]], 1)


def bucket_keys(step: np.ndarray) -> np.ndarray:
    """One number per table for the steps of its projections."""
    key = np.zeros(step.shape[:-1], np.uint64)
    for h in range(step.shape[-1]):
        key = (key ^ step[..., h].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def probe_steps(within: np.ndarray, probes: int) -> list[tuple[tuple[int, int], ...]]:
    """The ``probes`` likeliest sets of single steps (projection, -1 or 1), the empty one first.

    Costs are sorted; sets of places in that order come from a heap, each followed by the sets in
    which its last place moves on or the next one joins.
    """
    cost = np.concatenate([within**2, (1 - within) ** 2])
    order = np.argsort(cost, kind="stable")
    hashes = len(within)
    moves = [(int(i % hashes), -1 if i < hashes else 1) for i in order]
    cost = cost[order].tolist()
    found: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < probes:
        score, places = heapq.heappop(heap)
        last = places[-1]
        if last + 1 < len(cost):
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*places[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*places, last + 1)))
        chosen = tuple(moves[i] for i in places)
        if len({h for h, _ in chosen}) == len(chosen):  # not both ways at once
            found.append(chosen)
    return found


def visited(step: np.ndarray, within: np.ndarray, probes: int) -> np.ndarray:
    """The buckets of one table that a query visits."""
    visits = probe_steps(within, probes)
    steps = np.repeat(step[None], len(visits), 0)
    for k, moves in enumerate(visits):
        for h, by in moves:
            steps[k, h] += by
    return bucket_keys(steps)


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``id`` and ``v`` of the rows that take part."""
    number, v = F.col(f"`{id}`").cast("long"), F.col(f"`{vector}`")
    rows = vectors.select(number.alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return rows.filter("id is not null and v is not null").filter(~bad & some)


def as_matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros to ``width``, or to the longest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy().astype(np.float64)
    size = pc.list_value_length(column).to_numpy()
    width = int(size.max(initial=0)) if width is None else width
    if (size == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def with_length(reps: DataFrame) -> DataFrame:
    """The distinct vectors with ``length``, the logarithm (base 2) of their length."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = as_matrix(batch.column(2))
            most = np.abs(matrix).max(1)
            length = np.log2(most) + np.log2(((matrix / most[:, None]) ** 2).sum(1)) / 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(length)], ["rep", "first", "v", "length"]
            )

    kind = reps.schema["v"].dataType.simpleString()
    ddl = f"rep long, first long, v {kind}, length double"
    return reps.select("rep", "first", "v").mapInArrow(measure, ddl)


def hashed(distinct: DataFrame, tables: Tables, query: bool, probes: int) -> DataFrame:
    """One row per vector and bucket: of vectors their own, of queries all that they visit, in all
    bands. A number in ``table`` stands for a table of one band."""
    held = distinct.sparkSession.sparkContext.broadcast(pickle.dumps(tables))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = pickle.loads(held.value)
        count, _, width = made.projections.shape
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS_AT_ONCE):
                part = batch.slice(at, VECTORS_AT_ONCE)
                matrix = as_matrix(part.column(2), width - 1)
                rows, keys, numbers = [], [], []
                if query:
                    step, within = made.keys(lengthened(matrix, None))
                    for t, i in product(range(count), range(len(matrix))):
                        found = visited(step[i, t], within[i, t], probes)
                        for b in made.bands.tolist():
                            rows.append(np.full(len(found), i))
                            keys.append(found)
                            numbers.append(np.full(len(found), b * count + t))
                else:
                    band = part.column(3).to_numpy()
                    own = made.own(matrix, band)
                    for t in range(count):
                        rows.append(np.arange(len(matrix)))
                        keys.append(own[:, t])
                        numbers.append(band * count + t)
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(numbers).astype(np.int32)),
                        pa.array(np.concatenate(keys)),
                        part.column(0).take(row),
                        part.column(1).take(row),
                        part.column(2).take(row),
                    ],
                    ["table", "bucket", "rep", "first", "v"],
                )

    kind = distinct.schema["v"].dataType.simpleString()
    ddl = f"table int, bucket long, rep long, first long, v {kind}"
    columns = ["rep", "first", "v"] if query else ["rep", "first", "v", "band"]
    return distinct.select(*columns).mapInArrow(buckets, ddl)


def search_blocks(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` + 1 best of each block for each query that visits it: exact inner products.

    Rows of a block are vectors (``query`` 0) and queries (1), sorted; there are at most about
    BLOCK vectors, and queries are multiplied QUERY_BLOCK at a time.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["table", "bucket", "block"]):
            asks = group["query"].to_numpy() == 1
            if asks.all() or not asks.any():
                continue
            reps, least = group["rep"].to_numpy(), group["first"].to_numpy()
            matrix = as_matrix(group["v"])
            vectors, names, firsts = matrix[~asks], reps[~asks], least[~asks]
            order = np.lexsort((names, firsts))
            vectors, names, firsts = vectors[order], names[order], firsts[order]
            queries, numbers = matrix[asks], reps[asks]
            best = min(k + 1, len(names))
            for at in range(0, len(numbers), QUERY_BLOCK):
                with np.errstate(over="ignore", invalid="ignore"):
                    score = queries[at : at + QUERY_BLOCK] @ vectors.T
                score[np.isnan(score)] = -np.inf
                # Ties at the border go to the smaller id: the columns are in that order.
                top = np.argsort(-score, axis=1, kind="stable")[:, :best]
                number = np.repeat(numbers[at : at + QUERY_BLOCK], best)
                best_scores = np.take_along_axis(score, top, 1).ravel()
                columns = [number, names[top.ravel()], firsts[top.ravel()], best_scores]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["query_rep", "rep", "first", "score"]
                )

    return rows.select("table", "bucket", "block", "query", "rep", "first", "v").mapInArrow(
        search, "query_rep long, rep long, first long, score double"
    )


def trial_nearest(banded: DataFrame, asked: np.ndarray, reps: np.ndarray, k: int) -> list:
    """Rows ``(query, rep, v, band)`` of the ``k`` vectors nearest to each of a few queries, their
    own left out. Each task keeps its best while it reads, so that few rows are shuffled.
    """
    held = banded.sparkSession.sparkContext.broadcast(pickle.dumps((asked, reps)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, numbers = pickle.loads(held.value)
        best: list[pa.RecordBatch | None] = [None] * len(queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                score = as_matrix(batch.column(1), queries.shape[1]) @ queries.T
            score[np.isnan(score)] = -np.inf
            score[batch.column(0).to_numpy()[:, None] == numbers] = -np.inf
            for i in range(len(queries)):
                top = np.argsort(-score[:, i], kind="stable")[:k]
                found = batch.take(pa.array(top)).append_column("score", pa.array(score[top, i]))
                if best[i] is not None:
                    found = pa.concat_batches([best[i], found])
                    found = found.take(pc.sort_indices(found, [("score", "descending")])[:k])
                best[i] = found
        for i, found in enumerate(best):
            if found is not None:
                yield found.append_column("query", pa.array([i] * len(found), pa.int32()))

    kind = banded.schema["v"].dataType.simpleString()
    ddl = f"rep long, v {kind}, band int, score double, query int"
    found = banded.select("rep", "v", "band").mapInArrow(search, ddl)
    first = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k)
    rows = found.select("query", "rep", "v", "band").collect()
    return [r for r in rows if r.rep != reps[r.query]]


def filled(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def fitted(
    banded: DataFrame,
    query_reps: DataFrame,
    width: int,
    bands: np.ndarray,
    longest: np.ndarray,
    k: int,
    probes: int,
    choices: tuple[tuple, tuple, tuple],
) -> tuple[Tables, float, float]:
    """The tables that visit the fewest vectors among those that find TARGET of the ``k`` nearest in
    a trial, or those that find most, if none do; the share found; the share of vectors visited,
    where a vector that is met in two tables counts twice.

    ``choices`` are the numbers of tables and of hashes, and the widths. Trial queries and sampled
    vectors are chosen by a hash of the vector; no more than TRIAL * (k + 1) + SAMPLE vectors reach
    the driver.
    """
    counts, hashes, widths = choices
    sampled = [F.xxhash64("v"), F.col("rep")]
    asked = query_reps.orderBy(*sampled).limit(TRIAL).select("rep", "v").collect()
    queries = filled([r.v for r in asked], width)
    reps = np.array([r.rep for r in asked], np.int64)
    near = trial_nearest(banded, queries, reps, k) if asked else []
    some = banded.orderBy(*sampled).limit(SAMPLE).select("v", "band").collect()
    of = np.array([r.query for r in near], np.int64)
    near, some = (
        (filled([r.v for r in x], width), np.array([r.band for r in x])) for x in (near, some)
    )
    found = []
    for h, w in product(hashes, widths):
        made = made_tables(width, max(counts), h, w, bands, longest)
        if not len(of):
            return made.first(min(counts)), 1.0, 1.0
        near_keys, some_keys = made.own(*near), made.own(*some)
        step, within = made.keys(lengthened(queries, None))
        met, visits = np.zeros(near_keys.shape, bool), np.zeros(max(counts))
        for i, t in product(range(len(queries)), range(max(counts))):
            keys, mine = visited(step[i, t], within[i, t], probes), of == i
            met[mine, t] = np.isin(near_keys[mine, t], keys)
            visits[t] += np.isin(some_keys[:, t], keys).mean() / len(queries)
        for n in counts:
            recall, share = met[:, :n].any(1).mean(), visits[:n].sum()
            found.append((recall, share, n, h, made.first(n)))
    enough = [x for x in found if x[0] >= TARGET]
    if enough:
        best = min(enough, key=lambda x: x[1:4])
    else:
        best = max(found, key=lambda x: (x[0], -x[1]))
    return best[4], float(best[0]), float(best[1])


def every_block(queries: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """``search_blocks`` of the queries against all vectors, in blocks of both."""
    blocks, shares = (-(-frame.count() // n) for frame, n in ((reps, BLOCK), (queries, SHARE)))

    def dealt_into(n):
        return F.pmod(F.xxhash64("rep"), F.lit(n)).cast("long")

    def all_of(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def rows(frame, bucket, block, query):
        frame = frame.select(bucket.alias("bucket"), "rep", "first", "v")
        number, side = F.lit(0).alias("table"), F.lit(query).alias("query")
        return frame.select(number, "bucket", block.alias("block"), side, "rep", "first", "v")

    both = rows(reps, all_of(shares), dealt_into(blocks), 0).unionAll(
        rows(queries, dealt_into(shares), all_of(blocks), 1)
    )
    place = ["bucket", "block"]
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, *place).sortWithinPartitions("table", *place, "query")
    return search_blocks(dealt, k)


def best_members(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The ``k`` + 1 best rows of each query, from the best distinct vectors of its blocks."""
    best = found.groupBy("query_rep", "rep", "first").agg(F.max("score").alias("score"))
    first = Window.partitionBy("query_rep").orderBy(F.desc("score"), "first", "rep")
    best = best.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).drop("n")
    by_id = Window.partitionBy("query_rep").orderBy(F.desc("score"), "id", "rep")
    lists = best.join(members, "rep").withColumn("n", F.row_number().over(by_id))
    return lists.filter(F.col("n") <= k + 1).select("query_rep", "n", "score", "id", "rep")


def nearest(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    k: int = K,
    tables: int | None = 4,
    hashes: int | None = 4,
    probes: int = 12,
    width: float | None = 2.0,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, the id and ``score`` of the ``k`` nearest found of each query:
    ``k`` for each, or all candidates if there are fewer.

    Queries are the vectors whose id is divisible by ``every``; candidates are all other rows.
    Nearest is the largest inner product in double precision, ties to the smaller id; a product that
    overflows is infinite, and one without a value comes last. Vectors that are null, zero or hold
    null or non-finite components, and rows with a null id, take no part; all others do, however
    small or large. Of two vectors of unequal length the shorter is filled up with zeros. Rows that
    share an id, and equal rows, are rows of their own: each is a query, and only the query's own
    row is no candidate. Equal vectors, however many, cost one search. Empty tables give no rows.

    More ``hashes`` visit a smaller share of the vectors, more ``tables`` and ``probes`` a larger
    one: where ``tables``, ``hashes`` or ``width`` is None, a trial decides (see ``fitted``).
    """
    base = stored(usable(vectors, id, vector), "vectors")
    reps = base.groupBy("v").agg(F.min("id").alias("first"))
    # Numbers of the distinct vectors: ids may be shared. They are written, so they stay.
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "distinct")
    named = stored(base.join(reps, "v").select("id", "rep"), "named")
    measured = stored(with_length(reps), "measured")
    longest, size = measured.agg(F.max("length"), F.max(F.size("v"))).first()
    halved = F.floor(F.lit(longest or 0.0) - F.col("length"))
    band = F.least(F.greatest(halved, F.lit(0)), F.lit(MOST_BAND)).cast("int")
    banded = measured.withColumn("band", band)
    found = banded.groupBy("band").agg(F.max("length").alias("longest")).sort("band").collect()
    bands, lengths = (np.array([r[i] for r in found]) for i in range(2))
    asked = named.filter(F.col("id") % every == 0)
    query_reps = reps.join(asked.select("rep"), "rep", "semi")
    if None in (tables, hashes, width):
        choices = tuple(
            all_ if one is None else (one,)
            for one, all_ in ((tables, TABLES), (hashes, HASHES), (width, WIDTHS))
        )
        made, _, _ = fitted(banded, query_reps, size or 1, bands, lengths, k, probes, choices)
    else:
        made = made_tables(size or 1, tables, hashes, width, bands, lengths)
    place = ["table", "bucket"]
    held = hashed(banded, made, False, probes)
    large = (
        held.groupBy(*place)
        .agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        .filter("blocks > 1")
    )
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("rep"), blocks).alias("block")
    each = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block")
    stored_rows = held.join(large, place, "left")
    stored_rows = stored_rows.select(*place, own, F.lit(0).alias("query"), "rep", "first", "v")
    visits = hashed(query_reps, made, True, probes).join(large, place, "left")
    visits = visits.select(*place, each, F.lit(1).alias("query"), "rep", "first", "v")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored_rows.unionAll(visits).repartition(parts, *place, "block")
    found = search_blocks(dealt.sortWithinPartitions(*place, "block", "query"), k)

    # The least ids of each distinct vector: no others can be among the nearest.
    least = Window.partitionBy("rep").orderBy("id")
    members = named.withColumn("n", F.row_number().over(least))
    members = members.filter(F.col("n") <= k + 1).drop("n")
    lists = stored(best_members(found, members, k), "lists")
    enough = min(k + 1, named.count())
    met = lists.groupBy("query_rep").count().filter(F.col("count") >= enough)
    met = met.select("query_rep")
    few = query_reps.withColumnRenamed("rep", "query_rep").join(met, "query_rep", "anti")
    few = stored(few.select(F.col("query_rep").alias("rep"), "first", "v"), "few")
    if not few.isEmpty():
        whole = best_members(every_block(few, reps, k), members, k)
        lists = lists.join(met, "query_rep", "semi").unionAll(whole)
    whole = lists.groupBy("query_rep").agg(
        F.sort_array(F.collect_list(F.struct("n", "score", "id", "rep"))).alias("all")
    )
    answers = asked.select(F.col("id").alias("query_id"), F.col("rep").alias("query_rep"))
    is_own = F.transform(
        "all", lambda x: (x["rep"] == F.col("query_rep")) & (x["id"] == F.col("query_id"))
    )
    place = F.array_position(is_own, True).cast("int")
    without = F.concat(
        F.slice("all", 1, F.greatest(place - 1, F.lit(0))), F.slice("all", place + 1, k + 1)
    )
    others = F.when(place == 0, F.col("all")).otherwise(without)
    answers = answers.join(whole, "query_rep").select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "near")
    )
    return answers.select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("near.id").alias(id),
        F.col("near.score").alias("score"),
    )
