"""Hard negatives by angular triangle filtering.

Components are whole numbers (floor(256 x)) and scores are inner products. Every vector stores its
angles to a few reference directions. If a and b are the angles of two vectors to one direction, the
angle between them lies between |a - b| and a + b, so its cosine lies between cos(a + b) and
cos(a - b); the narrowest of all directions, times both norms and widened by more than rounding can
do, bounds the score. Only pairs whose bounds overlap a window of wanted scores are scored, in exact
integers.

Equal rows (vector and label) form one class with its least ids. Classes are in cells, by their
nearest reference and the angle to it; cells are put together or split into blocks of rows. Anchors
are dealt into shares in the same way. A share meets the blocks whose angles and norms admit a
score in its windows:

1. positives, first in the anchors' own cells, which gives each anchor a least score that its
   positives reach, then in the other blocks that admit more;
2. negatives, within the windows of the positives' scores.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.tables import stored
from turnout.llm.text import sorted_groups

POSITIVES, NEGATIVES = 5, 10
#: Window of a negative's score in percent of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Reference directions, and the rows of the bounded sample that they are picked from.
REFERENCES, SAMPLE = 16, 2000
#: Bands of the angle to the nearest reference.
BANDS = 64
CELLS = REFERENCES * BANDS
#: Rows of a block at least; more where the table is large, so that there are about CELLS blocks.
BLOCK, MOST_BLOCK = 1 << 13, 1 << 17
#: Pairs whose bounds are computed at once.
PAIRS = 1 << 20
#: Allowance for rounding of angles, cosines and norms, as a share of the product of the norms.
SLACK = 1e-6
#: Whole numbers up to this are held in two bytes; sums of products up to EXACT are exact doubles.
SHORT, EXACT = 1 << 15, 1 << 53
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def coded(values: np.ndarray) -> bytes:
    """floor(256 x) of each component: one byte that tells the form, and the numbers. Large ones are
    held as doubles of 1/256 of the number, which is exact for every finite double."""
    whole = np.floor(values * SCALE)
    if (np.abs(whole) < SHORT).all():
        return b"\x02" + whole.astype("<i2").tobytes()
    # 2^44 times 256 is beyond all fractions.
    small = np.abs(values) < 1 << 44
    part = np.where(small, np.floor(np.where(small, values, 0) * SCALE) / SCALE, values)
    return b"\x08" + (part + 0.0).astype("<f8").tobytes()


def parts_of(code: bytes) -> np.ndarray:
    """1/256 of the whole numbers of a coded vector."""
    if code[:1] == b"\x02":
        return np.frombuffer(code, "<i2", offset=1) / SCALE
    return np.frombuffer(code, "<f8", offset=1)


def matrix_of(codes: list[bytes]) -> np.ndarray:
    """1/256 of the whole numbers, one row each; shorter vectors are filled up with zeros."""
    rows = [parts_of(c) for c in codes]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def norms(matrix: np.ndarray) -> np.ndarray:
    """Lengths, without overflow; infinite only beyond the range of doubles."""
    most = np.abs(matrix).max(1, initial=0)
    most[most == 0] = 1
    with np.errstate(over="ignore"):
        return most * np.sqrt(((matrix / most[:, None]) ** 2).sum(1))


def angles(matrix: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of the rows to the directions; a right angle for zero vectors."""
    width = min(matrix.shape[1], directions.shape[1])
    most = np.abs(matrix).max(1, initial=0)
    scaled = matrix / np.where(most == 0, 1, most)[:, None]
    length = np.sqrt((scaled**2).sum(1))
    cosine = scaled[:, :width] @ directions[:, :width].T / np.where(length == 0, 1, length)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def cells_of(angle: np.ndarray) -> np.ndarray:
    near = angle.argmin(1)
    band = np.minimum(angle[np.arange(len(near)), near] * (BANDS / np.pi), BANDS - 1)
    return near * BANDS + band.astype(np.int64)


def references(matrix: np.ndarray, count: int) -> np.ndarray:
    """Directions of sampled vectors, each as far as can be from those before (one at least)."""
    length = norms(matrix)
    unit = matrix[(length > 0) & np.isfinite(length)]
    if not len(unit):
        return np.ones((1, max(1, matrix.shape[1]))) / np.sqrt(max(1, matrix.shape[1]))
    unit = unit / norms(unit)[:, None]
    picked = [0]
    nearest = unit @ unit[0]
    while len(picked) < min(count, len(unit)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    return unit[picked]


class Bounds(NamedTuple):
    """Norms (rows,) and angles (rows, references) of vectors."""

    norm: np.ndarray
    angle: np.ndarray

    def between(self, other: "Bounds") -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest whole scores of each pair (own rows, other rows)."""
        high = np.full((len(self.norm), len(other.norm)), np.inf)
        low = np.full_like(high, -np.inf)
        for r in range(self.angle.shape[1]):
            a, b = self.angle[:, r], other.angle[:, r]
            cosines, sines = np.outer(np.cos(a), np.cos(b)), np.outer(np.sin(a), np.sin(b))
            np.minimum(high, cosines + sines, out=high)  # cos(a - b)
            np.maximum(low, cosines - sines, out=low)  # cos(a + b)
        with np.errstate(over="ignore", invalid="ignore"):
            product = np.outer(self.norm, other.norm) * float(SCALE * SCALE)
            low, high = product * (low - SLACK) - 1, product * (high + SLACK) + 1
        # Products beyond the range of doubles bound nothing.
        return np.nan_to_num(low, nan=-np.inf, neginf=-np.inf, posinf=np.inf), np.nan_to_num(
            high, nan=np.inf, posinf=np.inf, neginf=-np.inf
        )


def whole_scores(vector: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Exact integer inner products of a row with the rows of a matrix, given 1/256 of both; those
    beyond 64 bits count as the nearest 64-bit number."""
    most = np.abs(vector).max(initial=0) * float(SCALE), np.abs(matrix).max(initial=0) * float(SCALE)
    if max(most) < EXACT and most[0] * most[1] * max(1, len(vector)) < EXACT:
        return (matrix @ vector * (SCALE * SCALE)).astype(np.int64)

    def whole(x: float) -> int:
        return int(x) * SCALE if abs(x) >= 1 << 44 else int(x * SCALE)

    own = [whole(x) for x in vector.tolist()]
    sums = (sum(x * whole(y) for x, y in zip(own, row)) for row in matrix.tolist())
    return np.array([min(max(s, LEAST), MOST) for s in sums], np.int64)


def usable(rows: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label`` (after its change) and ``v`` of the rows that take part."""
    number, kind = F.col(f"`{id}`").cast("long"), F.col(f"`{label}`").cast("long")
    changed = F.when(number % 7 == 0, (kind + 1) % 10).otherwise(kind)
    taken = rows.select(number.alias("id"), changed.alias("label"), F.col(f"`{vector}`").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return taken.filter("id is not null and label is not null and v is not null").filter(~bad)


def encoded(rows: DataFrame) -> DataFrame:
    """The rows with their vector as ``code``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            values = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(np.r_[0, [len(x) for x in v]]).tolist()
            codes = [coded(values[a:b]) for a, b in zip(ends, ends[1:])]
            columns = [batch.column(0), batch.column(1), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code"])

    taken = rows.select("id", "label", "v")
    return taken.mapInArrow(encode, "id long, label long, code binary")


def class_name():
    return F.md5(F.concat("code", F.col("label").cast("string").cast("binary")))


def classes_of(rows: DataFrame, least: int) -> DataFrame:
    """One row per vector and label: ``class``, a digest of both, and ``ids``, the ``least`` least."""
    by = Window.partitionBy("code", "label").orderBy("id")
    # Ranks are cut within tasks before the shuffle.
    ranked = rows.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= least)
    grouped = ranked.groupBy("code", "label").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return grouped.withColumn("class", class_name())


def directions_of(classes: DataFrame) -> np.ndarray:
    """Reference directions from the SAMPLE classes with the least digests."""
    rows = classes.select("class", "code").orderBy("class").limit(SAMPLE).collect()
    return references(matrix_of([bytes(r.code) for r in rows]), REFERENCES)


def placed(classes: DataFrame, directions: np.ndarray) -> DataFrame:
    """The classes with ``norm`` (1/256 of it), ``angles`` and ``cell``."""
    columns = ["class", "label", "ids", "code"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = matrix_of(batch.column(3).to_pylist())
            angle = angles(matrix, directions)
            made = [pa.array(norms(matrix)), pa.array(list(angle)), pa.array(cells_of(angle))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], [*columns, "norm", "angles", "cell"]
            )

    ddl = "class string, label long, ids array<long>, code binary, norm double, angles array<double>, cell long"
    return classes.select(*columns).mapInArrow(place, ddl)


class Dealing(NamedTuple):
    """Block numbers of cells: cell c has ``pieces[c]`` blocks from ``first[c]`` on; small cells
    next to each other share one."""

    first: np.ndarray
    pieces: np.ndarray


def dealing(rows: DataFrame) -> Dealing:
    """Blocks for the cells of the rows: CELLS counts are all that is collected."""
    count = np.zeros(CELLS, np.int64)
    for r in rows.groupBy("cell").count().collect():
        count[r.cell] = r["count"]
    most = min(MOST_BLOCK, max(BLOCK, int(count.sum()) // CELLS))
    first, pieces = np.zeros(CELLS, np.int64), np.ones(CELLS, np.int64)
    number, held = 0, 0
    for c in range(CELLS):
        if held and held + count[c] > most:
            number, held = number + 1, 0
        first[c], pieces[c] = number, max(1, -(-int(count[c]) // most))
        held += count[c]
        if pieces[c] > 1:
            number, held = number + int(pieces[c]), 0
    return Dealing(first, pieces)


class Ranges(NamedTuple):
    """Least and greatest norm and angles of groups (cells or shares), by ``key``."""

    key: np.ndarray
    norm: np.ndarray
    angle: np.ndarray

    @staticmethod
    def of(rows: DataFrame, key: str, directions: int) -> "Ranges":
        each = [F.get("angles", F.lit(r)) for r in range(directions)]
        found = rows.groupBy(key).agg(
            *(F.array(f("norm"), *map(f, each)).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi")))
        )
        got = found.orderBy(key).collect()
        held = np.array([(r.lo, r.hi) for r in got]).reshape(len(got), 2, directions + 1)
        return Ranges(np.array([r[key] for r in got]), held[:, :, 0], held[:, :, 1:])

    def admitted(self, other: "Ranges") -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores of any pair of each own group and each other group."""
        high = np.full((len(self.key), len(other.key)), np.inf)
        low = np.full_like(high, -np.inf)
        for r in range(self.angle.shape[2]):
            (a, b), (c, d) = self.angle[:, :, r].T, other.angle[:, :, r].T
            apart = np.where(a[:, None] > d, a[:, None] - d, np.where(c > b[:, None], c - b[:, None], 0))
            high = np.minimum(high, np.cos(apart))
            least, most = a[:, None] + c, b[:, None] + d
            turned = (least <= np.pi) & (most >= np.pi)
            low = np.maximum(low, np.where(turned, -1, np.minimum(np.cos(least), np.cos(most))))
        with np.errstate(over="ignore", invalid="ignore"):
            scale = float(SCALE * SCALE)
            small, great = (np.outer(self.norm[:, k], other.norm[:, k]) * scale for k in (0, 1))
            high = high + SLACK
            low = low - SLACK
            high = np.where(high > 0, great, small) * high + 1
            low = np.where(low < 0, great, small) * low - 1
        return np.nan_to_num(low, nan=-np.inf, neginf=-np.inf), np.nan_to_num(high, nan=np.inf, posinf=np.inf)


def windows_search(meets: DataFrame, same_label: bool, k: int) -> DataFrame:
    """For each anchor class and window, the ``k`` best rows of each block whose scores lie in it:
    ``class``, ``window``, ``score``, ``id`` and ``own``, whether the row is of the anchor's class.

    Rows of a group are a block's classes (``asks`` 0) and anchors (1) with windows ``lo`` to ``hi``
    (null: open). Candidates are scored from the greatest upper bound on; what is found raises
    the least score of its window.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["share", "block"]):
            asks = group["asks"].to_numpy() == 1
            if asks.all() or not asks.any():
                continue
            matrix = matrix_of(group["code"].to_pylist())
            flat = group["angles"].combine_chunks().flatten().to_numpy()
            bounds = Bounds(group["norm"].to_numpy(), flat.reshape(len(matrix), -1))
            label, name = group["label"].to_numpy(), np.array(group["class"].to_pylist())
            at = np.flatnonzero(~asks)
            ids = [group["ids"][int(i)].as_py() for i in at]
            least = np.array([i[0] for i in ids])
            rows, row_label, row_name = matrix[at], label[at], name[at]
            row_bounds = Bounds(bounds.norm[at], bounds.angle[at])
            anchors = np.flatnonzero(asks)
            step = max(1, PAIRS // len(at))
            out: list[list] = [[], [], [], [], []]
            for a in range(0, len(anchors), step):
                some = anchors[a : a + step]
                low, high = Bounds(bounds.norm[some], bounds.angle[some]).between(row_bounds)
                for i, anchor in enumerate(some.tolist()):
                    fits = (row_label == label[anchor]) == same_label
                    wanted = [
                        (w["lo"], w["hi"]) for w in group["windows"][int(anchor)].as_py()
                    ]
                    found = best_in_windows(
                        matrix[anchor], rows, least, low[i], high[i], fits, wanted, k
                    )
                    for w, best in enumerate(found):
                        pairs = sorted(
                            (-score, id, row_name[j] == name[anchor])
                            for score, j in best
                            for id in ids[j]
                        )[:k]
                        out[0] += [str(name[anchor])] * len(pairs)
                        out[1] += [w] * len(pairs)
                        out[2] += [-score for score, _, _ in pairs]
                        out[3] += [id for _, id, _ in pairs]
                        out[4] += [bool(own) for _, _, own in pairs]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, kinds)], ["class", "window", "score", "id", "own"]
            )

    key = ["share", "block"]
    parts = int(meets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = meets.repartition(parts, *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(search, "class string, window int, score long, id long, own boolean")


def best_in_windows(
    anchor: np.ndarray,
    rows: np.ndarray,
    least: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    fits: np.ndarray,
    windows: list[tuple[int | None, int | None]],
    k: int,
) -> list[list[tuple[int, int]]]:
    """For each window (None: open) the (score, row) of its ``k`` best rows, ties to the ``least``
    id. Rows whose bounds overlap no window are not scored."""
    floor = [lo for lo, _ in windows]
    found: list[list[tuple[int, int]]] = [[] for _ in windows]

    def overlap(rows: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(rows), bool)
        for lo, (_, hi) in zip(floor, windows):
            one = np.ones(len(rows), bool) if lo is None else high[rows] >= lo
            hit |= one if hi is None else one & (low[rows] <= hi)
        return rows[hit]

    left = overlap(np.flatnonzero(fits))
    left = left[np.argsort(-high[left], kind="stable")]
    size = 4 * k
    while len(left):
        take, left = left[:size], left[size:]
        scores = whole_scores(anchor, rows[take])
        for w, (_, hi) in enumerate(windows):
            inside = np.ones(len(take), bool) if floor[w] is None else scores >= floor[w]
            inside = inside if hi is None else inside & (scores <= hi)
            if not inside.any():
                continue
            new = [(int(s), int(j)) for s, j in zip(scores[inside], take[inside])]
            if len(new) > 4 * k:
                s, j = scores[inside], take[inside]
                order = np.lexsort((least[j], -s))
                new = [(int(s[o]), int(j[o])) for o in order[:k]]
            found[w] = sorted(found[w] + new, key=lambda x: (-x[0], least[x[1]]))[:k]
            if len(found[w]) == k:
                floor[w] = found[w][-1][0]
        size *= 8
        left = overlap(left)
    return found


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each class and window, ranked by ``n``."""
    by = Window.partitionBy("class", "window").orderBy(F.desc("score"), "id", F.desc("own"))
    return found.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= k)


class Layout(NamedTuple):
    """Blocks of rows and shares of anchors, and which may meet.

    A run is a cell with its blocks, or some small cells that share a block; runs and shares are
    bounded in number, so their ranges and what they admit are held by the driver.
    """

    rows: DataFrame
    anchors: DataFrame
    runs: Ranges
    shares: Ranges
    pieces: dict[int, int]

    def meets(self, which: np.ndarray, windows: DataFrame) -> DataFrame:
        """Rows and anchors of the pairs of share and run in ``which``, by share and block; anchors
        have ``windows``, those without take no part."""
        spark = self.rows.sparkSession
        runs, shares = self.runs.key.tolist(), self.shares.key.tolist()
        of_run = [(run, [shares[i] for i in np.flatnonzero(which[:, k])]) for k, run in enumerate(runs)]
        of_share = [
            (share, [(runs[k], self.pieces[runs[k]]) for k in np.flatnonzero(which[i])])
            for i, share in enumerate(shares)
        ]
        # Both lists have an entry for each pair at most: some MB where all meet all.
        to_shares = spark.createDataFrame(of_run, "run long, shares array<long>")
        to_runs = spark.createDataFrame(of_share, "share long, runs array<struct<run:long,pieces:long>>")
        columns = ["share", "block", "asks", "class", "label", "ids", "code", "norm", "angles", "windows"]
        none = F.lit(None).cast("array<struct<lo:long,hi:long>>").alias("windows")
        held = self.rows.join(F.broadcast(to_shares), "run").withColumn("share", F.explode("shares"))
        held = held.select("*", F.lit(0).alias("asks"), none)
        asking = self.anchors.join(windows, "class").join(F.broadcast(to_runs), "share")
        asking = asking.withColumn("at", F.explode("runs"))
        last = F.col("at.run") + F.col("at.pieces") - 1
        asking = asking.withColumn("block", F.explode(F.sequence(F.col("at.run"), last)))
        asking = asking.withColumn("asks", F.lit(1))
        return held.select(*columns).unionAll(asking.select(*columns))

    def per_share(self, windows: DataFrame, value) -> np.ndarray:
        """An aggregate over the windows of each share's anchors; null where it has none."""
        got = self.anchors.join(windows, "class").groupBy("share").agg(value.alias("value")).collect()
        value_of = {r.share: r.value for r in got}
        return np.array([value_of.get(s) for s in self.shares.key.tolist()], object)


def laid_out(classes: DataFrame, asked: DataFrame, directions: int) -> Layout:
    spark = classes.sparkSession
    anchors = classes.join(asked, "class", "semi")
    dealt_rows, dealt_anchors = dealing(classes), dealing(anchors)

    def dealt(frame: DataFrame, by: Dealing, first: str, number: str) -> DataFrame:
        cells = [(c, int(by.first[c]), int(by.pieces[c])) for c in range(CELLS)]
        cells = F.broadcast(spark.createDataFrame(cells, f"cell long, {first} long, pieces long"))
        at = F.col(first) + F.pmod(F.xxhash64("class"), F.col("pieces"))
        return frame.join(cells, "cell").withColumn(number, at).drop("pieces")

    rows = stored(dealt(classes, dealt_rows, "run", "block"), "rows")
    shared = stored(dealt(anchors, dealt_anchors, "first", "share").drop("first"), "anchors")
    pieces = dict(zip(dealt_rows.first.tolist(), dealt_rows.pieces.tolist()))
    for run, count in zip(dealt_rows.first.tolist(), dealt_rows.pieces.tolist()):
        pieces[run] = max(pieces[run], count)
    runs, shares = Ranges.of(rows, "run", directions), Ranges.of(shared, "share", directions)
    return Layout(rows, shared, runs, shares, pieces)


def best_positives(layout: Layout, k: int) -> DataFrame:
    """The ``k`` best rows of an anchor's label, itself among them: ``class``, ``n``, ``score``,
    ``id``, ``own``."""
    shape = "array<struct<lo:long,hi:long>>"
    open_ = F.array(F.struct(F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi")))
    every = layout.anchors.select("class", open_.cast(shape).alias("windows"))
    run_of = {r: i for i, r in enumerate(layout.runs.key.tolist())}
    share_of = {s: i for i, s in enumerate(layout.shares.key.tolist())}
    home = np.zeros((len(share_of), len(run_of)), bool)
    own = layout.anchors.join(layout.rows.select("class", "run"), "class").select("share", "run")
    for r in own.distinct().collect():
        home[share_of[r.share], run_of[r.run]] = True
    near = stored(best_of(windows_search(layout.meets(home, every), True, k), k), "near")
    least = near.groupBy("class").agg(F.max(F.when(F.col("n") == k, F.col("score"))).alias("lo"))
    least = stored(
        layout.anchors.select("class").join(least, "class", "left").select(
            "class", F.array(F.struct("lo", F.lit(None).cast("long").alias("hi"))).alias("windows")
        ),
        "least",
    )
    floor = layout.per_share(least, F.min(F.coalesce(F.col("windows")[0]["lo"], F.lit(LEAST))))
    _, high = layout.shares.admitted(layout.runs)
    far = (high >= floor.astype(float)[:, None]) & ~home
    if not far.any():
        return near
    more = windows_search(layout.meets(far, least), True, k)
    return stored(best_of(near.drop("n").unionAll(more), k), "positives")


def percent_of(percent: int, up: bool):
    """``percent`` of the score (not below 0) in whole numbers, within 64 bits."""
    rest = percent * (F.col("score") % 100) + (99 if up else 0)
    whole = F.expr("score div 100") * percent
    return whole + F.floor(rest / 100).cast("long")


def hard_negatives(
    rows: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """For each anchor and positive the best negatives whose scores are ``low`` to ``high`` percent
    of the positive's: ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``,
    ``positive_score``, ``negative_score``.

    Anchors are the rows whose id is divisible by ``every``, positives the first other rows of an
    anchor's label, negatives rows of other labels; greater scores come first, ties to the lesser
    id. Where an id is divisible by 7, its label first becomes (label + 1) % 10. A score is the inner
    product of the components' floor(256 x). A positive with a negative score admits none, as its
    window is empty; one with the score 0 admits negatives with 0.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Zero and
    empty vectors do; of two vectors of unequal length the shorter is filled up with zeros. Scores
    beyond 64 bits count as the nearest 64-bit number. Repeated rows, and rows that share an id, are
    rows of their own: only the anchor itself is no positive of its own. An empty table gives no
    rows. Other columns, whatever their names, are not looked at.
    """
    base = stored(encoded(usable(rows, id, vector, label)), "coded")
    classes = stored(classes_of(base, max(positives + 1, negatives)), "classes")
    directions = directions_of(classes)
    asking = base.filter(F.col("id") % every == 0).select("id", class_name().alias("class"))
    asking = stored(asking, "asking")
    if asking.isEmpty():
        ddl = "anchor_id long, positive_id long, rank int, negative_id long, "
        return rows.sparkSession.createDataFrame([], ddl + "positive_score long, negative_score long")
    layout = laid_out(placed(classes, directions), asking.select("class").distinct(), len(directions))

    near = best_positives(layout, positives + 1)
    wanted = near.filter("score >= 0").select("class", "score").distinct()
    window = F.struct(
        "score", percent_of(low, True).alias("lo"), percent_of(high, False).alias("hi")
    )
    wanted = wanted.groupBy("class").agg(F.sort_array(F.collect_list(window)).alias("all"))
    wanted = stored(
        wanted.select(
            "class",
            F.transform("all", lambda w: w["score"]).alias("scores"),
            F.transform("all", lambda w: F.struct(w["lo"], w["hi"])).alias("windows"),
        ),
        "windows",
    )
    least = layout.per_share(wanted, F.min(F.array_min("windows.lo")))
    most = layout.per_share(wanted, F.max(F.array_max("windows.hi")))
    some = np.array([x is not None for x in least])
    least, most = (np.where(some, x, 0).astype(float)[:, None] for x in (least, most))
    small, great = layout.shares.admitted(layout.runs)
    which = some[:, None] & (great >= least) & (small <= most)
    met = layout.meets(which, wanted.select("class", "windows"))
    found = best_of(windows_search(met, False, negatives), negatives)
    found = found.join(wanted.select("class", "scores"), "class").select(
        "class",
        F.get("scores", F.col("window")).alias("positive_score"),
        F.col("n").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )

    lists = near.groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("n", "score", "id", "own"))).alias("all")
    )
    own = F.transform("all", lambda x: x["own"] & (x["id"] == F.col("anchor_id")))
    place = F.array_position(own, True).cast("int")
    rest = F.when(place == 0, F.col("all")).otherwise(
        F.concat(F.slice("all", 1, F.greatest(place - 1, F.lit(0))), F.slice("all", place + 1, positives + 1))
    )
    pairs = asking.withColumnRenamed("id", "anchor_id").join(lists, "class")
    pairs = pairs.select("class", "anchor_id", F.explode(F.slice(rest, 1, positives)).alias("p"))
    pairs = pairs.select(
        "class", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score")
    )
    return pairs.join(found, ["class", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
