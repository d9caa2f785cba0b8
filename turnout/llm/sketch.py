"""How common hashes are in the corpus, in a table of bounded size.

Hashes fall into cells, about one for each PER_CELL of them but at most 2^MOST_BITS, which are
counted; a cell's level is twice the logarithm of its count. An order by level puts what is common
last. Only the choice between otherwise equal plans may rest on it: a level is no count of one hash.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

PER_CELL = 16
LEAST_BITS, MOST_BITS = 16, 24
PARTS = 64


def cell_bits(hashes: int) -> int:
    """Bits of the table for so many hashes; its levels take 16 MB at most."""
    return min(MOST_BITS, max(LEAST_BITS, (hashes // PER_CELL).bit_length()))


def cells(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes & np.uint64(size - 1)).astype(np.int64)


def levels(
    rows: DataFrame,
    hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
    bits: int,
) -> np.ndarray:
    """The level of each of 2^bits cells, one byte each.

    Each task counts into a table of its own, up to 255 for a cell, and hands on its parts packed.
    Tables are added in shares of the tasks first, by as many reducers as there are shuffle
    partitions, then the sums of the shares are, so no reducer reads the tables of all tasks.
    """
    size, part = 1 << bits, (1 << bits) // PARTS
    shares = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTS)

    def packed(keys: list[tuple[int, int]], counts: list[np.ndarray]) -> pa.RecordBatch:
        data = [zlib.compress(c.tobytes(), 1) for c in counts]
        share, number = (pa.array([key[i] for key in keys], pa.int64()) for i in range(2))
        return pa.RecordBatch.from_arrays(
            [share, number, pa.array(data, pa.binary())], ["share", "part", "counts"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for found in hashes(batches):
            cell, times = np.unique(cells(found, size), return_counts=True)
            total[cell] += times.astype(np.uint32)
        if total.any():
            share = TaskContext.get().partitionId() % shares
            small = np.minimum(total, 255).astype(np.uint8)
            for k, p in enumerate(np.split(small, PARTS)):
                yield packed([(share, k)], [p])

    def sums(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], np.ndarray]:
        out: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for share, k, p in zip(*(column.to_pylist() for column in batch.columns)):
                raw = zlib.decompress(p)
                found = np.frombuffer(raw, f"<u{len(raw) // part}")
                if (share, k) in out:
                    out[share, k] += found
                else:
                    out[share, k] = found.astype(np.uint64)
        return out

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sums(batches)
        # Less than 2^32 for each cell, at up to 16 million tasks.
        yield packed([(0, k) for _, k in found], [s.astype(np.uint32) for s in found.values()])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sums(batches)
        out = [np.floor(2 * np.log2(s + 1.0)).astype(np.uint8).tobytes() for s in found.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for _, k in found], pa.int64()), pa.array(out, pa.binary())],
            ["part", "levels"],
        )

    ddl = "share long, part long, counts binary"
    counted = rows.mapInArrow(count, ddl)
    if shares > 1:
        counted = counted.repartition(shares * PARTS, "share", "part").mapInArrow(add, ddl)
    whole = counted.repartition(PARTS, "part").mapInArrow(finish, "part long, levels binary")
    table = np.zeros(size, np.uint8)
    for row in whole.collect():
        table[row.part * part : (row.part + 1) * part] = np.frombuffer(row.levels, np.uint8)
    return table
