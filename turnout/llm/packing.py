"""Best-fit packing of token pieces into sequences under several capacities.

Each piece demands a vector: its tokens, one document, and its attention cost (tokens squared).
Pieces are placed largest first. Among the open sequences that can take a piece under every
capacity, the rule picks one: ``norm`` the least weighted norm of what would be left, ``dot`` the
greatest weighted dot product of demand and what is left. A new sequence opens only if none can.

Pieces are dealt at random into shares of about SHARE pieces, each packed by one task. A share
wastes at most about one sequence, so the number of shares hardly matters, and no task grows with
the corpus.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.tables import stored
from turnout.llm.text import text_chunks
from turnout.llm.tokens import word_bpe

TOKENS = 4096
END_ID = 1
SHARE = 50_000
#: Weights of the residual shares of tokens, documents and attention cost.
WEIGHTS = (1.0, 0.01, 0.01)


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    id: str = "doc_id",
    text: str = "text",
    most: int = TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, with
    ``keep_ids``, the ``ids``.

    A document is the ids of its text and END_ID; a null text is empty, so it has that id alone.
    Documents of more than ``most`` ids are cut into pieces of ``most``; the last may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for part, texts in text_chunks(batches, "text", 1 << 20):
            # Spark's text is UTF-8; other bytes, which no text column should hold, are replaced.
            encoded = encoder.encode([t.decode("utf-8", "replace") for t in texts])
            rows, piece, data = [], [], []
            for i, ids in enumerate(encoded):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * most)):
                    rows.append(i)
                    piece.append(k)
                    data.append(ids[at : at + 4 * most])
            columns = [
                part.column(0).take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array([k * most for k in piece], pa.int64()),
                pa.array([len(d) // 4 for d in data], pa.int64()),
                pa.array([crc32(d) for d in data], pa.int64()),
            ]
            if keep_ids:
                lists = [np.frombuffer(d, "<u4").astype(np.int32) for d in data]
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        encoder.forget()

    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    ddl = "id long, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    pieces = rows.mapInArrow(cut, ddl + ", ids array<int>" * keep_ids)
    return pieces.withColumnRenamed("id", id)


def pack(
    lengths: np.ndarray,
    tokens: int = TOKENS,
    documents: int | None = None,
    attention: int | None = None,
    rule: str = "norm",
    weights: tuple[float, float, float] = WEIGHTS,
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, by vector best fit, largest first.

    Ties of the rule go to the sequence that opened first, ties of length to the earlier piece.
    """
    capacity = np.array([tokens, documents or tokens, attention or tokens**2], np.float64)
    lengths = np.asarray(lengths, np.int64)
    if len(lengths) and (lengths.max() > tokens or lengths.max() ** 2 > capacity[2]):
        raise ValueError("a piece is larger than a sequence may be")
    scale, weight = 1 / capacity, np.array(weights, np.float64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    # Open sequences: what is left of each capacity, as shares; their numbers; tokens used.
    left = np.empty((1024, 3))
    number, used = np.empty(1024, np.int64), np.empty(1024, np.int64)
    count = opened = 0
    smallest = int(lengths.min()) if len(lengths) else 0
    for n, i in enumerate(order.tolist()):
        length = int(lengths[i])
        demand = np.array([length, 1, length * length], np.float64) * scale
        rest = left[:count] - demand
        fits = np.flatnonzero((rest > -1e-12).all(1))
        if len(fits):
            if rule == "norm":
                best = fits[np.argmin((weight * rest[fits] ** 2).sum(1))]
            else:
                best = fits[np.argmax((weight * left[fits] * demand).sum(1))]
        else:
            if count == len(left):
                left = np.concatenate([left, np.empty_like(left)])
                number = np.concatenate([number, np.empty_like(number)])
                used = np.concatenate([used, np.empty_like(used)])
            best, left[count], number[count], used[count] = count, 1.0, opened, 0
            count, opened = count + 1, opened + 1
        sequence[i], offset[i] = number[best], used[best]
        left[best] -= demand
        used[best] += length
        full = tokens - used[best] < smallest or (left[best] < scale * 0.5).any()
        if full:  # nothing fits any more: closed; the order of the open ones stays
            left[best : count - 1] = left[best + 1 : count]
            number[best : count - 1] = number[best + 1 : count]
            used[best : count - 1] = used[best + 1 : count]
            count -= 1
    return sequence, offset


def pack_share(share: pa.Table, **limits) -> pa.Table:
    share = share.sort_by("_place")
    sequence, offset = pack(share["length"].to_numpy(), **limits)
    sequence += share["_share"].to_numpy() << 32
    share = share.drop_columns(["_share", "_place"])
    return share.append_column("sequence_id", [sequence]).append_column("offset", [offset])


def pack_pieces(pieces: DataFrame, share: int = SHARE, **limits) -> DataFrame:
    """The pieces, with ``sequence_id`` and ``offset``; ``limits`` as for ``pack``.

    Other columns of the pieces are carried along, so they should be few and small. Pieces are
    written once, as they are counted and then read again; equal rows stay distinct pieces.
    """
    table = stored(pieces, "pieces")
    shares = -(-table.count() // share) or 1
    place = F.monotonically_increasing_id()
    dealt = table.withColumn("_place", place).withColumn(
        "_share", F.pmod(F.xxhash64("_place"), F.lit(shares)).cast("long")
    )

    def pack_one(rows: pa.Table) -> pa.Table:
        return pack_share(rows, **limits)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_share").applyInArrow(pack_one, schema)
