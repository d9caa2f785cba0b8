"""Line dedup: remove later occurrences of passages of three or more lines.

A window is three consecutive lines of one text, equal if the three lines are equal. The first
occurrence of a window, by id, then by place in the table, then by line, stays; the lines of each
later occurrence go. Windows are judged on the input: windows that overlap mark the union of their
lines, also where a later occurrence overlaps the first.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.tables import ROW, row_numbers, whole_row

WINDOW = 3


def line_windows(numbers: DataFrame, id: str, text: str) -> DataFrame:
    """One row per window of numbered rows: 128-bit hash, id, row number and first line.

    A hash of hashes of neighbouring lines: each line is hashed once. At 10^13 windows the chance
    that any two different ones meet is below 10^-12.
    """
    lines = F.split(F.col(f"doc.`{text}`"), "\n", -1)
    hashed = F.transform(lines, lambda line: F.unhex(F.md5(line.cast("binary"))))
    rows = numbers.select(
        F.col(f"doc.`{id}`").cast("long").alias("id"), ROW, hashed.alias("hashes")
    ).filter(F.size("hashes") >= WINDOW)
    starts = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    window = F.transform(
        starts,
        lambda i: F.unhex(F.md5(F.concat(*(F.get("hashes", i + j) for j in range(WINDOW))))),
    )
    return rows.select("id", ROW, F.posexplode(window).alias("line", "hash"))


def later_windows(windows: DataFrame) -> DataFrame:
    """Row number and first lines of the windows that occurred before.

    Hashes are counted within tasks first. The join sends a hash that a third of all rows share
    to one partition, which adaptive execution splits.
    """
    # A null id is later than any other.
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", ROW, "line")
    first = (
        windows.groupBy("hash")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("hash", F.col(f"first.{ROW}").alias("first_row"), F.col("first.line").alias("at"))
    )
    later = windows.join(first, "hash").filter(
        (F.col(ROW) != F.col("first_row")) | (F.col("line") != F.col("at"))
    )
    return later.groupBy(ROW).agg(F.collect_list("line").alias("later"))


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, with the text less its repeated lines, in a struct ``doc``, and
    ``n_lines`` and ``n_removed``.

    Null text stays null and has no lines; empty text is one line; a text that loses all lines
    becomes empty. Texts of fewer than three lines have no window and stay. Rows with a null id come
    last; rows with equal ids, and equal rows, count in the order of their numbers
    (see ``tables.row_numbers``).
    """
    rows = row_numbers(docs, whole_row(docs).alias("doc"))
    gone = later_windows(line_windows(rows, id, text))
    lines = F.split(F.col(f"doc.`{text}`"), "\n", -1)
    covered = F.array_distinct(
        F.flatten(F.transform("later", lambda i: F.sequence(i, i + WINDOW - 1)))
    )
    # Linear in the lines: array_except hashes its entries.
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "covered")
    kept = F.transform(left, lambda i: F.get(lines, i))
    joined = rows.join(gone, ROW, "left").withColumn("covered", covered)
    text_left = F.when(F.col("covered").isNull(), F.col(f"doc.`{text}`")).otherwise(
        F.array_join(kept, "\n")
    )
    return joined.select(
        F.col("doc").withField(f"`{text}`", text_left).alias("doc"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
