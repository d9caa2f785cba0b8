"""Tables that an operator writes and reads again, in the folder that the cluster shares."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.session import shared_folder

ROW = "_row"
TEXT = "_text"
#: Bits of a row number that are the row's place within its file.
PLACE_BITS = 40
#: Files whose names are numbered on the driver: some 15 MB of names, less than the scan's own list.
MOST_FILES = 100_000
#: Steps of a plan that return each row of a file at most once.
ROWWISE = {"Project", "Filter", "SubqueryAlias"}


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once: what reads it does not compute it again, and a lost executor
    costs no more than reading the files again."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole_row(frame: DataFrame) -> Column:
    """All columns of the frame as one struct, whatever their names."""
    return F.struct(*(F.col("`" + name.replace("`", "``") + "`") for name in frame.columns))


def bucketed(frame: DataFrame, key: str) -> DataFrame:
    """The frame, written once in buckets of ``key``: joins on it shuffle the other side only."""
    spark = frame.sparkSession
    path = shared_folder(spark, "buckets")
    name = f"buckets_{path[-32:]}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = frame.write.bucketBy(parts, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    rows = spark.table(name)
    # The frame knows its files and buckets by now; no entry is left in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return rows


def file_place(docs: DataFrame) -> tuple[Column, Column] | None:
    """File and place within the file of each row, if ``docs`` only scans files that tell them."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ROWWISE:
        plan = plan.children().apply(0)
    if plan.nodeName() != "LogicalRelation":
        return None
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place["row_index"])
    except AnalysisException:
        return None
    if plan.relation().location().rootPaths().size() != 1:
        return None  # a file that is named twice is read twice
    return place["file_path"], place["row_index"]


def row_numbers(docs: DataFrame, *columns: Column, most_files: int = MOST_FILES) -> DataFrame:
    """A row number in ``_row`` and the columns.

    The numbers do not depend on how a scan is split into tasks, which changes with the number of
    cores, so the frame may be read again and joined on them. Rows of Parquet files are numbered by
    the file, in the order of names, and their place in it. Other frames, and those of more than
    ``most_files`` files, are written once, with their numbers.
    """
    place, names = file_place(docs), []
    if place is not None:
        paths = docs.select(place[0].alias("path")).distinct().limit(most_files + 1)
        names = sorted(r.path for r in paths.collect())
    if place is None or len(names) > most_files:
        number = F.monotonically_increasing_id().alias(ROW)
        return stored(docs.select(number, *columns), "numbered")
    path, index = place
    files = docs.sparkSession.createDataFrame(
        [(name, i << PLACE_BITS) for i, name in enumerate(names)], "_path string, _first long"
    )
    rows = docs.select(path.alias("_path"), index.alias("_index"), *columns)
    # A few bytes for each of at most ``most_files`` files: the rows stay where they are.
    named = rows.join(F.broadcast(files), "_path")
    number = (F.col("_first") + F.col("_index")).alias(ROW)
    return named.select(number, *rows.columns[2:])


def numbered(docs: DataFrame, text: str, **columns: str) -> DataFrame:
    """A row number (see ``row_numbers``), the text as bytes, and other columns under names of our
    own."""
    return row_numbers(
        docs,
        F.col(f"`{text}`").cast("binary").alias(TEXT),
        *(F.col(f"`{name}`").alias(new) for new, name in columns.items()),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
