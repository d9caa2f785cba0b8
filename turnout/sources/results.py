"""Readers of the count table and of the detail table."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from turnout.functions.schema import COUNT_TABLE_DDL, DETAIL_TABLE_DDL, KEYS
from turnout.operators.newest import newest_batch

# Folder in a file table that notes its newest batch; readers of the table skip it.
NEWEST = "_newest"
# Property of a catalog table that holds the id of its newest batch.
NEWEST_PROPERTY = "turnout.newest_batch"


def count_table(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The count table kept as files, one partition per batch."""
    return spark.read.schema(COUNT_TABLE_DDL).format(file_format).load(path)


def detail_table(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The detail documents kept as files, one partition per batch."""
    return spark.read.schema(DETAIL_TABLE_DDL).format(file_format).load(path)


def newest_note(spark: SparkSession, path: str) -> Row | None:
    """``id`` of the newest batch that a file table notes, and the ``place`` of the note."""
    try:
        notes = (
            spark.read.schema("id BIGINT, place INT")
            .option("ignoreMissingFiles", True)
            .json(f"{path}/{NEWEST}")
        )
        return notes.filter("id IS NOT NULL").orderBy(F.desc("id")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def marked_newest_batch(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The newest batch of a file table whose sink notes it.

    Only the folder of that batch is listed and read, however many batches there are. A table
    without a note is listed as a whole; there are no rows only if it has none, or is not there yet.
    """
    newest = newest_note(spark, path)
    if newest is None:
        try:
            return newest_batch(count_table(spark, path, file_format))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], COUNT_TABLE_DDL)
            raise
    return (
        spark.read.schema(COUNT_TABLE_DDL)
        .format(file_format)
        .option("basePath", path)
        .load(f"{path}/batch_id={newest.id}")
    )


def catalog_newest_batch(spark: SparkSession, table: str) -> DataFrame:
    """The newest batch of a count table in the catalog, as its sink noted it.

    The id is a property of the table, fetched first: compared with a literal, it prunes the
    partitions before any file is listed. Of a table without the property, written by other means,
    the id is looked for in the rows.
    """
    noted = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == NEWEST_PROPERTY).first()
    rows = spark.table(table)
    if noted is None:
        return newest_batch(rows)
    return rows.filter(F.col("batch_id") == int(noted.value))


def database_query(
    spark: SparkSession, url: str, sql: str, connector: str = "jdbc", **options: str
) -> DataFrame:
    """Rows of a query that the database runs."""
    reader = spark.read.format(connector).option("url", url).option("query", sql)
    return reader.options(**options).load()


def database_newest_batch(
    spark: SparkSession, url: str, table: str, connector: str = "jdbc", **options: str
) -> DataFrame:
    """The newest batch of a count table in a database.

    The database picks the batch, so older rows do not travel. A batch that was written
    again after a failure is there twice; the copies are removed here. To read a large
    batch over several connections, pass ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``.
    """
    newest = f"(SELECT * FROM {table} WHERE batch_id = (SELECT max(batch_id) FROM {table})) newest"
    rows = (
        spark.read.format(connector)
        .option("url", url)
        .option("dbtable", newest)
        .options(**options)
        .load()
    )
    return rows.dropDuplicates([*KEYS, "batch_id"])


def key_share_sql(
    shares: int, share: int, hash_sql: str = "CRC32(CONCAT_WS(',', {keys}))"
) -> str:
    """Condition that picks one of ``shares`` disjoint parts of the groups; together they are all.

    ``hash_sql`` gives a whole number, 0 or more and never NULL, in the SQL of the database;
    ``{keys}`` stands for the key columns. All rows of a group are in one part.
    """
    return f"MOD({hash_sql.format(keys=', '.join(KEYS))}, {shares}) = {share}"


def database_newest_shares(
    spark: SparkSession,
    url: str,
    table: str,
    shares: int,
    connector: str = "jdbc",
    hash_sql: str = "CRC32(CONCAT_WS(',', {keys}))",
    **options: str,
) -> DataFrame:
    """``database_newest_batch``, read over ``shares`` connections, one for each part of the groups.

    The id is fetched first, so that all parts are of one batch, whatever is written meanwhile. No
    numeric column and no bounds are needed.
    """
    newest = database_query(
        spark, url, f"SELECT max(batch_id) AS batch_id FROM {table}", connector, **options
    ).first()
    if newest is None or newest.batch_id is None:
        return spark.createDataFrame([], COUNT_TABLE_DDL)
    rows = None
    for share in range(shares):
        where = f"batch_id = {int(newest.batch_id)} AND {key_share_sql(shares, share, hash_sql)}"
        part = spark.read.format(connector).option("url", url).options(**options)
        part = part.option("dbtable", f"(SELECT * FROM {table} WHERE {where}) newest").load()
        rows = part if rows is None else rows.unionAll(part)
    return rows.dropDuplicates([*KEYS, "batch_id"])


def top_groups_sql(table: str, n: int = 10, exact: str = "BINARY") -> str:
    """SQL of ``top_groups`` of the newest batch, for databases that know LIMIT.

    A batch that was written again is there twice; equal rows are kept once. Keys are
    told apart by their bytes, as type ``exact`` of the database, whatever its collation.
    """
    keys = ", ".join([*(f"CAST({name} AS {exact})" for name in KEYS), "response_count"])
    columns = ", ".join((*KEYS, "response_count", "batch_id"))
    order = ", ".join(f"{name} IS NULL, {name}" for name in KEYS)
    return (
        f"SELECT {columns} FROM (SELECT {columns}, "
        f"ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY response_count) AS copy_number "
        f"FROM {table} WHERE batch_id = (SELECT max(batch_id) FROM {table})) newest "
        f"WHERE copy_number = 1 ORDER BY response_count DESC, {order} LIMIT {n}"
    )


def database_top_groups(
    spark: SparkSession,
    url: str,
    table: str,
    n: int = 10,
    connector: str = "jdbc",
    exact: str = "BINARY",
    **options: str,
) -> DataFrame:
    """The ``n`` rows with the largest counts of the newest batch: only these travel.

    Groups are told apart by bytes; among equal counts the database orders by its collation.
    """
    return database_query(spark, url, top_groups_sql(table, n, exact), connector, **options)
