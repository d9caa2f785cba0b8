"""Stand-ins for connectors that are not on the class path: they record to files.

Each keeps the options it got and the rows as JSON lines in the folder ``store``. The
classes are local so that they travel to the Python workers by value.
"""


def register(spark):
    from pyspark.sql.datasource import (
        DataSource,
        DataSourceReader,
        DataSourceStreamWriter,
        DataSourceWriter,
        InputPartition,
        SimpleDataSourceStreamReader,
        WriterCommitMessage,
    )

    def save(options, rows):
        import json
        import os
        import time
        import uuid

        folder = options["store"]
        os.makedirs(folder, exist_ok=True)
        name = f"{time.time_ns()}-{uuid.uuid4().hex}"
        with open(f"{folder}/{name}.options", "w") as out:
            json.dump(dict(options), out)
        with open(f"{folder}/{name}.rows", "w") as out:
            for row in rows:
                text = json.dumps(row.asDict(True), default=lambda v: bytes(v).decode())
                out.write(text + "\n")

    def load(folder):
        import glob
        import json

        return [
            json.loads(line)
            for path in sorted(glob.glob(f"{folder}/*.rows"))
            for line in open(path)
        ]

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.options = options

        def write(self, iterator):
            save(self.options, iterator)
            return WriterCommitMessage()

    class StreamWriter(DataSourceStreamWriter):
        def __init__(self, options):
            self.options = options

        def write(self, iterator):
            save(self.options, iterator)
            return WriterCommitMessage()

        def commit(self, messages, batchId):
            pass

        def abort(self, messages, batchId):
            pass

    class TopicReader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def partitions(self):
            return [InputPartition(0)]

        def read(self, partition):
            import datetime

            save({**self.options, "store": self.options["store"] + "-read"}, [])
            now = datetime.datetime(2024, 1, 1)
            for row in load(self.options["store"]):
                yield (None, row["value"].encode(), self.options["subscribe"], now)

    class TopicStreamReader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.options = options

        def initialOffset(self):
            return {"row": 0}

        def read(self, start):
            import datetime

            save({**self.options, "store": self.options["store"] + "-read"}, [])
            rows = load(self.options["store"])
            now = datetime.datetime(2024, 1, 1)
            found = [
                (None, row["value"].encode(), self.options["subscribe"], now)
                for row in rows[start["row"] :]
            ]
            return iter(found), {"row": len(rows)}

        def readBetweenOffsets(self, start, end):
            rows, _ = self.read(start)
            return iter(list(rows)[: end["row"] - start["row"]])

    class Topic(DataSource):
        @classmethod
        def name(cls):
            return "test_topic"

        def schema(self):
            return "key BINARY, value BINARY, topic STRING, timestamp TIMESTAMP"

        def reader(self, schema):
            return TopicReader(self.options)

        def simpleStreamReader(self, schema):
            return TopicStreamReader(self.options)

        def writer(self, schema, overwrite):
            assert not overwrite
            return Writer(self.options)

        def streamWriter(self, schema, overwrite):
            return StreamWriter(self.options)

    class TableReader(DataSourceReader):
        def __init__(self, options, names):
            self.options, self.names = options, names

        def partitions(self):
            return [InputPartition(0)]

        def read(self, partition):
            save({**self.options, "store": self.options["store"] + "-read"}, [])
            for row in load(self.options["store"]):
                yield tuple(row[name] for name in self.names)

    class Table(DataSource):
        @classmethod
        def name(cls):
            return "test_store"

        def schema(self):
            return self.options["ddl"]

        def reader(self, schema):
            return TableReader(self.options, schema.names)

        def writer(self, schema, overwrite):
            assert not overwrite
            return Writer(self.options)

    class SqlReader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def partitions(self):
            return [InputPartition(0)]

        def read(self, partition):
            import duckdb

            save({**self.options, "store": self.options["store"] + "-read"}, [])
            database = duckdb.connect()
            database.execute(f"CREATE TABLE counts ({self.options['columns']})")
            rows = [tuple(row.values()) for row in load(self.options["store"])]
            marks = ", ".join("?" * len(rows[0])) if rows else ""
            if rows:
                database.executemany(f"INSERT INTO counts VALUES ({marks})", rows)
            sql = self.options.get("query") or f"SELECT * FROM {self.options['dbtable']}"
            yield from map(tuple, database.execute(sql).fetchall())

    class SqlTable(DataSource):
        """Runs the SQL that it is sent over the rows in the store, within the reading task."""

        @classmethod
        def name(cls):
            return "test_sql"

        def schema(self):
            return "batch_id BIGINT" if "query" in self.options else self.options["ddl"]

        def reader(self, schema):
            return SqlReader(self.options)

    spark.dataSource.register(Topic)
    spark.dataSource.register(SqlTable)
    spark.dataSource.register(Table)


def stored(folder):
    """Rows and options that a connector kept."""
    import json

    rows = [json.loads(t) for p in folder.glob("*.rows") for t in p.read_text().splitlines()]
    options = [json.loads(p.read_text()) for p in folder.glob("*.options")]
    return rows, options
