"""Response messages that Spark derives from the test tables (see FIXTURES.md, section 3)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES = 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: the group it answers for."""
    key = F.col("n_nationkey")

    def topic(j: int) -> Column:
        urlkey = F.concat(F.lit("topic_"), key, F.lit(f"_{j}"))
        name = F.when((key + j) % 3 != 0, F.upper(urlkey))
        topic = F.struct(urlkey.alias("urlkey"), name.alias("topic_name"))
        return F.when((key + j) % 5 != 0, topic)

    # None to three topics, some of them NULL, some without a name.
    topics = F.slice(F.array(topic(1), topic(2), topic(3)), 1, (key % 4).cast("int"))
    group = F.struct(
        F.when(key % 6 != 0, topics).alias("group_topics"),
        F.concat(F.lit("City_"), F.col("c_custkey") % 3).alias("group_city"),
        F.col("r_name").alias("group_country"),
        key.alias("group_id"),
        F.col("n_name").alias("group_name"),
        (7 * key - 90).alias("group_lon"),
        F.lower("n_name").alias("group_urlname"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("group_state"),
        (3 * key - 30).alias("group_lat"),
    )
    nations = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", group.alias("group"))
    )


def _record(millis: Column, *more: Column, in_group: tuple[Column, ...] = ()) -> Column:
    event_id, user_id = F.col("event_id"), F.col("user_id")
    response = (
        F.when(F.col("event_type").isin("purchase", "signup"), "yes")
        .when(F.col("event_type") == "error", "no")
        .when(F.col("event_type") == "view", "waitlist")
    )
    place, meeting = event_id % 97, event_id % 50
    venue = F.struct(
        F.concat(F.lit('Vénue "'), place, F.lit('"')).alias("venue_name"),
        (place / 2 - 22.5).alias("lon"),
        (place - 45).alias("lat"),
        place.alias("venue_id"),
    )
    photo = F.concat(F.lit("photo_"), user_id, F.lit(".jpg"))
    member = F.struct(
        user_id.alias("member_id"),
        F.when(user_id % 3 != 0, photo).alias("photo"),
        F.col("c_name").alias("member_name"),
    )
    event = F.struct(
        F.concat(F.lit("Event_"), meeting).alias("event_name"),
        meeting.alias("event_id"),
        millis.alias("time"),
        F.concat(F.lit("http://example.org/e/"), meeting).alias("event_url"),
    )
    return F.struct(
        F.when(event_id % 5 != 0, venue).alias("venue"),
        F.lit("public").alias("visibility"),
        response.alias("response"),
        (event_id % 4).alias("guests"),
        member.alias("member"),
        event_id.alias("rsvp_id"),
        millis.alias("mtime"),
        event.alias("event"),
        F.struct("group.*", *in_group).alias("group") if in_group else F.col("group"),
        *more,
    )


def unknown_to_schema() -> tuple[list[Column], tuple[Column, ...]]:
    """Fields of messages that the declared schema does not have, at the top and in the group."""
    event_id = F.col("event_id")
    marks = F.transform(F.sequence(F.lit(1), (event_id % 3 + 1).cast("int")), lambda j: j * 10)
    at_top = [
        F.when(event_id % 2 == 0, F.from_json("props", "k INT")).alias("props"),
        F.col("value").alias("score"),
        F.when(event_id % 7 != 0, marks).alias("marks"),
    ]
    return at_top, (F.col("user_id").alias("owner"),)


def messages(spark: SparkSession, sf_dir: str, unknown: bool = False) -> DataFrame:
    """``value BINARY, timestamp TIMESTAMP, batch_id BIGINT``, one message per event.

    Of 101 messages two are malformed: one has an extra brace before its text, one breaks
    off being JSON within the member. With ``unknown``, messages have fields that the declared
    schema does not know.
    """
    events = _table(spark, sf_dir, "events")
    total = events.agg(F.count(F.lit(1))).scalar()
    # Difference of wall-clock times, so independent of the session's time zone.
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    at_top, in_group = unknown_to_schema() if unknown else ([], ())
    text = F.to_json(_record(millis, *at_top, in_group=in_group))
    broken = F.replace(text, F.lit('"member_name":"'), F.lit('"member_name":'))
    kind = F.col("event_id") % 101
    text = F.when(kind == 100, F.concat(F.lit("{"), text)).when(kind == 50, broken).otherwise(text)
    # Events and customers both grow, so both are shuffled and merged, which may spill; AQE
    # splits the partition of a customer with very many events.
    groups = _groups(spark, sf_dir).hint("merge")
    rows = events.join(groups, F.col("user_id") == F.col("c_custkey")).withColumn("total", total)
    return rows.select(
        text.cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.least(
            F.expr(f"event_id * {SLICES}L div total"),
            F.lit(SLICES - 1).cast("bigint"),
        ).alias("batch_id"),
    )
