"""Schemas of the messages and of the two result tables."""

# Names, order and types of the message fields, of the detail
# columns and of the group keys. Every leaf is text, numbers included.
MESSAGE_DDL = """
    venue STRUCT<venue_name: STRING, lon: STRING, lat: STRING, venue_id: STRING>,
    visibility STRING,
    response STRING,
    guests STRING,
    member STRUCT<member_id: STRING, photo: STRING, member_name: STRING>,
    rsvp_id STRING,
    mtime STRING,
    event STRUCT<event_name: STRING, event_id: STRING, time: STRING, event_url: STRING>,
    `group` STRUCT<
        group_topics: ARRAY<STRUCT<urlkey: STRING, topic_name: STRING>>,
        group_city: STRING, group_country: STRING, group_id: STRING, group_name: STRING,
        group_lon: STRING, group_urlname: STRING, group_state: STRING, group_lat: STRING>
"""

DETAIL_FIELDS = (
    "group.group_name",
    "group.group_country",
    "group.group_state",
    "group.group_city",
    "group.group_lat",
    "group.group_lon",
    "group.group_id",
    "group.group_topics",
    "member.member_name",
    "response",
    "guests",
    "venue.venue_name",
    "venue.lon",
    "venue.lat",
    "venue.venue_id",
    "visibility",
    "member.member_id",
    "member.photo",
    "event.event_name",
    "event.event_id",
    "event.time",
    "event.event_url",
)

KEY_FIELDS = (
    "group.group_name",
    "group.group_country",
    "group.group_state",
    "group.group_city",
    "group.group_lat",
    "group.group_lon",
    "response",
)


def leaf(path: str) -> str:
    """Column name that a dotted field path gets when it is selected."""
    return path.rsplit(".", 1)[-1]


DETAIL_COLUMNS = tuple(leaf(path) for path in DETAIL_FIELDS)
KEYS = tuple(leaf(path) for path in KEY_FIELDS)

# The part of a message the counts need.
KEY_MESSAGE_DDL = """
    response STRING,
    `group` STRUCT<group_name: STRING, group_country: STRING, group_state: STRING,
                   group_city: STRING, group_lat: STRING, group_lon: STRING>
"""

DETAIL_TABLE_DDL = ", ".join(
    f"{name} ARRAY<STRUCT<urlkey: STRING, topic_name: STRING>>"
    if name == "group_topics"
    else f"{name} STRING"
    for name in DETAIL_COLUMNS
) + ", batch_id BIGINT"

COUNT_TABLE_DDL = (
    ", ".join(f"{name} STRING" for name in KEYS) + ", response_count BIGINT, batch_id BIGINT"
)
