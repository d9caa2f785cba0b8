"""SQL over the test tables for each query, without any JSON step."""

from turnout.functions.schema import DETAIL_COLUMNS, KEYS
from turnout.operators.newest import GRID_COLUMNS

_TOPICS = """CASE WHEN n_nationkey % 6 <> 0 THEN list_transform(
    [1, 2, 3][1:n_nationkey % 4],
    lambda j: CASE WHEN (n_nationkey + j) % 5 <> 0 THEN {
        'urlkey': 'topic_' || n_nationkey || '_' || j,
        'topic_name': CASE WHEN (n_nationkey + j) % 3 <> 0
            THEN 'TOPIC_' || n_nationkey || '_' || j END} END) END"""

_COLUMNS = {
    "visibility": "'public'",
    "response": (
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 'yes' "
        "WHEN event_type = 'error' THEN 'no' WHEN event_type = 'view' THEN 'waitlist' END"
    ),
    "guests": "event_id % 4",
    "rsvp_id": "event_id",
    "mtime": "epoch_us(ts) // 1000",
    "group_name": "n_name",
    "group_country": "r_name",
    "group_state": "CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END",
    "group_city": "'City_' || (c_custkey % 3)",
    "group_lat": "3 * n_nationkey - 30",
    "group_lon": "7 * n_nationkey - 90",
    "group_id": "n_nationkey",
    "group_urlname": "lower(n_name)",
    "group_topics": f"CAST(to_json({_TOPICS}) AS VARCHAR)",
    "member_name": "c_name",
    "venue_name": "CASE WHEN event_id % 5 <> 0 THEN 'Vénue \"' || (event_id % 97) || '\"' END",
    "lon": "CASE WHEN event_id % 5 <> 0 THEN (event_id % 97) / 2 - 22.5e0 END",
    "lat": "CASE WHEN event_id % 5 <> 0 THEN (event_id % 97) - 45 END",
    "venue_id": "CASE WHEN event_id % 5 <> 0 THEN event_id % 97 END",
    "member_id": "user_id",
    "photo": "CASE WHEN user_id % 3 <> 0 THEN 'photo_' || user_id || '.jpg' END",
    "event_name": "'Event_' || (event_id % 50)",
    "event_id": "event_id % 50",
    "time": "epoch_us(ts) // 1000",
    "event_url": "'http://example.org/e/' || (event_id % 50)",
}

# What a message that breaks off within the member keeps.
_BEFORE_MEMBER = {"venue_name", "lon", "lat", "venue_id", "visibility", "response", "guests"}
_DETAIL = DETAIL_COLUMNS
_KEYS = ", ".join(KEYS)


def _message(names: tuple[str, ...], *more: str, where: str = "true") -> str:
    """Columns of all messages as text, NULL where malformed ones lost them."""
    columns = [
        f"CASE WHEN event_id % 101 NOT IN ({'100' if name in _BEFORE_MEMBER else '50, 100'}) "
        f"THEN CAST({_COLUMNS[name]} AS VARCHAR) END AS {name}"
        for name in names
    ]
    return f"""
        SELECT {", ".join([*columns, *more])}
        FROM events
        JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE {where}"""


def _records(names: tuple[str, ...], rows: str) -> str:
    """Each row as one JSON object."""
    # Topics stay nested in a record.
    fields = ", ".join(
        f"{name} := {'topics' if name == 'group_topics' else name}" for name in names
    )
    return f"SELECT CAST(to_json(struct_pack({fields})) AS VARCHAR) AS record FROM ({rows}) r"


_NESTED_TOPICS = f"CASE WHEN event_id % 101 NOT IN (50, 100) THEN {_TOPICS} END AS topics"
_GOOD = "event_id % 101 NOT IN (50, 100)"

_BATCH = "least(event_id * 4 // (SELECT count(*) FROM events), 3) AS batch_id"

_COUNTS = f"SELECT {_KEYS}, count(response) AS response_count FROM ({{}}) m GROUP BY {_KEYS}"

_CHANGELOG = f"""
    SELECT {_KEYS}, batch_id,
           CAST(sum(in_batch) OVER (PARTITION BY {_KEYS} ORDER BY batch_id) AS BIGINT)
               AS response_count
    FROM (SELECT {_KEYS}, batch_id, count(response) AS in_batch
          FROM ({_message(KEYS, _BATCH)}) m GROUP BY {_KEYS}, batch_id) b"""

_NEWEST = f"""
    WITH log AS ({_CHANGELOG})
    SELECT * FROM log WHERE batch_id IN (SELECT max(batch_id) FROM log)"""

_ORDER = "ORDER BY response_count DESC, " + ", ".join(f"{name} ASC NULLS LAST" for name in KEYS)
_TOP = f"SELECT * FROM ({_NEWEST}) n {_ORDER} LIMIT 10"

_BARS = f"""
    SELECT group_name,
           CASE WHEN response = 'yes' THEN response_count ELSE 0 END AS yes_response_count,
           CASE WHEN response = 'no' THEN response_count ELSE 0 END AS no_response_count
    FROM ({_TOP}) t"""

_GRID = f"SELECT {', '.join(GRID_COLUMNS)} FROM ({_TOP}) t"

_DETAIL_SQL = _message(_DETAIL)
_COUNTS_SQL = _COUNTS.format(_message(KEYS))

_MATCHED = "events JOIN customer ON user_id = c_custkey"
_REJECTED = f"""
    SELECT event_id, (SELECT count(*) FROM {_MATCHED}) AS lines
    FROM {_MATCHED} WHERE NOT ({_GOOD})"""

# Fields that the declared schema does not know: type of the variant, and the events that have it.
_UNKNOWN = {
    "props": ("OBJECT<k: BIGINT>", "event_id % 2 = 0"),
    "score": ("DECIMAL", "true"),
    "marks": ("ARRAY<BIGINT>", "event_id % 7 <> 0"),
    "group.owner": ("BIGINT", "true"),
}

_CURRENT = f"""
    SELECT {_KEYS}, arg_max(response_count, batch_id) AS response_count, max(batch_id) AS batch_id
    FROM ({_CHANGELOG}) c GROUP BY {_KEYS}"""

ORACLE = {
    "parse_messages": _message(tuple(_COLUMNS), "ts AS timestamp"),
    "flatten_detail": _DETAIL_SQL,
    "response_counts": _COUNTS_SQL,
    "response_changelog": _CHANGELOG,
    "max_batch": f"SELECT max(batch_id) AS max_batch_id FROM ({_CHANGELOG}) c",
    "latest_batch": _NEWEST,
    "top_groups": _TOP,
    "sql_top_groups": _TOP,
    "yes_no_counts": _BARS,
    "display_table": _GRID,
    "chart_series": f"""
        WITH bars AS ({_BARS})
        SELECT group_name, 'yes_response_count' AS series, yes_response_count AS y FROM bars
        UNION ALL
        SELECT group_name, 'no_response_count' AS series, no_response_count AS y FROM bars""",
    "head_rows": f"SELECT * FROM ({_NEWEST}) n {_ORDER} LIMIT 5",
    "json_records": _records((*KEYS, "response_count", "batch_id"), _TOP),
    "encode_records": _records(_DETAIL, _message(_DETAIL, _NESTED_TOPICS)),
    "publish_roundtrip": _DETAIL_SQL,
    "text_feed_counts": _COUNTS_SQL,
    "feed_records": _COUNTS.format(_message(KEYS, where=_GOOD)),
    "stream_changelog": _CHANGELOG,
    "stream_detail": _message(_DETAIL, _BATCH),
    "stream_latest_batch": _NEWEST,
    "marked_latest_batch": _NEWEST,
    "stream_documents": _message(_DETAIL, _BATCH),
    "stream_two_tables": f"""
        SELECT c.*, copy FROM ({_CHANGELOG}) c, (VALUES ('first'), ('second')) v(copy)""",
    "stream_replayed": _CHANGELOG,
    "catalog_changelog": _CHANGELOG,
    "catalog_latest_batch": _NEWEST,
    "throttled_stream_counts": f"SELECT *, 3::BIGINT AS batches FROM ({_COUNTS_SQL}) c",
    "refresh_stamp": f"""
        SELECT *, strftime((SELECT max(ts) FROM events), '%Y-%m-%d %H:%M:%S') AS refreshed_at
        FROM ({_GRID}) g""",
    "rejected_lines": _REJECTED,
    "variant_fields": f"""
        SELECT CASE WHEN {_GOOD} THEN event_id END AS event_id,
               CASE WHEN {_GOOD} AND event_id % 2 = 0
                   THEN CAST(props::JSON->>'k' AS INTEGER) END AS k,
               CASE WHEN {_GOOD} THEN value END AS score,
               CASE WHEN {_GOOD} AND event_id % 7 <> 0 AND event_id % 3 > 0
                   THEN 20::INTEGER END AS second_mark,
               CASE WHEN {_GOOD} THEN user_id END AS owner
        FROM {_MATCHED}""",
    "unknown_fields": " UNION ALL ".join(
        f"SELECT '{path}' AS path, '{kind}' AS kind, count(*) AS fields "
        f"FROM {_MATCHED} WHERE {_GOOD} AND {where}"
        for path, (kind, where) in _UNKNOWN.items()
    ),
    "clean_detail": _message(_DETAIL, where=_GOOD),
    "stream_clean_detail": _message(_DETAIL, _BATCH, where=_GOOD),
    "stream_malformed": f"""
        SELECT event_id, {_BATCH}, (SELECT count(*) FROM {_MATCHED}) AS messages
        FROM {_MATCHED} WHERE NOT ({_GOOD})""",
    "state_counts": _COUNTS_SQL,
    "stream_progress": f"""
        WITH log AS ({_CHANGELOG}),
        firsts AS (SELECT {_KEYS}, min(batch_id) AS batch_id FROM log GROUP BY {_KEYS}),
        new_groups AS (SELECT batch_id, count(*) AS n FROM firsts GROUP BY batch_id),
        changed AS (SELECT batch_id, count(*) AS changed_groups FROM log GROUP BY batch_id),
        taken AS (SELECT batch_id, count(*) AS messages
                  FROM (SELECT {_BATCH} FROM {_MATCHED}) m GROUP BY batch_id)
        SELECT batch_id, messages, changed_groups,
               CAST(sum(coalesce(n, 0)) OVER (ORDER BY batch_id) AS BIGINT) AS n_groups
        FROM taken JOIN changed USING (batch_id) LEFT JOIN new_groups USING (batch_id)""",
    "current_counts": _CURRENT,
    "current_top_groups": f"SELECT * FROM ({_CURRENT}) c {_ORDER} LIMIT 10",
    "yes_no_any_case": f"""
        SELECT group_name,
               CASE WHEN lower(loud) = 'yes' THEN response_count ELSE 0 END AS yes_response_count,
               CASE WHEN lower(loud) = 'no' THEN response_count ELSE 0 END AS no_response_count
        FROM (SELECT *, CASE WHEN group_city = 'City_1' THEN upper(response) ELSE response END
              AS loud FROM ({_TOP}) t) u""",
    "stream_timed": _CHANGELOG,
    "stream_to_topic_files": _COUNTS.format(_message(KEYS, where=_GOOD)),
}
