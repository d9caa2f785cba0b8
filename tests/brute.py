"""Plain Python versions of the operators, for small inputs."""

import json
from collections import Counter

KEYS = (
    "group_name",
    "group_country",
    "group_state",
    "group_city",
    "group_lat",
    "group_lon",
    "response",
)


def key_of(text):
    """Keys of a well-formed message whose key fields are text, integers or NULL."""
    message = json.loads(text)
    group = message.get("group") or {}
    values = [group.get(name) for name in KEYS[:-1]] + [message.get("response")]
    return tuple(None if value is None else str(value) for value in values)


def counts(texts):
    totals = Counter()
    for key in map(key_of, texts):
        totals[key] += key[-1] is not None
    return dict(totals)


def changelog(batches):
    """Rows (key..., running total, batch id) of a stream in update mode."""
    totals, rows = Counter(), set()
    for batch_id, texts in enumerate(batches):
        touched = counts(texts)
        for key, count in touched.items():
            totals[key] += count
            rows.add((*key, totals[key], batch_id))
    return rows


def message(group="g", response="yes", **fields):
    return json.dumps({"response": response, "group": {"group_name": group, **fields}})
