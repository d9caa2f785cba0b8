import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from turnout.functions.schema import KEYS
from turnout.operators.counts import count_changelog, response_counts
from turnout.operators.messages import group_keys


def rows(frame):
    return {tuple(row) for row in frame.collect()}


def batches_frame(spark, batches):
    data = [(bytearray(text.encode()), i) for i, texts in enumerate(batches) for text in texts]
    return spark.createDataFrame(data, "value BINARY, batch_id BIGINT")


def test_null_keys_group_and_null_responses_count_zero(raw):
    texts = [
        brute.message("g", "yes"),
        brute.message("g", None),
        brute.message(None, "yes"),
        brute.message(None, "yes"),
        brute.message("g", "waitlist"),
        "broken",
    ]
    found = {(r.group_name, r.response): r.response_count for r in counts(raw(texts)).collect()}
    assert found == {
        ("g", "yes"): 1,
        ("g", None): 0,
        (None, "yes"): 2,
        ("g", "waitlist"): 1,
        (None, None): 0,
    }


def counts(frame):
    return response_counts(group_keys(frame))


def test_count_columns(raw):
    frame = counts(raw(["{}"]))
    assert frame.columns == [*KEYS, "response_count"]
    assert dict(frame.dtypes)["response_count"] == "bigint"


def test_groups_with_one_name_in_two_cities_stay_apart(raw):
    texts = [brute.message("g", "yes", group_city=city) for city in ("a", "b", "b")]
    assert sorted(r.response_count for r in counts(raw(texts)).collect()) == [1, 2]


def test_one_group_with_a_third_of_the_rows(raw):
    rng = random.Random(5)
    texts = [
        brute.message("hot" if i % 3 == 0 else f"g{rng.randrange(5000)}", "yes")
        for i in range(30_000)
    ]
    expected = {(*key, n) for key, n in brute.counts(texts).items()}
    assert rows(counts(raw(texts))) == expected


def test_changelog_of_three_batches(spark):
    m = brute.message
    batches = [
        [m("a", "yes"), m("a", "yes"), m("b", "no")],
        [m("a", "yes"), m("c", "yes")],
        [m("b", "no"), m("d", "waitlist")],
    ]
    frame = count_changelog(group_keys(batches_frame(spark, batches), "batch_id"))
    found = {(r.group_name, r.response, r.response_count, r.batch_id) for r in frame.collect()}
    assert found == {
        ("a", "yes", 2, 0),
        ("b", "no", 1, 0),
        ("a", "yes", 3, 1),
        ("c", "yes", 1, 1),
        ("b", "no", 2, 2),
        ("d", "waitlist", 1, 2),
    }


values = st.sampled_from(["a", "b", None])
texts = st.builds(
    lambda g, r, c: brute.message(g, r, group_city=c),
    values,
    st.sampled_from(["yes", "no", "waitlist", None]),
    values,
)


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.lists(texts, max_size=12), min_size=1, max_size=5))
def test_changelog_equals_plain_python(spark, batches):
    frame = count_changelog(group_keys(batches_frame(spark, batches), "batch_id"))
    found = rows(frame.select(*KEYS, "response_count", "batch_id"))
    assert found == brute.changelog(batches)
