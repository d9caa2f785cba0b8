import random

from turnout.llm.line_dedup import dedup_lines


def brute(rows):
    """Windows in the order of ids, nulls last, then of the table."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        text = rows[i][1]
        lines = [] if text is None else text.split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if window in seen:
                gone |= {at, at + 1, at + 2}
            seen.add(window)
        left = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out[i] = (rows[i][0], left, len(lines), len(gone))
    return [out[i] for i in range(len(rows))]


def run(documents, rows):
    found = dedup_lines(documents(rows)).select("doc.doc_id", "doc.text", "n_lines", "n_removed")
    return [tuple(r) for r in found.collect()]


def test_random_texts_against_brute_force(documents):
    rng = random.Random(1)
    rows = [
        (rng.choice([i, i, i, 3, None]), "\n".join(rng.choice("abc") for _ in range(rng.randrange(9))))
        for i in range(80)
    ]
    rows += [(200, None), (201, ""), (202, "\n".join("ab" * 2000)), (203, "é\r\né\n\n\n\n"), (5, rows[5][1])]
    assert sorted(run(documents, rows), key=repr) == sorted(brute(rows), key=repr)


def test_first_occurrence_stays_and_overlaps_merge(documents):
    found = run(documents, [(1, "a\nb\nc\nx"), (2, "y\na\nb\nc\nd"), (3, "q\nq\nq\nq")])
    assert sorted(found) == [(1, "a\nb\nc\nx", 4, 0), (2, "y\nd", 5, 3), (3, "q", 4, 3)]


def test_other_columns_stay_and_empty_table_has_no_rows(documents):
    row = dedup_lines(documents([(1, "a")])).first()
    assert row.doc.asDict() == {
        "doc_id": 1, "text": "a", "_row": 1, "hash": "x", "id": 2, "length": 3, "lines": "y",
        "score": 4, "doc": "z", "covered": 5, "piece": 6,
    }
    assert dedup_lines(documents([])).count() == 0
