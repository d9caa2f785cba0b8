import re

import pytest

from turnout.llm.licenses import BASE, parse, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in BASE.items():
        phrase = phrase.split()
        for at in range(len(words) - len(phrase) + 1):
            if words[at : at + len(phrase)] == phrase:
                places.append(at)
                labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, sorted(labels))


TEXTS = [
    None, "", "...", "under the MIT license", "x Under the\nMIT\tLicense. under, the mit-license!",
    "Apache License, Version 2.0 and CC BY-NC 4.0.", "é under the mit licenses", "cc by nc by nc cc by nc",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode", "all rights reserved",
    "SPDX-License-Identifier: MIT OR\nSPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0",
    "under the mit license " * 5000, "\x00under\x7fthe\x01mit\x02license",
]


def test_base_places_against_brute_force(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3]), (3, TEXTS[3])]
    found = scan_licenses(documents(rows)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert sorted(got, key=repr) == sorted([(i, *brute(t)) for i, t in rows], key=repr)
    assert all(0 <= r.score <= 1 and set(r.base_labels) <= set(r.labels) for r in found)
    by = {r.doc_id: r for r in found}
    assert by[1].score == 0 and by[9].labels == ["all-rights-reserved"] and by[9].score > 0
    assert by[8].labels == ["apache-2.0", "bsd-3-clause", "mit"]
    assert by[8].expressions == ["apache-2.0 and bsd-3-clause or bsd-3-clause and mit"]
    assert by[10].expressions == ["gpl-2.0-only with classpath-exception-2.0"]
    assert scan_licenses(documents([])).count() == 0


@pytest.mark.parametrize(
    "text, choices",
    [
        ("MIT", [["mit"]]),
        ("A OR B AND C", [["a"], ["b", "c"]]),
        ("(A OR B) AND C", [["a", "c"], ["b", "c"]]),
        ("A AND B OR C AND D", [["a", "b"], ["c", "d"]]),
        ("A WITH x AND B", [["a with x", "b"]]),
        ("((A))", [["a"]]),
        ("MIT */", [["mit"]]),
        ("MIT License text", [["mit"]]),
    ],
)
def test_expressions(text, choices):
    assert sorted(map(sorted, parse(text.encode()).choices)) == choices


@pytest.mark.parametrize("text", ["", "OR", "A OR", "(A", "A)", "A AND OR B", "()", "A (B)", "(A OR B) WITH x"])
def test_malformed_expressions(text):
    assert parse(text.encode()) is None


def test_no_choice_is_lost():
    names = [f"a{i}" for i in range(300)]
    value = parse(" OR ".join(names).encode())
    assert value.choices == {frozenset([n]) for n in names} and value.written() == " or ".join(sorted(names))
    value = parse(f"({' OR '.join(names[:257])}) OR x".encode())
    assert len(value.choices) == 258 and frozenset(["x"]) in value.choices
    value = parse(f"({' OR '.join(names[:257])}) AND x".encode())
    assert value.choices == {frozenset([n, "x"]) for n in names[:257]}


def test_products_of_choices_are_written_as_they_stand():
    value = parse(b" AND ".join(b"(b%d OR a%d)" % (i, i) for i in range(40)))
    assert len(value.names) == 80 and value.choices is None
    assert value.written() == " and ".join(sorted(f"(a{i} or b{i})" for i in range(40)))
    text = b" AND ".join(b"(b%d OR a%d)" % (i, i) for i in range(40))
    # What comes before or after an expression that is not expanded is kept too.
    for whole in (b"x OR " + text, text + b" OR x", b"(" + text + b") OR x"):
        assert parse(whole).written() == value.written() + " or x"
    assert parse(b"x AND (" + text + b" OR y)").written() == f"({value.written()} or y) and x"
    assert parse(b"(" + text + b") WITH e") is None


def test_long_chains_take_time_by_length():
    for op in (b" OR ", b" AND "):
        value = parse(op.join(b"n%d" % i for i in range(60000)))
        assert len(value.names) == 60000
        assert value.written() == op.decode().lower().join(sorted(f"n{i}" for i in range(60000)))
    assert parse(b"(" * 3000 + b"a" + b" OR b)" * 3000).written() == "a or b"
