"""License scans: identifier tags and notice phrases found by Aho-Corasick, and licence
expressions evaluated by a shunting-yard parser.

Phrases are sequences of words: the automaton runs over the text with its words in lower case and
single spaces between them, so that punctuation and line ends within a phrase do not matter, and
overlapping phrases are all found. A tag is followed by an expression of identifiers, AND, OR,
WITH and parentheses, up to the end of its line.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.text import ALNUM, text_chunks

#: Phrases whose places are counted, and their labels (fixed values).
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Other notices, and their labels.
NOTICES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "boost software license version 1": "bsl-1",
    "creative commons attribution": "cc-by",
    "all rights reserved": "all-rights-reserved",
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(rb"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(rb"\(|\)|[A-Za-z0-9.+:-]+")
#: How tightly operators bind.
BINDS = {"or": 1, "and": 2, "with": 3}
#: Weight of each kind of evidence: a text with none scores 0.
TAG_WEIGHT, BASE_WEIGHT, NOTICE_WEIGHT = 0.95, 0.8, 0.6


#: Licences in all choices of an expression up to which it is expanded into its choices.
EXPANDED = 4096


class Expression:
    """``names``: all identifiers. ``choices``: the sets of licences, any one of which is enough,
    with exceptions written "licence with exception"; None where they would hold more than EXPANDED
    licences, as products of choices grow exponentially. ``op`` and ``parts``: the expression as it
    stands, the texts of the operands of one AND or OR, or one licence."""

    def __init__(self, licence: str) -> None:
        self.names, self.op, self.parts = {licence}, "", {licence}
        self.choices: set[frozenset[str]] | None = {frozenset([licence])}
        self.size = 1  # licences in all choices

    def written(self) -> str:
        """The expression in normal form; nothing of it is left out, whether expanded or not."""
        if self.choices is None:
            return f" {self.op} ".join(sorted(self.parts))
        return " or ".join(sorted(" and ".join(sorted(c)) for c in self.choices))

    def operands(self, op: str) -> set[str]:
        if self.op in ("", op):
            return self.parts
        text = f" {self.op} ".join(sorted(self.parts))
        return {f"({text})" if self.op == "or" else text}

    def joined(self, op: str, other: "Expression") -> "Expression":
        """Both joined by AND or OR. The smaller one is added to the larger, so that a long chain
        costs its length."""
        if len(self.names) < len(other.names):
            self, other = other, self
        parts, more = self.operands(op), other.operands(op)
        if op == "or" and self.choices is not None and other.choices is not None:
            self.choices |= other.choices
            self.size += other.size
        elif op == "and" and self.choices is not None and other.choices is not None:
            size = self.size * len(other.choices) + other.size * len(self.choices)
            self.choices = (
                {a | b for a in self.choices for b in other.choices} if size <= EXPANDED else None
            )
            self.size = size
        else:
            self.choices = None
        if self.choices is not None and self.size > EXPANDED:
            self.choices = None
        parts |= more
        self.names |= other.names
        self.op, self.parts = op, parts
        return self


def parse(text: bytes) -> Expression | None:
    """The value of a licence expression; None if it is none.

    Operators wait on a stack until one that binds less tightly comes; values are combined as they
    leave it: OR joins the choices, AND pairs them, WITH adds an exception to a single licence.
    """
    values: list[Expression] = []
    waiting: list[str] = []
    operand = True  # whether one must come next

    def apply() -> bool:
        op = waiting.pop()
        if len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        if op != "with":
            values.append(left.joined(op, right))
            return True
        if len(left.names) != 1 or len(right.names) != 1:
            return False
        value = Expression(f"{min(left.names)} with {min(right.names)}")
        value.names = left.names
        values.append(value)
        return True

    for token in TOKEN.findall(text):
        word = token.decode("ascii").lower()
        if word == "(":
            if not operand:
                return None
            waiting.append(word)
        elif word == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                if not apply():
                    return None
            if not waiting:
                return None
            waiting.pop()
        elif word in BINDS:
            if operand:
                return None
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[word]:
                if not apply():
                    return None
            waiting.append(word)
            operand = True
        else:
            if not operand:
                break  # prose after the expression
            values.append(Expression(word))
            operand = False
    while waiting:
        if waiting[-1] == "(" or not apply():
            return None
    return values[0] if len(values) == 1 and not operand else None


class Scan(NamedTuple):
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: list[str]
    labels: list[str]
    expressions: list[str]
    score: float


def phrase_automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    """Phrases with a space on either side, so that whole words match."""
    automaton = ahocorasick.Automaton()
    for kind, phrases in (("notice", notices), ("base", base)):
        for phrase, label in phrases.items():
            automaton.add_word(f" {phrase} ", (kind, phrase, label))
    automaton.add_word(f" {TAG_WORDS} ", ("tag", TAG_WORDS, ""))
    automaton.make_automaton()
    return automaton


def scan(text: bytes, automaton: ahocorasick.Automaton) -> Scan:
    words = text.translate(ALNUM).split()
    # One character for each byte, so that places are byte places.
    line = f" {b' '.join(words).decode('latin-1')} "
    starts, base, other, tags = [], set(), set(), False
    for end, (kind, phrase, label) in automaton.iter(line):
        if kind == "base":
            starts.append(end - len(phrase) - 1)
            base.add(label)
        elif kind == "notice":
            other.add(label)
        else:
            tags = True
    found = [parse(m) for m in TAG.findall(text)] if tags else []
    valid = [e for e in found if e]
    named = set().union(*(e.names for e in valid))
    doubt = (1 - TAG_WEIGHT) ** len(valid) * (1 - BASE_WEIGHT) ** len(base)
    doubt *= (1 - NOTICE_WEIGHT) ** len(other)
    return Scan(
        len(words),
        len(starts),
        line.count(" ", 0, min(starts)) if starts else None,
        line.count(" ", 0, max(starts)) if starts else None,
        sorted(base),
        sorted(base | other | named),
        sorted({e.written() for e in valid}),
        1 - doubt,
    )


SCHEMA = (
    "id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels array<string>, labels array<string>, expressions array<string>, score double"
)


def scan_licenses(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    base: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
) -> DataFrame:
    """Per row: words, places of base phrases, the first and last place in words, sorted distinct
    labels of base phrases and of all evidence, licence expressions in normal form and a score. An
    expression is written as its choices, or where these would be too many as it stands, sorted.

    A null text is empty; a text without evidence has no labels and score 0. Each place counts,
    also of phrases that overlap; a malformed expression adds nothing. Equal rows get equal rows.
    """
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices

    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = phrase_automaton(base, notices)
        for part, texts in text_chunks(batches, "text"):
            columns = list(zip(*(scan(t, automaton) for t in texts)))
            types = [pa.int64()] * 4 + [pa.list_(pa.string())] * 3 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["id", *Scan._fields],
            )

    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    return rows.mapInArrow(scan_all, SCHEMA).withColumnRenamed("id", id)
