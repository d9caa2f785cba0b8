"""Each registered query against its SQL in DuckDB, and the pipeline against plain Python."""

import zlib

import duckdb
import numpy as np
import pytest
import test_decontaminate
import test_jaccard_join
import test_line_dedup
from tokenizers import Tokenizer

import corpus_pipeline
from turnout.llm.packing import END_ID, TOKENS
from turnout.llm.quality import fit_quality, probabilities
from turnout.llm.queries import ORACLE, QUERIES, WORD_VOCABULARY
from turnout.llm.tables import stored, table

SF_DIR = "/root/testdata/sf0.001"
# Each filter finds something to drop here.
EFFECT_DIR = "/root/testdata/sf0.01"
TABLES = ("documents", "benchmark", "embeddings")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for one in TABLES:
        database.execute(f"CREATE VIEW {one} AS SELECT * FROM read_parquet('{SF_DIR}/{one}.parquet')")
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = database.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    found = [tuple(row) for row in frame.select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr) and found


def test_stages_keep_columns_and_take_effect(spark):
    docs, counts = table(spark, EFFECT_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, EFFECT_DIR), name)
        assert after.schema.names == docs.schema.names
        assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        counts.append((name, docs.count(), after.count()))
        if name == "line_dedup":
            assert after.filter("n_chars != length(text)").isEmpty()
        docs = after
    before = dict((name, (a, b)) for name, a, b in counts)
    assert before["line_dedup"][0] == before["line_dedup"][1]
    for name in ("quality", "near_duplicates", "decontaminate"):
        assert before[name][1] < before[name][0]
    packed = corpus_pipeline.run(spark, EFFECT_DIR)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_whole_pipeline_against_plain_python(spark):
    documents, labels = (table(spark, SF_DIR, name) for name in ("documents", "labels"))
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    score = probabilities(fit_quality(documents, labels), [(t or "").encode() for _, t in rows])
    rows = [row for row, p in zip(rows, score) if p >= 0.7]
    rows = [(i, text) for i, text, _, _ in test_line_dedup.brute(rows)]
    parts = test_jaccard_join.brute(rows)
    rows = [row for row, (i, size, part) in zip(rows, parts) if not size or i == part]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    found = test_decontaminate.brute(rows, items)
    rows = [row for row, (_, _, _, _, bad) in zip(rows, found) if not bad]
    whole, expected = Tokenizer.from_file(WORD_VOCABULARY), set()
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [END_ID]
        for piece, start in enumerate(range(0, len(ids), TOKENS)):
            part = ids[start : start + TOKENS]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected.add((doc_id, piece, start, len(part), crc, tuple(part)))
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    got = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in packed}
    assert len(packed) == len(expected) and got == expected
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= TOKENS
    assert len(ends) <= -(-sum(r.length for r in packed) // TOKENS) + 1
