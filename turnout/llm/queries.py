"""One query per operator over the whole of its table, and SQL where SQL can express it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.llm.decontaminate import contamination
from turnout.llm.hard_negatives import hard_negatives
from turnout.llm.html_text import extract_text, fit_extractor
from turnout.llm.jaccard_join import jaccard_components
from turnout.llm.licenses import scan_licenses
from turnout.llm.line_dedup import dedup_lines
from turnout.llm.minmax import near_copies
from turnout.llm.neighbours import nearest
from turnout.llm.packing import pack_pieces, token_pieces
from turnout.llm.quality import fit_quality, score_quality
from turnout.llm.ranked_search import ranked_search
from turnout.llm.substring_dedup import dedup_substrings
from turnout.llm.tables import table
from turnout.llm.token_counts import context_limits, encoded_lengths, length_histogram

Query = Callable[[SparkSession, str], DataFrame]
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc.doc_id", "n_lines", "n_removed", "doc.text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = encoded_lengths(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)
    return context_limits(length_histogram(lengths))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumns(
        {name: F.array_join(name, ",") for name in ("base_labels", "labels")}
    ).withColumn("expressions", F.array_join("expressions", "; "))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("kept"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit_quality(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc.doc_id").cast("string").cast("binary")) % 4 == 2
    held_out = F.coalesce(held_out, F.lit(False))
    return score_quality(docs, weights).select(
        "doc.doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_pieces(token_pieces(table(spark, sf_dir, "documents"), WORD_VOCABULARY))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract_text(pages.select("page_id", "url", "html"), fit_extractor(pages))
    length = F.length("text").cast("long").alias("n_chars")
    return found.select("page.page_id", "page.url", "text", length)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_decontaminate": op3_decontaminate,
    "op4_licenses": op4_licenses,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality": op7_quality,
    "op8_best_fit": op8_best_fit,
    "op9_nearest": op9_nearest,
    "op10_html_text": op10_html_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minmax_dedup": op12_minmax_dedup,
    "op13_ranked_search": op13_ranked_search,
}
# Words of the classes that the operators take, in DuckDB's regular expressions.
ALNUM_WORDS = (
    "regexp_extract_all("
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
SPACED_WORDS = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"
LOWER_SPACED_WORDS = SPACED_WORDS.replace(
    "text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

LINE_DEDUP_SQL = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
),
windows AS (
  SELECT doc_id, place, line, lead(line, 1) OVER d AS second, lead(line, 2) OVER d AS third
  FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY place)
),
ranked AS (
  SELECT doc_id, place,
    row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, place) AS n
  FROM windows WHERE third IS NOT NULL
),
covered AS (
  SELECT DISTINCT doc_id, place + j AS place
  FROM ranked, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1
),
marked AS (
  SELECT l.*, c.place IS NOT NULL AS gone FROM lines l LEFT JOIN covered c USING (doc_id, place)
),
texts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS left_text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  t.left_text AS text
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({ALNUM_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({ALNUM_WORDS}, []) AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS words
  FROM i, unnest(range(1, greatest(len(w) - 11, 2))) AS r(p) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM patterns),
windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS r(p)
),
hits AS (SELECT doc_id, n, p, item_id FROM windows JOIN patterns USING (n, words)),
places AS (
  SELECT doc_id, count(DISTINCT p + j) AS n_hit
  FROM hits, unnest(range(0, n)) AS r(j) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRING_DEDUP_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({SPACED_WORDS}, []) AS w FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS words
  FROM d, unnest(range(1, len(w) - 33)) AS r(p)
),
repeated AS (SELECT words FROM windows GROUP BY words HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, p + j AS place
  FROM windows JOIN repeated USING (words), unnest(range(0, 35)) AS r(j)
),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
texts AS (
  SELECT doc_id, count(c.place) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (c.place IS NULL) AS kept
  FROM places LEFT JOIN covered c USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN texts USING (doc_id)
"""

def components_sql(n: int, columns: str) -> str:
    """Components of documents whose sets of ``n``-word shingles overlap by 80 percent."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({LOWER_SPACED_WORDS}, []) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least({n}, len(w)) - 1], ' ') AS gram
  FROM d, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS r(p) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a JOIN grams b USING (gram)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * pairs.n >= 80 * (s.n + t.n - pairs.n)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT x AS doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(y) AS component_id{columns}
FROM reach LEFT JOIN sizes ON sizes.doc_id = x GROUP BY x
"""


HARD_NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i]))::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""

RANKED_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({ALNUM_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, unnest({ALNUM_WORDS}) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS repeats FROM i GROUP BY ALL),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
held AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM held, totals GROUP BY term, n_docs
),
scores AS (
  SELECT item_id, doc_id, sum(repeats * weight
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term), totals GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op3_decontaminate": DECONTAMINATE_SQL,
    "op5_substring_dedup": SUBSTRING_DEDUP_SQL,
    "op6_jaccard_join": components_sql(5, ""),
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_minmax_dedup": components_sql(2, ", x = min(y) AS kept"),
    "op13_ranked_search": RANKED_SQL,
}
