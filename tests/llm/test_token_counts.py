import public_tokenizers

from turnout.llm.token_counts import (
    answer_limits,
    answer_quantiles,
    context_limits,
    encoded_lengths,
    length_histogram,
)
from turnout.llm.tokens import byte_bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_against_plain_counts(documents):
    rows = [(i, f"word {i % 7} " * (i * i % 91)) for i in range(60)]
    rows += [(None, None), (1, ""), (2, "é日本 <|endoftext|>"), (2, "x y " * 30_000), (2, "x y " * 30_000)]
    encode = byte_bpe(VOCABULARY).encode_ordinary
    lengths = [len(encode(t or "")) for _, t in rows]
    limits = context_limits(length_histogram(encoded_lengths(documents(rows), VOCABULARY)))
    got = {r.length: r for r in limits.collect()}
    assert sorted(got) == sorted(set(lengths))
    for k, r in got.items():
        over = [x for x in lengths if x > k]
        assert r.n_docs == lengths.count(k) and r.n_tokens == k * r.n_docs
        assert (r.docs_over, r.tokens_over) == (len(over), sum(over))
        assert r.tokens_kept == sum(min(x, k) for x in lengths)
        assert r.quantile == (len(lengths) - len(over)) / len(lengths)
    wanted = [0, 1, 50, 4096, 10**7]
    for r in answer_limits(limits, wanted).collect():
        over = [x for x in lengths if x > r.limit]
        assert (r.docs_over, r.tokens_over) == (len(over), sum(over))
        assert r.tokens_kept == sum(min(x, r.limit) for x in lengths)
    ordered = sorted(lengths)
    for r in answer_quantiles(limits, [0.0, 0.25, 0.5, 1.0]).collect():
        least = next(x for i, x in enumerate(ordered) if (i + 1) / len(ordered) >= r.share)
        assert r.length == max(least, ordered[0])


def test_empty_table(documents):
    assert context_limits(length_histogram(encoded_lengths(documents([]), VOCABULARY))).count() == 0


def test_documents_are_encoded_once(documents):
    limits = context_limits(length_histogram(encoded_lengths(documents([(1, "a b"), (2, "c")]), VOCABULARY)))
    plan = limits._jdf.queryExecution().executedPlan().toString()
    # The histogram is a written table by then; nothing encodes again.
    assert "MapInArrow" not in plan and "FileScan parquet" in plan
