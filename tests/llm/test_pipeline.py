"""The pipeline against brute force on the small documents, stage by stage."""

from collections import Counter

import corpus_pipeline
import pytest
import regex

from blockledger.llm import mixing, token_shards
from tests_llm_brute import contaminated_texts, components_of

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "mixture", "token_output"]


def test_pipeline_matches_brute_force(spark):
    from blockledger.llm.common import saved
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    at = names.index("text")
    want = rows(docs)

    stage = dict(corpus_pipeline.STAGES)
    docs = saved(stage["language_id"](spark, docs, SMALL), "t")
    want = [r for r in want if r[at] and regex.search(r"\p{L}", r[at])]
    assert docs.columns == names and Counter(rows(docs)) == Counter(want)

    docs = saved(stage["near_duplicates"](spark, docs, SMALL), "t")
    least = components_of([(r[0], r[at]) for r in want], per_cent=80, size=5)
    want = [r for r in want if least[r[0]] == r[0]]
    assert docs.columns == names and Counter(rows(docs)) == Counter(want)

    docs = saved(stage["decontamination"](spark, docs, SMALL), "t")
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = contaminated_texts([r[at] for r in want], items)
    assert bad
    want = [r for r in want if r[at] not in bad]
    assert docs.columns == names and Counter(rows(docs)) == Counter(want)

    taken = {r[0]: r[1] for r in mixing.copies(docs, keep=["doc_id"]).select("row.doc_id", "copies").collect()}
    docs = saved(stage["mixture"](spark, docs, SMALL), "t")
    want = [r for r in want for _ in range(taken[r[0]])]
    assert docs.columns == names and Counter(rows(docs)) == Counter(want)

    out = stage["token_output"](spark, docs, SMALL).collect()
    enc = token_shards.Encoder(*_tokenizer())
    total = sum(len(enc.ids(r[at])) // 2 + 1 for r in want)
    assert sum(r.n_tokens for r in out) == total
    assert sorted(r.slot for r in out) == list(range(len(out)))


def _tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_stages_on_awkward_rows(spark, documents):
    """Every stage runs on nulls, blanks, repeated rows and clashing columns, and keeps the columns."""
    from blockledger.llm.common import saved
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SMALL), f"t-{name}")
        assert docs.columns == documents.columns
    assert corpus_pipeline.token_output(spark, docs, SMALL).count() > 0


def test_stages_on_no_rows(spark, no_documents):
    from blockledger.llm.common import saved
    docs = saved(no_documents, "t-none")
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SMALL), f"t-{name}")
        assert docs.count() == 0
