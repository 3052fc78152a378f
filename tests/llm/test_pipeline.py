"""The pipeline, stage by stage, against brute force."""

import hashlib
import re

import corpus_pipeline
import pytest
from test_copies import brute_components

from weirflow.llm import toxicity
from weirflow.llm.common import stored, table
from weirflow.llm.queries import CORPUS_ORACLES, CORPUS_QUERIES, tokenizer

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    left = {r.doc_id: r.text for r in docs.collect()}
    grammar = toxicity.fit(docs, table(spark, SMALL, "labels"))
    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]

    def expected(name):
        if name == "toxicity":
            return {i for i, t in left.items() if grammar.score(t) < 0.5}
        if name == "exact dedup":
            first = {}
            for i in sorted(left):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[i] or ""), i)
            return set(first.values())
        if name == "near duplicates":
            return {i for i, c in brute_components(list(left.items())).items() if i == c}
        return {i for i, t in left.items() if not any(x in (t or "") for x in items)}

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), "stage")
        assert docs.columns == columns
        want = expected(name)
        assert {r.doc_id for r in docs.select("doc_id").collect()} == want, name
        left = {i: left[i] for i in want}
    name, stage = corpus_pipeline.STAGES[-1]
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in stage(spark, docs, SMALL).collect()}
    ids = {i: library.encode(t or "") for i, t in left.items()}
    assert got == {i: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in ids.items()}


def test_stages_take_an_empty_table(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), SMALL).collect() == []


@pytest.mark.parametrize("n", range(1, 14))
def test_one_query_for_each_operator(n):
    assert sum(name.startswith(f"op{n}_") for name in CORPUS_QUERIES) == 1
    assert set(CORPUS_ORACLES) <= set(CORPUS_QUERIES)
