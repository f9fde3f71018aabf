"""All stages in a row over odd rows, each against plain Python on the stage before."""

import corpus_pipeline
import public_tokenizers
from curbline.llm import language
from curbline.llm.common import written
from test_resemblance import plain_shingles


def test_stages_on_odd_rows(spark, odd_documents, tmp_path):
    from tokenizers import Tokenizer

    # Without a usable language every document with letters stays.
    docs = odd_documents.withColumn("lang", odd_documents["lang"].substr(10, 2).cast("string")).selectExpr(
        "doc_id", "text", "nullif(lang, '') as lang", "source", "n_chars", "row", "digest")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, "")
        if name != "pack":
            assert made.columns == docs.columns
        docs = written(made, name)
        seen[name] = docs.collect()
    given = [r["text"] for r in odd_documents.collect() if language.has_letter(r["text"])]
    assert sorted(r["text"] for r in seen["language_id"]) == sorted(given)
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    assert sorted(lower(r["text"]) for r in seen["exact_dedup"]) == sorted(set(map(lower, given)))
    sets = [frozenset(plain_shingles(r["text"])) for r in seen["near_dedup"]]
    assert len(set(sets)) == len(sets) and set(sets) == {frozenset(plain_shingles(r["text"])) for r in seen["exact_dedup"]}
    assert len(seen["pseudonymise"]) == len(seen["near_dedup"])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [[*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0] for r in seen["pseudonymise"]]
    pieces = seen["pack"]
    assert sum(r["length"] for r in pieces) == sum(map(len, want))
    assert max(r["offset"] + r["length"] for r in pieces) <= 1024
    assert sorted(r["doc_tokens"] for r in pieces if r["start"] == 0) == sorted(map(len, want))


def test_pipeline_on_no_rows(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
