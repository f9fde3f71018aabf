import hashlib
import random
from collections import defaultdict

from curbline.llm import exact
from curbline.llm.cuckoo import CuckooIndex


def expected(rows):
    """By plain grouping: text -> (largest id, count)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = expected(rows)
    found = exact.groups(df).collect()
    assert len(found) == len(rows)
    by_digest = {hashlib.sha256(t).digest(): v for t, v in want.items()}
    for r in found:
        assert (r["keep_id"], r["group_size"]) == by_digest[bytes(r["digest"])]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in found) == len(want)


def test_groups_of_documents(documents):
    check(documents)


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents)
    assert exact.groups(no_documents).count() == 0


def test_keep_one_keeps_columns(odd_documents):
    kept = exact.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    texts = [(r["text"] or "").encode().lower() for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(r["text"] or "").encode().lower() for r in odd_documents.collect()})


def test_flush_and_many_shards(documents):
    digests = exact.tagged(documents)
    small = exact.build_index(digests, keys_per_shard=50).collect()
    assert {(bytes(r["digest"]), r["keep_id"], r["group_size"]) for r in small} == {
        (bytes(r["digest"]), r["keep_id"], r["group_size"]) for r in exact.build_index(digests).collect()}


def test_retract(documents):
    digests = exact.tagged(documents)
    index = exact.build_index(digests)
    gone = index.where("group_size > 1 or keep_id % 7 = 0").selectExpr("keep_row as row")
    left = digests.join(gone, "row", "left_anti")
    got = exact.retract(index, digests, gone)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.build_index(left).collect()))


def test_cuckoo_index_against_a_dict():
    pick = random.Random(4)
    index, live = CuckooIndex(capacity=4, kicks=8), {}
    # Few fingerprints and buckets, so that false hits, moves and rebuilding happen.
    keys = [bytes([i % 3, 0, 7, 7]) + hashlib.sha256(bytes([i % 251, i // 251])).digest()[:12] for i in range(3000)]
    for step in range(20_000):
        key = pick.choice(keys)
        if pick.random() < 0.35:
            assert index.delete(key) == (live.pop(key, None) is not None)
        else:
            index.insert(key, step)
            live[key] = step
        probe = pick.choice(keys)
        assert index.find(probe) == live.get(probe)
    assert dict(index.items()) == live and len(index) == len(live)
