import random

import corpus_pipeline
from curbline.llm import resemblance

from test_near import reach


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def check_near_dedup(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    sets = [plain_shingles(t) for _, t in rows]
    pairs = []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 0.8 * max(len(a), len(b)) <= min(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                pairs.append((i, j))
    least = {}
    for (doc_id, _), r in zip(rows, reach(len(rows), pairs), strict=True):
        least[r] = min(least.get(r, float("inf")), float("inf") if doc_id is None else doc_id)
    kept = corpus_pipeline.near_dedup(df.sparkSession, df, "")
    assert kept.columns == df.columns
    found = sorted(float("inf") if r["doc_id"] is None else r["doc_id"] for r in kept.collect())
    assert found == sorted(least.values())
    return len(rows) - len(found)


def test_near_dedup_of_documents(documents):
    check_near_dedup(documents)


def test_near_dedup_of_edited_texts(spark):
    """Groups of copies with a few words replaced, some of them beyond 0.8 of each other, and a shared passage."""
    pick = random.Random(5)
    word = lambda: "".join(pick.choices("abcdefgh", k=6))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(120)]
        for _ in range(20):
            own = list(base)
            for _ in range(pick.randint(0, 4)):
                own[pick.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [" ".join([*passage, *(word() for _ in range(12))]) for _ in range(30)]
    removed = check_near_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert removed > 50


def test_near_dedup_of_odd_rows(odd_documents, no_documents):
    check_near_dedup(odd_documents.where("doc_id is null or doc_id not in (5, 6)"))
    assert corpus_pipeline.near_dedup(no_documents.sparkSession, no_documents, "").count() == 0


def test_prefix_filter_compares_few_texts_of_a_group_with_edits_of_their_own(spark):
    """Texts beyond 0.8 of each other meet seldom, and every pair within it is among the candidates."""
    pick = random.Random(9)
    word = lambda: "".join(pick.choices("abcdefghijkl", k=8))
    found = {}
    for n in (100, 200):
        base = [word() for _ in range(150)]
        texts = []
        for i in range(n):
            own = list(base)
            for at in pick.sample(range(150), 8 if i % 10 else 1):
                own[at] = word()
            texts.append(" ".join(own))
        sets = [resemblance.shingle_set(t.encode()) for t in texts]
        nodes = spark.createDataFrame([(i, len(s), i) for i, s in enumerate(sets)],
                                      "node long, size int, component long")
        stored = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)],
                                       "node long, shingles binary")
        met = {(r["a"], r["b"]) for r in resemblance.meeting(nodes, stored, 0.8).collect()}
        near = {(a, b) for b in range(n) for a in range(b) if resemblance.similar(sets[a], sets[b]) >= 0.8}
        assert near and near <= met
        found[n] = len(met - near)
    assert found[200] <= 200 and found[200] <= 3 * found[100] + 20


def test_ball_pairs_connect_what_lies_within_three_bits(spark):
    pick = random.Random(4)
    prints = []
    for _ in range(12):
        prints += [pick.getrandbits(63)]
        for _ in range(8):
            prints.append(prints[-1] ^ sum(1 << b for b in pick.sample(range(63), pick.choice([0, 1, 2, 3, 3, 4, 6]))))
    rows = [(i, 100, p) for i, p in enumerate(prints)] + [(1000, 50, prints[0])]
    met = {(r["a"], r["b"]) for r in resemblance.ball_pairs(
        spark.createDataFrame(rows, "node long, size int, print long"), 0.8).collect()}
    n = len(prints)
    near = {(a, b) for b in range(n) for a in range(b) if (prints[a] ^ prints[b]).bit_count() <= 3}
    assert met <= near and reach(n, met) == reach(n, near)
