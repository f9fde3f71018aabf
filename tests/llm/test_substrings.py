import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from curbline.llm import chunking, spans, suffixes


def removed(texts, length):
    """Byte masks under strings that start twice, by listing every string."""
    seen = defaultdict(list)
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen[hashlib.blake2b(t[i:i + length], digest_size=12).digest()].append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + length] = True
    return gone


def check_removal(df, **sizes):
    length, least = sizes.get("length", 400), sizes.get("least", 240)
    rows = df.select("doc_id", "text").collect()
    texts = [(r["text"] or "").encode() for r in rows]
    want = []
    for r, t, gone, noted in zip(rows, texts, removed(texts, length), removed(texts, least), strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(int)]) == 1))
        want.append((r["doc_id"] or -1, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(),
                     int(noted.sum())))
    found = suffixes.remove(df, **sizes).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["n_noted"])
                  for r in found) == sorted(want)


def test_removal_from_documents(documents):
    check_removal(documents)


def repetitive(spark, seed):
    pick = random.Random(seed)
    passages = ["".join(pick.choices("abcd ", k=pick.randint(20, 90))) for _ in range(12)]
    texts = []
    for _ in range(150):
        pieces = []
        for _ in range(pick.randint(0, 5)):
            p = pick.choice(passages)
            a = pick.randint(0, 10)
            pieces += [p[a:], "".join(pick.choices("xyzé", k=pick.randint(0, 25)))]
        texts.append("".join(pieces))
    texts += ["a" * 300, "ab" * 100, "a" * 39, texts[3], texts[3] + "q", "", None]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("crowd", [20_000, 2])
@pytest.mark.parametrize("seed, least", [(1, 24), (2, 25), (3, 40)])
def test_removal_of_short_strings(spark, seed, least, crowd):
    check_removal(repetitive(spark, seed), length=40, least=least, gram=16, crowd=crowd)


def test_removal_from_odd_rows(odd_documents, no_documents):
    check_removal(odd_documents.where("doc_id is null or doc_id not in (5, 6)"), length=8, least=6, gram=4)
    found = suffixes.remove(odd_documents).where("doc_id in (5, 6)").collect()
    assert all(r["n_removed"] == r["n_bytes"] for r in found)
    assert suffixes.remove(no_documents).count() == 0


def test_prefix_intervals_against_all_pairs():
    pick = random.Random(3)
    for _ in range(60):
        texts = sorted("".join(pick.choices("ab", k=pick.randint(1, 7))).encode() + b"$" for _ in range(9))
        prefixes = [suffixes.common(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        want = set()
        for i in range(len(texts)):
            for j in range(i + 1, len(texts)):
                p = min(prefixes[i:j])
                if p and (i == 0 or prefixes[i - 1] < p) and (j == len(texts) - 1 or prefixes[j] < p):
                    want.add((p, i, j))
        assert set(suffixes.prefix_intervals(prefixes, 1)) == want


def plain_groups(ahead, behind, least):
    """(p, e, members) by all pairs: for every member the extensions that no longer prefix has."""
    n = len(ahead)
    p = [[suffixes.common(a, b) for b in ahead] for a in ahead]
    e = [[suffixes.common(a, b) for b in behind] for a in behind]
    made = set()
    for i in range(n):
        known = -1
        for q in sorted({p[i][j] for j in range(n) if j != i}, reverse=True):
            best = max(e[i][j] for j in range(n) if j != i and p[i][j] >= q)
            known, further = max(known, best), best > known
            if further and q + best >= least:
                members = tuple(j for j in range(n) if j == i or (p[i][j] >= q and e[i][j] >= best))
                made.add((min(p[i][j] for j in members if j != i), best, members))
    return made


def test_groups_against_all_pairs():
    pick = random.Random(6)
    for n in (2, 3, 9, 25):
        for _ in range(40):
            ahead = sorted(b"g" + "".join(pick.choices("ab", k=pick.randint(3, 9))).encode() for _ in range(n))
            behind = ["".join(pick.choices("ab", k=pick.randint(0, 9))).encode() for _ in range(n)]
            found = [(p, e, tuple(sorted(m))) for p, e, m in suffixes.repeat_groups_of(ahead, behind, 4)]
            p_of = {(p, e, m) for p, e, m in found}
            want = plain_groups(ahead, behind, 4)
            assert want <= p_of
            for p, e, m in p_of:
                # All that share the string, and no longer string is shared by all of them.
                assert p == min(suffixes.common(ahead[m[0]], ahead[j]) for j in m[1:])
                assert e == min(suffixes.common(behind[m[0]], behind[j]) for j in m[1:])
                assert m == tuple(j for j in range(n) if suffixes.common(ahead[m[0]], ahead[j]) >= p
                                  and suffixes.common(behind[m[0]], behind[j]) >= e)


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_groups_list_all_occurrences(spark, crowd):
    df = repetitive(spark, 5)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
    groups = defaultdict(list)
    for r in suffixes.maximal_repeats(df, 40, 24, 16, crowd).collect():
        groups[r["group"]].append(r)
    assert groups
    for rows in groups.values():
        strings = {texts[r["doc_id"]][r["start"]:r["start"] + r["length"]] for r in rows}
        assert len(rows) > 1 and len(strings) == 1 and len(min(strings)) == rows[0]["length"] >= 24
        string = min(strings)
        places = {(d, i) for d, t in texts.items() for i in range(len(t)) if t.startswith(string, i)}
        assert {(r["doc_id"], r["start"]) for r in rows} <= places
        assert len({(r["doc_id"], r["start"]) for r in rows}) == len(rows)


def test_a_thousand_equal_passages_are_one_group(spark):
    pick = random.Random(7)
    word = lambda: "".join(pick.choices("abcdefghijklmnop", k=pick.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))[:300]
    texts = [" ".join(word() for _ in range(20)) + passage + " ".join(word() for _ in range(20)) for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = defaultdict(set)
    lengths = {}
    for r in suffixes.maximal_repeats(df).collect():
        groups[r["group"]].add(r["doc_id"])
        lengths[r["group"]] = r["length"]
    full = [g for g, ids in groups.items() if len(ids) == 1000]
    assert full and max(lengths[g] for g in full) == 300
    found = suffixes.remove(df).select("n_removed", "n_noted", "noted").collect()
    assert len(found) == 1000
    assert all(r["n_removed"] == 0 and 300 <= r["n_noted"] <= 315 and len(r["noted"]) == 1 for r in found)


def test_chunk_ends():
    pick = random.Random(8)
    for n in (0, 1, 16, 17, 500, 5000):
        text = "".join(pick.choices("abcdefghé 漢", k=n)).encode()
        ends = chunking.chunk_ends(text)
        assert ends == sorted(set(ends)) and (ends[-1:] == [len(text)] if n else ends == [])
        begins = [0, *ends[:-1]]
        assert all(b - a <= chunking.MOST for a, b in zip(begins, ends, strict=False))
        assert all(b - a >= chunking.LEAST or b == len(text) or b - a > chunking.MOST - 4
                   for a, b in zip(begins, ends, strict=False))
        for a, b in zip(begins, ends, strict=False):
            text[a:b].decode()
    hashes, h = chunking.gear_hash(np.frombuffer(b"some bytes that roll by", np.uint8)), 0
    for b, got in zip(b"some bytes that roll by", hashes.tolist(), strict=True):
        h = (2 * h + int(chunking.GEAR[b])) % 65536
        assert h == got


def test_insertions_move_few_chunks():
    pick = random.Random(9)
    text = "".join(pick.choices("abcdefgh ", k=6000)).encode()
    moved = text[:3000] + b"inserted" + text[3000:]

    def pieces(t):
        ends = chunking.chunk_ends(t)
        return {t[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)}

    assert len(pieces(text) - pieces(moved)) <= 4


def plain_dedup(rows, run):
    """Chunk by chunk in order of id, with a set of what has been seen."""
    made = {}
    seen = set()
    for doc_id, text in sorted(rows):
        ends = chunking.chunk_ends(text)
        later = []
        for a, b in zip([0, *ends[:-1]], ends, strict=True) if ends else ():
            if text[a:b] in seen:
                later.append((a, b))
            seen.add(text[a:b])
        made[doc_id] = spans.merged(later, run)
    return made


def test_chunk_dedup_of_documents(documents):
    want = plain_dedup([(r["doc_id"], r["text"].encode()) for r in documents.collect()], chunking.RUN)
    found = chunking.dedup(documents).collect()
    assert {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in found} == want
    for r in found:
        bytes(r["kept"]).decode()
        assert r["n_removed"] == r["n_bytes"] - len(r["kept"]) == sum(b - a for a, b in want[r["doc_id"]])
        assert r["kept_sha256"] == hashlib.sha256(bytes(r["kept"])).hexdigest()


def test_every_duplicate_chunk_is_cut(documents, spark):
    want = plain_dedup([(r["doc_id"], r["text"].encode()) for r in documents.collect()], 1)
    assert {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]]
            for r in chunking.dedup(documents).collect()} == want
    short = "A short text, twice."
    found = chunking.dedup(spark.createDataFrame([(1, short), (2, short), (3, short[:-1])], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {1: 0, 2: len(short), 3: 0}


def test_chunk_dedup_of_odd_rows(odd_documents, no_documents):
    found = sorted(chunking.dedup(odd_documents).collect(), key=lambda r: (r["doc_id"] or 99, r["n_bytes"]))
    assert len(found) == odd_documents.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[6]["n_removed"] == by_id[6]["n_bytes"] > 0 and by_id[4]["n_bytes"] == 0
    assert by_id[1]["n_removed"] == 0
    assert chunking.dedup(no_documents).count() == 0


def test_a_shared_passage_is_cut_once(spark):
    pick = random.Random(4)
    word = lambda: "".join(pick.choices("abcdefghijklmnop", k=pick.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(80)) for _ in range(40)]
    for i in range(0, 40, 4):
        at = pick.randint(0, len(texts[i]))
        texts[i] = texts[i][:at] + passage + texts[i][at:]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_removed"] for r in chunking.dedup(df).collect()}
    assert {d for d, n in found.items() if n} == set(range(4, 40, 4))
