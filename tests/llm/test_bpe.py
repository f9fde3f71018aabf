import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from curbline.llm import bpe, common, packing, queries, words

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def texts():
    pick = random.Random(1)
    alphabet = ["a", "e", "th", "er", " ", "  ", "\n", "'s", "'", "1", "23", ".", "é", "ß", "漢", "😀", " ", "-"]
    made = ["".join(pick.choices(alphabet, k=pick.randint(0, 60))) for _ in range(1500)]
    return made + ["a" * 3001, "ab" * 900 + "a", "xyz" * 777, "漢字" * 300, " " * 99, "0" * 1000, "\n \n" * 40,
                   "<|endoftext|> is text", "e" * 5 + "aaaa" * 200 + "th" * 100]


def test_tree_matches_library(library):
    coder = bpe.TreeBpe(bpe.read_ranks(PATH), PATTERN, remember=500)
    for text in texts():
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_merging_and_joining_agree():
    coder = bpe.TreeBpe(bpe.read_ranks(PATH), PATTERN)
    pick = random.Random(2)
    for _ in range(400):
        data = bytes(pick.choices(b"abeinrst hE\xc3\xa9\xe6\xbc", k=pick.randint(2, 90)))
        cut = pick.randint(1, len(data) - 1)
        assert coder.join(coder.tree(data[:cut]), coder.tree(data[cut:])) == coder.merged(data) == coder.tree(data)


def test_parts_are_independent(library):
    for text in texts():
        first, *rest = words.parts(text)
        ids = library.encode_ordinary(first)
        for part in rest:
            ids += library.encode_ordinary(" " + part)
        assert ids == library.encode_ordinary(text)


def test_part_cache_stays_bounded():
    cache = words.PartCache(lambda parts: [p.upper() for p in parts], limit=200)
    for i in range(300):
        head, rest = cache.values(f"a b{i} c{i % 3}")
        assert [head, *rest] == ["A", f" B{i}", f" C{i % 3}"]
        assert cache.held <= 200


def encoded(df):
    return bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)


def test_documents_round_trip(documents, odd_documents, no_documents, library):
    for df in (documents, odd_documents):
        want = sorted((r["doc_id"] or -1, r["text"] or "") for r in df.collect())
        got = sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode(), tuple(r["ids"])) for r in encoded(df).collect())
        assert [g[:2] for g in got] == want
        assert all(library.encode_ordinary(text) == list(ids) for _, text, ids in got)
    assert encoded(no_documents).count() == 0


def packed(df, length):
    rows = packing.pack(df, JSON, length).collect()
    return sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))


@pytest.mark.parametrize("length", [1024, 7])
def test_packing_places_every_token_once(documents, odd_documents, length):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    df = documents.repartition(5) if length == 1024 else odd_documents.where("doc_id is null or doc_id not in (5, 6)")
    rows = packed(df, length)
    at = 0
    for r in rows:
        assert (r["sequence_id"], r["offset"]) == divmod(at, length)
        assert r["offset"] + r["length"] <= length and r["length"] > 0
        assert r["continues"] == (r["start"] > 0) and r["continued"] == (r["start"] + r["length"] < r["doc_tokens"])
        at += r["length"]
    whole = []
    for r in rows:
        if not r["continues"]:
            whole.append((r["doc_id"] or -1, []))
        assert whole[-1][0] == (r["doc_id"] or -1) and len(whole[-1][1]) == r["start"]
        whole[-1][1].extend(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    want = [(r["doc_id"] or -1, [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0])
            for r in df.collect()]
    assert sorted(whole) == sorted(want)


def test_own_ranks_give_the_ids_of_the_library():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    encode, kind = packing.encoder(JSON)
    assert kind == "<u2" and packing.ranks_of(JSON) is not None
    for text in texts():
        assert np.frombuffer(encode(text), kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_a_text_have_the_ids_of_the_library(spark):
    tokenizer = Tokenizer.from_file(JSON)
    some = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  \n", "<|endoftext|", " \n <|endoftext|> 's",
            *texts()]
    rows = packed(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), 1 << 20)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in rows}
    assert 50256 in got[0]
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(some)}


def test_other_tokenizer_files_use_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.ranks_of(path) is None
    encode, kind = packing.encoder(path)
    assert np.frombuffer(encode("Some words here"), kind).tolist() == Tokenizer.from_file(path).encode(
        "Some words here", add_special_tokens=False).ids


def test_packing_nothing(no_documents):
    assert packing.pack(no_documents, JSON).count() == 0


def test_full_sequences(documents):
    pieces = packing.pack(documents, JSON)
    made = packing.sequences(pieces, pad=9).orderBy("sequence_id").collect()
    total = pieces.groupBy().sum("length").first()[0]
    assert [r["n_tokens"] for r in made[:-1]] == [1024] * (len(made) - 1) and sum(r["n_tokens"] for r in made) == total
    assert all(len(r["ids"]) == 4096 for r in made)
    tail = np.frombuffer(bytes(made[-1]["ids"]), "<u4")
    assert (tail[made[-1]["n_tokens"]:] == 9).all()


def test_round_trip_runs_in_small_batches(spark, documents, tmp_path, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "written", lambda df, label: seen.append(spark.conf.get(name)) or common.written(df, label))
    before = spark.conf.get(name)
    assert queries.op3_bpe_round_trip(spark, str(tmp_path)).count() == documents.count()
    assert seen == [str(bpe.ROWS)] and spark.conf.get(name) == before
