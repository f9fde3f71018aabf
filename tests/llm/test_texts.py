import datetime
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from curbline.llm import language, pseudonyms

KEY = b"a key"


def test_permutation_is_one_without_fixed_points():
    for size in (2, 3, 10, 97, 1000):
        p = pseudonyms.Permutation(KEY, "t", size)
        made = [p.step(x) for x in range(size)]
        assert sorted(made) == list(range(size))
        assert all(p.step(y, True) == x != y for x, y in enumerate(made))
    assert [pseudonyms.Permutation(b"other", "t", 1000).step(x) for x in range(9)] != [
        pseudonyms.Permutation(KEY, "t", 1000).step(x) for x in range(9)]


def card(pick):
    body = "4" + "".join(pick.choices("0123456789", k=14))
    return body + pseudonyms.luhn_digit(body)


def test_formats_stay_valid_and_come_back():
    pick = random.Random(6)
    there, back = pseudonyms.Pseudonyms(KEY), pseudonyms.Pseudonyms(KEY, back=True)
    values = {
        "card": [card(pick), "4111-1111-1111-1111", "4111 1111 1111 1111"],
        "ip": ["55.63.178.142", "0.0.0.0", "255.255.255.255"],
        "date": ["2024-02-29", "31.12.1999", "05/06/2001", "12/25/2020"],
        "ssn": ["078-05-1120", "665-01-0001", "667-99-9999", "899-12-3456", "001-01-0001"],
        "phone": ["+1 (988) 555-2485", "(212) 555-0100", "+49 30 1234567", "212-555-0100"],
        "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
        "email": ["rhokk.73@mail2.example.com", "A.b-c@x.org"],
    }
    for kind, some in values.items():
        for value in some:
            text = f"See {value}, or not."
            made, spans = there.replace(text)
            size = len(value.split("@")[0])  # the domain of an address stays
            assert spans == [(kind, 4, size)], (value, spans)
            new = made[4:-9]
            assert new != value and (kind == "ip" or len(new) == len(value))
            assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", new.split("@")[0] if kind != "ip" else ""))) == (
                re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", value.split("@")[0] if kind != "ip" else ""))))
            assert there.replace(new)[1] == [(kind, 0, len(new.split("@")[0]))]
            assert back.replace(made)[0] == text
    for n in range(200):
        value = datetime.date.fromordinal(700_000 + 37 * n).strftime("%m/%d/%Y")
        assert back.replace(there.replace(value)[0])[0] == value


def test_iban_before_capitals():
    made, spans = pseudonyms.Pseudonyms(KEY).replace("GB82 WEST 1234 5698 7654 32 IS MINE")
    assert spans == [("iban", 0, 27)] and made.endswith(" IS MINE")


def test_invalid_values_stay():
    own = pseudonyms.Pseudonyms(KEY)
    text = ("4111111111111112 256.1.1.1 2023-02-29 31/31/2020 000-12-3456 DE00370400440532013000 1.2.3.4.5 "
            "97ffa88d7c5f5655e365004e29bd123cdabd722a a@b @x.org 12345 1.5 3/4 x4111111111111111")
    assert own.replace(text) == (text, [])


def test_values_behind_candidates_are_found():
    own = pseudonyms.Pseudonyms(KEY)
    for text, want in {
        "DE89370400440532013000 SSN 123-45-6789": [("iban", 0, 22), ("ssn", 27, 11)],
        "AB12 4111 1111 1111 1111": [("card", 5, 19)],
        "2024 4111 1111 1111 1111": [("card", 5, 19)],
        "at 2024-03-01T12:00:00Z, 2024-03-02Tx": [("date", 3, 10)],
        "+1 988 555 2485 4111 1111 1111 1111": [("phone", 0, 15), ("card", 16, 19)],
        "4111 1111 1111 1111.john@x.org": [("card", 0, 19), ("email", 19, 5)],
        "XX00 XX00XX00XX00XX 10.0.0.1 a@b.org": [("ip", 20, 8), ("email", 29, 1)],
        "212-555-0100.ann@x.org": [("email", 0, 16)],
    }.items():
        made, spans = own.replace(text)
        assert spans == want, text
        for _, start, length in spans:
            assert text[start:start + length] not in made


def test_equal_values_are_linked_across_forms():
    own = pseudonyms.Pseudonyms(KEY)
    plain, dashed = own.replace("4111111111111111")[0], own.replace("4111-1111-1111-1111")[0]
    assert dashed.replace("-", "") == plain
    iso, dotted = own.replace("2001-02-03")[0], own.replace("03.02.2001")[0]
    assert dotted == ".".join(reversed(iso.split("-")))


def test_documents(documents, odd_documents, no_documents):
    made = pseudonyms.pseudonymise(documents, KEY, "spans")
    again = pseudonyms.pseudonymise(made.select(*documents.columns), KEY, back=True)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in documents.collect()}
    found = made.where(F.size("spans") > 0).collect()
    old = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(found) > 20
    for r in found:
        for kind, start, length in r["spans"]:
            value = old[r["doc_id"]][start:start + length]
            assert value not in r["text"], (kind, value)
    odd = pseudonyms.pseudonymise(odd_documents, KEY)
    assert odd.columns == odd_documents.columns
    assert sorted(map(str, odd.collect())) == sorted(map(str, odd_documents.collect()))
    assert pseudonyms.pseudonymise(no_documents, KEY).count() == 0


def test_gradient_matches_differences():
    """Backpropagation through time against finite differences in double precision."""
    net = language.new_network(["a", "b"], hidden=3)
    weights = [w.astype(np.float64) for w in net.forward]
    data = np.random.default_rng(1).integers(0, 5, (6, 4)).astype(np.intp)
    target = np.random.default_rng(2).standard_normal((6, 3, 4))
    kept: list = []
    states = language._read(weights, data, kept)
    grads = language._gradient(weights, data, states, kept, target)
    for w, g in zip(weights, grads, strict=True):
        for at in [(0, 1), (2, 0), (4, 2)]:
            old, step = w[at], 1e-5
            w[at] = old + step
            up = (language._read(weights, data)[1:] * target).sum()
            w[at] = old - step
            down = (language._read(weights, data)[1:] * target).sum()
            w[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 1e-4 * max(1, abs(g[at]))


def test_windows_and_padding_do_not_change_a_text():
    net = language.new_network(["a", "b", "c"])
    texts = [b"x", b"ab" * 48, b"ab" * 48 + b"c", b"", b"q" * 1000]
    together, votes = language.label_bytes(net, texts)
    for text, row in zip(texts, together, strict=True):
        assert np.allclose(language.label_bytes(net, [text])[0][0], row, atol=1e-5)
    assert np.allclose(together.sum(1), [1, 1, 1, 0, 1], atol=1e-4) and np.allclose(votes.sum(1), together.sum(1), atol=1e-2)


def test_held_out_accuracy(documents, odd_documents, no_documents):
    held = language.held_out(F.col("doc_id"))
    net = language.fit(documents.where(~held), steps=120)
    rows = language.predict(documents.withColumn("held", held), net).collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r["held"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = language.predict(odd_documents, net, "pred", "pred_score").collect()
    assert {r["doc_id"] for r in odd if r["pred"] == "und"} == {None, 3, 4, 7}
    assert all((r["pred_score"] == 0) == (r["pred"] == "und") for r in odd)
    assert language.fit(no_documents) is None
    assert {r["pred"] for r in language.predict(odd_documents, None, "pred").collect()} == {"und"}
    assert language.accepted(no_documents).count() == 0


def test_documents_stay_where_no_language_can_be_learned(odd_documents):
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    kept = language.accepted(unlabelled)
    assert kept.columns == odd_documents.columns
    want = [r for r in odd_documents.collect() if language.has_letter(r["text"])]
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted(r["text"] for r in want)
