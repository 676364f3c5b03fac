import hashlib
import random

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from marketframe.llm.bpe import Automaton, Encoder, encoded

from .conftest import clashing

FILE = path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return t


def test_texts_as_the_library(documents, rows, reference):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoded(clashing(documents), FILE).collect())
    want = []
    for i, text in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), reference.decode(ids, skip_special_tokens=False))]
        want.append((str(i), len(ids), *digests))
    assert got == sorted(want)


def test_random_texts_and_round_trip(reference):
    rng, encoder = random.Random(3), Encoder(FILE, keep=50)
    letters = "abcdeTHE  \n\t\x1c　 'sretvll.,!é漢字\U0001f6000123456789-_$$$<|endoftext|>\r\x00"
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        ids, line = encoder.encode(text)
        assert list(ids) == reference.encode(text, add_special_tokens=False).ids
        assert line == ",".join(map(str, ids)) and encoder.automaton.decode(ids) == text


def test_arcs_are_those_of_the_states():
    a, rng = Automaton(FILE), random.Random(5)
    tokens = list(a.target)
    common = tokens[:300]
    for _ in range(20_000):
        before, token = rng.choice(common), rng.choice(common if rng.random() < 0.5 else tokens)
        assert a.has_arc(before, token) == a._state_has_arc(a.target[before], token)


def test_ids_column_and_empty_table(spark, empty, reference):
    df = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in encoded(df, FILE, with_ids=True).collect()}
    assert got == {1: (reference.encode("Hello there").ids, "Hello there"), 2: ([], "")}
    assert encoded(empty, FILE).count() == 0
