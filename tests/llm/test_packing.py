import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from marketframe.llm import packing

from .conftest import clashing

FILE = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_and_places(documents, rows, reference):
    got = packing.packed(clashing(documents), FILE).collect()
    want = []
    for i, text in rows:
        ids = np.array(reference(text), "<u4")
        for p, at in enumerate(range(0, len(ids), 2048)):
            want.append((str(i), p, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    check(got, 2048)
    assert len({r["sequence_id"] for r in got}) <= -(-sum(r["length"] for r in got) // 2048) + 1


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_fullest_is_the_best_subset():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        room = rng.randint(0, 60)
        chosen = packing.fullest(Counter(sizes), room)
        best = max(sum(c) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k) if sum(c) <= room)
        assert sum(chosen) == best and not Counter(chosen) - Counter(sizes)


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    for _ in range(20):
        counts = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(rng.randint(0, 60))}
        used = Counter()
        for fill in packing.plan(counts, 100):
            assert sum(fill.lengths) <= 100
            used.update({x: n * fill.times for x, n in Counter(fill.lengths).items()})
        assert used == Counter(counts)


def test_hot_length_is_ranked_in_parts(spark):
    df = spark.range(5000).selectExpr("id doc_id", "0 piece", "0L start", "if(id % 10 < 9, 7L, id % 100 + 1) length", "id ids_crc32")
    got, counts = packing.ranked(df, rows=100)
    seen = defaultdict(list)
    for r in got.collect():
        seen[r["length"]].append(r["rank"])
    assert {k: sorted(v) == list(range(counts[k])) for k, v in seen.items()} == dict.fromkeys(counts, True)


def test_random_texts_as_the_library(reference):
    rng, tokens = random.Random(6), packing.Tokens(FILE, keep=50)
    letters = "abcdeTHEΣσḋ  \n\t\x1c　 'sretvll.,!é漢字\U0001f6000123456789-_²½<|endoftext|>"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert tokens.ids(text) == np.array(reference(text)[:-1], "<u4").tobytes()


@pytest.mark.parametrize("letters", [True, False])
def test_words_of_each_letter_as_the_library(reference, letters):
    """All characters up to U+024F, and some that fall apart, in words with marks; also without the short way for Latin letters."""
    tokens = packing.Tokens(FILE, keep=500)
    if not letters:
        tokens.letters = None
    texts = [f"{c} x{c} {c}Y x{c}y. {c}{c},,! {c}1 a.{c} don't{c}s {c}</w> A{c}{'|' * 12} {'Zz' * 31}{c} {'é' * 70}{c}" for c in [*map(chr, range(0x250)), *"\u0958\ufb1d\uac01"]]
    for text, got in zip(texts, tokens.ids_of(texts), strict=True):
        assert got == np.array(reference(text)[:-1], "<u4").tobytes()


def test_latin_words_are_encoded_without_end_tokens(reference, monkeypatch):
    """New words of Latin letters cost a space each: only their marks go the long way, and only once."""
    rng, given = random.Random(8), []
    words = ["".join(rng.choice("abcdéßTHE") for _ in range(9)) + rng.choice(["", ".", "***"]) for _ in range(3000)]
    texts = [" ".join(words[at : at + 100]) for at in range(0, 3000, 100)]
    tokens = packing.Tokens(FILE)
    encode = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda text: given.append(len(text)) or encode(text))
    assert [tokens.ids(t) for t in texts] == [np.array(reference(t)[:-1], "<u4").tobytes() for t in texts]
    assert sum(given) < 100


def test_few_words_and_rows_are_held(spark, documents, monkeypatch):
    """A process keeps up to 400,000 words and as many parts, and gets 1,000 rows at once; afterwards the session is as before."""
    tokens = packing.Tokens(FILE)
    for at in range(0, 900_000, 50_000):
        tokens.ids(" ".join(f"w{i:x}." for i in range(at, at + 50_000)))
    assert len(tokens.words) + len(tokens.older) <= 400_000 and len(tokens.parts) <= 450_000 + 1
    name, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], packing.written
    monkeypatch.setattr(packing, "written", lambda *a: seen.append(spark.conf.get(name)) or write(*a))
    before = spark.conf.get(name)
    assert packing.packed(documents, FILE).count() and seen == ["1000"] and spark.conf.get(name) == before


def test_empty_table(empty):
    assert packing.packed(empty, FILE).count() == 0
