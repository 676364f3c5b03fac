import random
import re
from collections import Counter

import pytest

from marketframe.llm import collocations as C

from .conftest import clashing

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, top=2000, least=30):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i : i + m]] = max(inside[lang, w[i : i + m]], a)
    out = {}
    for (lang, w), a in cand.items():
        if 100 * inside[lang, w] >= 80 * a:
            continue
        score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


def made(seed, texts=60):
    """Texts of a few words, some phrases and odd marks; one word stands in nearly half of all places."""
    rng = random.Random(seed)
    words = ["a"] * 40 + ["B", "é", "\U0001f600x", "c\x00d", "zz", "\x1cq", "the", "of", "İ", "e-f"] * 3 + [f"rare{i}" for i in range(300)]
    phrases = ["new york city hall", "a b a b", "The Of", "a a a a a", "éé éé"]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "\r\n", "!?"]
    rows = []
    for i in range(texts):
        text = "".join((rng.choice(phrases) if rng.random() < 0.2 else rng.choice(words)) + rng.choice(marks) for _ in range(rng.randrange(200)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "", "und"]), text))
    return rows


SCHEMA = "lang string, text string"


@pytest.mark.parametrize("settings", [C.Settings(), C.Settings(budget=200, chunk_chars=500, word_bits=1 << 16, pair_bits=1 << 16), C.Settings(budget=20, chunk_chars=3000, word_bits=1 << 15, pair_bits=1 << 15)])
def test_brute_force(spark, settings):
    """Also with groups so small that frequent words are extended, to two, three and four words."""
    rows = [*made(1), *made(2), (None, None), ("en", ""), ("en", " \t. "), ("xx", "one two"), *[("en", "said again and again")] * 40]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in C.collocations(clashing(df), settings=settings).collect())
    want = expected(rows)
    assert got == want and len({r[0] for r in want}) > 2


def test_given_documents(spark, documents):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text")
    want = expected([tuple(r) for r in df.collect()], top=50)
    assert sorted(tuple(r) for r in C.collocations(df, 50).collect()) == want and want


def test_top_and_ties(spark):
    """Equal scores and counts are ordered by the phrase's bytes, not by code units of its characters."""
    words = ["\U0001f600", "￰", "z", "é", "a"]
    rows = [("x", f"{w}1 {w}2") for w in words for _ in range(30)]
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), 4).orderBy("rank").collect()
    assert [r["phrase"] for r in got] == [f"{w}1 {w}2" for w in sorted(words, key=str.encode)[:4]]
    assert {r["score"] for r in got} == {1_000_000}


def test_large_counts(spark):
    """Products pass 64 bits."""
    big = 6 * 10**12
    phrases = spark.createDataFrame([("x", "a b", big), ("x", "a b c", big - 1)], "lang string, phrase string, n long")
    words = spark.createDataFrame([("x", w, 9 * 10**12) for w in "abc"], "lang string, word string, n long")
    got = {r["phrase"]: (r["score"], r["l"]) for r in C.scored(phrases.unionByName(spark.createDataFrame([("x", "b c", big)], phrases.schema)), words).collect()}
    assert got["a b"] == (2000000 * big // (18 * 10**12), 9 * 10**12)
    assert got["a b c"] == (2000000 * (big - 1) // (9 * 10**12 + big), 9 * 10**12)


def test_long_text(spark):
    """A text of one word, repeated."""
    (r,) = C.collocations(spark.createDataFrame([("x", "w " * 300_000)], SCHEMA)).collect()
    assert (r["phrase"], r["a"], r["n"]) == ("w w w w", 299_997, 300_000)


def test_empty(spark, empty):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.collocations(spark.createDataFrame([("a", "b c"), (None, None)], SCHEMA)).collect() == []
