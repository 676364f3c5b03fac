import re

import pytest
from pyspark.sql import functions as F

from marketframe.llm import quality_rules as Q

from .conftest import clashing

WORD = r"[^\x20\x09-\x0D]+"


def expected(text):
    w = re.findall(WORD, text or "")
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_measures_match_brute_force(documents, rows):
    got = Q.measures(clashing(documents)).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in got) == sorted((str(i), *expected(t)) for i, t in rows)
    assert all(not r["kept"] for r in got if r["base_failed"])


@pytest.mark.parametrize("text", ["a a a a", "a b c a b c a", "x y z", "x y", "", None, "a b a b a b", "p q r s p q r t q r s"])
def test_repeated_windows(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert Q.measures(df).first()["n_repeat_words"] == expected(text)[4]


def test_rules_reject_what_they_name(spark):
    good = " ".join(f"word{i}" for i in range(60))
    texts = {
        "few_words": "too short",
        "symbols": " ".join(f"w{i}##" for i in range(60)),
        "capitals": good.upper(),
        "dup_lines": "\n".join([" ".join(f"w{i}" for i in range(30))] * 1 + ["again"] * 9 + [good]),
        "word_size": " ".join("y" * 30 + str(i) for i in range(60)),
        "repeat_words": "one two three four " * 30,
        None: good,
    }
    df = spark.createDataFrame([(str(k), t) for k, t in texts.items()], "name string, text string")
    for name, text in texts.items():
        rule = [r for r in Q.rules() if r.name == name] or Q.rules()
        verdicts = {r["name"]: r["failed_rule"] for r in Q.with_verdict(df, of=rule).collect()}
        assert verdicts[str(name)] == name
    assert [r["name"] for r in Q.kept(df).collect()] == ["None"]


def test_order_is_by_rejection_per_cost_and_changes_no_verdict(documents):
    ordered = Q.order_rules(documents)
    rates = [share / cost if cost else 0 for _, share, cost in ordered]
    assert rates == sorted(rates, reverse=True)
    names = [r.name for r, _, _ in ordered]
    ways = [Q.cascade([r for r, _, _ in x], F.col("text"), Q.words(F.col("text"))).isNull() for x in (ordered, ordered[::-1])]
    assert documents.where(ways[0] != ways[1]).count() == 0 and set(names) == {r.name for r in Q.rules()}


def test_empty_table(empty):
    assert Q.measures(empty).count() == 0 and Q.kept(empty).columns == empty.columns
