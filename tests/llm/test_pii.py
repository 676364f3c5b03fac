import hashlib
import re

import pytest
from pyspark.sql import functions as F

from marketframe.llm import pii

from .conftest import clashing

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRICKY = [
    "a@b.c_d@e.f x..y@z.w. @a.b a@b a@b.c..d a@-.- %@x.y.z",
    "1.2.3.4.5.6.7.8 256.1.1.1 007.0255.1.1 1.2.3 1.2.3.4.5 0001.1.1.300",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 4111111111111112 4111 1111 1111 1111 2 4-1",
    "+1 (212) 555-0100 +12 +1(2)3 +49-30-1234567. ++1 222 333 4444 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "\U0001f600 éé me@x.org \U0001f600 10.0.0.1",
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 and GB82 WEST 1234 5698 7654 33",
    "call (212) 555-0100 now, or 212-555-0101; tel 212 555 0102",
    "5@5.5 5.5.5.5@5.5",
    "a@b" + ".c" * 30_000 + " " + "1 " * 30_000 + "9" * 40_000 + "." * 100,
    "",
    None,
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_brute_force(spark, documents, rows):
    every = rows + [(20_000 + i, t) for i, t in enumerate(TRICKY)]
    df = documents.unionByName(spark.createDataFrame(every[len(rows) :], "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["base_sha256"]) for r in pii.report(clashing(df)).collect())
    assert got == sorted((str(i), hashlib.sha256(base(t).encode()).hexdigest()) for i, t in every)


def test_added_spans(spark):
    df = spark.createDataFrame(enumerate(TRICKY), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    found = [TRICKY[5][slice(*map(int, s.split(":")[1:]))] for s in got[5]["spans"].split(",") if s.startswith("iban")]
    assert found == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    assert got[6]["n_tel"] == 2 or got[6]["n_tel"] == 3
    assert "tel:5:19" in got[6]["spans"]
    far = spark.createDataFrame([(1, "see (212) 555-0100 there")], "doc_id long, text string")
    assert pii.report(far).first()["n_tel"] == 0


def test_context_changes_scores(spark):
    df = spark.createDataFrame([(1, "mail a@b.c"), (2, "from a@b.c")], "doc_id long, text string")
    scores = [r["pii"][0]["score"] for r in pii.with_spans(df).orderBy("doc_id").collect()]
    assert scores[0] > scores[1]


@pytest.mark.parametrize(
    "text, want",
    [("a@b.c and 1.2.3.4.", "<EMAIL> and <IP>."), ("5.5.5.5@5.5", "<EMAIL>"), ("nothing", "nothing"), (None, None), ("", "")],
)
def test_redaction(spark, text, want):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.with_spans(df).select(pii.redacted(F.col("text"), F.col("pii"))).first()[0] == want


def test_empty_table(empty):
    assert pii.report(empty).count() == 0
