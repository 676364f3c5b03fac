"""Personal data as spans, in Spark expressions only.

Regular expressions propose spans, checksums (Luhn, mod 97) and number ranges confirm them, and words
in front of a span adjust its score. The patterns loop over single characters only, so their time is
linear in the text and long runs don't exhaust the regular expression engine's stack.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, starts

# What the result's contract says a span of each kind is.
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)             parts at most 255
#   card   [0-9]([\x20-]?[0-9])+                            13 to 19 digits, Luhn
#   phone  \+[0-9][\x20().0-9-]+[0-9]                       9 to 15 digits
# The patterns below find the same spans: a match starts where its run of characters does or where the
# match before ended (\G), and a domain ends where no further character or dotted label follows.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
    r"[A-Za-z0-9-][A-Za-z0-9.-]*?(?![A-Za-z0-9-]|\.[A-Za-z0-9-])"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Separators that stand between two digits stay, all else becomes a line end: cards are runs of what is left.
NOT_CARD = r"[^0-9\x20-]|[\x20-](?![0-9])|(?<![0-9])[\x20-]"
CARD = r"[0-9][0-9\x20-]+"
CARD_LIKE = r"[0-9](?:[\x20-]?[0-9]){12}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

#: Characters in front of a span that are searched for context words.
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    """How one kind of span is found.

    ``may(text)`` is a cheap test that a text can hold one, ``prepared(text)`` what the pattern runs on
    (as many code points as the text), ``valid(match)`` the confirmation. A span scores ``score``, plus
    ``boost`` if a context word stands in front of it, and is kept from ``least`` on.
    """

    name: str
    pattern: str
    may: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    context: str
    score: float
    boost: float = 0.2
    least: float = 0.0
    prepared: Callable[[Column], Column] = lambda text: text


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def digit_count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.length(digits(match)).between(low, high)


def ip_parts(match: Column) -> Column:
    """Every part at most 255; leading zeros don't count."""

    def small(part: Column) -> Column:
        return let(F.regexp_replace(part, "^0+", ""), lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))

    return F.forall(F.split(match, r"\."), small)


def luhn(match: Column) -> Column:
    """The Luhn sum over the digits of a match is a multiple of 10."""

    def total(d: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            v = F.when((F.size(d) - i) % 2 == 0, x.cast("int") * 2).otherwise(x.cast("int"))
            return F.when(v > 9, v - 9).otherwise(v)

        return F.aggregate(F.transform(d, value), F.lit(0), lambda a, x: a + x)

    return let(F.split(digits(match), ""), lambda d: let(F.filter(d, lambda x: x != ""), lambda e: total(e) % 10 == 0))


def card_number(match: Column) -> Column:
    return digit_count(13, 19)(match) & luhn(match)


def mod97(match: Column) -> Column:
    """An IBAN's checksum: its first four characters moved to the end, letters as 10 to 35, leaves 1 modulo 97."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, x: Column) -> Column:
        code = F.ascii(x)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.length(plain).between(15, 34) & (
        F.aggregate(F.filter(F.split(moved, ""), lambda x: x != ""), F.lit(0), step) == 1
    )


def kinds() -> list[Kind]:
    """Kinds in the order of the results: the four of the contract, then those that the method adds."""
    return [
        Kind("email", EMAIL, lambda t: t.contains("@"), lambda m: F.lit(True), "mail|contact|write|reply", 0.8),
        Kind("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), ip_parts, "ip|address|host|server|login", 0.6),
        Kind("card", CARD, lambda t: t.rlike(CARD_LIKE), card_number, "card|credit|debit|visa|payment", 0.7, prepared=lambda t: F.regexp_replace(t, NOT_CARD, "\n")),
        Kind("phone", PHONE, lambda t: t.contains("+"), digit_count(9, 15), "tel|phone|call|mobile|fax", 0.7),
        Kind("iban", IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), mod97, "iban|account|bank|transfer", 0.8),
        Kind("tel", LOCAL_PHONE, lambda t: t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), lambda m: F.lit(True), "tel|phone|call|mobile|fax", 0.3, 0.4, 0.6),
    ]


SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def spans_of(kind: Kind, text: Column) -> Column:
    """Spans of one kind in a text, by start: kind, start, end (code points, end exclusive) and score."""

    def found(run: Column, whole: Column) -> Column:
        def spans(matches: Column) -> Column:
            gaps = F.split(run, kind.pattern, -1)
            sizes = F.zip_with(
                F.slice(gaps, F.lit(1), F.size(matches)),
                matches,
                lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")),
            )
            every = F.zip_with(matches, starts(sizes), lambda m, s: F.struct(m.alias("match"), s.alias("start")))
            confirmed = F.filter(every, lambda x: kind.valid(x["match"]))

            def scored(x: Column) -> Column:
                start = x["start"]
                near = F.substr(whole, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS)))
                score = kind.score + F.when(near.rlike(rf"(?i)\b(?:{kind.context})"), kind.boost).otherwise(0.0)
                return F.struct(
                    F.lit(kind.name).alias("kind"),
                    start.alias("start"),
                    (start + F.length(x["match"])).alias("end"),
                    score.alias("score"),
                )

            scored_spans = F.transform(confirmed, scored)
            if kind.least > kind.score:
                scored_spans = F.filter(scored_spans, lambda x: x["score"] >= kind.least)
            return F.when(F.size(matches) > 0, scored_spans).otherwise(F.array()).cast(SPAN)

        return let(F.regexp_extract_all(run, F.lit(kind.pattern), F.lit(0)), spans)

    return F.when(
        kind.may(text), let(F.struct(kind.prepared(text).alias("r"), text.alias("t")), lambda x: found(x["r"], x["t"]))
    ).otherwise(F.array().cast(SPAN))


def with_spans(df: DataFrame, text: str = "text", out: str = "pii", of: list[Kind] | None = None) -> DataFrame:
    """``df`` with an array of confirmed spans, by kind and start, in ``out`` (a column of that name is replaced).

    A NULL or empty text has none. Spans of one kind don't overlap; a span that the method adds to the
    contract's four kinds is left out where it overlaps one of those. Repeated rows get equal spans, and
    an empty table stays empty.
    """
    of = of or kinds()
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    frame = df
    for k in of:
        frame = frame.withColumn(f"__pii_{k.name}", spans_of(k, whole))
    base = [f"__pii_{k.name}" for k in of if k.name in ("email", "ip", "card", "phone")]
    added = [f"__pii_{k.name}" for k in of if k.name not in ("email", "ip", "card", "phone")]
    first = F.concat(*base) if base else F.array().cast(SPAN)

    def free(b: Column) -> Column:
        extra = F.concat(*added) if added else F.array().cast(SPAN)
        return F.concat(b, F.filter(extra, lambda x: ~F.exists(b, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))))

    return frame.withColumn(out, let(first, free)).drop(*base, *added)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first and longest."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), s["kind"].alias("kind"))))
    none = F.array().cast("array<struct<start:int,back:int,end:int,kind:string>>")

    def joined(merged: Column, s: Column) -> Column:
        last = F.get(merged, F.size(merged) - 1)
        apart = F.concat(merged, F.array(s))
        grown = F.concat(
            F.slice(merged, F.lit(1), F.size(merged) - 1),
            F.array(F.struct(last["start"].alias("start"), last["back"].alias("back"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))),
        )
        return F.when((F.size(merged) > 0) & (last["end"] > s["start"]), grown).otherwise(apart)

    def rebuilt(m: Column) -> Column:
        parts = F.transform(
            m,
            lambda s, i: let(
                F.when(i > 0, F.get(m, F.greatest(i - 1, F.lit(0)))["end"]).otherwise(0),
                lambda e: F.concat(F.substr(text, e + 1, s["start"] - e), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
            ),
        )
        return F.concat(F.array_join(parts, ""), F.substr(text, F.get(m, F.size(m) - 1)["end"] + 1))

    return F.when(F.size(spans) > 0, let(F.aggregate(by_start, none, joined), rebuilt)).otherwise(text)


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: spans by kind, their digests and the spans themselves; other columns are left out."""
    frame = with_spans(df.select(F.col(key).alias("doc_id"), F.col(text).alias("__text")), "__text", "pii").drop("__text")

    def count(name: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("pii", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    return frame.select(
        "doc_id",
        *(count(n) for n in ("email", "ip", "card", "phone", "iban", "tel")),
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line(F.col("pii")).alias("spans"),
    )
