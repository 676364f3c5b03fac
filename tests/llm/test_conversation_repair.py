import hashlib
import itertools
import random
import re
import zlib

import pytest

from marketframe.llm import conversation_repair as R

from .conftest import clashing

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
GAP = ["", "u", "a", "uu", "ua", "au", "aa"]


def cheapest(rows):
    """Cost, audit and repaired rows by trying every edit of every row and up to two insertions in every gap."""
    best = None
    for choice in itertools.product("KuaD", repeat=len(rows)):
        cost = n = 0
        for c, (role, text, fault) in zip(choice, rows):
            cost += {"K": 0, "D": 2}.get(c, 1) + 5 * (fault == "t" and c != "D")
            n += fault in ("b", "d") and c != "D"
        if n:
            continue
        said = [{"K": role[:1] or "-", "D": ""}.get(c, c) for c, (role, _, _) in zip(choice, rows)]
        if best and cost > best[0]:
            continue
        for gaps in itertools.product(GAP, repeat=len(rows) + 1):
            whole = cost + 5 * sum(map(len, gaps))
            if best and whole > best[0]:
                continue
            initials = "".join(itertools.chain.from_iterable(zip(gaps, [*said, ""])))
            if not re.fullmatch("(s?(ua)+)?", initials):
                continue
            audit = lines = None
            audit, lines = "", []
            for g, c, row in itertools.zip_longest(gaps, choice, rows):
                audit += "I" * len(g) + ({"K": "K", "D": "D"}.get(c, "R") if c else "")
                lines += [{"u": "user:", "a": "assistant:"}[x] for x in g]
                if c and c != "D":
                    lines.append(f"{row[0] if c == 'K' else {'u': 'user', 'a': 'assistant'}[c]}:{row[1]}")
            if best is None or (whole, audit) < best[:2]:
                best = (whole, audit, "\n".join(lines))
    return best


def faults(rows):
    """(role, text, first fault) of (turn, role, text) rows in their order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1].encode(), r[2].encode()))
    out, seen = [], set()
    for _, role, text in rows:
        shown = text.rstrip(SPACE)
        fault = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def counted(rows):
    """What the operator returns for one conversation's rows, but cost and what follows."""
    turns = {r[0] for r in rows} - {None}
    f = faults(rows)
    initials = [r[0][:1] for r in f]
    bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(r[2] == k for r in f) for k in "bdt"), bad)


def expected(rows):
    cost, audit, text = cheapest(faults(rows)) if rows else (0, "", "")
    return (*counted(rows), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def made(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "ursa"]
    texts = ["Hi.", "What?", "cut off", " ", "", "Ends! \n", "Hi. ", "x"]
    return [(rng.choice([None, 0, 1, 2, 3, 7]), rng.choices(roles, [5, 5, 2, 1, 1, 1])[0], rng.choices(texts, [6, 3, 2, 1, 1, 2, 1, 1])[0]) for _ in range(n)]


CONVERSATIONS = {k: made(k, k % 4) for k in range(120)}


def result(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("block_rows", [50_000, 40, 3])
def test_brute_force(spark, block_rows):
    """Also with so small blocks that most conversations are cut."""
    rows = [(k, *r) for k, rs in CONVERSATIONS.items() for r in rs]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(R.repaired(clashing(df), block_rows))
    assert got == {k: expected(rs) for k, rs in CONVERSATIONS.items() if rs}


def replay(rows, audit):
    """Cost and rows that an audit gives, told by the roles that the pattern asks for."""
    n = sum(x != "D" for x in audit)
    roles = ["s"] * (n % 2) + ["u", "a"] * (n // 2)
    cost, out, i = 0, [], 0
    for x in audit:
        want = roles[len(out)] if x != "D" else ""
        name = {"u": "user", "a": "assistant", "s": "system"}.get(want)
        if x == "I":
            cost, out = cost + 5, [*out, f"{name}:"]
            continue
        role, text, fault = rows[i]
        i += 1
        cost += {"K": 0, "R": 1, "D": 2}[x] + 5 * (fault == "t" and x != "D")
        assert x == "D" or fault not in ("b", "d")
        if x == "K":
            assert role[:1] == want
            out.append(f"{role}:{text}")
        elif x == "R":
            assert want != "s"
            out.append(f"{name}:{text}")
    assert i == len(rows) and len(out) == n
    return cost, "\n".join(out)


def test_a_conversation_of_many_blocks(spark):
    """One conversation holds nearly all rows: cut into blocks it is repaired as in one."""
    rng = random.Random(5)
    hot = [(i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Text {i}.", f"Text {i}", "Again.", ""])) for i in range(3000)]
    df = spark.createDataFrame([(1, *r) for r in hot] + [(2, 0, "user", "Hi."), (None, 0, "assistant", "Ho.")], SCHEMA).repartition(5)
    whole, cut = result(R.repaired(df)), result(R.repaired(df, 200))
    assert whole == cut and set(cut) == {1, 2, None}
    rows = faults(hot)
    cost, text = replay(rows, cut[1][6])
    assert cut[1][:5] == counted(hot) and cut[1][5] == cost and cut[1][7] == hashlib.sha256(text.encode()).hexdigest()


def test_equal_rows(spark):
    """Repeated rows are parted over blocks; all but the first are duplicates."""
    df = spark.createDataFrame([(1, 5, "user", "Hi.")] * 500 + [(1, 6, "assistant", "Ho.")], SCHEMA)
    for size in (50_000, 30):
        (r,) = R.repaired(df, size).collect()
        assert (r["duplicate"], r["cost"], r["audit"]) == (499, 998, "K" + "D" * 499 + "K")


def harm(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code:
            role = "user" if code == 4 else role
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def test_damage_and_report(spark, values):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(60)]), *r) for r in made(9, 90)]
    rows += [(100 + i, None, None, None) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    left = harm(rows)
    assert values(R.damaged(df)) == sorted(left, key=lambda r: tuple((v is not None, str(v)) for v in r))
    got = result(R.report(clashing(df)))
    want = {k: [r[1:] for r in left if r[0] == k] for k in {r[0] for r in rows}}
    assert any(not v for v in want.values()) and set(got) == set(want)
    assert got == {k: (expected(v) if len(v) < 4 else (*counted(v), *got[k][5:])) for k, v in want.items()}


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "x " * 500_000 + "."), (1, 1, "assistant", " " * 500_000 + "y.")], SCHEMA)
    (r,) = R.repaired(df).collect()
    assert (r["cost"], r["audit"]) == (0, "KK")
    assert R.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tables(spark):
    """The given conversations: every audit is replayed; cut into small blocks the results are the same."""
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = result(R.report(df))
    assert got == result(R.report(df, 16))
    left = harm([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    for k, r in got.items():
        rows = [x[1:] for x in left if x[0] == k]
        cost, text = replay(faults(rows), r[6])
        assert r == (*counted(rows), cost, r[6], hashlib.sha256(text.encode()).hexdigest())
