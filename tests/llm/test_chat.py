import hashlib

from marketframe.llm import chat_format as C

from .conftest import clashing

ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "user", "there"), (1, 3, "assistant", "a <|im_end|> b"), (1, 4, "assistant", ""), (1, 5, "assistant", "<|im_next|>"),
    (2, 2, "assistant", None), (2, 1, "user", "<\\|x <\\\\| <| \\<|"), (3, 1, None, "no role"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, None, "odd\nrole%0A<|", "first"),
    (None, 1, "assistant", "no conversation \U0001f600"), (4, 1, "assistant", "x\n" * 20_000),
]


def expected():
    out = {}
    for conv in {r[0] for r in ROWS}:
        turns = sorted((r[1:] for r in ROWS if r[0] == conv), key=lambda r: (r[0] is not None, r[0], r[1] or "", r[2] or ""))
        turns = [(role or "", text or "") for _, role, text in turns]
        learned = "".join(t for role, t in turns if role == "assistant")
        lines = "".join(f"{role}\n{t}\n" for role, t in turns)
        out[conv] = (len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_reading_back(spark):
    df = clashing(spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: tuple(r)[1:5] for r in C.report(df).collect()}
    assert got == expected()


def test_neighbours_of_a_role_share_a_block(spark):
    df = spark.createDataFrame(ROWS[:6], "conv_id long, turn long, role string, text string")
    r = C.formatted(df).first()
    assert r["formatted"] == (
        "<|im_start|>system\nbe brief<|im_end|>\n<|im_start|>user\nhi<|im_next|>there<|im_end|>\n"
        "<|im_start|>assistant\na <\\|im_end|> b<|im_next|><|im_next|><\\|im_next|><|im_end|>\n"
    )
    assert [r["formatted"][s["start"] : s["end"]] for s in r["loss"]] == ["a <\\|im_end|> b", "", "<\\|im_next|>"]


def test_many_turns(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"text {i}") for i in range(1000)]
    r = C.report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)).first()
    learned = "".join(t for _, i, role, t in rows if role == "assistant")
    assert r["n_turns"] == 1000 and r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_empty_table(spark):
    assert C.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
