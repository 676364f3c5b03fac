"""Cheapest repair of conversations, found as a lightest derivation.

A repaired conversation reads ``(s?(ua)+)?`` in its rows' role initials. Item (i, q) says: from row i on,
with the pattern in state q, the rest can be repaired. Every edit is a deduction: from an item, its cost
and its audit to the item before it, at a higher cost and with the edit's initial in front. Knuth's
agenda pops items by weight, so each is final when it is popped, and stops at the goal, item (0, 0).

A weight is (cost, rows covered, audit). Keeping a row costs nothing, so the cost alone would let an item
be popped before an equally cheap one behind it; the rows covered, equal for all derivations of one item,
make every deduction strictly superior, and putting a letter in front keeps the order of audits.
An item and a letter determine what follows, so ties of an item are settled by the first letter alone:
items keep one cost and one letter, not whole audits.

Long conversations are cut into blocks of rows. A block's cheapest derivations between each two states
are found independently and composed, so no task needs the rows of a whole conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, small_side, written

# What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. The pattern may end in the first and the last.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
BACK = {to: [(q, c) for (q, c), t in NEXT.items() if t == to] for to in range(4)}
ENDS = (0, 3)
#: The role that a rerole or an insertion gives in a state.
MADE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
#: Rows and characters of a block, about.
BLOCK_ROWS, BLOCK_CHARS = 50_000, 30_000_000
#: Keys of cut conversations that are broadcast at most; there is one at each border of blocks at most.
BROADCAST_KEYS = 100_000


class Lightest:
    """Lightest derivations from every item of a block of rows to its ``ends``.

    ``initials`` and ``faults`` are the rows' role initials and first faults ('b', 'd', 't' or ''). Without
    ``last`` a further block follows: ends are states there, and insertions behind the last row are left to it.
    """

    def __init__(self, initials: list[str], faults: list[str], ends=ENDS, last: bool = True, goal: int | None = 0):
        self.initials, n = initials, len(initials)
        self.cost: list = [None] * (4 * n + 4)
        self.letter = [""] * (4 * n + 4)
        agenda = [(0, 0, "", n, q) for q in ends]
        heapq.heapify(agenda)
        while agenda:
            cost, covered, letter, i, q = heapq.heappop(agenda)
            if self.cost[4 * i + q] is not None:
                continue
            self.cost[4 * i + q], self.letter[4 * i + q] = cost, letter
            if i == 0 and q == goal:
                return
            if last or i < n:
                for p, c in BACK[q]:
                    if c != "s":
                        heapq.heappush(agenda, (cost + INSERT, covered, "I", i, p))
            if i == 0:
                continue
            fault = faults[i - 1]
            heapq.heappush(agenda, (cost + DELETE, covered + 1, "D", i - 1, q))
            if fault in ("b", "d"):
                continue
            stays = cost + TRUNCATED * (fault == "t")
            for p, c in BACK[q]:
                if c == initials[i - 1]:
                    heapq.heappush(agenda, (stays, covered + 1, "K", i - 1, p))
                if c != "s":
                    heapq.heappush(agenda, (stays + REROLE, covered + 1, "R", i - 1, p))

    def edits(self, q: int = 0) -> Iterator[tuple[str, int, int]]:
        """(letter, row, state before) of the derivation from state ``q`` at the first row."""
        i = 0
        while letter := self.letter[4 * i + q]:
            yield letter, i, q
            if letter == "K":
                q = NEXT[q, self.initials[i]]
            elif letter != "D":
                q = NEXT[q, MADE[q][0]]
            i += letter != "I"


def rows_of(edits, roles: list[str], texts: list[str]) -> Iterator[str]:
    """The repaired rows as ``role:text``."""
    for letter, i, q in edits:
        if letter == "I":
            yield f"{MADE[q]}:"
        elif letter != "D":
            yield f"{roles[i] if letter == 'K' else MADE[q]}:{texts[i]}"


def damaged(df: DataFrame) -> DataFrame:
    """Rows of conversations damaged by the remainder of crc32(``conv_id:turn``) divided by 20; a NULL is one space there, as in role and text."""
    said = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = df.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), (F.crc32(said.cast("binary")) % 20).alias("__code"))
    code = F.col("__code")
    rows = rows.where(code != 0).select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("__copy"),
    )
    return rows.drop("__copy")


def ordered(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` written in order of conversation, turn (NULL first), role and text, with their ``place`` in it and their ``block``, about ``block_rows`` rows."""
    # Equal rows may be parted anywhere, so a number tells them apart: else they would all lie in one block.
    keys = ["conv_id", "turn", "role", "text", "__tie"]
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    parts = max(1, -(-size["n"] // block_rows), -(-size["chars"] // BLOCK_CHARS))
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__tie")
    shown = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(shown == "", "b").when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")
    return written(
        dealt.withColumns(
            {
                "place": F.monotonically_increasing_id(),
                "block": F.spark_partition_id(),
                "fault": fault,
                "said": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)),
            }
        ),
        "turns",
    )


def _faults(rows: pd.DataFrame, first: pd.DataFrame) -> tuple[list[str], list[str]]:
    """Initials and first faults of a block's rows; rows that aren't the first of their text are duplicates unless blank."""
    new = rows["place"].isin(first["place"])
    faults = rows["fault"].where(new | (rows["fault"] == "b"), "d")
    return [r[:1] for r in rows["role"]], list(faults)


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


REPAIRED = "conv_id {key}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repairs of conversations that lie in one block, whose rows come by conversation and place.

    Before a row that is the first of its text stands a mark, a row of the same place.
    """
    open_key, rows, marked = None, [], None

    def repair() -> tuple:
        roles, texts, faults = (list(c) for c in zip(*rows))
        initials = [r[:1] for r in roles]
        found = Lightest(initials, faults)
        edits = list(found.edits())
        text = "\n".join(rows_of(edits, roles, texts))
        return (open_key, *map(faults.count, "bdt"), _illegal(initials), found.cost[0], "".join(e[0] for e in edits), hashlib.sha256(text.encode()).hexdigest())

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["__key", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

    for batch in batches:
        out = []
        for key, place, mark, role, text, fault in zip(*(batch[c].tolist() for c in ("__key", "place", "__mark", "role", "text", "fault"))):
            if mark == 0:
                marked = place
                continue
            if rows and key != open_key:
                out.append(repair())
                rows = []
            open_key = key
            rows.append((role, text, fault if fault == "b" or place == marked else "d"))
        yield frame(out)
    if rows:
        yield frame([repair()])


def _of_whole(rows: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """Repairs of conversations of one block each: one shuffle, and no frame a conversation."""
    text_key = F.coalesce(F.concat(F.lit("k"), F.col("conv_id").cast("string")), F.lit("")).alias("__key")
    marks = first.select(F.col("first_conv").alias("conv_id"), "place").select(text_key, "place", F.lit(0).alias("__mark"))
    both = rows.select(text_key, "place", F.lit(1).alias("__mark"), "role", "text", "fault").unionByName(marks, allowMissingColumns=True)
    both = both.repartition("__key").sortWithinPartitions("__key", "place", "__mark")
    found = both.mapInPandas(_whole, REPAIRED.format(key="string").replace("conv_id", "__key"))
    conv_id = F.when(F.col("__key") != "", F.expr("substring(__key, 2)")).cast(key).alias("conv_id")
    return found.select(conv_id, *found.columns[1:])


BLOCK = "conv_id {key}, block int, q int, end int, cost long, audit string, blank long, duplicate long, truncated long, illegal long, initials string"


def _spans(rows: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
    """Lightest derivations of one block from each state to each state of the next block, or to the end in the last block (``end`` 4)."""
    rows = rows.sort_values("place")
    initials, faults = _faults(rows, first)
    last = bool(rows["last"].iloc[0])
    said = (*map(faults.count, "bdt"), _illegal(initials), f"{initials[0]:1}{initials[-1]:1}")
    out = []
    for ends, end in [(ENDS, 4)] if last else [((q,), q) for q in range(4)]:
        found = Lightest(initials, faults, ends, last, goal=None)
        out += [(rows["conv_id"].iloc[0], rows["block"].iloc[0], q, end, found.cost[q], "".join(e[0] for e in found.edits(q)), *said) for q in range(4) if found.cost[q] is not None]
    names = ["conv_id", "block", "q", "end", "cost", "audit", "blank", "duplicate", "truncated", "illegal", "initials"]
    return pd.DataFrame(out, columns=names).astype({"conv_id": rows["conv_id"].dtype})


PATH = "conv_id {key}, block int, q int, end int, cost long, illegal long"


def _path(spans: pd.DataFrame) -> pd.DataFrame:
    """The blocks' lightest derivations composed from the last to the first; ``spans`` has an audit's rank instead of the audit.

    Derivations of one block from one state have different audits, none of them the beginning of another
    (each ends with the block's last row), so the cheapest of smallest audit in this block is the lightest.
    """
    best, after = {4: (0, [])}, None
    illegal = 0
    for block, rows in sorted(spans.groupby("block"), reverse=True):
        found: dict[int, tuple] = {}
        for q, end, cost, rank in zip(rows["q"], rows["end"], rows["cost"], rows["rank"]):
            if end in best:
                key = (cost + best[end][0], rank)
                if q not in found or key < found[q][0]:
                    found[q] = (key, end)
        edges = rows["initials"].iloc[0]
        illegal += int(rows["illegal"].iloc[0]) + (after is not None and (edges[1] + after).strip() not in ("su", "ua", "au"))
        after = edges[0]
        best = {q: (key[0], (block, q, end, best[end][1])) for q, (key, end) in found.items()}
    cost, at = best[0]
    out = []
    while at:
        block, q, end, at = at
        out.append((spans["conv_id"].iloc[0], block, q, end, cost, illegal))
    return pd.DataFrame(out, columns=["conv_id", "block", "q", "end", "cost", "illegal"]).astype({"conv_id": spans["conv_id"].dtype})


PIECES = "conv_id {key}, block int, part int, piece binary"


def _pieces(rows: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
    """The repaired rows of a block on the conversation's path, each ended by a newline, in pieces."""
    rows = rows.sort_values("place")
    initials, faults = _faults(rows, first)
    q, end = int(rows["q"].iloc[0]), int(rows["end"].iloc[0])
    found = Lightest(initials, faults, ENDS if end == 4 else (end,), end == 4, goal=None)
    lines = list(rows_of(found.edits(q), list(rows["role"]), list(rows["text"])))
    pieces = [(rows["conv_id"].iloc[0], rows["block"].iloc[0], k, "".join(x + "\n" for x in lines[k : k + 1000]).encode()) for k in range(0, len(lines), 1000)]
    return pd.DataFrame(pieces, columns=["conv_id", "block", "part", "piece"]).astype({"conv_id": rows["conv_id"].dtype})


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each conversation's pieces, which come in order; only the hash's state is kept between them."""
    open_key, state, held = None, None, b""
    for batch in batches:
        out = []
        for key, piece in zip(batch["__key"], batch["piece"]):
            if state is None or key != open_key:
                if state is not None:
                    state.update(held[:-1])
                    out.append((open_key, state.hexdigest()))
                open_key, state, held = key, hashlib.sha256(), b""
            state.update(held)
            held = piece
        yield pd.DataFrame(out, columns=["__key", "repaired_sha256"])
    if state is not None:
        state.update(held[:-1])
        yield pd.DataFrame([(open_key, state.hexdigest())], columns=["__key", "repaired_sha256"])


def _of_cut(rows: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """Repairs of the conversations that lie in several blocks; ``rows`` has each one's first and ``last`` block."""
    first_turns = first.groupBy("first_conv", "first_block")
    spans = written(rows.groupBy("conv_id", "block").cogroup(first_turns).applyInPandas(_spans, BLOCK.format(key=key)), "spans")
    ranked = spans.withColumn("rank", F.expr("row_number() OVER (PARTITION BY conv_id, block, q ORDER BY audit)")).drop("audit", "blank", "duplicate", "truncated")
    path = written(ranked.groupBy("conv_id").applyInPandas(_path, PATH.format(key=key)), "path")
    same = [spans[c].eqNullSafe(path[c]) for c in ("conv_id", "block", "q", "end")]
    chosen = spans.join(path, same).select(spans["conv_id"], spans["block"], "audit", "blank", "duplicate", "truncated", path["illegal"], path["cost"])
    # The answer is one text a conversation, so its audit meets in one row.
    audits = chosen.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.max("illegal").alias("illegal"),
        F.max("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    steps = path.select(F.col("conv_id").alias("__conv"), F.col("block").alias("__block"), "q", "end")
    on_path = rows.join(steps, rows["conv_id"].eqNullSafe(F.col("__conv")) & (rows["block"] == F.col("__block"))).drop("__conv", "__block")
    pieces = on_path.groupBy("conv_id", "block").cogroup(first_turns).applyInPandas(_pieces, PIECES.format(key=key))
    # A NULL key and a key's text as one sortable string.
    text_key = F.coalesce(F.concat(F.lit("k"), F.col("conv_id").cast("string")), F.lit(""))
    sorted_pieces = pieces.select(text_key.alias("__key"), "block", "part", "piece").repartition("__key").sortWithinPartitions("__key", "block", "part")
    digests = sorted_pieces.select("__key", "piece").mapInPandas(_digests, "__key string, repaired_sha256 string")
    joined = audits.withColumn("__key", text_key).join(digests, "__key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return joined.select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


def repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, none of the last two NULL): faults, cheapest edits and the repaired text's hash.

    Rows stand by turn, NULL first, then by role and text. A row's first fault counts: blank, duplicate
    (role and text seen earlier) or truncated. A row with an empty role has no initial, so it isn't kept as
    it is. A NULL conv_id is a conversation of its own. Other columns
    are left out; no rows give no rows. ``gaps`` counts the turn numbers missing between the first and
    last.
    """
    key = rows.schema["conv_id"].dataType.simpleString()
    rows = shipped(ordered(rows.select("conv_id", "turn", "role", "text"), block_rows))
    first = rows.groupBy("conv_id", "said").agg(F.min("place").alias("place"))
    first = first.select(F.col("conv_id").alias("first_conv"), F.shiftright("place", 33).cast("int").alias("first_block"), "place")
    turns = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.min("block").alias("__from"),
        F.max("block").alias("__to"),
    )
    turns = written(turns, "gaps")
    cut = turns.where("__from < __to").select(F.col("conv_id").alias("__conv"), "__to")
    narrow = rows.drop("said")
    if not cut.take(1):
        found = _of_whole(narrow, first, key)
    else:
        cut = small_side(cut, BROADCAST_KEYS)
        in_cut, first_in_cut = (F.col(c).eqNullSafe(F.col("__conv")) for c in ("conv_id", "first_conv"))
        found = _of_whole(narrow.join(cut, in_cut, "left_anti"), first.join(cut, first_in_cut, "left_anti"), key)
        parts = narrow.join(cut, in_cut).withColumn("last", F.col("block") == F.col("__to")).drop("__conv", "__to")
        found = found.unionByName(_of_cut(parts, first.join(cut, first_in_cut, "left_semi"), key))
    gaps = turns.select(F.col("conv_id").alias("__conv"), "gaps")
    return found.join(gaps, found["conv_id"].eqNullSafe(F.col("__conv"))).select("conv_id", "gaps", *found.columns[1:])


def report(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every conversation of ``df`` with the repair of its damaged rows.

    NULLs in role and text are one space. A conversation that loses all rows has zeros, an empty audit
    and the hash of the empty text. Repeated rows are rows of their own; further columns are left out,
    and an empty table gives no rows.
    """
    found = repaired(damaged(df), block_rows)
    every = df.select(F.col("conv_id").alias("__conv")).distinct()
    joined = every.join(found, F.col("__conv").eqNullSafe(F.col("conv_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("__conv").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
