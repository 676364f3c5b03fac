"""Best-fit packing by minimum bin slack, planned on lengths and carried out by Spark.

All that the plan needs is how many pieces there are of each length, at most ``capacity`` numbers
whatever the data's size. A bin starts with the longest length left; bitset subset sums over the
lengths available find the fullest combination for the rest of it. The combination is removed as often
as its lengths allow, so the plan has a few thousand entries, and every piece then finds its sequence
from its length and its rank among pieces of that length.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .caching import held
from .common import batch_rows, shipped, written

#: Pieces of one length that a task ranks at most, about.
RANK_ROWS = 50_000
#: Fixed value: the string of the vocabulary's end token, an added token that texts are cut at first of all.
END_TOKEN = "<|endoftext|>"
MARKS = ".,;:!?*%$&#|"
#: Words of Latin letters with marks behind them, one a line: the word, its letters and its marks.
PLAIN = re.compile(r"^(([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]{1,64})([.,;:!?*%$&#|]{0,8}))$", re.M)
#: Recent words that a process keeps, once to twice as many, and twice as many parts; words of texts that are looked up at once.
KEPT_WORDS, GROUP_WORDS = 200_000, 20_000
#: Rows of a batch that a Python task is handed at once.
BATCH_ROWS = 1000


class Tokens:
    """Ids of texts by a vocabulary whose splitting drops white space: texts are cut there and recent words kept.

    Unknown words of some texts are encoded in one call: those of Latin letters with marks behind them between
    spaces, and cut apart behind the ids that end a word; others with the end token between them.
    """

    def __init__(self, path: str, keep: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.keep = keep
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.end = self.tokenizer.token_to_id(END_TOKEN)
        suffix = self.tokenizer.model.end_of_word_suffix
        # The same merges, for text in lower case that has only letters and spaces: the file's other steps leave that as it is.
        self.letters = Tokenizer.from_str(self.tokenizer.to_str()) if suffix else None
        if self.letters:
            self.letters.normalizer = normalizers.Sequence([])
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            names = self.tokenizer.get_vocab()
            self.last = np.zeros(max(names.values()) + 1, bool)
            self.last[[i for name, i in names.items() if name.endswith(suffix)]] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _cut(self, parts: list[str], ids: np.ndarray, ends: np.ndarray, skipped: int) -> None:
        """Ids of parts, each up to its end; so many ids there belong to none."""
        data, start = ids.tobytes(), 0
        for x, e in zip(parts, ends.tolist()):
            self.parts[x] = data[4 * start : 4 * e]
            start = e + skipped

    def _learn(self, words: set[str]) -> None:
        """Ids of new words from those of their parts: letters in lower case, and the marks behind them.

        The vocabulary's splitting never joins a letter or number to a mark, and its lower case is taken
        character by character; both are used only where they hold without doubt.
        """
        parts = self.parts
        left = words.difference(self.older)
        old = words.difference(left)
        self.words.update(zip(old, map(self.older.__getitem__, old)))
        if len(parts) > 2 * self.keep:
            parts.clear()
        new = [(w, w if (low := core.lower()) == w else low, mark) for w, core, mark in PLAIN.findall("\n".join(left))] if self.letters else []
        cores = list({core for _, core, _ in new}.difference(parts))
        if cores:
            ids = np.array(self.letters.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, "<u4")
            self._cut(cores, ids, np.flatnonzero(self.last[ids]) + 1, 0)
        plain = {mark for _, _, mark in new}
        for w in left.difference([w for w, _, _ in new]):
            core = w.rstrip(MARKS)
            # Some letters end in a combining sign once the vocabulary has taken them apart; it joins the marks.
            if not core or not unicodedata.normalize("NFC", core[-1]).lower()[-1].isalnum():
                core = w
            if max(core, default="") <= "\xff":
                new.append((w, core.lower(), w[len(core) :]))
            else:
                new.append((w, core, w[len(core) :]))
            plain.update(new[-1][1:])
        plain = plain.difference(parts)
        odd = {x for x in plain if "<" in x or not x}
        for x in odd:
            parts[x] = self._encode(x).tobytes()
        plain = list(plain - odd)
        if plain:
            ids = self._encode(END_TOKEN.join(plain))
            self._cut(plain, ids, np.append(np.flatnonzero(ids == self.end), len(ids)), 1)
        for w, core, mark in new:
            self.words[w] = parts[core] + parts[mark] if mark else parts[core]

    def _found(self, group: list[list[str]]) -> Iterator[bytes]:
        """The ids of some texts' words, text by text."""
        words = set().union(*group)
        new = words.difference(self.words)
        if len(self.words) + len(new) > self.keep:
            self.older, self.words, new = self.words, {}, words
        long = {w: self._encode(w).tobytes() for w in new if len(w) > 64}
        self._learn(new.difference(long))
        known = self.words
        for found in group:
            if long:
                yield b"".join([known[w] if w in known else long[w] for w in found])
            else:
                yield b"".join(map(known.__getitem__, found))

    def ids_of(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of whole texts, each as little-endian unsigned 32-bit numbers."""
        group, size = [], 0
        for text in texts:
            group.append(text.replace("\n", " ").split(" "))
            size += len(group[-1])
            if size >= GROUP_WORDS:
                yield from self._found(group)
                group, size = [], 0
        yield from self._found(group)

    def ids(self, text: str) -> bytes:
        """The ids of one whole text."""
        return next(self.ids_of([text]))


def tokens_of(path: str) -> Tokens:
    """One tokenizer for a worker process and file, kept from task to task."""
    return held(f"Tokens {path}", lambda: Tokens(path))


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048) -> DataFrame:
    """Per row its pieces: doc_id, piece (from 0), start, length and ids_crc32.

    A row's ids are those of its text by the vocabulary file ``path``, which every executor has, and
    then id 0. More than ``capacity`` of them are cut into pieces of that length, the last one shorter.
    A NULL or empty text is the one id 0; a NULL key stays NULL; other columns are left out.
    """
    source = shipped(df).select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    end, step = b"\0\0\0\0", 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            row, piece, start, length, crc = [], array("i"), array("q"), array("q"), array("q")
            for r, data in enumerate(tokens.ids_of(value.as_py() or "" for value in batch.column(1))):
                data += end
                for p, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    row.append(r)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            keys = batch.column(0).take(pa.array(row, pa.int64()))
            rest = [pa.array(np.frombuffer(a, dtype=t)) for a, t in ((piece, np.int32), (start, np.int64), (length, np.int64), (crc, np.int64))]
            yield pa.RecordBatch.from_arrays([keys, *rest], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass(frozen=True)
class Fill:
    """``times`` sequences that each hold ``lengths``, longest first."""

    lengths: tuple[int, ...]
    times: int


def fullest(counts: Mapping[int, int], room: int) -> list[int]:
    """Available lengths that fill ``room`` as far as any combination does, by bitset subset sums.

    Bit s of a set says that some combination sums to s. A length that there is n times enters in parts of
    1, 2, 4, ... and what is left, at most as often as it fits.
    """
    mask, sums, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            steps.append((length, part, sums))
            sums |= sums << length * part & mask
            left -= part
            part *= 2
        if sums >> room & 1:
            break
    total, chosen = sums.bit_length() - 1, []
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * part
            total -= length * part
    return sorted(chosen, reverse=True)


def plan(counts: Mapping[int, int], capacity: int = 2048) -> list[Fill]:
    """Sequences for so many pieces of each length; every piece is in one of them."""
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    fills = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        lengths = [longest, *fullest({k: v for k, v in rest.items() if v}, capacity - longest)]
        uses = {x: lengths.count(x) for x in set(lengths)}
        times = min(left[x] // n for x, n in uses.items())
        fills.append(Fill(tuple(lengths), times))
        for x, n in uses.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return fills


def _places(fills: list[Fill]) -> tuple[np.ndarray, np.ndarray]:
    """Where ranks of a length go: sorted keys (length, first rank) and rows of (first rank, uses, first sequence, offset)."""
    used: dict[int, int] = {}
    keys, rows, sequence = [], [], 0
    for fill in fills:
        offset = 0
        for x in sorted(set(fill.lengths), reverse=True):
            uses = fill.lengths.count(x)
            first = used.get(x, 0)
            keys.append(x << 44 | first)
            rows.append((first, uses, sequence, offset))
            used[x] = first + uses * fill.times
            offset += uses * x
        sequence += fill.times
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return np.array(keys, np.int64)[order], np.array(rows, np.int64).reshape(-1, 4)[order]


def ranked(df: DataFrame, rows: int = RANK_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``df`` with a column ``rank`` from 0 among rows of the same ``length``, and the count of each length.

    A length may hold any share of the rows: they are dealt into parts by a hash of all their columns, ranked
    there, and moved on by the sizes of the parts before.
    """
    counts = {r["length"]: r["count"] for r in df.groupBy("length").count().collect()}
    parts = max(1, -(-max(counts.values(), default=0) // rows))
    dealt = df.withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("length", "__part").count()
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__shift"))
    inside = F.row_number().over(Window.partitionBy("length", "__part").orderBy("doc_id", "piece"))
    out = dealt.withColumn("rank", inside - 1).join(shifts, ["length", "__part"])
    return out.withColumn("rank", F.col("rank") + F.col("__shift")).drop("__part", "__shift"), counts


def packed(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048) -> DataFrame:
    """Every piece (see pieces) with its sequence_id and its offset there; sequences have no gaps.

    Repeated rows are packed each. An empty table gives no rows.
    """
    with batch_rows(df.sparkSession, BATCH_ROWS):
        whole = written(pieces(df, path, key, text, capacity), "pieces")
    places, counts = ranked(whole)
    keys, rows = _places(plan(counts, capacity))
    kind = whole.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            first, uses, sequence, offset = rows[np.searchsorted(keys, length << 44 | rank, side="right") - 1].T
            turn, slot = np.divmod(rank - first, uses)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence + turn), pa.array(offset + slot * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return places.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long")).mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
