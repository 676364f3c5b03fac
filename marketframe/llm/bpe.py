"""Byte-pair encoding by a tokenization automaton.

The merges are compiled, one by one, into a deterministic automaton whose arcs are tokens and which
accepts exactly the token sequences that the merges produce. It starts as one state with an arc for
every byte. The gadget for a merge (a, b) works on state(a), the state behind every arc a: if it has an
arc b, arcs a lead to a copy of it without arc b from now on, and every state with an arc a gets an arc
ab that leads where b led. As targets depend on the label only, a state is its predecessor less one
arc, so the whole automaton takes two numbers a merge. A state has arc t if none of the arcs that it
dropped is t, or a first part of t that was merged further only later. (Of "aa" the dropped arc "a" is such
a part: the new state gets no arc "aa".)

Encoding walks a word's bytes once and keeps, for every prefix, the last token of its encoding: the one
token that ends there and is an arc of the state before it. Arcs asked for are kept in a table.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .caching import Recent, held
from .common import shipped

#: How byte-level vocabularies split text before merges (a fixed value, the one of the vocabulary files' kind).
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space other than blanks and line ends: such texts are split in one piece.
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: Blanks and line ends belong to what follows; no split word reaches over the start of such a chunk.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The compiled merges of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels: dict[int, bytes] = {i: s.encode() for s, i in self.special.items()}
        for token, i in vocab.items():
            if token not in self.special:
                self.labels[i] = bytes(alphabet[c] for c in token)
        self.byte_id = {b: vocab[c] for c, b in alphabet.items()}
        self.by_label = {label: i for i, label in self.labels.items() if i not in self.special.values()}
        #: Arcs by label: the state they lead to. State 0 has all arcs there are.
        self.target = dict.fromkeys(self.byte_id.values(), 0)
        #: By state: the state it was copied from, the arc it dropped then and the number of the merge.
        self.copied_from, self.dropped, self.merge_of = [-1], [-1], [-1]
        #: Tokens by their first part and the number of the merge that made them.
        self.first_part: dict[int, tuple[int, int]] = {}
        self.last_part: dict[int, tuple[int, int]] = {}
        #: Numbers of merges by both parts, that is of dropped arcs.
        self.merges: dict[int, int] = {}
        #: Arcs that were asked for.
        self.arcs: dict[int, bool] = {}
        for number, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(number, vocab[a], vocab[b], vocab[a + b])
        #: Ends of labels and what they are the whole label of, if of any: the walk back from a byte stops where no label ends so.
        self.tails = dict.fromkeys((label[k:] for label in self.by_label for k in range(len(label))), -1)
        self.tails.update((label, i) for label, i in self.by_label.items() if i in self.target)

    def _gadget(self, number: int, a: int, b: int, joined: int) -> None:
        state = self.target[a]
        if joined in self.target or not self._state_has_arc(state, b):
            return
        behind = self.target[b]
        self.copied_from.append(state)
        self.dropped.append(b)
        self.merge_of.append(number)
        self.target[a] = len(self.copied_from) - 1
        self.target[joined] = behind
        self.first_part[joined] = (a, number)
        self.last_part[joined] = (b, number)
        self.merges[a << 20 | b] = number

    def _state_has_arc(self, state: int, token: int) -> bool:
        """Whether a state has an arc: follows the copies back to state 0, which has all."""
        parts, made = {}, 1 << 60
        while True:
            parts[token] = made
            if token not in self.first_part:
                break
            token, made = self.first_part[token]
        while state > 0:
            if parts.get(self.dropped[state], -1) >= self.merge_of[state]:
                return False
            state = self.copied_from[state]
        return True

    def has_arc(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow behind an arc ``before``.

        The states that state(before) was copied from dropped one arc for each merge of ``before``, and for
        each merge of its last parts up to the one that joined them; the table of merges has all of those.
        """
        merges = self.merges
        last, joined = before, 1 << 60
        while True:
            first, made = token, 1 << 60
            while True:
                number = merges.get(last << 20 | first)
                if number is not None and number < joined and number <= made:
                    return False
                if first not in self.first_part:
                    break
                first, made = self.first_part[first]
            if last not in self.last_part:
                return True
            last, joined = self.last_part[last]

    def encode_word(self, word: bytes) -> list[int]:
        """Token ids of one split word."""
        whole = self.by_label.get(word)
        if whole is not None and whole in self.target:
            return [whole]
        n = len(word)
        ends: list[tuple[int, int]] = [(-1, 0)] * (n + 1)  # last token of the prefix, where it starts
        arcs, tails = self.arcs, self.tails
        for i in range(1, n + 1):
            j = i
            while j:
                j -= 1
                token = tails.get(word[j:i])
                if token is None:
                    break
                if token < 0:
                    continue
                if j == 0:
                    ends[i] = (token, 0)
                    break
                before = ends[j][0]
                allowed = arcs.get(before << 20 | token)
                if allowed is None:
                    if len(arcs) > 300_000:
                        arcs.clear()
                    allowed = arcs[before << 20 | token] = self.has_arc(before, token)
                if allowed:
                    ends[i] = (token, j)
                    break
        ids, i = [], n
        while i > 0:
            token, i = ends[i]
            ids.append(token)
        return ids[::-1]

    def decode(self, ids: Sequence[int]) -> str:
        """The text that the arcs' labels spell; bytes that form no character become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class Encoder:
    """Encodes whole texts; keeps what recent chunks and split words became, ``keep`` to twice as many of each."""

    def __init__(self, path: str, keep: int = 400_000):
        self.automaton = Automaton(path)
        self.words = Recent(lambda word: array("I", self.automaton.encode_word(word.encode())), keep)
        self.chunks = Recent(self._chunk, keep // 8)
        #: What comes after a blank, by the text without it.
        self.spaced = Recent(lambda piece: self._chunk(f" {piece}"), keep)
        special = self.automaton.special
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        ids = array("I")
        for word in SPLIT.findall(chunk):
            ids += self.words[word] if len(word) <= 64 else array("I", self.automaton.encode_word(word.encode()))
        return ids.tobytes(), ",".join(map(str, ids))

    def encode(self, text: str) -> tuple[array, str]:
        """Ids of a text, as numbers and in decimal joined by commas. Special tokens' strings become their ids."""
        if not text:
            return array("I"), ""
        if self.special is None or not self.special.search(text):
            found = self._plain(text)
        else:
            found = []
            for piece in filter(None, self.special.split(text)):
                known = self.automaton.special.get(piece)
                found += self._plain(piece) if known is None else [(array("I", [known]).tobytes(), str(known))]
        return array("I", b"".join([f[0] for f in found])), ",".join([f[1] for f in found])

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        if _OTHER_SPACE.search(text):
            return [self._chunk(text)]
        if "  " not in text and " \n" not in text and text[0] != " " and text[-1] != " ":
            # One blank before each piece but the first, and none before other white space.
            pieces = text.split(" ")
            first, known = self._chunk(pieces[0]), self.spaced
            if max(map(len, pieces)) > 64:
                return [first, *(known[p] if len(p) <= 64 else self._chunk(f" {p}") for p in pieces[1:])]
            return [first, *map(known.__getitem__, pieces[1:])]
        known, chunks = self.chunks, _CHUNK.findall(text)
        if max(map(len, chunks)) > 64:
            return [known[c] if len(c) <= 64 else self._chunk(c) for c in chunks]
        return [known[c] for c in chunks]


def encoder_of(path: str) -> Encoder:
    """One encoder for a worker process and file, kept from task to task."""
    return held(f"Encoder {path}", lambda: Encoder(path))


def encoded(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: the key, the number of tokens and digests of the ids and of the text decoded from them.

    ``path`` names a byte-level vocabulary file that every executor has. ``with_ids`` adds the ids
    (array of int) and the decoded text. A NULL or empty text has no tokens and decodes to an empty
    one; a NULL key stays NULL; repeated rows give equal results; other columns are left out.
    """
    source = shipped(df).select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        sha = hashlib.sha256
        for batch in batches:
            counts, ids_sha, text_sha, all_ids, texts = [], [], [], [], []
            for value in batch.column(1):
                ids, line = encoder.encode(value.as_py() or "")
                decoded = encoder.automaton.decode(ids)
                counts.append(len(ids))
                ids_sha.append(sha(line.encode()).hexdigest())
                text_sha.append(sha(decoded.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids.tolist())
                    texts.append(decoded)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, schema)
