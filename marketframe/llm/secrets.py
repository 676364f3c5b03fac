"""Secrets in texts: labelled credentials by pattern, and what has their format by learned automata.

The contract's patterns find credentials in all texts and label them by kind. From a bounded sample of
each kind's distinct values a prefix tree of character classes is built, and its states are merged where
their frequencies are statistically compatible (ALERGIA), which leaves a small probabilistic automaton a
kind. One more is learned from the runs that no pattern marks. Every long run of credential characters in
every text is then scored by how much likelier its format is under a kind's automaton than under the last.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import top_by
from .common import shipped, written

# What the result's contract says a span of each kind is, and the least length of what counts.
WORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(?:" + "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", w) for w in WORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", re.compile(ASSIGN), 12), ("access", re.compile("(AKIA[A-Z0-9]+)"), 18), ("hex", re.compile("([0-9a-f]{16,})"), 16))
#: A text without any of these holds no match of the kind. A run of hex digits is maximal, so its least length may stand in the pattern.
HINTS = (("passw", "secret", "token", "apikey", "api_key"), ("akia",), ())
#: The kind of the spans that the automata add, and of the runs that are not credentials.
LEARNED, OTHER = "learned", "other"

#: Classes of characters; inside a class all characters are equally likely.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")
SYMBOL = {ord(c): chr(65 + i) for i, chars in enumerate(CLASSES) for c in chars}
LOG_SIZE = {chr(65 + i): math.log(len(chars)) for i, chars in enumerate(CLASSES)}


@dataclass(frozen=True)
class Settings:
    """``sample``: distinct values of a kind that are learned from at most, those of smallest hash.

    ``least_chars`` is the length from which runs are scored, however long they are; ``most_chars`` bounds the
    values of the sample, so that a model's size doesn't follow the texts.
    ``alpha`` is the merging test's error, ``least_visits`` the visits from which it is applied.
    ``threshold``: how much likelier (natural logarithm) a candidate is to be a credential.
    """

    sample: int = 2000
    least_chars: int = 16
    most_chars: int = 512
    alpha: float = 0.05
    least_visits: int = 20
    threshold: float = 8.0

    @property
    def run(self) -> re.Pattern:
        return re.compile("[A-Za-z0-9+/_.=-]{%d,}" % self.least_chars)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of its kind, end, value) of what the contract's patterns find, in order."""
    found, lower = [], text.lower()
    for place, (_, pattern, least) in enumerate(BASE):
        if HINTS[place] and not any(x in lower for x in HINTS[place]):
            continue
        found += [(m.start(), place, m.end(), m[1]) for m in pattern.finditer(text) if m.end() - m.start(1) >= least]
    return sorted(found)


def candidates(text: str, base: list, settings: Settings) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of long runs of credential characters that overlap no base span; stops around one aren't part of it."""
    i, reach = 0, 0
    for m in settings.run.finditer(text):
        run = m[0].strip(".")
        start = m.start() + m[0].index(run)
        end = start + len(run)
        while i < len(base) and base[i][0] < end:
            reach = max(reach, base[i][2])
            i += 1
        if reach <= start and len(run) >= settings.least_chars:
            yield start, end, run


class PrefixTree:
    """Counts of symbol sequences by prefix; merging makes it an automaton."""

    def __init__(self, sequences):
        self.visits, self.stops, self.arcs = [0], [0], [{}]
        for sequence in sequences:
            state = 0
            self.visits[0] += 1
            for x in sequence:
                state = self.arcs[state].setdefault(x, len(self.arcs)) if x in self.arcs[state] else self._grown(state, x)
                self.visits[state] += 1
            self.stops[state] += 1
        # Visits of an arc's end from this arc: equal in a tree, kept apart once states are merged.
        self.taken = [{x: self.visits[t] for x, t in arcs.items()} for arcs in self.arcs]

    def _grown(self, state: int, x: str) -> int:
        self.arcs[state][x] = new = len(self.arcs)
        self.visits.append(0), self.stops.append(0), self.arcs.append({})
        return new

    def alike(self, a: int, b: int, settings: Settings) -> bool:
        """No difference between what follows both states is more than chance (Hoeffding's bound, all the way down)."""
        width = math.sqrt(0.5 * math.log(2 / settings.alpha))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            if n < settings.least_visits or m < settings.least_visits:
                continue
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.stops[a] / n - self.stops[b] / m) > bound:
                return False
            for x in self.arcs[a].keys() | self.arcs[b].keys():
                if abs(self.taken[a].get(x, 0) / n - self.taken[b].get(x, 0) / m) > bound:
                    return False
                if x in self.arcs[a] and x in self.arcs[b]:
                    todo.append((self.arcs[a][x], self.arcs[b][x]))
        return True

    def fold(self, into: int, tree: int) -> None:
        """Adds a subtree's counts to a state and what follows it."""
        todo = [(into, tree)]
        while todo:
            into, tree = todo.pop()
            self.visits[into] += self.visits[tree]
            self.stops[into] += self.stops[tree]
            for x, t in self.arcs[tree].items():
                self.taken[into][x] = self.taken[into].get(x, 0) + self.taken[tree][x]
                if x in self.arcs[into]:
                    todo.append((self.arcs[into][x], t))
                else:
                    self.arcs[into][x] = t

    def merged(self, settings: Settings) -> list[tuple[int, int, dict]]:
        """The automaton: (visits, stops, arcs to (state, times taken)) of its states, the first being the start."""
        red, blue = [0], [(0, x) for x in sorted(self.arcs[0])]
        known = {0}
        while blue:
            # The most visited first: it is the best known.
            blue.sort(key=lambda e: (-self.visits[self.arcs[e[0]][e[1]]], e))
            parent, x = blue.pop(0)
            state = self.arcs[parent][x]
            if state in known:
                continue
            same = next((r for r in red if self.alike(r, state, settings)), None)
            if same is None:
                red.append(state)
                known.add(state)
                blue += [(state, y) for y in sorted(self.arcs[state])]
            else:
                self.arcs[parent][x] = same
                self.fold(same, state)
                blue = [(r, y) for r in red for y in sorted(self.arcs[r]) if self.arcs[r][y] not in known]
        at = {state: i for i, state in enumerate(red)}
        return [(self.visits[r], self.stops[r], {x: (at[t], self.taken[r][x]) for x, t in self.arcs[r].items()}) for r in red]


class Automaton:
    """Log-likelihoods of runs under a learned automaton.

    A fixed share of every state's probability is spread evenly over all symbols and the end, so that what
    no sample shows is as unlikely under an automaton of few samples as under one of many.
    """

    EVEN = 1e-3

    def __init__(self, states: list[tuple[int, int, dict]]):
        every = 1 / (len(CLASSES) + 1)

        def weight(times: int, visits: int) -> float:
            return math.log((1 - self.EVEN) * times / visits + self.EVEN * every if visits else every)

        self.stop = [weight(stops, visits) for visits, stops, _ in states]
        # Where no arc leads on, the run goes on in the state.
        self.arcs = [
            {x: (arcs.get(x, (i, 0))[0], weight(arcs.get(x, (i, 0))[1], visits) - log_size) for x, log_size in LOG_SIZE.items()}
            for i, (visits, _, arcs) in enumerate(states)
        ]

    def score(self, sequence: str) -> float:
        state, total = 0, 0.0
        for x in sequence:
            state, weight = self.arcs[state][x]
            total += weight
        return total + self.stop[state]


@dataclass
class Model:
    """What was learned of a kind: its automaton's states, and the least mean weight of a symbol in the values learned from."""

    states: list[tuple[int, int, dict]]
    floor: float = -math.inf


def learned(values: list[str], settings: Settings = Settings()) -> Model:
    """The model of some values; without values one state that knows nothing."""
    sequences = sorted(v.translate(SYMBOL) for v in values)
    model = Model(PrefixTree(sequences).merged(settings))
    automaton = Automaton(model.states)
    model.floor = min((automaton.score(x) / (len(x) + 1) for x in sequences), default=-math.inf)
    return model


class Scorer:
    """How much likelier a run is to be a credential of the likeliest kind than something else.

    Only kinds count whose format the run has: it fits the automaton as well as the worst value learned from.
    """

    def __init__(self, models: dict[str, Model]):
        self.kinds = [(Automaton(m.states), m.floor) for kind, m in sorted(models.items()) if kind != OTHER]
        self.other = Automaton((models.get(OTHER) or learned([])).states)

    def score(self, run: str) -> float:
        sequence = run.translate(SYMBOL)
        weights = ((a.score(sequence), floor) for a, floor in self.kinds)
        best = max((w for w, floor in weights if w >= floor * (len(sequence) + 1)), default=-math.inf)
        return best - self.other.score(sequence)


def fitted(values: dict[str, list[str]], settings: Settings) -> dict[str, Model]:
    """A model for each kind. The others hold unmarked credentials too: runs likelier to be one are taken out until none is left."""
    models = {kind: learned(v, settings) for kind, v in sorted(values.items())}
    others, before = values.get(OTHER, []), None
    while len(models) > 1 and others and len(others) != before:
        before, scorer = len(others), Scorer(models)
        others = [run for run in others if scorer.score(run) <= 0]
        models[OTHER] = learned(others, settings)
    return models


def labelled(df: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Distinct (kind, value): credentials found by pattern, and the other long runs."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = set()
            for text in batch["text"]:
                if text:
                    base = base_spans(text)
                    out.update((BASE[place][0], value) for _, place, _, value in base if len(value) <= settings.most_chars)
                    out.update((OTHER, run) for _, _, run in candidates(text, base, settings) if len(run) <= settings.most_chars)
            yield pd.DataFrame(sorted(out), columns=["kind", "value"], dtype=object)

    texts = shipped(df).select(F.col(text).cast("string").alias("text"))
    return texts.mapInPandas(found, "kind string, value string").distinct()


MODEL = "kind string, state int, visits long, stops long, symbol string, to int, taken long, floor double"


def train(df: DataFrame, text: str = "text", settings: Settings = Settings()) -> dict[str, Model]:
    """Models by kind, learned from ``settings.sample`` values of each kind in one task.

    The sample is every kind's distinct values of smallest hash over the whole table. A kind without a
    value has no model, so an empty table gives none and no run is then a secret.
    """
    order = [F.xxhash64("value"), F.col("value")]
    sample = top_by(labelled(df, text, settings), "kind", order, settings.sample)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, model in fitted({k: list(v) for k, v in rows.groupby("kind")["value"]}, settings).items():
            for i, (visits, stops, arcs) in enumerate(model.states):
                out.append((kind, i, visits, stops, "", 0, 0, model.floor))
                out += [(kind, i, visits, stops, x, to, taken, model.floor) for x, (to, taken) in sorted(arcs.items())]
        return pd.DataFrame(out, columns=["kind", "state", "visits", "stops", "symbol", "to", "taken", "floor"])

    # At most sample * most_chars states a kind, and in practice tens: the model's size doesn't follow the corpus.
    rows = written(sample.groupBy().applyInPandas(fit, MODEL), "automata").orderBy("kind", "state", "symbol").collect()
    models: dict[str, Model] = {}
    for r in rows:
        states = models.setdefault(r["kind"], Model([], r["floor"])).states
        if r["symbol"] == "":
            states.append((r["visits"], r["stops"], {}))
        else:
            states[-1][2][r["symbol"]] = (r["to"], r["taken"])
    return models


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def with_spans(df: DataFrame, models: dict[str, Model], text: str = "text", out: str = "secrets", settings: Settings = Settings()) -> DataFrame:
    """``df`` with the secrets of its texts in ``out`` (kind, start, end in code points, score), by start and kind.

    A column named ``out`` is replaced. Base spans have score NULL; spans of one kind don't overlap, those of
    the contract's kinds may overlap each other, and a learned one overlaps none. A NULL or empty text has
    none; repeated rows get equal spans. The time is linear in the text.
    """

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        scorer = Scorer(models)
        known: dict[str, float] = {}
        found = []
        for text in texts:
            base = base_spans(text or "")
            row = [(start, place, BASE[place][0], end, None) for start, place, end, _ in base]
            for start, end, run in candidates(text or "", base, settings) if scorer.kinds else ():
                if run not in known:
                    known[run] = scorer.score(run)
                if known[run] >= settings.threshold:
                    row.append((start, len(BASE), LEARNED, end, known[run]))
            found.append([{"kind": kind, "start": start, "end": end, "score": score} for start, _, kind, end, score in sorted(row, key=lambda r: r[:2])])
        return pd.Series(found, dtype=object)

    return shipped(df).withColumn(out, spans(F.col(text).cast("string")))


def report(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per row: secrets by kind, their digest and the spans; other columns are left out."""
    models = train(df, text, settings)
    frame = with_spans(df.select(F.col(key).alias("doc_id"), F.col(text).alias("__text")), models, "__text", "secrets", settings).drop("__text")

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(name):
        return F.size(F.filter("secrets", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter("secrets", lambda s: s["kind"] != LEARNED)
    return frame.select(
        "doc_id",
        *(count(name) for name in [*(name for name, _, _ in BASE), LEARNED]),
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line(F.col("secrets")).alias("spans"),
    )
