"""Time-decayed mean and standard deviation over irregularly spaced rows, per key.

Per key in (ts, seq) order, with ``a = exp(-dt / tau)`` (Eckner 2014; Mueller 1991; Finch 2009):

    m_1 = x_1    m_n = a * m_(n-1) + (1 - a) * x_n
    v_1 = 0      v_n = a * (v_(n-1) + (1 - a) * (x_n - m_(n-1))**2)

For keys that fit a task both are running sums of decayed terms per key. If there are hot keys, rows
are grouped by (key, block), where only hot keys have several blocks. Inside a block the recurrences are
run relative to the block's first row with plain window sums, which gives both values as polynomials in
the state after that first row: ``m_n = x_1 + M + c / g`` and ``v_n = D0 - 2 c D1 + c**2 D2 + v_1 / g``
where ``c = m_1 - x_1`` and ``g = exp((t_n - t_1) / tau)``. One row per block of a hot key then carries
the states from block to block and leads its block as an extra row, so all rows are shuffled once. No
window spans all rows of a hot key, and all terms of a sum have the weight they have in the result. Sums
run over stretches of time in which no exponent exceeds ``SPAN``; ``g`` ends at exp(2 ``SPAN``), where
what it divides no longer shows.

NULL inputs and inputs without a time leave the state as it is. The deviation of a key's first value is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import micros
from .ordered import BLOCK, SPLIT_ROWS, US, Cuts, plan_cuts, to_micros, with_blocks
from .relational import Names, as_list

# 1 for rows of the table, 0 for the row that leads a block.
OWN = "__own"
# The time a row counts as of, when states continue.
AT = "__at"

# Longest stretch, in units of tau, over which exp() is accumulated: exp(300) is far from overflow
# and exp(-SPAN / 2) is far below the resolution of a double.
SPAN = 300

# Column expressions are SQL text here: a stage is one list of named formulas.
# Sum of a key's terms so far, each decayed from its own time to the current row's time. It is
# accumulated over two grids of stretches shifted by half a stretch; a row uses the grid in which at
# least half a stretch lies behind it, and what that leaves out has decayed by exp(-SPAN / 2).
_DECAYED = (
    "CASE WHEN pmod({t}, {stretch}) >= {half} "
    "THEN sum({term} * exp(pmod({t}, {stretch}) / {tau})) {grid0} * exp(-pmod({t}, {stretch}) / {tau}) "
    "ELSE sum({term} * exp(pmod({t} + {half}, {stretch}) / {tau})) {grid1} "
    "* exp(-pmod({t} + {half}, {stretch}) / {tau}) END"
)
_LOCAL = (
    {
        "t": "last(IF({x} IS NULL, NULL, {us}), true) {running}",
        "t1": "first(IF({x} IS NULL, NULL, {us}), true) {running}",
        "x1": "first({x}, true) {running}",
        "n": "count({x}) {running}",
        "tp": "last(IF({x} IS NULL, NULL, {us}), true) {earlier}",
    },
    {
        "g": "exp(least(({t} - {t1}) / {tau}, {cap}))",
        # Share of the new value, 1 - exp(-dt / tau); 0 on the block's first row.
        "w": "coalesce(-expm1(({tp} - {t}) / {tau}), 0D)",
        "d": "coalesce({x} - {x1}, 0D)",
    },
    {"term": "{w} * {d}"},
    {"m": f"IF({{t}} IS NULL, NULL, {_DECAYED})"},
)
_LOCAL_STD = (
    {
        "gp": "coalesce(lag({g}) {ordered}, 1D)",
        "e": "IF({w} > 0, {d} - coalesce(lag({m}) {ordered}, 0D), 0D)",
    },
    {"term": "coalesce(exp(({tp} - {t}) / {tau}), 0D) * {w} * {e} * {e}"},
    {
        "d0": f"IF({{t}} IS NULL, NULL, {_DECAYED})",
        "d1": "sum({w} * {e}) {running} / {g}",
        "d2": "sum({w} / {gp}) {running} / {g}",
    },
)

_KNOWN = "({x1} IS NOT NULL OR {m_in} IS NOT NULL)"
_CHAIN = (
    {"tb": "last({t}, true) {before}"},
    {
        # Weight of the state before the block after the block's first row; 0 in a key's first block.
        "a1": "coalesce(exp(({tb} - {t1}) / {tau}), 0D)",
        "term": "coalesce({m_in}, {x1} * coalesce(-expm1(({tb} - {t}) / {tau}), 1D) + {m}, 0D)",
    },
    {"mo": f"IF({_KNOWN}, {_DECAYED}, NULL)"},
    {"mb": "last({mo}, true) {before}"},
    {"c": "{a1} * coalesce({mb} - {x1}, 0D)"},
)
_CHAIN_STD = (
    {
        "entry": "{a1} * (1 - {a1}) * coalesce(({mb} - {x1}) * ({mb} - {x1}), 0D)",
    },
    {
        "term": "coalesce({v_in}, {d0} - 2 * {c} * {d1} + {c} * {c} * {d2} + {entry} / {g}, 0D)",
    },
    {"vo": f"IF({_KNOWN}, {_DECAYED}, NULL)"},
    {"vb": "last({vo}, true) {before}"},
    {"v1": "{a1} * coalesce({vb}, 0D) + {entry}"},
)
# What the leading row brought, on every row of its block.
_CARRIED = ({n: f"first({{{n}}}, true) {{running}}" for n in ("c", "mb", "v1", "vb")},)
# The same per whole key: a value's share of the mean, and its squared distance from the mean before.
_WHOLE = (
    {
        "t": "last(IF({x} IS NULL, NULL, {us}), true) {running}",
        "tp": "last(IF({x} IS NULL, NULL, {us}), true) {earlier}",
    },
    {"w": "IF({x} IS NULL, 0D, coalesce(-expm1(({tp} - {t}) / {tau}), 1D))"},
    {"term": "{w} * coalesce({x}, 0D)"},
    {"mo": f"IF({{t}} IS NULL, NULL, {_DECAYED})"},
)
_WHOLE_STD = (
    {"e": "coalesce({x} - lag({mo}) {ordered}, 0D)"},
    {"term": "coalesce(exp(({tp} - {t}) / {tau}), 0D) * {w} * {e} * {e}"},
    {"vo": f"IF({{t}} IS NULL, NULL, {_DECAYED})"},
)
_WHOLE_RESULT = {"mean": "{mo}", "std": "IF({tp} IS NULL AND {x} IS NOT NULL, NULL, sqrt({vo}))"}
_MEAN = "coalesce({x1} + {m} + coalesce({c}, 0D) / {g}, {mb})"
_VAR = (
    "IF({mb} IS NULL AND {n} = 1 AND {x} IS NOT NULL, NULL, "
    "coalesce({d0} + coalesce({c} * {c} * {d2} - 2 * {c} * {d1}, 0D) + coalesce({v1}, 0D) / {g}, {vb}))"
)
_STD = f"sqrt(IF({_VAR} > 0, {_VAR}, IF({_VAR} IS NULL, NULL, 0D)))"

_NAMES = "t t1 x1 n tp g w d m gp e d0 d1 d2 m_in v_in tb a1 term mo mb c entry vo vb v1".split()


def decay_stats(
    df: DataFrame,
    ts: str,
    tau: timedelta | int | float,
    by: Names,
    mean: Mapping[str, str] | None = None,
    std: Mapping[str, str] | None = None,
    seq: Names | None = None,
    block: int | None = None,
    initial: DataFrame | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Add decayed means and standard deviations, as ``{output: input}`` mappings.

    Keys with more than ``split_rows`` rows (None: there are none) are cut into blocks; ``block``
    (microseconds) forces a block length on all keys. ``initial`` continues an earlier run: the states of
    :func:`last_states`. A row from before its key's state counts as of the state's time, so it has weight 0.
    """
    mean, std = dict(mean or {}), dict(std or {})
    keys, seq = as_list(by), as_list(seq)
    tau_us = to_micros(tau)
    rows, at = df, ts
    if initial is not None:
        rows, at = _not_before(df, ts, keys, [*mean.values(), *std.values()], initial), AT
    cuts = None if block else plan_cuts(rows, keys, at, seq, split_rows)
    if initial is None and not block and cuts is None:
        return _whole(df, ts, keys, seq, tau_us, mean, std)
    out = _blocked(rows, at, keys, seq, tau_us, mean, std, block, cuts, initial)
    return out.drop(AT) if initial is not None else out


def _not_before(df: DataFrame, ts: str, keys: list[str], inputs: list[str], initial: DataFrame) -> DataFrame:
    """Rows with their time, or their key's last state's if that is later."""
    last = F.greatest(*[F.col(f"__state_{c}.t") for c in inputs], F.lit(None).cast("long"))
    states = initial.select(*[F.col(k).alias(f"__of_{k}") for k in keys], last.alias("__last"))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(states[f"__of_{k}"])
    at = F.timestamp_micros(F.greatest(micros(F.col(ts)), "__last"))
    return df.join(states, same, "left").withColumn(AT, at).drop("__last", *[f"__of_{k}" for k in keys])


def _blocked(df, ts, keys, seq, tau_us: int, mean, std, block, cuts: Cuts | None, initial) -> DataFrame:
    """Keys in blocks: states inside each block, carried from block to block."""
    columns = df.columns
    inputs = list(dict.fromkeys([*mean.values(), *std.values()]))

    def local(frame: DataFrame) -> DataFrame:
        for i, column in enumerate(inputs):
            stages = _LOCAL + (_LOCAL_STD if column in std.values() else ())
            frame = _add(frame, stages, _terms(i, column, keys, seq, tau_us, inside=True))
        return frame

    def cut(frame: DataFrame, hot_only: bool = False) -> DataFrame:
        return with_blocks(frame, keys, ts, seq, block, cuts, hot_only).withColumn(OWN, F.lit(1))

    # A key of one block and no state hands nothing on.
    narrow = local(cut(df.select(*dict.fromkeys([*keys, ts, *seq, *inputs])), hot_only=initial is None))
    carry = _carries(narrow, inputs, keys, seq, tau_us, set(std.values()), initial)
    out = local(cut(df).unionByName(carry, allowMissingColumns=True))
    for i, column in enumerate(inputs):
        brought = [{n: e for n, e in _CARRIED[0].items() if f"__{n}{i}" in carry.columns}]
        out = _add(out, brought, _terms(i, column, keys, seq, tau_us))
    return out.filter(f"{OWN} = 1").selectExpr(
        *[f"`{c}`" for c in columns],
        *[f"{_MEAN.format(**_terms(inputs.index(c)))} AS `{out}`" for out, c in mean.items()],
        *[f"{_STD.format(**_terms(inputs.index(c), c))} AS `{out}`" for out, c in std.items()],
    )


def _whole(df, ts, keys, seq, tau_us: int, mean, std) -> DataFrame:
    """Keys that fit a task each: every window is over one shuffle by key."""
    columns = df.columns
    inputs = list(dict.fromkeys([*mean.values(), *std.values()]))
    out = df.withColumn(US, micros(F.col(ts)))
    for i, column in enumerate(inputs):
        stages = _WHOLE + (_WHOLE_STD if column in std.values() else ())
        out = _add(out, stages, _terms(i, column, keys, seq, tau_us, whole=True))
    results = [
        f"{_WHOLE_RESULT[kind].format(**_terms(inputs.index(c), c))} AS `{name}`"
        for kind, wanted in (("mean", mean), ("std", std))
        for name, c in wanted.items()
    ]
    return out.selectExpr(*[f"`{c}`" for c in columns], *results)


def ema_time(df, ts, tau, columns: Mapping[str, str], by: Names, seq=None, **split) -> DataFrame:
    """Time-decayed mean."""
    return decay_stats(df, ts, tau, by, mean=columns, seq=seq, **split)


def emstd_time(df, ts, tau, columns: Mapping[str, str], by: Names, seq=None, **split) -> DataFrame:
    """Time-decayed standard deviation."""
    return decay_stats(df, ts, tau, by, std=columns, seq=seq, **split)


def _add(frame: DataFrame, stages, terms: Mapping[str, str]) -> DataFrame:
    for stage in stages:
        replaced = [terms[name] for name in stage]
        kept = [f"`{c}`" for c in frame.columns if c not in replaced]
        frame = frame.selectExpr(*kept, *[f"{e.format(**terms)} AS {terms[n]}" for n, e in stage.items()])
    return frame


def _terms(i: int, column: str = "", keys=(), seq=(), tau_us: int = 1, whole: bool = False, inside: bool = False) -> dict[str, str]:
    """What the formulas' names stand for: this input's columns, windows and constants.

    Decayed sums run over a ``whole`` key's rows, over the rows ``inside`` a block, or else over a key's blocks.
    """
    stretch = SPAN * tau_us
    by = ", ".join(f"`{k}`" for k in keys)
    order = ", ".join([US, *[f"`{c}`" for c in seq]])
    rows = f"PARTITION BY {by} ORDER BY {order}" if whole else f"PARTITION BY {by}, {BLOCK} ORDER BY {OWN}, {order}"
    grid = "OVER (PARTITION BY {by}, __t{i} - pmod(__t{i} + {shift}L, {stretch}L) ORDER BY {block} ROWS UNBOUNDED PRECEDING)"
    of, along = (f"{by}, {BLOCK}", f"{OWN}, {order}") if inside else (by, order if whole else BLOCK)
    grids = [grid.format(by=of, i=i, shift=s, stretch=stretch, block=along) for s in (0, stretch // 2)]
    return {
        **{name: f"__{name}{i}" for name in _NAMES},
        "x": f"IF({US} IS NULL, NULL, CAST(`{column}` AS DOUBLE))",
        "us": US,
        "tau": f"{float(tau_us)!r}D",
        "stretch": f"{stretch}L",
        "half": f"{stretch // 2}L",
        "cap": f"{2 * SPAN}D",
        "ordered": f"OVER ({rows})",
        "running": f"OVER ({rows} ROWS UNBOUNDED PRECEDING)",
        "earlier": f"OVER ({rows} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        "before": f"OVER (PARTITION BY {by} ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        "grid0": grids[0],
        "grid1": grids[1],
    }


def _carries(local, inputs, keys, seq, tau_us: int, with_std: set, initial=None) -> DataFrame:
    """State handed to each (key, block): one row per block, chained over the key's blocks."""
    by = [f"`{k}`" for k in keys]
    terms = [_terms(i, c, keys, seq, tau_us) for i, c in enumerate(inputs)]
    states = [c for c in local.columns if c.startswith("__") and c not in (US, BLOCK, OWN)]
    ends = local.selectExpr(*by, BLOCK, *states, f"lead(1) {terms[0]['ordered']} AS __more")
    ends = ends.filter("__more IS NULL").drop("__more")
    if initial is not None:
        # A state is a finished block before all others: its sums so far are its mean and variance.
        given = [
            f"`__state_{c}`.{field} AS {terms[i][name]}"
            for i, c in enumerate(inputs)
            for field, name in (("t", "t"), ("m", "m_in"), ("v", "v_in"))
        ]
        start = initial.selectExpr(*by, f"{-(2**62)}L AS {BLOCK}", *given)
        ends = ends.unionByName(start, allowMissingColumns=True)
    else:
        none = [f"CAST(NULL AS DOUBLE) AS {t[n]}" for t in terms for n in ("m_in", "v_in")]
        ends = ends.selectExpr("*", *none)
    kept = []
    for i, column in enumerate(inputs):
        ends = _add(ends, _CHAIN + (_CHAIN_STD if column in with_std else ()), terms[i])
        names = ("c", "mb", "v1", "vb") if column in with_std else ("c", "mb")
        kept += [terms[i][n] for n in names]
    handed = " OR ".join(f"{t['mb']} IS NOT NULL" for t in terms)
    return ends.filter(handed).selectExpr(*by, BLOCK, *kept, f"0 AS {OWN}")


def last_states(stats: DataFrame, by: Names, ts: str, columns: Mapping[str, tuple[str, str | None]], seq=None):
    """Final state per key of a :func:`decay_stats` result, to continue from: per input column its
    last time, mean and variance. ``columns`` maps each input to its (mean, deviation) outputs."""
    order = F.struct(micros(F.col(ts)), *[F.col(c) for c in as_list(seq)])
    states = []
    for column, (mean, std) in columns.items():
        given = F.col(column).isNotNull()
        var = F.coalesce(F.col(std) * F.col(std), F.lit(0.0)) if std else F.lit(0.0)
        state = F.struct(micros(F.col(ts)).alias("t"), F.col(mean).alias("m"), var.alias("v"))
        states.append(F.max_by(state, F.when(given, order)).alias(f"__state_{column}"))
    return stats.groupBy(*as_list(by)).agg(*states)


def merge_states(earlier: DataFrame, later: DataFrame, by: Names) -> DataFrame:
    """The later state of each key and column."""
    both = earlier.unionByName(later)
    states = [c for c in both.columns if c.startswith("__state_")]
    return both.groupBy(*as_list(by)).agg(*[F.max(c).alias(c) for c in states])
