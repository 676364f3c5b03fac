"""Near duplicates by bottom-k sketches of word shingles.

Texts with the same shingle set are one class. A class keeps the k smallest hashes of its set, its
sketch. Inverted lists of the few smallest values propose pairs: two sets that agree in ``percent`` (p, as a
share) share one of their n smallest values but for (1 - p) ** n of the cases, and n follows from p (8 at
85 %, 10 at 80 %). The sketch of two sets' union estimates their similarity, and pairs that may agree
enough are confirmed on full sets. Confirmed pairs join classes to components.

Members of every list first meet one hub, the member that is in most and longest lists, so a group of
near copies costs one pair a member. Members that the hub links are done there, unless others lie so near
to the hub that both could still be linked (the share that sets disagree in is a distance, so who is farther
than twice the limit from the hub can't be linked to those within it). What is left of a list is compared
in one sorted pass over wider sketches, which are whole sets but for long texts: it gives out a spanning forest of
the links, never all pairs. Members of lists that still have more than LIST_ROWS go on to a second level, the
lists of the rarest of their RANKS smallest values: linked sets share so many of these that some are among
the rarest of both, whatever passages they have in common with others. Its long lists are compared block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_rows, checkpointed, shipped, written
from .hashing import shingles

#: Values of a sketch, and of the wider one of classes that hubs don't settle.
SKETCH, WIDE = 64, 1024
#: Members of lists that have no hub, and of lists that are compared at once.
STAR_ROWS, LIST_ROWS = 1, 1000
#: Chance that linked sets meet in no list, and standard deviations that estimates may be off.
MISSED, DEVIATIONS = 3e-7, 6
#: Lists of smallest values, then of rarest ones, which are chosen from so many.
LEVELS, RANKS = 2, 32
#: Keys of rows whose full sets are computed that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Rows of a batch whose sets a Python task holds at once, and pairs of a list that it tests at once.
BATCH_ROWS, SLICE_PAIRS = 1000, 100_000


def listed_for(percent: int) -> int:
    """Smallest values whose lists propose pairs."""
    return math.ceil(math.log(MISSED) / math.log(1 - percent / 100)) if percent < 100 else 1


def _under(share: float, sketch: int) -> float:
    """The share less the deviations that a sketch of so many values may be off."""
    return max(0.0, share - DEVIATIONS * math.sqrt(share * (1 - share) / sketch))


def least_estimate(percent: int, sketch: int) -> float:
    """Below it a pair isn't confirmed; linked sets also share that part of their smallest values at least."""
    return _under(percent / 100, sketch)


def near_estimate(percent: int, sketch: int) -> float:
    """Below it a set is farther from its hub than twice the limit: the shares that sets disagree in add up at most."""
    return _under(max(0.0, 2 * percent / 100 - 1), sketch)


def text_hash(text: str) -> Column:
    """Tells rows of one key apart by their texts."""
    return F.xxhash64(F.col(text).cast("string"))


def sketches(df: DataFrame, key: str, text: str, words: int = 5, sketch: int = SKETCH) -> DataFrame:
    """Per row: doc_id, text_hash, node (128-bit hash of the shingle set; NULL for an empty one), n_shingles and sketch."""
    source = shipped(df).select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("__text"), text_hash(text).alias("text_hash"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, low = [], [], []
            for value in batch.column(1):
                s = shingles(value.as_py(), words)
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sizes.append(len(s))
                low.append(s[:sketch].copy())
            columns = [batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(low, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "n_shingles", "sketch"])

    return source.mapInArrow(run, f"doc_id {kind}, text_hash long, node binary, n_shingles long, sketch array<long>")


def _similar(a: str, b: str, sketch: int) -> Column:
    """Similarity that the sketch of two sets' union shows."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, sketch)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)


def estimated(pairs: DataFrame, classes: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """Pairs with the similarity that the sketch of their union shows."""
    side = classes.select("node", "sketch")
    both = pairs.join(side.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
    both = both.join(side.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
    return both.select(*pairs.columns, _similar("sa", "sb", sketch).alias("similar"))


def allowed(percent: int, ranks: int) -> list[int]:
    """By number r: of the r smallest values of linked sets' union more are shared than this, but for MISSED of the cases."""
    p = percent / 100
    out = []
    for r in range(1, ranks + 1):
        few = np.cumsum([math.comb(r, i) * p**i * (1 - p) ** (r - i) for i in range(r)])
        out.append(int(np.searchsorted(few, MISSED, side="right")) - 1)
    return out


def rarest(classes: DataFrame, percent: int, ranks: int = RANKS) -> DataFrame:
    """Rarest of the classes' ``ranks`` smallest values, as (node, n, list): so many that linked sets have one in common.

    Two sets that share c of these values share one of the size - c + 1 that come first in any common order.
    """
    size = F.least(F.size("sketch"), F.lit(ranks))
    values = classes.select("node", F.col("n_shingles").alias("n"), size.alias("size"), F.explode(F.slice("sketch", 1, ranks)).alias("list"))
    often = values.groupBy("list").agg(F.count("*").alias("often")).where("often > 1")
    # A set may have fewer values than another one that it is linked to, by the limit's share at most.
    both = F.least("size", F.ceil(F.col("n") * percent / 100)).cast("int")
    first = F.col("size") - F.get(F.array(*map(F.lit, allowed(percent, ranks))), both - 1)
    order = Window.partitionBy("node").orderBy("often", "list")
    # Values of a single class come first in its order and are in no list: only their number counts.
    met = values.join(often, "list").withColumn("seen", F.count("*").over(Window.partitionBy("node"))).withColumn("rank", F.row_number().over(order))
    return met.where(F.col("rank") + F.col("size") - F.col("seen") <= first).select("node", "n", "list")


def sets_of(nodes: DataFrame, classes: DataFrame, df: DataFrame, key: str, text: str, words: int, most: int | None = None) -> DataFrame:
    """Shingle sets (their ``most`` smallest hashes) of classes, read from the texts again: node and set."""
    wanted = checkpointed(nodes.join(classes.select("node", "rep"), "node").where(F.col("rep").isNotNull()))
    ids = wanted.select(F.col("rep").alias("__rep")).distinct()
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_ROWS else ids
    source = df.select(F.col(key).alias("__rep"), F.col(text).cast("string").alias("__text")).join(ids, "__rep", "left_semi").select("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(value.as_py(), words) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s[:most] for s in sets], pa.list_(pa.int64()))], ["node", "set"]
            )

    # A key may stand in several rows: the node tells which sets are meant, and one of equal sets is enough.
    return source.mapInArrow(run, "node binary, set array<long>").groupBy("node").agg(F.first("set").alias("set"))


def confirmed(pairs: DataFrame, classes: DataFrame, df: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) on full sets: linked (100 * intersection >= percent * union) and near (within twice that distance)."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, df, key, text, words)
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    both = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("shared"), (F.size("sa") + F.size("sb")).alias("sizes"))
    union = F.col("sizes") - F.col("shared")
    return both.select("a", "b", (100 * F.col("shared") >= percent * union).alias("linked"), (100 * F.col("shared") >= (2 * percent - 100) * union).alias("near"))


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many values every two sets share."""
    if len(sets) <= 8:
        out = np.zeros((len(sets), len(sets)))
        for i, j in zip(*np.triu_indices(len(sets), 1)):
            out[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.cumsum(count > 1) - 1
    keep = count[at] > 1
    owner, at = owner[keep], common[at[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    step = 1024
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, step):
        low, high = np.searchsorted(at, [start, start + step])
        has = np.zeros((len(sets), step), np.float32)
        has[owner[low:high], at[low:high] - start] = 1
        out += has @ has.T
    return out


def _union_similar(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """Similarity that the sketch of two sets' union shows."""
    union = np.union1d(a, b)[:size]
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)) / len(union)


def forest(nodes: list[bytes], roots: list[bytes], sizes: np.ndarray, sets: list[np.ndarray], percent: int, wide: int) -> Iterator[tuple[bytes, bytes, bool]]:
    """Pairs of the members of a list that connect all that are linked, each with whether it is needed at first.

    Sets of up to ``wide`` values are whole, so of their links a spanning forest is enough. Pairs with a longer
    one are estimated: a forest of the likeliest is tried first, the others only where its pairs fail.
    """
    shared = _shared(sets)
    whole = sizes <= wide
    length = np.minimum(sizes, wide)
    least = least_estimate(percent, wide)

    def near(rows: slice) -> tuple[np.ndarray, ...]:
        """Pairs of some rows with all later ones that may be linked: both, how alike, and whether that is sure."""
        i, j = np.nonzero(np.triu(shared[rows] >= (least > 0), rows.start + 1))
        i += rows.start
        c, sure = shared[i, j].astype(np.float64), whole[i] & whole[j]
        near_sizes = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
        enough = np.where(sure, 100 * c >= percent * (sizes[i] + sizes[j] - c), c >= least * np.minimum(length[i], length[j]))
        found = np.flatnonzero(near_sizes & enough)
        i, j = i[found], j[found]
        return i.astype(np.int32), j.astype(np.int32), c[found] / np.maximum(length[i], length[j]), sure[found]

    step = max(1, SLICE_PAIRS // len(nodes))
    i, j, alike, sure = map(np.concatenate, zip(*(near(slice(at, at + step)) for at in range(0, len(nodes), step))))
    del shared
    found = np.lexsort((-alike, ~sure))
    up = {r: r for r in roots}

    def top(r: bytes) -> bytes:
        while up[r] != r:
            up[r] = r = up[up[r]]
        return r

    sure_of = None
    for x in found:
        m, n = i[x], j[x]
        if not sure[x] and sure_of is None:
            sure_of = {r: top(r) for r in up}
        if sure_of and sure_of[roots[m]] == sure_of[roots[n]]:
            continue
        p, q = top(roots[m]), top(roots[n])
        if p == q and sure[x]:
            continue
        if not sure[x] and _union_similar(sets[m], sets[n], wide) < least:
            continue
        up[p] = q
        yield min(nodes[m], nodes[n]), max(nodes[m], nodes[n]), p != q


def compared(lists: DataFrame, sets: DataFrame, percent: int, list_rows: int, wide: int = WIDE) -> DataFrame:
    """Pairs of members of the same list (list, node, root, n, left) that ``forest`` gives: a, b, first.

    A list of more than ``list_rows`` members is cut into blocks, and every two blocks are compared.
    """
    blocks = F.ceil(F.col("left") / list_rows).cast("int")
    rows = lists.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("list", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "root", "n").join(sets, "node")
    rows = rows.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j").select("list", "i", "j", "node", "root", "n", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, roots, sizes, sets = None, [], [], [], []

        def pairs() -> pa.RecordBatch:
            found = list(forest(nodes, roots, np.array(sizes), sets, percent, wide)) if len(nodes) > 1 else []
            a, b, first = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(first, pa.bool_())], ["a", "b", "first"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(5))))
            n, held = batch.column(5).to_numpy(), batch.column(6)
            values, ends = held.flatten().to_numpy(), np.cumsum(held.value_lengths().to_numpy())
            for x, (*group, node, root) in enumerate(keys):
                if group != now:
                    yield pairs()
                    now, nodes, roots, sizes, sets = group, [], [], [], []
                nodes.append(node)
                roots.append(root)
                sizes.append(n[x])
                sets.append(values[ends[x - 1] if x else 0 : ends[x]].copy())
        yield pairs()

    return rows.mapInArrow(run, "a binary, b binary, first boolean")


def components(edges: DataFrame) -> DataFrame:
    """Nodes of the edges (a, b) with the smallest node they are connected to, as (node, root).

    Large and small stars in turn: every node's neighbours move to the smallest node around it, until
    nothing changes. Hubs only ever pass on one minimum, so long neighbour lists stay partial aggregates.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())

    # Kept as (a, b) with a > b.
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct())
    before = state(now)
    while before[0]:
        ways = now.union(now.select("b", "a"))
        least = ways.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = ways.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a")
        small = moved.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        now = checkpointed(small.distinct())
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def links(classes: DataFrame, df: DataFrame, key: str, text: str, words: int = 5, percent: int = 85, sketch: int = SKETCH, listed: int | None = None, star_rows: int = STAR_ROWS, list_rows: int = LIST_ROWS, levels: int = LEVELS, wide: int = WIDE) -> DataFrame | None:
    """Classes that are linked to others, with the smallest node of their component, as (node, root); None if there are none."""
    listed = listed or listed_for(percent)
    near = near_estimate(percent, sketch)
    posted = classes.select("node", F.col("n_shingles").alias("n"), F.explode(F.slice("sketch", 1, listed)).alias("list"))
    roots: DataFrame | None = None
    open_pairs: list[DataFrame] = []

    def confirm(pairs: DataFrame) -> DataFrame:
        return written(confirmed(pairs, classes, df, key, text, words, percent), "links")

    def connected(pairs: DataFrame) -> DataFrame:
        """The components so far, joined by more links."""
        ways = pairs.where("linked").select("a", "b")
        return components(ways if roots is None else ways.union(roots.select("node", "root")))

    def with_root(rows: DataFrame) -> DataFrame:
        if roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def propose(lists: DataFrame) -> None:
        sets = sets_of(lists.select("node").distinct(), classes, df, key, text, words, wide)
        open_pairs.append(written(compared(lists, sets, percent, list_rows, wide), "pairs"))

    for level in range(1, levels + 1):
        sizes = posted.groupBy("list").agg(F.count("*").alias("members")).where("members > 1")
        lists = written(posted.join(sizes, "list"), f"lists{level}")
        short = lists.where(F.col("members") <= star_rows).withColumn("left", F.col("members"))
        if star_rows > 1 and short.take(1):
            propose(short.withColumn("root", F.col("node")))
        long = lists.where(F.col("members") > star_rows)
        weight = long.groupBy("node").agg(F.sum("members").alias("weight"))
        hubs = long.join(weight, "node").groupBy("list").agg(F.max(F.struct("weight", "node")).alias("hub"))
        rest = long.join(hubs.select("list", F.col("hub.node").alias("hub")), "list").where(F.col("node") != F.col("hub"))
        rest = written(rest.withColumns({"a": F.least("node", "hub"), "b": F.greatest("node", "hub")}), "spokes")
        if not rest.take(1):
            break
        met = estimated(rest.select("a", "b").distinct(), classes, sketch)
        met = confirm(written(met.where(F.col("similar") >= near).select("a", "b"), "stars"))
        roots = connected(met)
        rest = with_root(rest.join(met, ["a", "b"], "left").withColumns({"linked": F.coalesce("linked", F.lit(False)), "near": F.coalesce("near", F.lit(False))}))
        rest = written(rest.select("list", "node", "n", "root", "linked", "near"), "met")
        other = F.when(~F.col("linked"), F.col("root"))
        mixed = rest.groupBy("list").agg(
            F.max(F.col("near") & ~F.col("linked")).alias("mixed"),
            F.count_if(~F.col("linked")).alias("others"),
            F.count("*").alias("left"),
            (F.min("root") != F.max("root")).alias("apart"),
            (F.min(other) != F.max(other)).alias("others_apart"),
        )
        # A list is settled if what is left of it is connected already.
        mixed = mixed.where(F.when(F.col("mixed"), F.col("apart")).otherwise(F.coalesce("others_apart", F.lit(False))))
        rest = rest.join(mixed, "list").where(F.col("mixed") | ~F.col("linked"))
        rest = rest.withColumn("left", F.when(F.col("mixed"), F.col("left")).otherwise(F.col("others")))
        rest = written(rest.select("list", "node", "n", "root", "left"), "rest")
        now = rest if level == levels else rest.where(F.col("left") <= list_rows)
        if now.take(1):
            propose(now)
        finer = rest.where(F.col("left") > list_rows)
        if level == levels or not finer.take(1):
            break
        posted = rarest(classes.join(finer.select("node").distinct(), "node", "left_semi"), percent)
    if not open_pairs:
        return roots
    pairs = reduce(DataFrame.union, open_pairs).groupBy("a", "b").agg(F.max("first").alias("first"))
    pairs = written(pairs, "waiting")
    if pairs.where("first").take(1):
        roots = connected(confirm(pairs.where("first")))
    later = pairs.where("not first").select("a", "b")
    if later.take(1):
        # A pair whose ends other links connect need not be confirmed.
        sides = later.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        sides = sides.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        later = written(sides.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "later")
        if later.take(1):
            roots = connected(confirm(later))
    return roots


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 85, **sizes: int) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest key it is linked to, over any number of links) and kept.

    ``kept`` is true where the key is the component's. A NULL or empty text, or one without words, has no
    shingles and is a component of its own. A row with a NULL key is linked only to rows of the same
    shingles; without such a row with a key its component is NULL and it is kept. Repeated rows are
    copies of each other under one key, all kept or none. Other columns are left out; an empty table gives no rows.
    """
    return grouped(df, key, text, words, percent, **sizes).drop("text_hash")


def grouped(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 85, **sizes: int) -> DataFrame:
    """``near_duplicates`` with the text_hash of each row."""
    with batch_rows(df.sparkSession, BATCH_ROWS):
        return _grouped(df, key, text, words, percent, **sizes)


def _grouped(df: DataFrame, key: str, text: str, words: int, percent: int, **sizes: int) -> DataFrame:
    rows = written(sketches(df, key, text, words, sizes.get("sketch", SKETCH)), "sketches")
    classes = rows.where(F.col("node").isNotNull()).groupBy("node")
    classes = written(classes.agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    roots = links(classes, df, key, text, words, percent, **sizes)
    named = classes.select("node", "rep")
    if roots is not None:
        roots = roots.join(named, "node")
        least = roots.groupBy("root").agg(F.min("rep").alias("least"))
        named = named.join(roots.join(least, "root").select("node", "least"), "node", "left")
        named = named.select("node", F.coalesce("least", "rep").alias("rep"))
    out = rows.select("doc_id", "text_hash", "node", "n_shingles").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("rep"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
