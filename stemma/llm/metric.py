"""Radius join of words under the edit metric by metric-space partitioning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.edits import alike, coded, damages, deletes, half_edit_pairs
from stemma.sources.tables import broadcast_checked, cut

#: Pivots: this many times the square root of the words. A word has fewer copies with fewer
#: pivots, and what is done within a cell grows only with its words.
PIVOT_FACTOR = 0.5
#: Words of a block of a cell that are compared with as many others, and of all blocks that a
#: task holds at once.
GROUP = 20_000


def _distances(words: tuple, pivots: tuple) -> np.ndarray:
    n, m = len(words[2]), len(pivots[2])
    out = np.empty((n, m), np.int32)
    step = max(1, 100_000 // max(1, m))
    for lo in range(0, n, step):
        k = min(step, n - lo)
        out[lo : lo + k] = half_edit_pairs(words, np.repeat(np.arange(lo, lo + k), m), pivots, np.tile(np.arange(m), k)).reshape(k, m)
    return out


def _near(homes: list[tuple], members: list[tuple], radius: int) -> tuple[list[int], list[int]]:
    """Places of the pairs of (block, ring, word), home < member, of a block that may lie within
    the radius: their distances to the pivot differ by no more, and where confused letters
    are one, half as many deletions on each side make them equal."""
    by: dict[tuple, list[int]] = {}
    for j, (block, _, w) in enumerate(members):
        for k in deletes(alike(w), radius // 2):
            by.setdefault((block, k), []).append(j)
    found = set()
    for i, (block, ring, w) in enumerate(homes):
        for k in deletes(alike(w), radius // 2):
            found.update((i, j) for j in by.get((block, k), ()) if members[j][2] > w and abs(members[j][1] - ring) <= radius)
    return [i for i, _ in found], [j for _, j in found]


def radius_join(words: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b), a < b: all pairs of words at most ``radius`` half edits apart (``half_edits``:
    at 2 one edit, or two letters that scanners confuse).

    words: (word), distinct, of any length. Words drawn by hash are pivots, in
    proportion to the square root of the words; a word lives in the cell of its nearest
    pivot, at distance d, and is copied into every cell whose pivot is at most d + 2 * radius
    away: by the triangle inequality a word within the radius of another is then in the
    cell where the other lives, and their distances to its pivot differ by at most the radius.
    Cells are cut into blocks of at most about GROUP words a side, so a crowded
    cell is many groups of a task each; small cells share one. Within a block, candidates are
    found by deletions and measured exactly. Null and empty words have no
    pairs. The pivots that every task holds grow as the square root of the words.
    """
    words = words.where("word is not null and word <> ''").select("word")
    n = words.count()
    chosen = [r.word for r in words.orderBy(F.xxhash64("word")).limit(int(max(1, PIVOT_FACTOR * n**0.5))).collect()]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = coded(chosen)
        for b in batches:
            for lo in range(0, len(b), 2_000):
                w = b["word"].iloc[lo : lo + 2_000].to_numpy()
                d = _distances(coded(list(w)), pivots)
                home = d.argmin(1)
                row, cell = np.nonzero(d <= d[np.arange(len(w)), home][:, None] + 2 * radius)
                yield pd.DataFrame({"cell": cell.astype(np.int32), "ring": d[row, cell], "word": w[row], "home": home[row] == cell})

    placed = cut(words.repartition(max(8, n // 2_000), "word").mapInPandas(assign, "cell int, ring int, word string, home boolean"))
    sizes = broadcast_checked(placed.groupBy("cell").agg(F.ceil(F.sum(F.col("home").cast("int")) / GROUP).cast("int").alias("nh"), F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("nm")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1))
    own = lambda n: F.pmod(F.xxhash64("word"), F.greatest(F.col(n), F.lit(1))).cast("int")
    met = placed.join(sizes, "cell")
    homes = met.where("home").withColumn("part", every("nm")).withColumn("side", own("nh")).withColumn("homely", F.lit(True))
    members = met.withColumn("part", own("nm")).withColumn("side", every("nh")).withColumn("homely", F.lit(False))
    blocks = homes.unionByName(members).select(F.concat_ws("|", "cell", "part", "side").alias("block"), "ring", "word", "homely")
    groups = max(1, -(-placed.count() // GROUP))

    def compare(b: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(b["block"], b["ring"], b["word"]))
        x, y = ([r for r, h in zip(rows, b["homely"]) if h == own] for own in (True, False))
        i, j = _near(x, y, radius)
        if not i:
            return pd.DataFrame([], columns=["a", "b"])
        i, j = np.array(i), np.array(j)
        near = half_edit_pairs(coded([r[2] for r in x]), i, coded([r[2] for r in y]), j) <= radius
        return pd.DataFrame([(x[p][2], y[q][2]) for p, q in zip(i[near], j[near])], columns=["a", "b"])

    return blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")).applyInPandas(compare, "a string, b string").distinct()


def swapped(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of words that differ by two neighbouring letters changing
    places. Such words have the same letters, so they are at distance 0 under the bag metric:
    an equi-join on the sorted letters; then the places are compared."""
    keyed = words.where("word is not null").select("word", F.array_join(F.array_sort(F.split("word", "")), "").alias("bag"))
    both = keyed.select("bag", F.col("word").alias("a")).join(keyed.select("bag", F.col("word").alias("b")), "bag").where("a < b")
    differ = F.filter(F.sequence(F.lit(1), F.length("a")), lambda i: F.substring("a", i, F.lit(1)) != F.substring("b", i, F.lit(1)))
    return both.withColumn("at", differ).where("size(at) = 2 and at[1] = at[0] + 1").select("a", "b")


def damaged(words: DataFrame, long: int, head: int = 0) -> DataFrame:
    """(a, b, d), a < b: all pairs of words at one damage, and at two if the longer one has
    ``long`` letters; the first ``head`` signs count as none and must be equal.

    A damage is an edit or a swap of neighbours. Words that far apart become equal by as many
    deletions on each side: an equi-join on what deletions leave, then an exact measure.
    """

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 1_000):
                out = [(w[:head] + k, w) for w in b["word"].iloc[lo : lo + 1_000] for k in deletes(w[head:], 2 if len(w) - head >= long - 2 else 1)]
                yield pd.DataFrame(out, columns=["left", "word"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = [damages(x[head:], y[head:]) for x, y in zip(b["a"], b["b"])]
            near = [k <= 1 + (max(len(x), len(y)) - head >= long) for k, x, y in zip(d, b["a"], b["b"])]
            yield b.assign(d=d)[near]

    words = words.where(F.length("word") > head).select("word")
    keyed = cut(words.repartition("word").mapInPandas(leave, "left string, word string"))
    both = keyed.select("left", F.col("word").alias("a")).join(keyed.select("left", F.col("word").alias("b")), "left").where("a < b")
    return both.select("a", "b").distinct().mapInPandas(measure, "a string, b string, d int")
