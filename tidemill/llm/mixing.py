"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target divided by its size says how often its documents are to be taken: a whole part that every document
gets, and a fraction that is an inclusion probability. The flight phase moves these probabilities along the null space
of the two balancing rows (document total, token total), so both totals are kept exactly while one document after
another reaches 0 or 1. A block of documents ends with at most two undecided; the undecided ones of all blocks of a
source are the next round's documents, until one block is left.

Scale: rows hold an id, a size and a source. A source is cut into blocks of about ``block_rows`` by a hash, so a source
with a third of all rows is as many tasks as its rows need. A round divides the undecided rows by half a block, so
100 billion documents take three rounds. Random choices are seeded per block: reruns agree.

Defined results: a null text has size 0 and is never taken; null is a source of its own, last in order; rows that
repeat are separate documents; targets are capped at ``max_repeats`` times a source's size; an empty table gives no
rows; no other column is read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import documents, row_hash, side, text_or_empty, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_ROWS = 5_000
LANDING = 12
_EPS = 1e-9


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size, n_docs).

    Filling to a common level: a source stops at its cap when the level passes cap / weight. Sorted by that ratio,
    source i is at its cap exactly if the level left for the sources from i on reaches its ratio. The windows without
    partition hold one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_repeats))
    rows = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / weight_left).withColumn("full", F.col("level") >= F.col("ratio"))
    open_level = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)  # the first open source's; it only sinks after
    target = F.when(F.col("full"), F.col("cap")).otherwise(open_level * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_size", "n_docs", "target")


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, keep: int = 0) -> np.ndarray:
    """Moves probabilities along the null space until at most two (plus the last ``keep`` units) are undecided.

    Units enter in the given order. Three undecided units and two balancing rows leave one direction; the step goes to
    the first bound met on either side, chosen so that every unit keeps its expectation.
    """
    x = p.astype(float).tolist()
    sizes = size.astype(float).tolist()
    draws = rng.random(2 * len(x) + 8)
    n, used, ahead = len(x) - keep, 0, 0
    window: list[int] = []
    while True:
        while len(window) < 3 and ahead < n:
            if _EPS < x[ahead] < 1 - _EPS:
                window.append(ahead)
            ahead += 1
        if len(window) >= 3:
            a, b, c = window
            u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)
        elif len(window) == 2 and sizes[window[0]] == sizes[window[1]]:
            u = (1.0, -1.0)
        else:
            return np.array(x)
        up = down = math.inf
        for i, step in zip(window, u):
            if step > 0:
                up, down = min(up, (1 - x[i]) / step), min(down, x[i] / step)
            elif step < 0:
                up, down = min(up, x[i] / -step), min(down, (1 - x[i]) / -step)
        move = up if draws[used] * (up + down) < down else -down
        used += 1
        left = []
        for i, step in zip(window, u):
            value = x[i] + move * step
            if value < _EPS:
                x[i] = 0.0
            elif value > 1 - _EPS:
                x[i] = 1.0
            else:
                x[i] = value
                left.append(i)
        window = left


def land(p: np.ndarray, size: np.ndarray, tolerance: float = 1.0) -> np.ndarray:
    """Decides all units given: nearest to the token total (steps of ``tolerance``), then to the document total."""
    tokens, docs = (p * size).sum(), p.sum()
    outcomes = np.array(list(product((0.0, 1.0), repeat=len(p))))
    off = np.abs(outcomes @ size.astype(float) - tokens)
    return outcomes[np.lexsort((off, np.abs(outcomes.sum(axis=1) - docs), np.floor(off / tolerance)))[0]]


def _round(seed: int, number: int, landing: int):
    def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        source, block, blocks = key
        # Large documents first, so that what is left at the end is small.
        rows = rows.sort_values(["size", "no_id", "doc_id", "tie"], ascending=[False, True, True, True], kind="stable")
        rng = np.random.default_rng([seed, number, int(block), zlib.crc32(repr(source).encode())])
        if blocks == 1:
            # The landing units stand back until all others are decided; they cover the whole range of sizes.
            back = np.unique(np.linspace(0, len(rows) - 1, min(landing, len(rows))).astype(int))
            rest = np.setdiff1d(np.arange(len(rows)), back)
            rows = rows.iloc[np.concatenate([rest, back])]
        else:
            back = ()
        size = rows["size"].to_numpy()
        x = flight(rows["p"].to_numpy(), size, rng, keep=len(back))
        if blocks == 1:
            left = np.flatnonzero((x > _EPS) & (x < 1 - _EPS))
            x[left] = land(x[left], size[left], max(1.0, 5e-4 * (rows["p"] * rows["size"]).sum()))
        return rows.assign(p=x).drop(columns=["_block", "_blocks"])

    return settle


def _by_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    named = per_source.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


_ROW = "doc_id bigint, no_id boolean, tie bigint, size bigint, source string, p double"


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = 1,
    block_rows: int = BLOCK_ROWS,
    landing: int = LANDING,
) -> DataFrame:
    """doc_id, row_hash, size, source, source_size, target, copies and taken (copies times size) of every row."""
    sized = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        row_hash().alias("tie"),
        word_count(text_or_empty()).cast("bigint").alias("size"),
        F.col("source").cast("string"),
    )
    sized = written(sized, "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = written(targets(sources, weights, max_repeats), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = side(sources.withColumn("rate", rate), 80)
    joined = _by_source(sized, rates)
    whole = F.least(F.floor(F.col("rate") + _EPS), F.lit(max_repeats)).cast("bigint")
    # A document without words changes no total.
    part = F.when(F.col("size") > 0, F.greatest(F.col("rate") - whole, F.lit(0.0))).otherwise(F.lit(0.0))
    rows = joined.withColumn("p", F.when(part > _EPS, part).otherwise(F.lit(0.0)))
    open_rows = rows.filter("p > 0").select("doc_id", "no_id", "tie", "size", "source", "p")
    decided, number = None, 0
    while True:
        per_source = open_rows.groupBy("source").agg(F.count("*").alias("_rows"))
        per_source = written(
            per_source.withColumn("_blocks", F.ceil(F.col("_rows") / block_rows).cast("int")), "mix-blocks"
        )
        most = per_source.agg(F.max("_blocks")).first()[0]
        if most is None:
            break
        counts = side(per_source.drop("_rows"), 48)
        dealt = _by_source(open_rows, counts)
        dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("doc_id", "no_id", "tie"), F.col("_blocks")).cast("int"))
        settled = dealt.groupBy("source", "_block", "_blocks").applyInPandas(_round(seed, number, landing), _ROW)
        settled = written(settled, "mix-round")
        done = settled.filter((F.col("p") <= 0) | (F.col("p") >= 1))
        decided = done if decided is None else decided.unionByName(done)
        open_rows, number = settled.filter((F.col("p") > 0) & (F.col("p") < 1)), number + 1
    columns = [F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), F.col("tie").alias("row_hash"), "size", "source"]
    plain = rows.filter("p = 0").select(*columns, F.lit(0.0).alias("p"))
    result = plain if decided is None else plain.unionByName(decided.select(*columns, "p"))
    back = side(sources.withColumn("whole", F.least(F.floor(rate + _EPS), F.lit(max_repeats)).cast("bigint")), 80)
    result = _by_source(result, back)
    copies = F.col("whole") + F.col("p").cast("bigint")
    return result.select(
        "doc_id", "row_hash", "size", "source", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
