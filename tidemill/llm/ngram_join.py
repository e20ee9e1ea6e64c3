"""Self-join of documents on the Jaccard likeness of their word shingles, exact, by T-occurrence search.

1. Copies: rows with the same text become one node (grouped by two hashes of the text).
2. Order: shingles that many documents share are put last. How common a shingle is, is counted on a sample of nodes;
   the table of common shingles is bounded and only decides the order, never the result.
3. Prefixes: sets of n shingles with likeness t share at least k among the first n - ceil(t n) + k of each in one common
   order (k: a tenth of n), so only these are shuffled. Within a shingle, sorted by set size, neighbours whose sizes can
   meet the threshold are tied, each to the first of its run: as many ties as rows, no pairs.
4. Families: ties that several shingles repeat make groups. Each group's sets go to one task, which indexes them by
   shingle and runs DivideSkip: the overlap T a partner must reach is known, the longest inverted lists are set aside,
   the short ones are merged, nodes that reach T minus the number of long lists are probed in these by binary search.
   Nodes already in one component are not compared again.
5. The rest: shingles inside one family are done with. A node can have a link out of its family only if k of its prefix
   shingles lie in other families too; nodes that pass (twice over) are tied and searched in the same way.
6. A group too large for a task is cut into blocks, bounded in rows and in shingles, of sets of similar size. Rounds of
   query nodes (twice as many each round) are streamed past the blocks whose sizes they can meet; nodes of the largest
   component so far need no search of their own. It ends when every node was searched or belongs to that component, so no
   link between components is lost.

Defined results: null and empty texts and texts of blanks have an empty set and link with nothing; a text with fewer
words than a shingle is one shingle; rows that repeat a text share its component; a null doc_id is never a component id
unless it stands alone; an empty table gives no rows; no column but doc_id and text is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.keyed import top_per_key
from tidemill.llm.common import Spans, blocks, documents, mix64, row_hash, side, text_bytes, text_or_empty, written
from tidemill.llm.components import components

WORDS = 5
PERCENT = 75
SHARED_PERCENT = 10
STRONG_PERCENT = 5
SAMPLE_DOCS = 20_000
COMMON_LIMIT = 200_000
GROUP_ROWS = 20_000
GROUP_SHINGLES = 3_000_000
BLOCK_ROWS = 1000
BLOCK_SHINGLES = 1_000_000
FIRST_QUERIES = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, lower-cased, and the number of words of each document."""
    if not len(body):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~_BLANK[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return Spans(_LOWER[body]).hash(starts, ends), counts


_PLACE = mix64(np.arange(11, 11 + 64, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    hashes, counts = word_hashes(body, offsets)
    ends = np.cumsum(counts)
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        rolled = np.full(n, np.uint64(words))
        for i in range(words):
            rolled += hashes[i : i + n] * _PLACE[i]
        rolled = mix64(rolled)
    out = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= words:
            part = np.sort(rolled[end - count : end - words + 1])
            out.append(part[np.concatenate([[True], part[1:] != part[:-1]])])
        elif count:
            part = hashes[end - count : end]
            out.append(mix64(np.array([np.uint64(count) + (part * _PLACE[:count]).sum(dtype=np.uint64)])))
        else:
            out.append(part_of_nothing)
    return out


part_of_nothing = np.zeros(0, np.uint64)


class Order:
    """Ranks shingles: those not known to be common first, then by how common, then by hash."""

    def __init__(self, shingles: np.ndarray, classes: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.classes = shingles[order], classes[order]
        self.hint = np.zeros(1 << 20, bool)
        self.hint[(self.shingles >> np.uint64(44)).astype(np.int64)] = True

    def prefix(self, own: np.ndarray, percent: int) -> np.ndarray:
        n = len(own)
        length = n - -(-percent * n // 100) + max(1, SHARED_PERCENT * n // 100) if n else 0
        maybe = np.flatnonzero(self.hint[(own >> np.uint64(44)).astype(np.int64)])
        if len(maybe):
            at = np.searchsorted(self.shingles, own[maybe])
            hit = self.shingles[np.minimum(at, len(self.shingles) - 1)] == own[maybe]
            if hit.any():
                classes = np.zeros(n, np.int64)
                classes[maybe[hit]] = self.classes[at[hit]]
                return own[np.argsort(classes, kind="stable")[:length]]
        return own[:length]


def needed(a: int, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets with a and b members that reaches the threshold."""
    return -(-percent * (a + b) // (100 + percent))


class Index:
    """Inverted lists of a group's sets; ``search`` is DivideSkip."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.docs = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[order]
        tokens = tokens[order]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        self.tokens, self.starts = tokens[first], np.concatenate([first, [len(tokens)]])
        self.longest = int(np.diff(self.starts).max())

    def search(self, query: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Members with ``wanted`` set whose likeness to the query reaches the threshold."""
        at = np.searchsorted(self.tokens, query)
        at = at[at < len(self.tokens)] if not len(query) else at
        hit = self.tokens[np.minimum(at, len(self.tokens) - 1)] == query
        lists, found = at[hit], query[hit]
        least = -(-self.percent * len(query) // 100)
        if len(lists) < least:
            return np.zeros(0, np.int64)
        lengths = self.starts[lists + 1] - self.starts[lists]
        by_length = np.argsort(lengths, kind="stable")
        n_long = min(int(least / (0.0085 * math.log2(self.longest + 1) + 1)), least - 1)
        short, long = by_length[: len(lists) - n_long], by_length[len(lists) - n_long :]
        runs = lengths[short]
        ends = np.cumsum(runs)
        merged = self.docs[np.repeat(self.starts[lists[short]] - (ends - runs), runs) + np.arange(ends[-1])]
        counts = np.bincount(merged, minlength=len(self.sets))
        goal = needed(len(query), self.sizes, self.percent)
        candidates = np.flatnonzero((counts >= np.maximum(goal - n_long, 1)) & wanted)
        probes = np.sort(found[long])
        for i, c in enumerate(candidates.tolist()):
            own = self.sets[c]
            place = np.searchsorted(own, probes)
            overlap = counts[c] + int((own[np.minimum(place, len(own) - 1)] == probes).sum())
            if overlap < goal[c]:
                candidates[i] = -1
        return candidates[candidates >= 0]


def link_group(sets: list[np.ndarray], labels: list[int], percent: int = PERCENT) -> np.ndarray:
    """Component number (the first member's place) of each set of a group; equal labels are linked already."""
    place: dict[int, int] = {}
    root = np.array([place.setdefault(label, i) for i, label in enumerate(labels)])
    if len(place) == 1:
        return root
    index = Index(sets, percent)
    for i, own in enumerate(sets):
        other = root != root[i]
        if not other.any():
            break
        for j in index.search(own, other).tolist():
            a, b = sorted((root[i], root[j]))
            if a != b:
                root[root == b] = a
    return root


def _sets_of(batch: pa.RecordBatch, words: int) -> list[np.ndarray]:
    return shingle_sets(*text_bytes(batch.column("text")), words)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _as_sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in column.to_pylist()]


def _search_groups(percent: int):
    """Streams groups sorted by number; a group is complete when the next begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, labels, sets = None, [], [], []

        def finish() -> pa.RecordBatch:
            root = link_group(sets, labels, percent)
            ids = np.array(nodes, np.int64)
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, root, ids)
            other = least[root] != ids
            return pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(least[root][other])], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("root", "node", "label", "shingles")]
            for key, node, label, blob in zip(*columns):
                if key != group:
                    if len(nodes) > 1:
                        yield finish()
                    group, nodes, labels, sets = key, [], [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node)
                    labels.append(label)
                    sets.append(np.frombuffer(blob, np.uint64))
        if len(nodes) > 1:
            yield finish()

    return run


def _search_blocks(percent: int):
    """Query sets against the other sets of each block, which come first; queries are streamed past the block's index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, nodes, sets, index, ids, u, v = None, [], [], None, None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("root", "block", "is_query", "node", "shingles")]
            for root, number, is_query, node, blob in zip(*columns):
                if (root, number) != block:
                    block, nodes, sets, index = (root, number), [], [], None
                own = np.frombuffer(blob, np.uint64)
                if not is_query:
                    nodes.append(node)
                    sets.append(own)
                elif sets:
                    if index is None:
                        index, ids = Index(sets, percent), np.array(nodes, np.int64)
                    hits = ids[index.search(own, ids != node)].tolist()
                    u += [node] * len(hits)
                    v += hits
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                u, v = [], []

    return run


def _size_band(size: Column, percent: int) -> Column:
    """Sets that can be alike are in the same band or in neighbouring ones."""
    if percent >= 100:
        return size.cast("bigint")
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(100 / percent)) + 1e-9).cast("bigint")


def _link_large(sets: DataFrame, percent: int, block_rows: int, block_shingles: int, first_queries: int) -> DataFrame:
    """Links of groups that are cut into blocks; ``sets`` has root, node, label, shingles and is a written table.

    A block holds sets of one size band, bounded in rows and in shingles; a query visits the blocks of its own band and of
    the next ones below and above, as no others can reach the threshold.
    """
    size = F.octet_length("shingles") / 8
    bands = sets.groupBy("root", _size_band(size, percent).alias("band")).agg(F.count("*").alias("_rows"), F.sum(size).alias("_all"))
    blocks_of = F.greatest(F.ceil(F.col("_rows") / block_rows), F.ceil(F.col("_all") / block_shingles)).cast("int")
    bands = written(bands.select("root", "band", blocks_of.alias("_blocks")), "join-blocks")
    banded = sets.withColumn("band", _size_band(size, percent))
    place = F.struct(F.col("band").alias("band"), F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int").alias("part"))
    dealt = banded.join(side(bands, 32), ["root", "band"]).withColumn("block", place)
    parts = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("part")
    every_block = bands.select("root", "band", parts).select("root", "band", F.struct("band", "part").alias("block"))
    links = written(sets.filter("node != label").select(F.col("node").alias("u"), F.col("label").alias("v")), "join-links")
    searched, count = None, first_queries
    while True:
        labels = written(components(links), "join-labels").select("node", F.col("root").alias("main_label"))
        state = sets.select("root", "node").join(labels, "node", "left")
        state = state.withColumn("main_label", F.coalesce("main_label", "node"))
        sizes = state.groupBy("root", "main_label").agg(F.count("*").alias("_n"))
        main = sizes.groupBy("root").agg(F.max(F.struct("_n", "main_label"))["main_label"].alias("main"))
        state = state.join(main, "root").filter((F.col("main_label") != F.col("main")) | F.lit(searched is None))
        if searched is not None:
            state = state.join(searched, "node", "left_anti")
        queries = top_per_key(state, ["root"], [F.xxhash64("node"), F.col("node")], count)
        queries = written(queries.select("root", "node"), "join-queries")  # count rows of each group at most
        if not queries.limit(1).count():
            return links
        asked = banded.join(side(queries, 16), ["root", "node"], "left_semi")
        near = F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band")
        asked = asked.select("root", "node", "shingles", near).join(every_block, ["root", "band"])
        columns = ["root", "block", "is_query", "node", "shingles"]
        visited = written(asked.select("root", "block").distinct(), "join-visited")
        work = asked.withColumn("is_query", F.lit(True)).select(*columns)
        others = dealt.join(side(visited, 24), ["root", "block"], "left_semi")
        work = work.unionByName(others.withColumn("is_query", F.lit(False)).select(*columns))
        work = work.repartition("root", "block").sortWithinPartitions("root", "block", "is_query")
        work = work.withColumn("block", F.to_json("block"))
        found = written(work.mapInArrow(_search_blocks(percent), "u bigint, v bigint"), "join-links")
        links = links.unionByName(found)
        now = queries.select("node")
        searched = now if searched is None else searched.unionByName(now)
        count *= 2


def _tied(entries: DataFrame, percent: int) -> DataFrame:
    """Entries (node, n, shingle) that share their shingle, with ``u``: the first of the run of sizes they belong to."""
    by_size = Window.partitionBy("shingle").orderBy("n", "node")
    smaller = F.lag("n").over(by_size)
    begins = smaller.isNull() | (smaller * 100 < F.col("n") * percent)
    shared = smaller.isNotNull() | F.lead("n").over(by_size).isNotNull()
    marked = entries.withColumn("_first", F.when(begins, F.col("node"))).withColumn("_shared", shared)
    first = F.last("_first", ignorenulls=True).over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("u", first).filter("_shared").select("node", "n", "shingle", "u")


def ngram_components(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    group_rows: int = GROUP_ROWS,
    group_shingles: int = GROUP_SHINGLES,
    block_rows: int = BLOCK_ROWS,
    block_shingles: int = BLOCK_SHINGLES,
    first_queries: int = FIRST_QUERIES,
) -> DataFrame:
    """One row per document: doc_id, row_hash, n_shingles and component_id."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("bigint"), row_hash().alias("h1"), F.xxhash64(F.lit(7), text_or_empty()).alias("h2"), "text"
    )
    rows = written(texts.drop("text"), "join-rows")
    nodes = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least_id"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    n_nodes = nodes.count()

    def of_nodes(wanted: DataFrame) -> DataFrame:
        """(node, text) of the first row of each wanted node; the text stays where it is read if that is possible."""
        found = texts.join(side(wanted, 48), ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("least_id")))
        return found.drop("h1", "h2", "doc_id", "least_id")

    one_in = max(16, n_nodes // SAMPLE_DOCS)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=1 << 19):
            flat = np.concatenate([part_of_nothing, *_sets_of(block, words)])
            yield pa.RecordBatch.from_arrays([pa.array(_signed(flat))], names=["shingle"])

    some = nodes.filter(F.pmod("node", F.lit(one_in)) == 0) if n_nodes < 1000 else nodes.filter(
        F.pmod(F.xxhash64("node"), F.lit(one_in)) == 0
    )
    common = of_nodes(some).mapInArrow(sampled, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n"))
    common = common.filter("n > 2").orderBy(F.desc("n"), "shingle").limit(COMMON_LIMIT).toPandas()
    classes = np.floor(np.log2(common["n"].to_numpy(np.float64))).astype(np.int64)
    order = spark.sparkContext.broadcast(Order(common["shingle"].to_numpy(np.int64).view(np.uint64), classes))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=1 << 19):
            sets = _sets_of(block, words)
            firsts = [_signed(order.value.prefix(s, percent)) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([_signed(part_of_nothing), *firsts])))
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([block.column("node"), n, lists], names=["node", "n", "prefix"])

    heads = of_nodes(nodes).mapInArrow(prefixes, "node bigint, n bigint, prefix array<bigint>")
    heads = written(heads, "join-prefixes")
    sizes = heads.groupBy("node").agg(F.max("n").alias("n"))
    entries = heads.select("node", "n", F.explode("prefix").alias("shingle"))
    entries = written(_tied(entries, percent), "join-entries")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=1 << 19):
            blobs = pa.array([s.tobytes() for s in _sets_of(block, words)], pa.binary())
            names = ["root", "node", "label"]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in names), blobs], names=[*names, "shingles"])

    def links_of(ties: DataFrame, labels: DataFrame | None) -> DataFrame:
        """(u, v) links that connect all linked nodes of each component of the ties."""
        groups = written(components(ties).join(sizes, "node"), "join-groups")
        totals = groups.groupBy("root").agg(F.count("*").alias("_rows"), F.sum("n").alias("_all"))
        small = (F.col("_rows") <= group_rows) & (F.col("_all") <= group_shingles)
        totals = written(totals.withColumn("small", small | (F.col("_rows") <= 2)), "join-totals")
        wanted = nodes.join(groups.select("node", "root"), "node").join(side(totals.select("root", "small"), 24), "root")
        if labels is None:
            wanted = wanted.withColumn("label", F.col("node"))
        else:
            wanted = wanted.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        wanted = written(wanted.select("h1", "h2", "least_id", "node", "label", "root", "small"), "join-wanted")
        shipped = "root bigint, node bigint, label bigint, shingles binary"
        sets = of_nodes(wanted.filter("small").drop("small")).mapInArrow(full, shipped)
        sets = sets.repartition("root").sortWithinPartitions("root", "node")
        found = written(sets.mapInArrow(_search_groups(percent), "u bigint, v bigint"), "join-found")
        if totals.filter("NOT small").limit(1).count():
            large = of_nodes(wanted.filter("NOT small").drop("small")).mapInArrow(full, shipped)
            large = written(large, "join-large")
            # Rows that repeat a doc_id and a text bring the same set more than once.
            if large.select("node").distinct().count() < large.count():
                large = written(large.dropDuplicates(["node"]), "join-large")
            found = found.unionByName(_link_large(large, percent, block_rows, block_shingles, first_queries))
        return found

    ties = entries.filter("u != node").groupBy("u", F.col("node").alias("v")).agg(
        F.count("*").alias("_times"), F.max("n").alias("_n")
    )
    found = links_of(ties.filter(F.col("_times") * 100 >= F.col("_n") * STRONG_PERCENT).select("u", "v"), None)
    labels = written(components(found), "join-labels").select("node", F.col("root").alias("label"))
    # A link out of a family needs this many prefix shingles in common with a set of at least t n members.
    at_least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) * SHARED_PERCENT / 100))
    rest = entries.select("node", "n", "shingle").join(labels, "node", "left")
    rest = rest.withColumn("label", F.coalesce("label", "node"))
    for _ in range(2):
        families = rest.groupBy("shingle").agg(F.min("label").alias("_a"), F.max("label").alias("_b"))
        rest = rest.join(families.filter("_a != _b").select("shingle"), "shingle", "left_semi")
        able = rest.groupBy("node").agg(F.count("*").alias("_times"), F.max("n").alias("n"))
        rest = written(rest.join(able.filter(F.col("_times") >= at_least).select("node"), "node", "left_semi"), "join-rest")
    ties = _tied(rest, percent).filter("u != node").select("u", F.col("node").alias("v")).distinct()
    more = links_of(ties, labels)
    # what the first search linked is known as stars by now
    known = labels.filter("node != label").select(F.col("node").alias("u"), F.col("label").alias("v"))
    found = written(components(known.unionByName(more)), "join-links")
    ids = nodes.select("node", "least_id")
    linked = found.join(ids, "node")
    least = linked.groupBy("root").agg(F.min("least_id").alias("component"))
    linked = linked.join(least, "root").select("node", "component")
    result = nodes.join(sizes, "node").join(linked, "node", "left")
    result = written(result.select("h1", "h2", "n", "least_id", "component"), "join-result")
    own = F.when(F.col("n") > 0, F.coalesce("component", "least_id", "doc_id")).otherwise(F.col("doc_id"))
    return rows.join(side(result, 48), ["h1", "h2"]).select(
        "doc_id", F.col("h1").alias("row_hash"), F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir)).drop("row_hash")
