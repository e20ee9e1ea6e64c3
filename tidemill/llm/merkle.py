"""Merkle manifest of a document table by a nested-struct rollup.

A leaf is the SHA-256 of a row's fields, each written as its UTF-8 byte count, ``:`` and its value (``-`` for null). The
leaves of a source ascend by doc_id; every ``FAN`` neighbours become the digest of their joined hex digests until one node,
the subroot, is left (a lone leaf is its own subroot). Subroots in order of source, null first, give the root in the same way.

A node's rank, written in base ``FAN``, is its path. The digits are columns: grouping away the lowest one nests the nodes
of a run, in order, in the struct of their parent, and so on up to the top of a block of ``FAN ** DEPTH`` nodes. A block is
one row of bounded size; rows of a block meet in one shuffle, as hashing on the block serves every digit. The blocks of
a tree are the nodes of its next round, so a source may hold any share of the rows. Downwards, what stands above a
block is united with it, and one ``transform`` over the nested structs and one ``explode`` give each node the siblings on its
way to the root: no join, neither between rounds nor for the proofs.

Only digests, ids and carried columns travel; a text is hashed where it is read.

Defined results: equal doc_ids stand in order of their leaves; rows that repeat are leaves of their own; a null doc_id comes
first and, as the empty text, has the checksum 0 and so counts as tampered with; an empty table gives no rows; only doc_id,
source, lang, n_chars and text are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents, held_out, written
from tidemill.llm.ranks import ranked

FAN = 16
DEPTH = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = "array<struct<left:string,right:string>>"


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row; ``changed`` puts other columns in the place of its own."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _rollup(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes (_tree, _rank, _size, digest, item): _tree, _block, _size, _blocks, digest and the nested ``kids``.

    ``_size`` is the number of nodes of the tree; a level on which only one is left is not hashed any more.
    """
    span = FAN**DEPTH
    digits = [F.pmod(F.floor(F.col("_rank") / F.lit(FAN**k)), F.lit(FAN)).cast("int") for k in range(DEPTH)]
    names = [f"_d{k}" for k in range(1, DEPTH)]
    level = nodes.select(
        "_tree",
        F.floor(F.col("_rank") / F.lit(span)).alias("_block"),
        "_size",
        *[d.alias(n) for d, n in zip(digits[1:], names)],
        F.struct(digits[0].alias("digit"), "digest", "item").alias("node"),
    ).repartition("_tree", "_block")
    for k in range(DEPTH):
        kids = level.groupBy("_tree", "_block", "_size", *names[k:]).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        alone = F.col("_size") <= FAN**k
        digest = F.when(alone, F.col("kids")[0]["digest"]).otherwise(F.sha2(_joined(F.col("kids.digest")), 256))
        level = kids.withColumn("digest", digest)
        if k < DEPTH - 1:
            node = F.struct(F.col(names[k]).alias("digit"), "digest", "kids").alias("node")
            level = level.select("_tree", "_block", "_size", *names[k + 1 :], node)
    blocks = F.ceil(F.col("_size") / F.lit(span)).alias("_blocks")
    return level.select("_tree", "_block", "_size", blocks, "digest", "kids")


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of blocks from the nodes up to one block per tree."""
    rounds = []
    while True:
        rounds.append(written(_rollup(nodes), "merkle-blocks"))
        most = rounds[-1].agg(F.max("_blocks")).first()[0]
        if most is None or most <= 1:
            return rounds
        item = F.struct("_block").alias("item")
        nodes = rounds[-1].select("_tree", F.col("_block").alias("_rank"), F.col("_blocks").alias("_size"), "digest", item)


def _paths(kids: Column, depth: int) -> Column:
    """Every node below ``kids``: its item, its digest and its siblings level by level."""
    alone = F.col("_size") <= FAN ** (depth - 1)

    def step(kid: Column, at: Column) -> Column:
        digests = F.transform(kids, lambda k: k["digest"])
        left, right = _joined(F.slice(digests, F.lit(1), at)), _joined(F.slice(digests, at + 2, F.lit(FAN)))
        own = F.when(alone, F.array().cast(PROOF)).otherwise(F.array(F.struct(left.alias("left"), right.alias("right"))))
        if depth == 1:
            return F.array(F.struct(kid["item"].alias("item"), kid["digest"].alias("digest"), own.alias("way")))
        below = _paths(kid["kids"], depth - 1)
        return F.transform(below, lambda p: F.struct(p["item"], p["digest"], F.concat(p["way"], own).alias("way")))

    return F.flatten(F.transform(kids, step))


def _descend(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """One row per node of the blocks: item, digest, and ``over``: its siblings up to the root, subroot and root.

    ``above`` (_tree, _block, over) has one row per block; the two meet in a group of two rows.
    """
    both = blocks.select("_tree", "_block", "_size", "kids").unionByName(above, allowMissingColumns=True)
    first = [F.first(c, ignorenulls=True).alias(c) for c in ("_size", "kids", "over")]
    found = both.groupBy("_tree", "_block").agg(*first).select("_tree", "over", F.explode(_paths(F.col("kids"), DEPTH)).alias("p"))
    way = F.concat("p.way", "over.proof").alias("proof")
    return found.select("_tree", "p.item", "p.digest", F.struct(way, "over.subroot", "over.root").alias("over"))


def _over(proof: Column, subroot: Column, root: Column) -> Column:
    return F.struct(proof.cast(PROOF).alias("proof"), subroot.alias("subroot"), root.alias("root")).alias("over")


def manifest(docs: DataFrame, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, ``proof`` and the ``carry`` columns.

    ``proof`` lists, from the leaf to the root, the joined digests left and right of the document's own node; ``folded`` turns
    a leaf and a proof into a root. ``carry`` names narrow expressions over the columns of ``docs``.
    """
    carry = dict(carry or {})
    leaves = docs.select(
        F.col("source").alias("_tree"),
        F.col("doc_id").alias("_id"),
        leaf_digest().alias("digest"),
        F.struct("doc_id", *[c.alias(n) for n, c in carry.items()]).alias("item"),
    )
    lower = _climb(ranked(leaves, "_tree", ["_id", "digest"]).select("_tree", "_rank", "_size", "digest", "item"))
    subroots = lower[-1].select(F.lit("").alias("_tree"), F.col("_tree").alias("_source"), "digest")
    tops = ranked(subroots, "_tree", ["_source"])
    upper = _climb(tops.select("_tree", "_rank", "_size", "digest", F.struct("_source").alias("item")))
    none = F.lit(None).cast("string")
    found = upper[-1].select("_tree", "_block", _over(F.array(), none, F.col("digest")))
    for k, blocks in reversed(list(enumerate(upper))):
        found = _descend(blocks, found)
        found = found.select("_tree", "item._block", "over") if k else found
    over = _over(F.col("over.proof"), F.col("digest"), F.col("over.root"))
    found = found.select(F.col("item._source").alias("_tree"), F.lit(0).cast("bigint").alias("_block"), over)
    for k, blocks in reversed(list(enumerate(lower))):
        found = _descend(blocks, found)
        found = found.select("_tree", "item._block", "over") if k else found
    return found.select(
        "item.doc_id",
        F.col("_tree").alias("source"),
        F.col("digest").alias("leaf"),
        "over.subroot",
        "over.root",
        "over.proof",
        *[F.col("item")[n].alias(n) for n in carry],
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda digest, p: F.sha2(F.concat(p["left"], digest, p["right"]), 256))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = leaf_digest(text=F.translate("text", UPPER, LOWER))
    found = manifest(documents(spark, sf_dir), {"tampered": F.when(held_out(), changed)})
    siblings = F.sha2(_joined(F.transform("proof", lambda p: F.concat(p["left"], p["right"]))), 256)
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings.alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_CHECKSUM = (
    "(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)), "
    "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"
)


def _sql_leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256(concat({', '.join(fields)}))"


_RUNS = """
{name} AS (
    SELECT tree, 0 AS level, pos, digest, size FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), any_value((size + 15) // 16)
    FROM {name} WHERE size > 1 GROUP BY tree, level, pos // 16)"""

ORACLE_SQL = f"""
WITH RECURSIVE d AS (
    SELECT *, xor({_CHECKSUM.format("coalesce(doc_id::VARCHAR, '')")}, 4294967295) % 5 = 0 AS hit FROM documents),
h AS (
    SELECT doc_id, source AS tree, {_sql_leaf("text")} AS digest,
        CASE WHEN hit THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM d),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS size FROM h),
{_RUNS.format(name="low", leaves="leaves")},
tops AS (
    SELECT tree AS source, digest AS subroot, 0 AS tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos,
        count(*) OVER () AS size FROM low WHERE size = 1),
{_RUNS.format(name="high", leaves="tops")},
runs AS (
    SELECT 0 AS part, tree AS source, level, pos // 16 AS run, list(digest ORDER BY pos) AS ds FROM low WHERE size > 1 GROUP BY ALL
    UNION ALL
    SELECT 1, NULL, level, pos // 16, list(digest ORDER BY pos) FROM high WHERE size > 1 GROUP BY level, pos // 16),
heights AS (SELECT tree AS source, max(level) AS height FROM low GROUP BY tree),
way AS (
    SELECT l.doc_id, l.tree AS source, l.digest AS leaf, t.subroot, t.pos AS top, h.height, 0 AS step, l.pos,
        coalesce(l.other, l.digest) AS cur, '' AS proof, l.pos AS start
    FROM leaves l JOIN tops t ON t.source IS NOT DISTINCT FROM l.tree JOIN heights h ON h.source IS NOT DISTINCT FROM l.tree
    UNION ALL
    SELECT w.doc_id, w.source, w.leaf, w.subroot, w.top, w.height, w.step + 1,
        CASE WHEN w.step + 1 = w.height THEN w.top ELSE p // 16 END,
        sha256(array_to_string(ds[:p % 16], '') || w.cur || array_to_string(ds[p % 16 + 2:], '')),
        w.proof || array_to_string(ds[:p % 16], '') || array_to_string(ds[p % 16 + 2:], ''), w.start
    FROM (SELECT *, CASE WHEN step = height THEN top ELSE pos END AS p FROM way) w JOIN runs r
        ON r.part = (w.step >= w.height)::INT AND r.source IS NOT DISTINCT FROM (CASE WHEN w.step < w.height THEN w.source END)
        AND r.level = w.step - (CASE WHEN w.step >= w.height THEN w.height ELSE 0 END) AND r.run = p // 16),
done AS (
    SELECT * FROM way QUALIFY row_number() OVER (PARTITION BY source, start ORDER BY step DESC) = 1)
SELECT doc_id, leaf, subroot, (SELECT digest FROM high WHERE size = 1) AS root, sha256(proof) AS proof_sha256,
    cur AS folded_root, cur = (SELECT digest FROM high WHERE size = 1) AS verified
FROM done
"""
