"""Merkle manifest of a dataset: a tree per language, a tree over their roots, proofs for every row.

A row's leaf is the digest of its fields, each with its byte count. Leaves of a language ascend by
doc_id (null first; rows of one doc_id by leaf); every `FANOUT` consecutive nodes become the digest
of their joined hex digests, until one is left. The languages' roots, null first and then by bytes,
are the leaves of the last tree.

A rank is written in digits of base `FANOUT`. The lowest `DIGITS` of them are columns that are grouped
away one after another, which nests the child structs, so that a row comes to hold a block of
FANOUT**DIGITS nodes and never more. Block roots are the nodes of the next tier. On the way
back a block gets the path above it by one aggregate, and a transform over the nested structs with one
explode gives every node its path. No joins lie between a node and its proof, and no key has more rows
than a block; ranks come from range slices, so a language of any size is spread over tasks.

Nulls are written as `-`, an empty text as `0:`. A row without doc_id is never tampered with. Repeated
rows are leaves of their own, ties are equal leaves and any order of them gives the same
digests. An empty table gives an empty result. Other columns are left out. The longest text
bounds what one row holds; only its digest is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.store import stored, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
DIGITS = 8
PATH = "array<struct<left: string, right: string>>"


def digest(*fields: Column) -> Column:
    """SHA-256 in hex of fields as `-` or byte count, colon and value."""
    told = []
    for field in fields:
        value = field.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                               F.lit("-")))
    return F.sha2(F.concat(*told), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """`tree` (orders the languages), `hash` and `item` (doc_id and the tampered leaf, if any)."""
    whole = [F.col(f) for f in fields]
    edited = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in fields]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        digest(*whole).alias("hash"),
        F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                 F.when(tampered, digest(*edited)).alias("tampered")).alias("item"))


def ranked(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """Add `rank` from 0 within each tree and `n`, the nodes of the tree, by range slices.

    The last key is the row's place in the stored input, so that equal rows can be cut apart.
    """
    placed = nodes.withColumn("_row", F.monotonically_increasing_id())
    keys = [F.col("tree"), *order, F.col("_row")]
    cut = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumn(
        "_at", F.monotonically_increasing_id())
    cut = stored(cut.withColumn("_slice", F.shiftright("_at", 33)))
    sizes = cut.groupBy("tree", "_slice").agg(F.min("_at").alias("_first"),
                                              F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("tree", "_slice", "_first", F.sum("_n").over(whole).alias("n"),
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return cut.join(offsets, ["tree", "_slice"]).select(
        "tree", (F.col("_at") - F.col("_first") + F.col("_base")).alias("rank"), "n", "hash",
        "item")


def blocks(nodes: DataFrame, fanout: int = FANOUT, digits: int = DIGITS) -> DataFrame:
    """`tree`, `block`, `n`, `hash` and the nested `kids` of FANOUT**DIGITS consecutive nodes.

    A level whose tree has one node left keeps it as it is.
    """
    names = [f"digit{k}" for k in range(digits)]
    now = nodes.select(
        "tree", "n", F.expr(f"rank div {fanout ** digits}").alias("block"), "hash",
        F.col("item").alias("below"),
        *[F.expr(f"cast(rank div {fanout ** k} % {fanout} as int)").alias(d)
          for k, d in enumerate(names)])
    now = now.repartition("tree", "block")
    for level, name in enumerate(names):
        kids = F.sort_array(F.collect_list(F.struct(
            F.col(name).alias("digit"), "hash", "below")))
        now = now.groupBy("tree", "block", "n", *names[level + 1:]).agg(kids.alias("below"))
        joined = F.sha2(F.array_join(F.transform("below", lambda c: c["hash"]), ""), 256)
        now = now.withColumn("hash", F.when(F.col("n") > fanout ** level, joined)
                             .otherwise(F.col("below")[0]["hash"]))
    return now.select("tree", "block", "n", "hash", F.col("below").alias("kids"))


def paths(kids: Column, n: Column, above: Column, fanout: int = FANOUT,
          digits: int = DIGITS) -> Column:
    """An array of (item, hash, path) for the nodes of a block.

    A path has an entry a level from the node upwards: the digests left and right of it in its run.
    """
    def told(rows: Column, start: Column, length: Column) -> Column:
        return F.array_join(F.transform(F.slice(rows, start, length), lambda c: c["hash"]), "")

    def down(rows: Column, level: int, over: Column) -> Column:
        def child(c: Column, i: Column) -> Column:
            own = F.struct(told(rows, F.lit(1), i).alias("left"),
                           told(rows, i + 2, F.lit(fanout)).alias("right"))
            here = F.when(n > fanout ** level, F.array(own)).otherwise(F.array().cast(PATH))
            path = F.concat(here, over)
            if level:
                return down(c["below"], level - 1, path)
            return F.struct(c["below"].alias("item"), c["hash"].alias("hash"), path.alias("path"))
        found = F.transform(rows, child)
        return F.flatten(found) if level else found

    return down(kids, digits - 1, above)


def _tiers(nodes: DataFrame, fanout: int, digits: int) -> list[DataFrame]:
    """Blocks of nodes, blocks of these, and so on until every tree is one block."""
    tiers = [stored(blocks(nodes, fanout, digits))]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > fanout ** digits:
        upper = tiers[-1].select(
            "tree", F.col("block").alias("rank"),
            F.expr(f"(n + {fanout ** digits - 1}) div {fanout ** digits}").alias("n"), "hash",
            F.struct("block").alias("item"))
        tiers.append(stored(blocks(upper, fanout, digits)))
    return tiers


def _descend(tiers: list[DataFrame], top: DataFrame, fanout: int, digits: int) -> DataFrame:
    """`tree`, `above` (struct of the tree), `item`, `hash` and `path` of the nodes at the bottom.

    top: `tree`, `block` 0, `path` over the tree's root and `above`, carried along.
    """
    carried = top
    for tier in reversed(tiers):
        given = {f.name: f.dataType for f in carried.schema.fields}
        both = tier.select(
            "tree", "block", "n", "kids",
            *[F.lit(None).cast(given[c]).alias(c) for c in ("path", "above")]).unionByName(
            carried.select("tree", "block", F.lit(None).cast("long").alias("n"),
                           F.lit(None).cast(tier.schema["kids"].dataType).alias("kids"),
                           "path", "above"))
        met = both.groupBy("tree", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "above")])
        found = met.select("tree", "above", F.explode(
            paths(F.col("kids"), F.col("n"), F.col("path"), fanout, digits)).alias("node"))
        if tier is not tiers[0]:
            carried = found.select("tree", F.col("node.item.block").alias("block"),
                                   F.col("node.path").alias("path"), "above")
    return found.select("tree", "above", "node.*")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT,
             digits: int = DIGITS) -> DataFrame:
    """`doc_id`, `leaf`, `tampered` (a leaf or null), `subroot`, `root` and `path` of every row."""
    nodes = ranked(stored(leaves(docs, fields)),
                   [F.asc_nulls_first(F.col("item.doc_id")), F.col("hash")])
    tiers = _tiers(nodes, fanout, digits)
    subroots = stored(tiers[-1].select(F.lit("").alias("tree"), "hash",
                                       F.struct(F.col("tree").alias("of")).alias("item")))
    over = _tiers(ranked(subroots, [F.col("item.of")]), fanout, digits)
    crown = over[-1].select("tree", "block", F.array().cast(PATH).alias("path"),
                            F.col("hash").alias("above"))
    tops = _descend(over, crown, fanout, digits).select(
        F.col("item.of").alias("tree"), F.lit(0).cast("long").alias("block"), "path",
        F.struct(F.col("hash").alias("subroot"), F.col("above").alias("root")).alias("above"))
    return _descend(tiers, tops, fanout, digits).select(
        "item.doc_id", F.col("hash").alias("leaf"), "item.tampered", "above.subroot", "above.root",
        "path")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda sofar, step: F.sha2(
        F.concat(step["left"], sofar, step["right"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path in one string, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = manifest(table(spark, sf_dir, "documents")).withColumn(
        "folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return told.select("doc_id", "leaf", "subroot", "root",
                       F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
