"""Mixing sources to target weights with fixed-length blocks and pseudorandom permutations.

Targets. Sources by code point, null last, weigh 5, 2, 1, repeating, and share all words. A source
stops at `REPEATS` times its words; the excess is shared again by weight. That fixed point is found
in one pass: by ascending cap per weight, sources are capped while their fair share exceeds the cap.

Blocks. A source's documents, in hashed order, are one stream of words cut into blocks of
`BLOCK_WORDS`. A pass takes every full block once, in the order of a pseudorandom permutation keyed
by the source (a swap-or-not network), and the short last block at its end. A source
takes as many slots as its target needs, and the last slot is trimmed, so the source gets its target
to the word. Whole passes first, so no document is taken more than `REPEATS` times.

Shards. For every source a multinomial draw, seeded by the source, deals its slots over the output
shards; the totals stay exact and the shards differ by chance only. Slots are numbered along the
shards, mapped to blocks, and joined with the blocks by index.

Work is spread by document and by shard, never by source: positions in a stream come from hashed
slices of a source, as many as hold `SLICE_ROWS` rows each, and the sums of slices. Reruns agree, as
everything is seeded by its key.

Nulls: a null text has size 0, a null source is a source of its own, a null doc_id is a document.
Every row is a document, also repeated rows, which follow each other in the stream. A source without
words gets target 0. Extra columns are ignored here. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.store import stored, table

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
SLICE_ROWS = 4096
ROUNDS = 32
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target). One row per source."""
    ranked = sizes.withColumn("_at", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.col("_at") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumns({"_weight": weight, "_cap": F.col("source_size") * float(repeats)})
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "_at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    fair = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(
        F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    shared = ranked.withColumn("_fair", fair).withColumn(
        "_capped", F.col("_cap") / F.col("_weight") < F.col("_fair"))
    first = F.min(F.when(~F.col("_capped"), F.struct(F.col("_cap") / F.col("_weight"), "_at",
                                                     "_fair"))).over(Window.partitionBy())
    level = first["_fair"]  # of the first source that is not capped
    return shared.withColumn("target", F.when(
        F.col("_capped"), F.col("_cap")).otherwise(
        F.least(F.col("_weight") * level, F.col("_cap")))).select(
        "source", "source_size", "target")


def _sources(sizes: DataFrame, block_words: int) -> DataFrame:
    """Per source: numbers of words, full blocks, slots in a pass, slots taken, words trimmed to."""
    found = targets(sizes)
    taken = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * REPEATS)
    found = found.withColumns({
        "_taken": taken, "full": F.floor(F.col("source_size") / block_words),
        "per_pass": F.ceil(F.col("source_size") / block_words)})
    rest = F.expr("_taken % source_size")
    return found.where("source_size > 0").withColumn("_rest", rest).withColumns({
        "slots": F.floor(F.col("_taken") / F.col("source_size")) * F.col("per_pass")
        + F.ceil(F.col("_rest") / block_words),
        "trim": F.when(F.col("_rest") % block_words > 0, F.col("_rest") % block_words)
        .otherwise(F.lit(block_words))}).drop("_taken", "_rest")


def deal(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """Slots of every source by output shard: multinomial counts with the source's exact total."""
    total = sources.agg(F.sum("slots").alias("all_slots"))
    known = sources.crossJoin(F.broadcast(total)).select(
        "source", "full", "per_pass", "slots", "trim",
        F.ceil(F.col("all_slots") / shard_slots).alias("shards"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                name = "" if row.source is None else "s" + row.source
                rng = np.random.default_rng([seed, zlib.crc32(name.encode())])
                shards = int(row.shards)
                counts = rng.multinomial(int(row.slots), np.full(shards, 1 / shards))
                at = np.flatnonzero(counts)
                yield pd.DataFrame({
                    "source": row.source, "full": row.full, "per_pass": row.per_pass,
                    "slots": row.slots, "trim": row.trim, "shard": at, "n": counts[at],
                    "first": (np.cumsum(counts) - counts)[at]})

    return known.mapInPandas(run, "source string, full long, per_pass long, slots long, "
                                  "trim long, shard long, n long, first long")


def permuted(at: str, n: str, key: str) -> Column:
    """Where index `at` goes under the permutation of 0..n-1 named by `key`; others stay.

    A swap-or-not network: every round pairs x with (k - x) mod n, and a hash of the pair says whether
    the two change places. That is a permutation for any n, and one SQL expression.
    """
    size = f"greatest({n}, 1L)"
    other = f"pmod(pmod(xxhash64({key}, r), {size}) - x, {size})"
    turn = (f"transform(array({other}), y -> if((xxhash64({key}, r, greatest(x, y)) & 1L) = 1L, "
            "y, x))[0]")
    return F.expr(f"if({at} >= {n}, {at}, aggregate(sequence(1, {ROUNDS}), {at}, (x, r) -> {turn}))")


def slots(dealt: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per slot: shard, source, the block it shows, and how many of its words."""
    spread = dealt.repartition("source", "shard").withColumn(
        "slot", F.explode(F.expr("sequence(first, first + n - 1)")))
    return spread.select(
        "shard", "source", "slot", F.expr("slot div per_pass").alias("pass"),
        permuted("(slot % per_pass)", "full", "source").alias("block"),
        F.when(F.col("slot") == F.col("slots") - 1, F.col("trim")).otherwise(
            F.lit(block_words)).alias("shown"))


def place(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Each document's size and place in its source's stream, and the sources' sizes."""
    body = F.col(f"`{text}`").cast("string")
    measured = stored(docs.select(
        "doc_id", F.xxhash64(body, F.lit(3)).alias("_text"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    parts = 1 + measured.count() // SLICE_ROWS
    sized = measured.withColumn("_slice", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(parts)))
    sums = sized.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("_source"), F.col("_slice").alias("_part"),
                         F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("source", "_slice").orderBy("doc_id", "_text").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = sized.withColumn("_inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, F.expr("source <=> _source and _slice = _part")).select(
        "doc_id", "_text", "source", "size", (F.col("_offset") + F.col("_inner")).alias("start"))
    return stored(placed), sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def mix(docs: DataFrame, text: str = "text",
        block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Placed documents with their sources' targets, and the pieces of them that the mix shows.

    A piece is (shard, slot, pass, source, start, words from `lo` up to `hi` of the document).
    """
    placed, sizes = place(docs, text)
    sources = stored(_sources(sizes, block_words))
    shown = stored(slots(deal(sources), block_words))
    blocks = placed.where("size > 0").select(
        F.col("source").alias("_source"), "start", "size", F.explode(F.expr(
            f"sequence(start div {block_words}, (start + size - 1) div {block_words})"))
        .alias("_block"))
    met = shown.join(blocks, F.expr("source <=> _source and block = _block"))
    lo = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    hi = F.least(F.col("block") * block_words + F.col("shown") - F.col("start"), F.col("size"))
    pieces = met.select("shard", "slot", "pass", "source", "start", lo.alias("lo"), hi.alias("hi")) \
        .where("hi > lo")
    known = targets(sizes).select(F.col("source").alias("_source"), "source_size", "target")
    return placed.join(known, F.expr("source <=> _source")).drop("_source"), pieces


def taken(docs: DataFrame, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    placed, pieces = mix(docs, text, block_words)
    used = pieces.groupBy(F.col("source").alias("_source"), F.col("start").alias("_start")).agg(
        F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    met = placed.join(used, F.expr("source <=> _source and start = _start and size > 0"), "left")
    return met.select("doc_id", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents as the mix shows them: a row for each pass over a document, or none.

    A pass that shows all words keeps the text as it is, another one the shown words joined by one
    space; `n_chars` follows where there is one. Rows equal in doc_id and text share their other
    columns with the first of them.
    """
    names = docs.columns
    placed, pieces = mix(docs, "text", block_words)
    shown = pieces.groupBy(F.col("source").alias("_source"), F.col("start").alias("_start"),
                           F.col("pass")).agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("_shown"),
        F.sum(F.col("hi") - F.col("lo")).alias("_taken"))
    wanted = placed.where("size > 0").join(shown, F.expr(
        "source <=> _source and start = _start")).select(
        F.col("doc_id").alias("_id"), F.col("_text").alias("_key"), "_shown",
        (F.col("_taken") < F.col("size")).alias("_partly"))
    body = F.col("text").cast("string")
    kept = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)]
    bodies = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(body, F.lit(3)).alias("_hash"),
                         body.alias("_body"), *kept).dropDuplicates(["_doc", "_hash"])
    met = bodies.join(wanted, F.expr("_doc <=> _id and _hash = _key"))
    words = F.regexp_extract_all("_body", F.lit(WORD), F.lit(0))
    part = met.withColumn("_words", F.when(F.col("_partly"), words))
    text = F.when(F.col("_partly"), F.array_join(F.flatten(F.transform(
        "_shown", lambda p: F.slice("_words", (p["lo"] + 1).cast("int"),
                                    (p["hi"] - p["lo"]).cast("int")))), " ")) \
        .otherwise(F.col("_body"))
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return part.select(*[new.get(c, F.col(f"_c{i}")).alias(c) for i, c in enumerate(names)])


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))
