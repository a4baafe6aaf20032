"""Collocations by SETM: sorted occurrence relations, merge joins, group counts, semi-joins.

Texts are lower-cased (A-Z) and cut at `.,;:!?` and line ends into pieces, and these at blanks
into words. Documents of a language in one slice of an Arrow batch make a run: a dictionary of its
distinct words and one code for each word in order, with a gap where a piece ends. Words are counted
over the dictionaries; those with at least `min_count` occurrences get an id, which reaches the runs by
a join on the dictionaries.

A relation holds occurrences (at, g): a group of `size` words with id g starts at position `at`.
Positions are unique, and adjacent ones lie in one piece. The first relation is stored in order, as
blocks of `BLOCK` positions; the first position of a block is also given to the block before, so that
neighbours always meet and the next position is the next element. Later relations are stored as rows.
Relation k+1 joins relation k with itself at the next position, by place in the blocks and by merge
joins on the rows: two groups that overlap are one of k+1 words. Its groups are counted, and those
with at least `min_count` get ids; the join with them is the semi-join that prunes the relation before
it is extended again. Ids are exact, no hashes stand for words, and every join of relations has whole
numbers as its key.

The joins that bring ids hash the frequent words and groups of a partition rather than sort their
occurrences, of which each has at least `min_count`; a task holds its partition's groups in memory.

A phrase scores the lowest of floor(SCALE * a * a / (l * r)) over its cuts, in decimals of 38
digits. A phrase inside a longer candidate with COVER percent of its count or more goes; as counts
only fall with length, candidates one word longer decide that. Ranks keep at most `top` rows of a
language in each task before they meet.

Null texts count as empty, null languages as `und`. Repeated rows count as often as they come; order
of rows does not matter, ties are broken by count and phrase. Other columns are left out. An empty
table gives an empty result. A run holds about a megabyte of text or one longer text, which bounds a
task's memory; a word of any weight is summed before it is shuffled, and joins on it can be split.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.store import discard, stored, table, with_settings
from marketlens.llm.words import LOWER, flat, slices

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
COVER = 50
SCALE = 1_000_000

_LETTER, _BLANK, _BREAK = range(3)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_LOWER = np.frombuffer(LOWER, np.uint8)
GAP = -1
BLOCK = 4096


def _list(values: pa.Array, lengths: list[int]) -> pa.ListArray:
    """Consecutive values as lists of the given lengths."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _run(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, their counts, and the code of each word with a gap after every piece."""
    data, offsets = flat(column)
    data = _LOWER[data]
    kind = _CLASS[data]
    inside = kind == _LETTER
    at_row = np.zeros(len(data) + 1, bool)
    at_row[offsets] = True
    starts = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~at_row[:-1]))
    ends = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~at_row[1:])) + 1
    lengths = ends - starts
    bounds = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    coded = pa.LargeStringArray.from_buffers(
        len(lengths), pa.py_buffer(bounds), pa.py_buffer(data[inside])).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    breaks = np.cumsum((kind == _BREAK) | at_row[:-1])
    ending = np.flatnonzero(np.diff(breaks[starts])) + 1 if len(starts) else []
    words = coded.dictionary.cast(pa.string())
    return words, np.bincount(codes, minlength=len(words)), np.insert(codes, ending, GAP)


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """`run`, `lang`, `words`, `counts` and `codes` of the slices of documents of a language."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lang in batch.column("lang").unique():
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                for piece in slices(own, text):
                    words, counts, codes = _run(piece.column(text))
                    if not len(words):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([run]), pa.array([lang.as_py()]), _list(words, [len(words)]),
                         _list(pa.array(counts), [len(counts)]),
                         _list(pa.array(codes), [len(codes)])],
                        ["run", "lang", "words", "counts", "codes"])
                    run += -(-len(codes) // BLOCK)

    named = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text)
    return named.mapInArrow(make, "run long, lang string, words array<string>, "
                                  "counts array<long>, codes array<int>")


def _numbered(groups: DataFrame) -> tuple[DataFrame, int]:
    """Stored groups with an id `g`, and a number above all ids.

    Ids are the row in its task times the tasks plus the task, so they are nearly consecutive.
    """
    tasks = 1 << 33
    placed = stored(groups.withColumn("_place", F.monotonically_increasing_id()))
    last = placed.agg(F.max(F.expr(f"_place div {tasks}")), F.max(F.expr(f"_place % {tasks}")),
                      ).first()
    parts, rows = (last[0] or 0) + 1, (last[1] or 0) + 1
    return placed.withColumn("g", F.expr(
        f"_place % {tasks} * {parts} + _place div {tasks}")).drop("_place"), parts * rows


def _numbered_words(cut: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """Frequent words of each language: `lang`, `word`, `f` and `g`."""
    told = cut.select("lang", "counts", F.posexplode("words").alias("code", "word")).select(
        "word", "lang", F.get("counts", "code").alias("count"))
    return _numbered(told.groupBy("word", "lang").agg(F.sum("count").alias("f")).where(
        F.col("f") >= min_count))


def _occurrences(cut: DataFrame, words: DataFrame) -> DataFrame:
    """The stored first relation: `block` and the ids from its first position on, null for gaps.

    A block ends with the first id of the next block of its run.
    """
    entries = cut.select("run", "lang", F.posexplode("words").alias("code", "word"))
    known = entries.join(words.select("word", "lang", "g").hint("shuffle_hash"),
                         ["word", "lang"]).groupBy("run").agg(
        F.collect_list(F.struct("code", "g")).alias("ids"))
    named = cut.select("run", "codes").join(known, "run").select(
        "run", "codes", F.col("ids.code").alias("known"), F.col("ids.g").alias("g"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes, known, g = (batch.column(c).slice(k, 1).flatten().to_numpy()
                                   for c in ("codes", "known", "g"))
                ids_of = np.full(codes.max(initial=0) + 2, GAP, np.int64)  # the last one: GAP
                ids_of[known] = g
                ids = ids_of[codes]
                at = np.arange(0, len(ids), BLOCK)
                lengths = np.minimum(len(ids) - at, BLOCK + 1)
                found = np.insert(ids, at[1:] + 1, ids[at[1:]])  # first ids of blocks twice
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("run")[k].as_py() + np.arange(len(at))),
                     _list(pa.array(found, mask=found == GAP), lengths)], ["block", "ids"])

    return stored(named.mapInArrow(number, "block long, ids array<long>"))


def _neighbours(blocks: DataFrame) -> DataFrame:
    """`at`, `g` and the group `h` at the next position, for the blocks of the first relation."""
    return blocks.select("block", "ids", F.posexplode("ids").alias("at", "g")).select(
        F.expr(f"block * {BLOCK} + at").alias("at"), "g",
        F.get("ids", F.col("at") + 1).alias("h")).where("g is not null and h is not null")


def _pairs(relation: DataFrame) -> DataFrame:
    """`at`, `g` and the group `h` at the next position, for a relation of rows (at, g)."""
    right = relation.select((F.col("at") - 1).alias("at"), F.col("g").alias("h"))
    return relation.join(right.hint("merge"), "at").select("at", "g", "h")


def _grown(pairs: DataFrame, ids: int, min_count: int) -> tuple[DataFrame, int, Column]:
    """Frequent pairs (`key`, `f`, `g`), a number above their ids, and the key of a pair.

    The key is exact: one long while it fits, else a decimal.
    """
    kind = "long" if ids < isqrt(1 << 63) else "decimal(38, 0)"
    key = F.expr(f"cast(g as {kind}) * {ids} + h").cast(kind)
    counted = pairs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("f"))
    groups, above = _numbered(counted.where(F.col("f") >= min_count))
    return groups.withColumns({"left": F.expr(f"cast(key div {ids} as long)"),
                               "right": F.expr(f"cast(key % {ids} as long)")}), above, key


def frequent(docs: DataFrame, text: str = "text", min_count: int = MIN_COUNT,
             max_words: int = MAX_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Frequent groups by length, and all words `n` by lang.

    Groups have an id `g` and a count `f`; words also `lang` and `word`, longer groups the ids `left`
    and `right` of the groups without their last and their first word.
    """
    cut = stored(runs(docs, text))
    totals = stored(cut.groupBy("lang").agg(F.sum(F.aggregate(
        "counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")))
    words, ids = _numbered_words(cut, min_count)
    groups = [words]
    relation = _occurrences(cut, words)
    discard(cut)
    for size in range(2, max_words + 1):
        # Neighbours in blocks cost less to find again than to store.
        pairs = (_neighbours(relation) if size == 2 else
                 _pairs(relation) if size == max_words else stored(_pairs(relation)))
        found, ids, key = _grown(pairs, ids, min_count)
        groups.append(found)
        used = relation
        if size < max_words:
            relation = stored(pairs.select("at", key.alias("key")).join(
                found.select("key", "g").hint("shuffle_hash"), "key").select("at", "g"))
            if size > 2:
                discard(pairs)
        discard(used)
    return groups, totals


def _told(groups: list[DataFrame]) -> list[DataFrame]:
    """Groups with `lang`, `words`, and counts of their first (`pre`) and last (`post`) 1.. words."""
    told = [groups[0].select("g", "lang", F.array("word").alias("words"), F.array("f").alias("pre"),
                             F.array("f").alias("post"))]
    for longer in groups[1:]:
        left = told[-1].select(F.col("g").alias("left"), "lang", "words", "pre")
        right = told[-1].select(F.col("g").alias("right"), "post",
                                F.element_at("words", -1).alias("last"))
        told.append(stored(longer.join(left, "left").join(right, "right").select(
            "g", "lang", F.concat("words", F.array("last")).alias("words"),
            F.concat("pre", F.array("f")).alias("pre"),
            F.concat("post", F.array("f")).alias("post"))))
    return told


def _scored(told: DataFrame, size: int) -> DataFrame:
    """`a`, and l, r and score of the cut that scores lowest, the first of equal ones."""
    cuts = []
    for k in range(1, size):
        counts = {"a": f"pre[{size - 1}]", "l": f"pre[{k - 1}]", "r": f"post[{size - k - 1}]"}
        whole = {name: f"cast({c} as decimal(18, 0))" for name, c in counts.items()}
        score = (f"cast({whole['a']} * {whole['a']} * cast({SCALE} as decimal(7, 0)) div "
                 f"({whole['l']} * {whole['r']}) as long)")
        cuts.append(F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"),
                             F.expr(counts["l"]).alias("l"), F.expr(counts["r"]).alias("r")))
    least = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return told.select("g", "lang", F.array_join("words", " ").alias("phrase"),
                       F.expr(f"pre[{size - 1}]").alias("a"), least.alias("cut")).select(
        "g", "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, text: str = "text", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, cover: int = COVER) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score` of the best phrases by language."""
    groups, totals = frequent(docs, text, min_count, max_words)
    found = []
    for size, told in enumerate(_told(groups), 1):
        if size == 1:
            continue
        phrases = _scored(told, size)
        if size < max_words:
            around = reduce(DataFrame.unionByName, [
                groups[size].select(F.col(side).alias("g"), "f") for side in ("left", "right")])
            phrases = phrases.join(around.groupBy("g").agg(F.max("f").alias("f")), "g", "left")
            phrases = phrases.where(f"f is null or 100 * f < {cover} * a")
        found.append(phrases.select("lang", "phrase", "a", "l", "r", "score"))
    return _best(docs.sparkSession, reduce(DataFrame.unionByName, found), totals, top)


def _best(spark: SparkSession, phrases: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    number = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    # The limit below which a task keeps only its own first rows of a language.
    with with_settings(spark, {"spark.sql.optimizer.windowGroupLimitThreshold": str(top)}):
        best = stored(phrases.withColumn("rank", number.cast("long")).where(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
