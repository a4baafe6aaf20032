"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: lines, and within a line runs of at most `WORDS` words. The set of
their XXH64 digests goes into a sketch of three tables of `CELLS` cells; a digest falls into one cell
of each table, and a cell holds the count, the exclusive-or of its digests and that of their checks.
Sketches of two versions subtract cell by cell, and peeling cells that hold one digest recovers the
digests that differ. If cells stay full, the comparison is made again larger: the digests are split
by hash into parts of a few, each with a sketch of its own, then with four times the cells, and what
still resists is compared digest by digest. Every way yields the digests that differ, each with the
side that has it (`difference`). All of it is one expression over a row's arrays, built
from SQL functions only, and linear in the text for the fixed-size sketch and n to the power 1.5 for
the larger ones.

Likeness is the Jaccard similarity of the digest sets that the recovered difference implies; two
texts without a paragraph are alike. Equal texts have equal fingerprints, which start with the
XXH64 of the text and the number of distinct paragraphs.

The next document follows in ascending doc_id, after the last the first; null ids come last, and
rows that share an id follow by a hash of their text. Rows equal in id and text are one document and
get equal results. Links between neighbours are found on ids only, in range slices with stitched
ends; texts move once, keyed by document, and of the next document only the wanted head. Null texts
are empty. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.store import stored, table

WORDS = 32
CELLS = 8
PART = 8
STEPS = 15
_LAST = (1 << 63) - 1
_PARAGRAPH = (r"(?:[^\x20\x09-\x0D]++[\x20\x09\x0B-\x0D]*+){1,%d}+" % WORDS)


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    parts = F.regexp_extract_all(text, F.lit(_PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(F.rtrim(p))))


def _cell(key: str, which: str, cells: int) -> str:
    """Index of a digest's cell in one of the three tables."""
    return f"(shiftrightunsigned({key}, 20 * {which} + 4) & {cells - 1})"


def _sketch(keys: str, cells: int) -> str:
    """Three tables of cells (n, k, h) over an array of digests, as SQL."""
    return (f"transform(sequence(0, 2), u -> transform(sequence(0, {cells - 1}), i -> aggregate("
            f"filter({keys}, x -> {_cell('x', 'u', cells)} = i), "
            "named_struct('n', 0, 'k', 0L, 'h', 0L), (a, x) -> named_struct("
            "'n', a.n + 1, 'k', a.k ^ x, 'h', a.h ^ xxhash64(x)))))")


_NONE = "cast(array() as array<struct<side: int, digest: bigint>>)"


def _peel(one: str, other: str, cells: int) -> str:
    """The digests that differ between two sketches, or null if peeling gets stuck, as SQL."""
    apart = (f"zip_with({one}, {other}, (p, q) -> zip_with(p, q, (x, y) -> named_struct("
             "'n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h)))")
    pure = "filter(s.t[r % 3], c -> abs(c.n) = 1 and xxhash64(c.k) = c.h)"
    removed = ("transform(s.t, (w, u) -> transform(w, (c, i) -> aggregate(filter(pure, p -> "
               f"{_cell('p.k', 'u', cells)} = i), c, (a, p) -> named_struct("
               "'n', a.n - p.n, 'k', a.k ^ p.k, 'h', a.h ^ p.h))))")
    step = (f"transform(array({pure}), pure -> if(size(pure) = 0, s, named_struct("
            f"'t', {removed}, 'd', concat(s.d, transform(pure, c -> named_struct("
            f"'side', c.n, 'digest', c.k))))))[0]")
    return (f"aggregate(sequence(0, {STEPS - 1}), named_struct('t', {apart}, 'd', {_NONE}), "
            f"(s, r) -> {step}, s -> if(exists(s.t, w -> exists(w, c -> c.n <> 0 or c.k <> 0 "
            "or c.h <> 0)), null, s.d))")


def _larger(one: str, other: str) -> str:
    """The same from digests split by hash into parts, each retried with more cells, as SQL."""
    tries = [_peel(_sketch("b.x", cells), _sketch("b.y", cells), cells)
             for cells in (CELLS, 4 * CELLS)]
    exact = "concat(" + ", ".join(
        f"transform(array_except(b.{p}, b.{q}), k -> named_struct('side', {side}, 'digest', k))"
        for p, q, side in (("x", "y", 1), ("y", "x", -1))) + ")"

    def share(keys: str, seed: int, count: str, which: str) -> str:
        return f"filter({keys}, x -> pmod(xxhash64(x, {seed}), {count}) = {which})"

    inner = (f"transform(sequence(0, m - 1), j -> named_struct('x', {share('g.x', 2, 'm', 'j')}, "
             f"'y', {share('g.y', 2, 'm', 'j')}))")
    inner = f"transform({inner}, b -> coalesce({', '.join(tries)}, {exact}))"
    groups = (f"transform(sequence(0, m - 1), o -> named_struct('x', {share(one, 1, 'm', 'o')}, "
              f"'y', {share(other, 1, 'm', 'o')}))")
    found = f"flatten(flatten(transform({groups}, g -> {inner})))"
    size = f"cast(ceil(sqrt(greatest(size({one}) + size({other}), 1) / {PART})) as int)"
    return f"transform(array({size}), m -> {found})[0]"


def _difference(one: str, other: str, keys: str, other_keys: str) -> str:
    """All digests that differ, from the fixed sketches or else from larger ones, as SQL."""
    return f"coalesce({_peel(one, other, CELLS)}, {_larger(keys, other_keys)})"


def difference(pairs: DataFrame, one: str = "one", other: str = "other",
               out: str = "difference") -> DataFrame:
    """Add the paragraph digests by which two texts of a row differ, in no order.

    An array of (side, digest): side 1 for a paragraph of `one` alone, -1 for one of `other` alone.
    A null text is empty.
    """
    names = pairs.columns
    body = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (one, other)]
    kept = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("_kept")
    cut = pairs.select(kept, digests(body[0]).alias("x"), digests(body[1]).alias("y"))
    cut = cut.withColumns({f"{k}s": F.expr(_sketch(k, CELLS)) for k in ("x", "y")})
    return cut.select(*[F.col(f"_kept.c{i}").alias(c) for i, c in enumerate(names)],
                      F.expr(_difference("xs", "ys", "x", "y")).alias(out))


def _likeness(one: str, other: str, keys: str, other_keys: str) -> Column:
    """Jaccard similarity from the difference that the sketches give."""
    d = f"size({_difference(one, other, keys, other_keys)})"
    both = f"(size({keys}) + size({other_keys}))"
    return F.expr(f"transform(array({d}), d -> if({both} = 0, 1D, "
                  f"cast({both} - d as double) / ({both} + d)))[0]")


def _print(text: Column, keys: str, sketch: str) -> Column:
    """The sketch as text: hash of the text, number of digests, then the cells of each table."""
    cells = F.expr(f"array_join(transform(flatten({sketch}), c -> concat(c.n, '.', "
                   "lower(hex(c.k)), '.', lower(hex(c.h & 4294967295L)))), ' ')")
    return F.concat_ws(" ", F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0")),
                       F.size(keys).cast("string"), cells)


def neighbours(keys: DataFrame) -> DataFrame:
    """(id, th, n) to the same with the next and the previous key and `prev_n`, in a circle."""
    sliced = stored(keys.repartitionByRange("id", "th").withColumn(
        "part", F.spark_partition_id()))
    row = F.struct("id", "th", "n")
    ends = sliced.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    order = Window.orderBy("part")  # one row per slice
    circle = Window.orderBy("part").rowsBetween(Window.unboundedPreceding,
                                                Window.unboundedFollowing)
    ends = ends.select(
        "part", F.coalesce(F.lead("first").over(order), F.first("first").over(circle)).alias("up"),
        F.coalesce(F.lag("last").over(order), F.last("last").over(circle)).alias("down"))
    inside = Window.partitionBy("part").orderBy("id", "th")
    met = sliced.withColumns({"lead": F.lead(row).over(inside), "lag": F.lag(row).over(inside)}) \
        .join(ends, "part")
    up, down = F.coalesce("lead", "up"), F.coalesce("lag", "down")
    return met.select("id", "th", up["id"].alias("next_id"), up["th"].alias("next_th"),
                      down["id"].alias("prev_id"), down["th"].alias("prev_th"),
                      down["n"].alias("prev_n"))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its text with the last quarter taken from the next."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("id"),
                        F.xxhash64(body, F.lit(5)).alias("th"), body.alias("body"))
    keys = keyed.groupBy("id", "th").agg(F.max(F.char_length("body")).cast("long").alias("n"))
    linked = keyed.join(stored(neighbours(keys)), ["id", "th"])
    # The head carries doc_id only so that both joins read one and the same shuffle of the texts.
    heads = linked.groupBy(F.col("prev_id").alias("id"), F.col("prev_th").alias("th")).agg(
        F.first(F.struct(F.expr("substring(body, 1, cast(prev_n div 4 as int))").alias("head"),
                         digests(F.col("body")).alias("keys"), "doc_id")).alias("next"))
    met = keyed.join(heads, ["id", "th"])
    cut = F.expr("n_chars - n_chars div 4")
    versions = met.withColumn("n_chars", F.char_length("body").cast("long")).select(
        "doc_id", "n_chars", "body",
        F.concat(F.substring("body", F.lit(1), cut.cast("int")), F.col("next.head"))
        .alias("edited"), F.col("next.keys").alias("z"))
    sketched = versions.withColumns({"x": digests(F.col("body")), "y": digests(F.col("edited"))})
    sketched = sketched.withColumns(
        {f"{k}s": F.expr(_sketch(k, CELLS)) for k in ("x", "y", "z")})
    return sketched.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        _print(F.col("body"), "x", "xs").alias("fingerprint"),
        _print(F.col("edited"), "y", "ys").alias("edited_fingerprint"),
        _likeness("xs", "ys", "x", "y").alias("near_edited"),
        _likeness("xs", "zs", "x", "z").alias("near_next"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
