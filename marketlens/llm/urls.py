"""URL filters: rules first, then naive Bayes over segmented host and path tokens.

A rule is a host and a path prefix; it fits its host and all subdomains, and the longest fitting
rule decides. Urls that no rule fits go to the method.

Segmentation. Word counts over all page texts give a unigram model. Every run of letters in a host is
cut by Viterbi into the most probable words; an unknown word costs more with every letter. The
candidate substrings of each distinct run meet the counts by a join, so the model is never sent whole,
and a run has at most its length times `MAX_WORD` of them: no piece of a cut is longer. Page words of any
length are counted whole; longer ones only add to the total.

Naive Bayes. There are no labelled urls, so the training classes are weak: urls whose segmented host
has a word of `SEEDS` against all others. Token counts by class are smoothed by one. The log odds of
a url are the prior and the sum over its tokens; above zero it is blocked. Tokens that keep company
with the seeds carry the verdict to hosts without one.
Counts are taken per distinct url, hosts and runs are segmented once each, and joins have one row per
token, host or url on one side, so a hot host is only ever a split join or a partial sum.

Null urls and urls without `://` have an empty host and path; nothing fits them and the prior
decides. Equal urls are judged alike, repeated rows each get a row. A class without urls has only its
smoothing. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.store import stored, table

# The rules of the registered query, (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
# Host words that mark a url as unwanted for training.
SEEDS = ["ads", "adult", "bet", "bets", "betting", "casino", "escort", "gambling", "hack", "malware", "phish",
         "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx"]
SEED_COUNT = 100
MAX_WORD = 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return (F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")),
            F.coalesce(path, F.lit("")))


def match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (rule, verdict), or null. The list of rules is short."""
    found = None
    for verdict, name, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        value = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) over all page texts, tags removed, lower case."""
    seen = F.regexp_replace(F.coalesce(F.col(html).cast("string"), F.lit("")), "<[^>]*+>", " ")
    words = F.regexp_extract_all(F.lower(seen), F.lit("[a-z]{2,}+"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(
        F.count("*").alias("n"))


def viterbi(text: str, known: dict[str, float], unknown: float) -> list[str]:
    """The most probable cut of a run of letters; `unknown` is log10 of a word never seen."""
    best, last = [0.0], [0]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            word = text[start:end]
            cost = known.get(word)
            if cost is None:
                cost = unknown - len(word)
            options.append((best[start] + cost, -start))
        top = max(options)
        best.append(top[0])
        last.append(-top[1])
    cut, end = [], len(text)
    while end:
        cut.append(text[last[end]:end])
        end = last[end]
    return cut[::-1]


def segment(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run) to (run, words) by the unigram counts; the seeds count as seen `SEED_COUNT` times."""
    seeds = counts.sparkSession.createDataFrame([(s, SEED_COUNT) for s in SEEDS],
                                                "word string, n long")
    counts = counts.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()["t"]
    pieces = runs.select("run", F.explode(F.expr(
        f"array_distinct(flatten(transform(sequence(1, length(run)), i -> transform(sequence(2, "
        f"least(greatest({MAX_WORD}, 2), greatest(length(run), 2))), k -> "
        "substring(run, i, k)))))")).alias("word"))
    met = pieces.join(counts, "word").groupBy("run").agg(
        F.collect_list("word").alias("known"), F.collect_list("n").alias("n"))
    ready = runs.join(met, "run", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.log10(max(total, 1))
        for batch in batches:
            cut = []
            for text, known, n in zip(*(c.to_pylist() for c in batch.columns)):
                costs = {w: np.log10(c) - base for w, c in zip(known or [], n or [])}
                cut.append(viterbi(text, costs, 1 - base))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cut, pa.list_(pa.string()))], ["run", "words"])

    return ready.select("run", "known", "n").mapInArrow(run, "run string, words array<string>")


def url_tokens(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, path, token, times) of distinct urls: words of the host's runs, tokens of the path."""
    hosts = urls.select("host").distinct().select("host", F.explode(F.regexp_extract_all(
        "host", F.lit("[a-z]+"), F.lit(0))).alias("run"))
    cut = segment(hosts.select("run").distinct(), counts)
    words = hosts.join(cut, "run").select("host", F.explode("words").alias("token")).groupBy(
        "host", "token").agg(F.count("*").alias("times"))
    of_host = urls.join(words, "host").select(
        "host", "path", F.concat(F.lit("h:"), "token").alias("token"), "times")
    of_path = urls.select("host", "path", F.explode(F.regexp_extract_all(
        F.regexp_replace(F.lower("path"), "[0-9]+", "0"), F.lit(r"[\p{L}0]+"), F.lit(0)))
        .alias("token")).groupBy("host", "path", F.concat(F.lit("p:"), "token").alias("token")) \
        .agg(F.count("*").alias("times"))
    return of_host.unionByName(of_path)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the log odds of being blocked (null under a rule)."""
    host, path = parts(F.col("url").cast("string"))
    split = stored(pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "hit", match(F.col("host"), F.col("path"), RULES if rules is None else rules)))
    urls = stored(split.groupBy("host", "path").agg(
        F.max(F.col("hit").isNull()).alias("open"), F.count("*").alias("pages")))
    tokens = stored(url_tokens(urls, stored(word_counts(pages))))
    bad = tokens.where(F.col("token").isin(["h:" + s for s in SEEDS])).select(
        "host", "path").distinct().withColumn("bad", F.lit(True))
    labelled = stored(urls.join(bad, ["host", "path"], "left").withColumn(
        "bad", F.coalesce("bad", F.lit(False))))
    times = F.col("times") * F.col("pages")
    model = stored(tokens.join(labelled, ["host", "path"]).groupBy("token").agg(
        F.sum(F.when(F.col("bad"), times).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("bad"), 0).otherwise(times)).alias("a")))
    whole = model.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0)),
                      F.count("*")).first()
    block, allow = labelled.agg(
        F.coalesce(F.sum(F.when(F.col("bad"), F.col("pages"))), F.lit(0)),
        F.coalesce(F.sum(F.when(~F.col("bad"), F.col("pages"))), F.lit(0))).first()
    odds = F.log((F.col("b") + 1) / float(whole[0] + whole[2] + 1)) - F.log(
        (F.col("a") + 1) / float(whole[1] + whole[2] + 1))
    prior = float(np.log((block + 1) / (allow + 1)))
    sums = tokens.join(urls.where("open").select("host", "path"), ["host", "path"]).join(
        model.select("token", odds.alias("odds")), "token").groupBy("host", "path").agg(
        F.sum(F.col("times") * F.col("odds")).alias("sum"))
    judged = urls.where("open").join(sums, ["host", "path"], "left").select(
        "host", "path", (F.coalesce("sum", F.lit(0.0)) + prior).alias("log_odds"))
    met = split.join(judged, ["host", "path"], "left")
    return met.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("log_odds") > 0, "block").otherwise("allow"))
        .alias("verdict"), F.col("log_odds"))


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
