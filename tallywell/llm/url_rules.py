"""URL filters: listed host and path rules, and token rules that FP-growth mines from labelled URLs.

A URL becomes a set of tokens: the ends and the labels of its host, its path segments with digits folded, with and
without their place, the extension of its file, the names of its query, and its scheme. Tokens too rare for any rule
go, and tokens that stand in the same labelled URLs are one: else a long host or path that many URLs share would have
all of its subsets mined. Frequent sets of tokens with a label give association rules; those with enough support and
confidence stay, unless a part of one says the same at least as surely. A rule is indexed by its rarest token, so a
URL meets only rules that share that token with it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Listed:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


LISTED = [Listed("net", "/", "block"), Listed("example.net", "/en/", "allow"), Listed("example.com", "/de/", "block"),
          Listed("org", "/fr/", "allow")]


@dataclass(frozen=True)
class Settings:
    """Rules need ``support`` of all labelled URLs and ``confidence``; a URL that none fits gets ``otherwise``."""

    support: float = 0.01
    confidence: float = 0.9
    otherwise: str = "allow"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[Listed]) -> tuple[Column, Column]:
    """(text, verdict) of the longest listed rule that fits; null if none does."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.text) if rule is None else rule.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if rule is None else (rule, verdict)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL; none for one without a host."""
    labels = F.split(host, "\\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(
        F.lit("host:"), F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")))
    single = F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("label:"), x))
    folded = F.regexp_replace(path, "[0-9]+", "#")
    segments = F.transform(F.filter(F.split(folded, "/"), lambda x: x != ""), lambda x: F.regexp_replace(x, "\\..*$", ""))
    steps = F.transform(segments, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), x))
    anywhere = F.transform(segments, lambda x: F.concat(F.lit("path:"), x))
    ending = F.regexp_extract(folded, "\\.([A-Za-z#]{1,8})$", 1)
    asked = F.regexp_extract(url, "\\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(asked, "&"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    rest = F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)), F.concat(F.lit("file:"), ending))
    return F.when(host != "", F.array_distinct(F.concat(ends, single, steps, anywhere, names, rest))).otherwise(F.array().cast("array<string>"))


def frequent_tokens(labelled: DataFrame, s: Settings = Settings(), tokens: str = "tokens") -> DataFrame:
    """(token, stands_for) of the tokens in at least ``support`` of the rows; equal ``stands_for``: in the same rows.

    Rows are told apart by 64-bit hashes of their tokens, summed in decimals. There are at most the mean number of tokens of
    a row over ``support`` of them, whatever the number of rows.
    """
    rows = labelled.where(F.size(tokens) > 0).select(tokens)
    own = F.xxhash64(F.array_sort(tokens)).cast("decimal(20,0)")
    seen = rows.select(own.alias("row"), F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.sum("row").alias("sum"))
    least = math.ceil(s.support * rows.count() - 1e-9)
    seen = settled(seen.where(F.col("n") >= least), "frequent-tokens")
    names = seen.groupBy("n", "sum").agg(F.min("token").alias("stands_for"))
    return settled(seen.join(names, ["n", "sum"]).select("token", "stands_for"), "token-classes")


def condensed(tokens: Column, known: DataFrame) -> Column:
    """``tokens`` without those that are not ``known``, each by what it stands for.

    ``known`` is read into the query as a literal map; ``frequent_tokens`` states its bound.
    """
    pairs = [(r.token, r.stands_for) for r in known.collect()]
    if not pairs:
        return F.array().cast("array<string>")
    names = F.map_from_arrays(F.lit([a for a, _ in pairs]), F.lit([b for _, b in pairs]))
    return F.array_distinct(F.filter(F.transform(tokens, lambda x: F.element_at(names, x)), lambda x: x.isNotNull()))


def mine(labelled: DataFrame, s: Settings = Settings(), tokens: str = "tokens", label: str = "label") -> DataFrame:
    """(key, tokens, verdict, confidence, support) of the rules mined from token sets with labels.

    Rows with a null label or without tokens teach nothing; repeated rows count as often as they occur. Without any
    rows there are no rules.
    """
    spark = labelled.sparkSession
    known = labelled.where(F.col(label).isNotNull() & (F.size(tokens) > 0)).select(
        F.concat(F.col(tokens), F.array(F.concat(F.lit("="), F.col(label)))).alias("items"))
    none = spark.createDataFrame([], "key string, tokens array<string>, verdict string, confidence double, support double")
    if known.isEmpty():
        return none
    model = FPGrowth(itemsCol="items", minSupport=s.support, minConfidence=s.confidence).fit(known)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = model.associationRules.where(F.col("consequent")[0].startswith("=")).select(
        F.sort_array("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 2, 1 << 20).alias("verdict"),
        "confidence", "support")
    rules = settled(rules, "rules")
    rarest = rules.select("tokens", "verdict", F.explode("tokens").alias("token")).join(single, "token").groupBy(
        "tokens", "verdict").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    rules = settled(rules.join(rarest, ["tokens", "verdict"]), "indexed-rules")
    inner = rules.select("key", F.col("tokens").alias("_part"), F.col("verdict").alias("_verdict"), F.col("confidence").alias("_c"))
    shadowed = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("key")).join(inner, "key").where(
        (F.col("verdict") == F.col("_verdict")) & (F.size("_part") < F.size("tokens")) & (F.col("_c") >= F.col("confidence"))
        & (F.size(F.array_except("_part", "tokens")) == 0)).select("tokens", "verdict").distinct()
    return rules.join(shadowed, ["tokens", "verdict"], "left_anti").select("key", "tokens", "verdict", "confidence", "support")


def fitting(urls: DataFrame, rules: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(url, verdict) of the surest rule of each distinct URL that one fits: by confidence, support, size, then block first."""
    open_ = urls.select("url", tokens, F.explode(tokens).alias("key"))
    rules = rules.withColumnRenamed("tokens", "_rule")
    found = open_.join(rules, "key").where(F.size(F.array_except("_rule", tokens)) == 0)
    best = F.max_by("verdict", F.struct("confidence", "support", F.size("_rule"), (F.col("verdict") == "block"), "verdict"))
    return found.groupBy("url").agg(best.alias("_mined"))


def judge(pages: DataFrame, listed: list[Listed] = LISTED, s: Settings = Settings(), id: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of each row.

    Listed rules decide where they fit, and their verdicts are the labels that token rules are mined from; the rest
    go to the surest mined rule that fits, or to ``otherwise``. A null URL, or one without ``://``, has an
    empty host and path. Ids may be null or repeated; other columns are ignored. An empty table gives no rows.
    """
    rows = pages.select(F.col(id).alias(id), F.col(url).alias("url")).select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("_listed"))
    known = rows.select(tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), F.col("_listed").alias("label"))
    known = settled(known.where("label IS NOT NULL"), "labelled-urls")
    classes = frequent_tokens(known, s)
    rules = mine(known.select(condensed(F.col("tokens"), classes).alias("tokens"), "label"), s)
    open_ = rows.where("rule IS NULL AND host <> ''").select("url", "host", "path").distinct().select(
        "url", condensed(tokens_of(F.col("url"), F.col("host"), F.col("path")), classes).alias("tokens"))
    return rows.join(fitting(open_, rules), "url", "left").select(
        id, "host", "path", "rule", F.coalesce("_listed", "_mined", F.lit(s.otherwise)).alias("verdict"))
