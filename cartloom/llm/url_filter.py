"""URL filter: rules first, then a character language-model ratio.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, give
every character its probability after the longest known context (Witten-Bell blending of
orders ``ORDER`` to 0). The score of a URL is the difference of the two log-likelihoods
divided by its length; it is accepted from a threshold on, which is calibrated on a fold of
accepted URLs that the models have not seen.

Only DataFrame expressions are used. Counts come from all URLs that a rule decides and are
exact: one row per gram (a context and its character) in landed tables that grow with the
grams there are. Every different gram of the URLs gets its log-likelihood difference once, by
joins with the counts of its shorter ones; the characters of every different URL are joined
with these and summed.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and
is scored as its whole text (null: the empty text). Repeated rows are judged alike. Without
training URLs every score is 0; without accepted URLs in the calibration fold the threshold
is 0. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import UPPER, landed, table

ORDER = 3
#: Without effect since counts are exact; callers that set it still may.
SLOTS = 1 << 14
#: One URL in this many (by checksum of its id) calibrates the threshold and trains nothing.
FOLDS = 4
#: Share of accepted calibration URLs that may fall below the threshold.
MISS = 0.02
START, END = "\u0002", "\u0003"

#: (action, host and path), as the filter's owner gives them.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its action (both null if none fits)."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rule_path = rule.partition("/")
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(slash + rule_path))
        name, action = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(action)
    return name, action


def _padded(url: Column) -> Column:
    letters = F.filter(F.split(F.coalesce(url, F.lit("")), ""), lambda c: c != "")
    return F.concat(F.array_repeat(F.lit(START), ORDER), letters, F.array(F.lit(END)))


def _grams(urls: DataFrame) -> DataFrame:
    """One row per character of every URL (column ``url``): it and the ``ORDER`` before it as
    an array ``g``, other columns kept."""
    every = F.transform(F.sequence(F.lit(ORDER), F.size("p") - 1),
                        lambda i: F.slice(F.col("p"), i - ORDER + 1, ORDER + 1))
    return urls.withColumn("p", _padded(F.col("url"))).withColumn("g", F.explode(every)).drop("p")


def _ratios(urls: DataFrame) -> DataFrame:
    """``g, ratio``: the log-likelihood difference of the last character of every different
    gram of ``urls`` (url, a, r: accepted and rejected training rows with this URL)."""
    grams = landed(_grams(urls.select("url", "a", "r")).groupBy("g").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "url-grams")
    known, blended = grams, grams.select("g")
    for order in range(ORDER + 1):
        # Counts of the last ``order`` characters before, with and without the character itself.
        counts = landed(known.where("a > 0 OR r > 0")
                        .groupBy(F.slice("g", ORDER + 1 - order, order + 1).alias("k"))
                        .agg(F.sum("a").alias("a"), F.sum("r").alias("r")), f"url-counts-{order}")
        contexts = landed(counts.groupBy(F.slice("k", 1, order).alias("c")).agg(
            F.sum("a").alias("ca"), F.sum("r").alias("cr"),
            F.sum((F.col("a") > 0).cast("int")).alias("ta"),
            F.sum((F.col("r") > 0).cast("int")).alias("tr")), f"url-contexts-{order}")
        held = (blended.withColumn("k", F.slice("g", ORDER + 1 - order, order + 1))
                .withColumn("c", F.slice("g", ORDER + 1 - order, order))
                .join(counts, "k", "left").join(contexts, "c", "left"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
        # An unseen context hands all weight to the shorter one: total 0, one kind.
        kinds = lambda t, c: F.when(zero(c) > 0, zero(t)).otherwise(F.lit(1.0))
        ta, tr = kinds("ta", "ca"), kinds("tr", "cr")
        if order == 0:  # with one more kind for characters never seen
            pa, pr = (zero("a") + 1) / (zero("ca") + ta + 1), (zero("r") + 1) / (zero("cr") + tr + 1)
        else:
            pa = (zero("a") + ta * F.col("pa")) / (zero("ca") + ta)
            pr = (zero("r") + tr * F.col("pr")) / (zero("cr") + tr)
        blended = landed(held.select("g", pa.alias("pa"), pr.alias("pr")), f"url-blended-{order}")
    return landed(blended.select("g", (F.log("pa") - F.log("pr")).alias("ratio")), "url-ratios")


def _scores(urls: DataFrame) -> DataFrame:
    """``key, score`` of every different URL (``key``: the URL, null as the empty text): mean
    log-likelihood difference per character (the end mark counts as one)."""
    train = (F.col("action").isNotNull() & ~F.col("held")).cast("long")
    accepted = (F.col("action") == "allow").cast("long")
    distinct = landed(urls.groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(
        F.sum(F.coalesce(train * accepted, F.lit(0))).alias("a"),
        F.sum(F.coalesce(train * (1 - accepted), F.lit(0))).alias("r"))
        .withColumn("n", F.monotonically_increasing_id()), "url-distinct")
    # Long URLs do not travel with each of their characters; landed, their numbers are fixed.
    score = (_grams(distinct.select("n", "url")).select("n", "g").join(_ratios(distinct), "g").groupBy("n")
             .agg((F.sum("ratio") / F.count(F.lit(1))).alias("score")))
    return landed(distinct.select("n", F.col("url").alias("key")).join(score, "n").select("key", "score"), "url-scores")


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Judge every row: ``page_id, host, path, rule, verdict, score``; ``verdict`` is the
    longest fitting rule's action, else ``allow`` from the calibrated score on."""
    host, path = split_url(F.col("url"))
    urls = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
            .select("page_id", "url", host.alias("host"), path.alias("path")))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.select("*", rule.alias("rule"), action.alias("action"))
    held = F.pmod(F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), F.lit(FOLDS)) == 0
    urls = urls.select("*", held.alias("held"), F.coalesce("url", F.lit("")).alias("key"))
    scores = _scores(urls)
    scored = urls.join(scores, "key")
    threshold = (scored.where(F.col("held") & (F.col("action") == "allow"))
                 .agg(F.coalesce(F.percentile_approx("score", F.lit(MISS), F.lit(10000)), F.lit(0.0))
                      .alias("threshold"))).scalar()
    judged = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("action", judged).alias("verdict"), "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge the URL of every page."""
    return filter_urls(table(spark, sf_dir, "pages"))
