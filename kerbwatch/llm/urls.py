"""URL filtering by stated rules and, where none fits, by mined association rules.

Urls that a stated rule judges are the labelled examples. FP-growth mines combinations of their tokens (host
labels, path segments, query keys, file endings) that go with a verdict; combinations below a support or a
confidence are pruned, as are those that a shorter one already implies. Matching goes through an inverted index: each mined
rule is filed under its rarest token, urls meet it there by an equi-join, and the other tokens are checked on
the pair. The verdict of the most certain rule counts, else ``allow``.

A null url, or one without ``://``, has empty host and path, no tokens and no rule: ``allow``. Repeated urls
are judged once. With no labelled url nothing is mined. Extra columns of the table are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.session import materialise

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
SUPPORT, CONFIDENCE = 0.005, 0.8


def split(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, as the module says."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def stated(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule (host and path as one text) and verdict of the longest stated rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    def marked(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    query = F.regexp_extract(F.coalesce(url, F.lit("")), "[?]([^#]*)", 1)
    ending = F.regexp_extract(path, "[.]([A-Za-z0-9]+)$", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    return F.array_distinct(F.concat(
        marked("h:", F.split(host, "[.]")), marked("p:", F.split(F.lower(path), "/")), marked("q:", keys), marked("x:", F.array(ending))))


def mine(examples: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame | None:
    """tokens, verdict, confidence, support and anchor of the kept rules; ``examples`` has tokens and verdict."""
    baskets = materialise(examples.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items")), "url-baskets")
    if not baskets.take(1):
        return None
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    found = model.associationRules.where(F.col("consequent")[0].startswith("=")).where(
        ~F.exists("antecedent", lambda x: x.startswith("=")))
    found = found.select(F.array_sort("antecedent").alias("tokens"), F.expr("substring(consequent[0], 2)").alias("verdict"),
                         "confidence", "support")
    found = materialise(found, "url-rules")
    part = found.select("tokens", F.explode("tokens").alias("token")).join(single, "token")
    anchors = part.groupBy("tokens").agg(F.min_by("token", F.struct("freq", "token")).alias("anchor"))
    index = materialise(found.join(anchors, "tokens"), "url-rules")
    shorter = index.select(*(F.col(c).alias(f"r_{c}") for c in ("anchor", "tokens", "verdict", "confidence")))
    longer = index.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    implied = longer.join(shorter, longer.token == shorter.r_anchor).where(
        (F.size("r_tokens") < F.size("tokens")) & (F.size(F.array_except("r_tokens", "tokens")) == 0)
        & (F.col("verdict") == F.col("r_verdict")) & (F.col("r_confidence") >= F.col("confidence")))
    return index.join(implied.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``key``, host, path, rule (stated one or null), verdict and by (``rule``, ``mined`` or ``default``)."""
    split_ = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("url"))
    host, path = split(F.col("url"))
    split_ = split_.withColumn("host", host).withColumn("path", path)
    rule, verdict = stated(F.col("host"), F.col("path"), rules)
    rows = split_.withColumn("rule", rule).withColumn("stated", verdict)
    worded = materialise(rows.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path"))), "urls")
    mined = mine(worded.where("stated IS NOT NULL").select("tokens", F.col("stated").alias("verdict")), support, confidence)
    if mined is None:
        judged = worded.withColumn("mined", F.lit(None).cast("string"))
    else:
        index = mined.select("anchor", F.col("tokens").alias("need"), F.col("verdict").alias("said"), "confidence", "support")
        open_ = worded.where("stated IS NULL AND url IS NOT NULL").select("url", "tokens").distinct()
        met = open_.select("url", "tokens", F.explode("tokens").alias("token")).join(index, F.col("token") == F.col("anchor"))
        met = met.where(F.size(F.array_except("need", "tokens")) == 0)
        best = met.groupBy("url").agg(F.max_by("said", F.struct("confidence", F.size("need"), "support", "said")).alias("mined"))
        judged = worded.join(best, "url", "left")
    by = F.when(F.col("stated").isNotNull(), "rule").when(F.col("mined").isNotNull(), "mined").otherwise("default")
    return judged.select(F.col("_key").alias(key), "host", "path", "rule",
                         F.coalesce("stated", "mined", F.lit("allow")).alias("verdict"), by.alias("by"))
