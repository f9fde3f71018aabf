"""URL filter: host rules first, then the ratio of two character models. DataFrame functions only.

The rules decide the urls that they fit. The urls that they accept and those
that they reject train one character model each: an interpolated Markov model
of orders zero to three, where a long context falls back on the shorter one in
proportion to how rarely it was seen. A url without a rule is allowed when its
log-likelihood difference per character reaches the threshold, which is
calibrated on a fifth of the ruled urls that the counts leave out. Only the
rules look at host and path; the models read whole urls.

Symbols are the 41 of ``ALPHABET`` (letters are lower-cased, digits are one
symbol, anything else is ``~``), so the model has at most 41 ** 4 rows whatever
the input; that bound is what allows it to be broadcast.

Null urls and urls without ``://`` have an empty host and path, which no rule
fits; without any character there is no evidence, and the verdict is block. Without ruled urls of
both kinds the threshold is zero. Repeated rows are judged each; an empty table
gives an empty result; other columns of the input are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import written

ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_?=&%:@+~^$"
ORDER = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule, else null. A rule is a host, then a path that starts with a slash."""
    rule = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: len(r[0])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(
            path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
    return rule


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url (null: empty), host, path, rule and the rule's verdict (null without a rule)."""
    parts = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for text, decision in rules:
        verdict = F.when(F.col("rule") == text, F.lit(decision)).otherwise(verdict)
    return parts.withColumn("ruled", verdict)


def symbols(text: Column) -> Column:
    """The text in the model's alphabet between start and end marks; empty stays empty."""
    low = F.regexp_replace(F.lower(text), "[0-9]", "0")
    low = F.regexp_replace(low, r"[^a-z0./\-_?=&%:@+]", "~")
    return F.when(F.length(text) > 0, F.concat(F.lit("^" * ORDER), low, F.lit("$"))).otherwise(F.lit(""))


def grams(frame: DataFrame, text: str) -> DataFrame:
    """A row per character with its context: ``gram`` holds three symbols of context and the character."""
    places = F.when(F.length(text) > ORDER, F.sequence(F.lit(1), F.length(text) - ORDER))
    return frame.withColumn("at", F.explode(places)).withColumn(
        "gram", F.substring(F.col(text), F.col("at"), F.lit(ORDER + 1))).drop("at")


def calibration_fold(url: Column) -> Column:
    return F.crc32(url) % 5 == 0


def _probability(count: str, totals: float, strength: float) -> Column:
    """Interpolated probability of the last symbol, from the counts of all grams."""
    size = float(len(ALPHABET))
    p = (F.sum(count).over(Window.partitionBy(F.substring("gram", 4, 1))) + strength / size) / (totals + strength)
    for order in range(1, ORDER + 1):
        start = ORDER + 1 - order
        seen = F.sum(count).over(Window.partitionBy(F.substring("gram", start, order + 1)))
        context = F.sum(count).over(Window.partitionBy(F.substring("gram", start, order)))
        p = (seen + strength * p) / (context + strength)
    return p


def fit(pages: DataFrame, strength: float = 4.0) -> DataFrame:
    """(gram, ratio): the log-ratio of the two models for every gram of any url, from counts over all
    ruled urls outside the calibration fold."""
    learned = F.when(calibration_fold(F.col("url")), F.lit("")).otherwise(
        F.coalesce("ruled", F.lit("")))
    texts = pages.select(learned.alias("kind"), symbols(F.col("url")).alias("text"))
    counts = written(
        grams(texts, "text").groupBy("gram").agg(
            F.count_if(F.col("kind") == "allow").alias("accepted"),
            F.count_if(F.col("kind") == "block").alias("rejected")), "grams")
    totals = counts.agg(F.sum("accepted"), F.sum("rejected")).first()
    ratio = F.log(_probability("accepted", float(totals[0] or 0), strength)) - F.log(
        _probability("rejected", float(totals[1] or 0), strength))
    return written(counts.select("gram", ratio.alias("ratio")), "url-model")


def scored(pages: DataFrame, model: DataFrame) -> DataFrame:
    """``pages`` with ``score``: the mean log-ratio per character, null without characters."""
    keyed = pages.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "text", symbols(F.col("url")))
    placed = keyed.withColumn("at", F.explode_outer(
        F.when(F.length("text") > ORDER, F.sequence(F.lit(1), F.length("text") - ORDER))))
    # A page's grams are scored and summed in the task that reads it; one row per page is shuffled.
    # At most 41 ** 4 short rows are broadcast.
    hit = placed.withColumn("gram", F.substring("text", F.col("at"), F.lit(ORDER + 1))).join(
        F.broadcast(model), "gram", "left")
    return hit.groupBy("row", *pages.columns).agg(
        # Sums of whole millionths do not depend on the order of addition.
        (F.sum(F.round(F.col("ratio") * 1_000_000).cast("long")) / F.count("ratio") / 1_000_000).alias("score")
    ).drop("row")


def threshold(pages: DataFrame, model: DataFrame) -> float:
    """Between the classes' mean scores on the calibration fold, nearer to the narrower class."""
    held = pages.where(F.col("ruled").isNotNull() & calibration_fold(F.col("url")))
    found = {r["ruled"]: (r["m"], r["s"] or 0.0) for r in scored(held, model).groupBy("ruled").agg(
        F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect() if r["m"] is not None}
    if len(found) < 2:
        return 0.0
    (a, sa), (r, sr) = found["allow"], found["block"]
    return round((a * sr + r * sa) / (sa + sr) if sa + sr > 0 else (a + r) / 2, 6)


def judge(pages: DataFrame, rules=RULES, strength: float = 4.0) -> DataFrame:
    """page_id, host, path, rule, verdict, score."""
    known = ruled(pages, rules)
    model = fit(known, strength)
    least = threshold(known, model)
    by_score = F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return scored(known, model).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score")
