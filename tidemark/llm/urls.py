"""Operator 9, URL filter by a ratio of character language models.

Host and path rules (``net/``, ``example.org/es/``) decide first: a rule fits its
host and all subdomains if the path starts with the rule's path; the longest
fitting rule wins (ties: the smaller string).  URLs without a fitting rule are
judged by two smoothed variable-order Markov models, of accepted and of rejected
URLs, learned from the URLs that rules decide.  Both models interpolate orders 0
to ``order`` after Witten and Bell:

    p(c | ctx) = (n(ctx c) + T(ctx) * p(c | shorter ctx)) / (N(ctx) + T(ctx))

where T(ctx) is the number of different characters seen after ctx.  The score is
the difference of the log-likelihoods over the number of characters; a URL is
accepted from a threshold on, which is calibrated on the fifth of the labelled
URLs that the models have not seen (best balanced accuracy; ties: the smaller
distance to 0).

Counts are taken over all labelled URLs and kept as tables: the models are a
table of n-grams with a score each, joined to the n-grams of the distinct URLs.

Defined results: a null URL, or one without ``://``, has empty host and path, and
no rule; a null URL scores as an empty one; with one class only (or none) the
threshold is 0; repeated rows stay; an empty table gives no rows; columns beside
``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, stored

START, END = "\x02", "\x03"
ORDER = 4
#: Weight of the lowest order: a character never seen has 1 / ALPHABET.
ALPHABET = 256
FOLDS = 5
#: Scores are calibrated to this many decimals, within the limits.
DECIMALS, LIMIT = 2, 5.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as columns; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(tail, F.lit(""))


def with_rules(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    rule = verdict = F.lit(None).cast("string")
    for x in sorted(rules, key=lambda r: (len(r.rule), [-ord(c) for c in r.rule])):  # the last one wins
        fits = ((F.col("host") == x.host) | F.col("host").endswith("." + x.host)) & F.col("path").startswith(x.path)
        rule, verdict = F.when(fits, F.lit(x.rule)).otherwise(rule), F.when(fits, F.lit(x.verdict)).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("by_rule", verdict)


def grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """A row for each character of ``url`` and its end, with up to ``order``
    characters before it: columns of ``urls`` and ``gram``."""
    text = F.concat(F.lit(START), F.col("url"), F.lit(END))
    rows = urls.withColumn("_t", text).withColumn("_i", F.explode(F.sequence(F.lit(2), F.char_length("_t"))))
    start = F.greatest(F.lit(1), F.col("_i") - order)
    return rows.withColumn("gram", F.substring(F.col("_t"), start, F.col("_i") - start + 1)).drop("_t", "_i")


def gram_scores(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, llr)`` of every gram in ``(gram, n_a, n_r)``: log p(last character
    | rest) under the accepted less under the rejected model."""
    at = F.char_length("gram")
    lower = scores = None
    for o in range(order + 1):
        level = counts.filter(at > o).groupBy(F.expr(f"right(gram, {o + 1})").alias("gram")).agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))
        w = Window.partitionBy("ctx")
        level = level.withColumn("ctx", F.expr(f"left(gram, {o})"))
        for k in "ar":
            level = level.withColumn(f"all_{k}", F.sum(f"n_{k}").over(w)).withColumn(f"kinds_{k}", F.sum((F.col(f"n_{k}") > 0).cast("long")).over(w))
        if lower is None:
            level = level.withColumn("q_a", F.lit(1.0 / ALPHABET)).withColumn("q_r", F.lit(1.0 / ALPHABET))
        else:
            short = lower.select(F.col("gram").alias("_s"), F.col("p_a").alias("q_a"), F.col("p_r").alias("q_r"))
            level = level.join(short, F.expr(f"right(gram, {o})") == F.col("_s"))
        for k in "ar":
            total = F.col(f"all_{k}") + F.col(f"kinds_{k}")
            mixed = (F.col(f"n_{k}") + F.col(f"kinds_{k}") * F.col(f"q_{k}")) / F.when(total > 0, total)
            level = level.withColumn(f"p_{k}", F.coalesce(mixed, F.col(f"q_{k}")))
        lower = level.select("gram", "p_a", "p_r")
        if o < order:
            lower = stored(lower, f"url-order{o}")
        # a gram shorter than the longest stands at the start of a URL
        own = lower if o == order else lower.filter(F.col("gram").startswith(START))
        part = own.select("gram", (F.log("p_a") - F.log("p_r")).alias("llr"))
        scores = part if scores is None else scores.unionByName(part)
    return scores


def url_scores(labelled: DataFrame, order: int = ORDER) -> tuple[DataFrame, float]:
    """``(url, score)`` of every distinct URL in ``(url, by_rule)``, and the
    calibrated threshold."""
    urls = labelled.select(F.coalesce("url", F.lit("")).alias("url"), "by_rule").groupBy("url").agg(F.max("by_rule").alias("by_rule"))
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS))
    urls = stored(urls.withColumn("seen", F.col("by_rule").isNotNull() & (fold != 0)), "urls")
    seen = lambda v: F.sum((F.col("seen") & (F.col("by_rule") == v)).cast("long"))
    counts = stored(grams(urls, order).groupBy("gram").agg(seen("allow").alias("n_a"), seen("block").alias("n_r")), "url-grams")
    model = stored(gram_scores(counts, order), "url-model")
    per = grams(urls, order).groupBy("url", "gram").agg(F.count("*").alias("n"))
    total = per.join(small(model), "gram").groupBy("url").agg(F.sum(F.round(F.col("llr") * F.col("n"), 9).cast("decimal(28,9)")).alias("llr"))
    score = F.col("llr").cast("double") / (F.char_length("url") + 1)
    scores = stored(urls.join(total.withColumnRenamed("url", "_u"), F.col("url") == F.col("_u")).select("url", "by_rule", "seen", score.alias("score")), "url-scores")
    held = scores.filter(F.col("by_rule").isNotNull() & ~F.col("seen"))
    held = held.groupBy(F.round(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), "score")), DECIMALS).alias("s"))
    bins = held.agg(F.sum((F.col("by_rule") == "allow").cast("long")).alias("a"), F.sum((F.col("by_rule") == "block").cast("long")).alias("r"))
    return scores.select("url", "score"), threshold([(x.s, x.a, x.r) for x in bins.collect()])


def threshold(bins: list[tuple[float, int, int]]) -> float:
    """Least score to accept, from ``(score, accepted, rejected)`` counts of at
    most 2 * LIMIT * 10**DECIMALS + 1 bins."""
    good, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not good or not bad:
        return 0.0
    step = 10.0**-DECIMALS
    tries = [0.0, *(s + x for s, _, _ in bins for x in (-step / 2, step / 2))]
    rate = lambda t: sum(b[1] for b in bins if b[0] >= t) / good + sum(b[2] for b in bins if b[0] < t) / bad
    return max(tries, key=lambda t: (round(rate(t), 9), -abs(t), t))


def judge(pages: DataFrame, rules: tuple[Rule, ...], order: int = ORDER) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)``; ``score`` is the model's,
    also where a rule decides."""
    rows = with_rules(pages, rules)
    scores, least = url_scores(rows.select("url", "by_rule"), order)
    joined = rows.withColumn("_u", F.coalesce("url", F.lit(""))).join(scores.withColumnRenamed("url", "_v"), F.col("_u") == F.col("_v"), "left")
    by_model = F.when(F.col("score") >= least, "allow").otherwise("block")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")
