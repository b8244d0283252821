"""URL filter: host and path rules, and a character language-model ratio for the URLs that no rule fits.

The URLs with a verdict by rule train two smoothed Markov models of variable order, one of accepted and one of
rejected URLs. A character's chance after a context interpolates its count there with its chance after the context
that is one character shorter, down to an even chance. A URL's score is the mean log-likelihood difference per
character. The models learn from one half of the URLs with a rule, told by a hash; the threshold is the one that errs
least on the other half, which they never saw, both classes weighing alike.

Everything is DataFrame work: equal URLs are counted before they are cut into characters, n-grams are added up before
each shuffle, and the models stay tables that are joined on the n-gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import lower_ascii, pick, shuffle_partitions
from emporia.sources.shared import written

#: Characters of context at most.
ORDER = 3
#: Weight of the shorter context's chance, in counts.
SMOOTHING = 2.0
ALPHABET = 256
BEGIN, END = "\x02", "\x03"
#: Scores are calibrated on steps of this width.
STEP = 0.01
REACH = 20.0

Rule = tuple[str, str, str]
CLASSES = ("allow", "block")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null and for a URL without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    held = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(held, shape, 1)), F.regexp_extract(held, shape, 2)


def _fits(host: Column, path: Column, rule: Rule) -> Column:
    return ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, ruling``: the longest rule that fits, null without one.

    A rule is (verdict, host, path); it fits its host and all subdomains when the URL's path starts with its own. Of
    rules of equal length that fit, the later one in the list wins.
    """
    host, path = split_url(F.col("url"))
    parts = pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    name, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = _fits(F.col("host"), F.col("path"), rule)
        name = F.when(fits, F.lit(rule[1] + rule[2])).otherwise(name)
        ruling = F.when(fits, F.lit(rule[0])).otherwise(ruling)
    return parts.withColumn("rule", name).withColumn("ruling", ruling)


def _grams(urls: DataFrame, size: int) -> DataFrame:
    """``key, gram``: every character of a URL with ``size - 1`` characters of context, its end included."""
    held = F.concat(F.lit(BEGIN * (size - 1)), F.col("key"), F.lit(END))
    places = F.sequence(F.lit(1), F.length("key") + 1)
    return urls.withColumn("held", held).withColumn("at", F.explode(places)).withColumn(
        "gram", F.substring(F.col("held"), F.col("at"), F.lit(size))
    )


def learned(urls: DataFrame) -> DataFrame:
    """``urls`` with the label counts of the half that is learned from; those of the other half are zero."""
    return _half(urls, 0)


def kept_back(urls: DataFrame) -> DataFrame:
    """``urls`` with the label counts of the half that the models never see."""
    return _half(urls, 1)


def _half(urls: DataFrame, half: int) -> DataFrame:
    inside = F.pmod(F.xxhash64(F.lit("half"), "key"), F.lit(2)) == half
    return urls.withColumns({f"n_{c}": F.when(inside, F.col(f"n_{c}")).otherwise(F.lit(0)) for c in CLASSES})


def train(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: the log-likelihood difference of each n-gram's last character after the others.

    ``urls`` has ``key, n_allow, n_block``. N-grams of URLs without a label are there with counts of zero, so every
    character of every URL finds its ratio under one n-gram of the longest size.
    """
    counts = [f"n_{c}" for c in CLASSES]
    longest = written(
        _grams(urls, order + 1).groupBy("gram").agg(*[F.sum(c).alias(c) for c in counts]), "url-grams"
    )
    model: DataFrame | None = None
    for size in range(1, order + 2):
        # an n-gram's shorter forms are its ends, so their counts are sums of its own
        grams = longest.groupBy(F.substring("gram", order + 2 - size, size).alias("gram")).agg(
            *[F.sum(c).alias(c) for c in counts]
        )
        context = F.substring("gram", 1, size - 1)
        totals = grams.groupBy(context.alias("context")).agg(*[F.sum(c).alias(f"t_{c}") for c in counts])
        held = grams.withColumn("context", context).join(totals, "context")
        if model is None:
            held = held.withColumns({f"b_{c}": F.lit(1.0 / ALPHABET) for c in CLASSES})
        else:
            shorter = model.select(F.col("gram").alias("tail"), *[F.col(f"p_{c}").alias(f"b_{c}") for c in CLASSES])
            held = held.withColumn("tail", F.substring("gram", 2, size - 1)).join(shorter, "tail")
        chances = {
            f"p_{c}": (F.col(f"n_{c}") + SMOOTHING * F.col(f"b_{c}")) / (F.col(f"t_n_{c}") + SMOOTHING) for c in CLASSES
        }
        model = written(held.withColumns(chances).select("gram", *chances), "url-model")
    return model.select("gram", (F.ln("p_allow") - F.ln("p_block")).alias("ratio"))


def scored(urls: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls`` with ``score``, the mean log-likelihood difference per character (its end included)."""
    each = _grams(urls.select("key"), order + 1).groupBy("key", "gram").agg(F.count(F.lit(1)).alias("n"))
    summed = each.join(model, "gram").groupBy("key").agg(
        F.round(F.sum(F.col("ratio") * F.col("n")) / F.sum("n"), 6).alias("score")
    )
    return urls.join(summed, "key")


def calibrated(scores: DataFrame) -> DataFrame:
    """``threshold``, one row: URLs that score below it are blocked.

    Of all steps the one with the smallest sum of both classes' error rates, the lowest among equals; ``scores`` has
    ``score, n_allow, n_block``. Without labelled URLs of both classes it is 0.
    """
    reach = F.least(F.greatest(F.col("score"), F.lit(-REACH)), F.lit(REACH))
    steps = scores.groupBy(F.floor(reach / STEP).alias("step")).agg(*[F.sum(f"n_{c}").alias(f"n_{c}") for c in CLASSES])
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # at most 2 * REACH / STEP + 1 steps, whatever the number of URLs
    error = F.coalesce(F.sum("n_allow").over(below), F.lit(0)) / F.sum("n_allow").over(whole) + (
        F.sum("n_block").over(whole) - F.coalesce(F.sum("n_block").over(below), F.lit(0))
    ) / F.sum("n_block").over(whole)
    both = (F.sum("n_allow").over(whole) > 0) & (F.sum("n_block").over(whole) > 0)
    tried = steps.withColumn("error", F.when(both, error)).filter(F.col("error").isNotNull())
    best = tried.agg(F.min_by("step", F.struct("error", "step")).alias("step"))
    return best.select((F.coalesce(F.col("step"), F.lit(0)) * F.lit(STEP)).alias("threshold"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row.

    The verdict is the rule's, else ``block`` where the score lies below the calibrated threshold and ``allow``
    elsewhere. Models read host and path; null URLs have neither and are scored as an empty URL. Repeated rows each
    appear, and an empty table gives no rows. A URL may be of any length: it makes a row for each character, and only
    equal n-grams are ever added up together.
    """
    held = ruled(pages, rules)
    key = F.concat("host", "path")
    urls = held.groupBy(key.alias("key")).agg(
        *[F.sum(F.when(F.col("ruling") == c, 1).otherwise(0)).alias(f"n_{c}") for c in CLASSES]
    )
    # dealt out by number, since a small table would come to one task with all its characters
    urls = written(urls.repartition(shuffle_partitions(urls), "key"), "urls")
    scores = written(scored(urls, train(learned(urls))), "url-scores")
    with_score = held.withColumn("key", key).join(scores.select("key", "score"), "key")
    method = F.when(F.col("score") < F.col("threshold"), "block").otherwise("allow")
    return with_score.crossJoin(F.broadcast(calibrated(kept_back(scores)))).select(
        "page_id", "host", "path", "rule", F.coalesce("ruling", method).alias("verdict"), "score"
    )
