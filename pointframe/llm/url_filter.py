"""URL filter: host and path rules, and a character language-model ratio where no rule fits.

Two variable-order Markov models of characters, one of URLs that the rules accept and one of those
that they reject, are compared. Each is interpolated from order 0 up by Witten-Bell smoothing, so a
context that was never seen falls back to a shorter one. The interpolation is written as a sum: a
seen context of order k adds the logarithm of its back-off weight, and a seen n-gram the logarithm
of what it gains over backing off. The log-likelihood ratio of a URL is therefore one sum over the
contexts and n-grams it holds, which is a join and a grouped sum. Two thirds of the labelled URLs
train the models; the rest calibrate the cut on the ratio per character.

DataFrame operations only. URLs are made distinct first, so a URL that is a third of all rows is
scored once. N-grams are counted over all labelled URLs and the model keeps every one, so it grows with
the input. Only the entries of keys that are hot among the asked ones (at least one in ``_HOT`` positions,
so a bounded number) are broadcast; all others meet the asked keys by exchange, where no key has many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join

# (verdict, host, path): fixed values
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ALPHABET = 96
_HOT = 2_000
_TASK = 100_000  # characters of a task, until there are as many tasks as shuffle partitions


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    whole = F.coalesce(F.col(url), F.lit(""))
    return F.translate(F.regexp_extract(whole, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(whole, _PARTS, 2)


def matching_rule(host: str, path: str, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):  # the last that fits stands
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _normal(url: str, order: int) -> Column:
    """What the models read: lower case, a start of ``order`` marks and an end mark."""
    return F.concat(F.lit("^" * order), F.lower(F.col(url)), F.lit("$"))


def _characters(urls: DataFrame) -> int:
    return urls.agg(F.sum(F.length("url") + 1)).first()[0] or 0


def _positions(urls: DataFrame, order: int, characters: int) -> DataFrame:
    # a URL becomes some hundred rows: deal out by characters, not by the few bytes that the URLs have, and into no
    # more tasks than they need, since each sums its own keys before the exchange
    spark = urls.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-characters // _TASK))
    s = urls.repartition(max(parts, spark.sparkContext.defaultParallelism)).withColumn("s", _normal("url", order))
    return s.withColumn("i", F.explode(F.sequence(F.lit(order + 1), F.length("s"))))


def train(labelled: DataFrame, order: int, max_grams: int | None = None) -> DataFrame:
    """Model entries ``key, value`` from ``labelled(url, allow)``; a key is 'g' + n-gram or 'c' + context.

    All n-grams are kept, unless a caller gives ``max_grams``: then those rarer than one in ``max_grams`` characters
    of their class count as unseen."""
    grams = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"substring(s, i - {k}, {k + 1})").alias("gram")) for k in range(order + 1)])).alias("x")
    counts = cut(_positions(labelled, order, _characters(labelled)).select("allow", grams).groupBy("allow", "x.k", "x.gram").agg(F.count("*").alias("n")))
    if max_grams is not None:
        least = counts.where("k = 0").groupBy("allow").agg(F.ceil(F.sum("n") / max_grams).alias("least"))  # two rows
        counts = cut(counts.join(F.broadcast(least), "allow").where("n >= least").drop("least"))
    lower, entries = None, None
    for k in range(order + 1):
        level = counts.where(F.col("k") == k).withColumn("context", F.expr(f"substring(gram, 1, {k})"))
        contexts = level.groupBy("allow", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        level = level.join(contexts, ["allow", "context"])
        if lower is None:
            level = level.withColumn("back", F.lit(1.0 / _ALPHABET))
        else:
            level = level.withColumn("tail", F.expr("substring(gram, 2)")).join(lower.select("allow", F.col("gram").alias("tail"), F.col("p").alias("back")), ["allow", "tail"])
        level = level.withColumn("p", (F.col("n") + F.col("types") * F.col("back")) / (F.col("total") + F.col("types")))
        lower = level = cut(level.select("allow", "gram", "p", (F.col("p") / (F.col("types") / (F.col("total") + F.col("types")) * F.col("back"))).alias("gain")))
        sign = F.when(F.col("allow"), 1.0).otherwise(-1.0)
        here = level.select(F.concat(F.lit("g"), "gram").alias("key"), (sign * F.log("gain")).alias("value")).unionByName(
            contexts.select(F.concat(F.lit("c"), "context").alias("key"), (sign * F.log(F.col("types") / (F.col("total") + F.col("types")))).alias("value"))
        )
        entries = here if entries is None else entries.unionByName(here)
    return cut(entries.groupBy("key").agg(F.sum("value").alias("value")))


def ratio(urls: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """``url`` and ``score``, the log-likelihood ratio per character of distinct URLs."""
    keys = [F.expr(f"concat('g', substring(s, i - {k}, {k + 1}))") for k in range(order + 1)] + [F.expr(f"concat('c', substring(s, i - {k}, {k}))") for k in range(order + 1)]
    urls = cut(urls.select("url", F.monotonically_increasing_id().alias("at")))
    positions = _characters(urls)
    asked = _positions(urls, order, positions).select("at", F.explode(F.array(*keys)).alias("key"))
    hot = cut(asked.groupBy("key").count().where(F.col("count") >= max(1, positions // _HOT)).select("key"))
    warm = cut(model.join(F.broadcast(hot), "key", "left_semi"))
    rest = asked.join(F.broadcast(hot), "key", "left_anti")
    cold = model.join(F.broadcast(hot), "key", "left_anti").hint("shuffle_hash")
    values = asked.join(F.broadcast(warm), "key").select("at", "value").unionByName(rest.join(cold, "key").select("at", "value"))
    sums = values.groupBy("at").agg(F.sum("value").alias("sum"))
    return urls.join(sums, "at", "left").select("url", (F.coalesce("sum", F.lit(0.0)) / (F.length("url") + 1)).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The cut on ``scored(score, allow)`` with the least balanced error; from a histogram of at most 4,001 bins."""
    bins = scored.groupBy(F.round(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "score")) * 100).cast("int").alias("bin")).agg(F.count_if("allow").alias("good"), F.count_if(~F.col("allow")).alias("bad")).collect()
    good, bad = sum(r.good for r in bins), sum(r.bad for r in bins)
    if not good or not bad:
        return 0.0
    best, edge, lost, kept = 2.0, 0.0, 0, bad
    for r in sorted(bins, key=lambda r: r.bin):
        if lost / good + kept / bad < best:
            best, edge = lost / good + kept / bad, r.bin / 100 - 0.005
        lost, kept = lost + r.good, kept - r.bad
    if lost / good + kept / bad < best:
        edge = max(r.bin for r in bins) / 100 + 0.005
    return edge


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, order: int = 6, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: ``id_col``, ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    A rule's verdict stands; elsewhere a URL is blocked if its ratio per character lies below the
    calibrated cut. ``score`` is null where a rule decides. Null URLs read as empty ones. Where the
    rules accept nothing or reject nothing there is no model: ratios are 0 and the verdict is 'allow'.
    Whole URLs are read, however long. Repeated rows are all kept; an empty table gives an empty table; other
    columns are not read.
    """
    host, path = host_and_path("url")
    base = pages.select(F.col(id_col), F.coalesce(F.col(url_col), F.lit("")).alias("url")).withColumn("host", host).withColumn("path", path)
    rule, verdict = matching_rule("host", "path", rules)
    base = base.withColumn("rule", rule).withColumn("verdict", verdict)
    urls = cut(base.groupBy("url").agg(F.first("verdict").alias("verdict"), F.count("*").alias("count")))
    labelled = urls.where("verdict is not null").select("url", (F.col("verdict") == "allow").alias("allow"), (F.pmod(F.xxhash64("url"), F.lit(3)) == 0).alias("held"))
    trained_on = labelled.where("not held").select("url", "allow")
    both = {r.allow for r in trained_on.groupBy("allow").count().collect()}
    model = train(trained_on if len(both) == 2 else trained_on.limit(0), order)
    held = labelled.where("held")
    edge = calibrate(ratio(held.select("url"), model, order).join(held, "url").select("score", "allow"))
    undecided = urls.where("verdict is null")
    # a URL may be a third of all rows
    scored = salted_join(base.where("verdict is null"), ratio(undecided.select("url"), model, order), ["url"], counts=undecided.select("url", "count"))
    judged = F.when(F.col("score") < edge, "block").otherwise("allow")
    names = [id_col, "host", "path", "rule", "verdict", "score"]
    return base.where("verdict is not null").withColumn("score", F.lit(None).cast("double")).select(*names).unionByName(scored.withColumn("verdict", judged).select(*names))
