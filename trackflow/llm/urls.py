"""URL filtering by rules and, where no rule fits, by two character language models; DataFrame functions only.

URLs that rules allow or block train one model each: a variable-order Markov model, in which every order is smoothed by the
next shorter one in proportion to how many different characters have followed the context. A URL's score is the difference
of its log-likelihoods for each character. One labelled URL in ``HELD_OUT``, chosen by a hash of its text, is held out for
calibration: models of the others score these, and the threshold that parts them best decides on the scores of models of all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.work import staged

ORDER = 4
#: Characters of the uniform distribution below order 0.
ALPHABET = 256
START = "\u0002"
HELD_OUT = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` and for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def whole_of(url: Column) -> Column:
    """The whole URL, null as empty, with its host in lower case."""
    start = F.regexp_extract(url, r"(?s)^.*?://", 0)
    return F.coalesce(F.concat(start, host_of(url), F.substr(url, F.length(start) + F.length(host_of(url)) + 1)), F.lit(""))


def ruling(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits, null if none does; of equal ones the last in the alphabet."""
    fits = [
        F.when(((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path), F.struct(F.lit(len(r.host) + len(r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in rules
    ]
    none = F.lit(None).cast("struct<size: int, rule: string, verdict: string>")
    return F.array_max(F.array(none, *fits))


def grams(text: Column, order: int) -> Column:
    """Array of (context, char): every character with the ``order`` characters before it, padded at the start."""
    chars = F.split(F.concat(F.lit(START * order), text), "")
    each = F.transform(F.sequence(F.lit(order + 1), F.size(chars)), lambda i: F.struct(F.array_join(F.slice(chars, i - order, order), "").alias("context"), F.element_at(chars, i).alias("char")))
    return F.when(F.length(text) > 0, each)


def model(counts: DataFrame, order: int) -> DataFrame:
    """(context, char, gain): the difference of the log-probabilities of two models, from counts of both (``n_allow``, ``n_block``)."""
    shorter = None
    for k in range(order + 1):
        level = counts.select(F.substring("context", order - k + 1, k).alias("context") if k else F.lit("").alias("context"), "char", "n_allow", "n_block")
        level = level.groupBy("context", "char").agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
        after = Window.partitionBy("context")  # at most as many rows as there are characters
        for m in ("allow", "block"):
            level = level.withColumn(f"all_{m}", F.sum(f"n_{m}").over(after)).withColumn(f"kinds_{m}", F.sum((F.col(f"n_{m}") > 0).cast("long")).over(after))
        if shorter is None:
            level = level.withColumns({f"q_{m}": F.lit(1.0 / ALPHABET) for m in ("allow", "block")})
        else:
            below = shorter.select(F.col("context").alias("_context"), F.col("char").alias("_char"), F.col("p_allow").alias("q_allow"), F.col("p_block").alias("q_block"))
            level = level.join(below, (F.expr("substring(context, 2)") == F.col("_context")) & (F.col("char") == F.col("_char")))
        for m in ("allow", "block"):
            smoothed = (F.col(f"n_{m}") + F.col(f"kinds_{m}") * F.col(f"q_{m}")) / (F.col(f"all_{m}") + F.col(f"kinds_{m}"))
            level = level.withColumn(f"p_{m}", F.when(F.col(f"all_{m}") > 0, smoothed).otherwise(F.col(f"q_{m}")))
        shorter = staged(level.select("context", "char", "p_allow", "p_block"), "model")
    return shorter.select("context", "char", (F.log("p_allow") - F.log("p_block")).alias("gain"))


def threshold_of(scored: DataFrame) -> float:
    """The score from which on URLs are allowed: it parts the labelled URLs in ``scored`` with the best mean of both hit rates.

    Scores are rounded to thousandths, so the table of candidates has a bounded size; one number reaches the driver. With
    one label only, zero.
    """
    binned = scored.where("verdict IS NOT NULL").groupBy(F.round("score", 3).alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("allow"), F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("block")
    )
    one = Window.partitionBy(F.lit(1))
    below = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    rates = binned.withColumns({"all_allow": F.sum("allow").over(one), "all_block": F.sum("block").over(one)}).withColumns({
        "lost": F.coalesce(F.sum("allow").over(below), F.lit(0)), "caught": F.coalesce(F.sum("block").over(below), F.lit(0)),
    })
    rates = rates.withColumn("cut", (F.col("bin") + F.coalesce(F.lag("bin").over(one.orderBy("bin")), "bin")) / 2)  # half way to the next lower score
    best = rates.where("all_allow > 0 AND all_block > 0").select("cut", (F.col("caught") / F.col("all_block") - F.col("lost") / F.col("all_allow")).alias("gain"))
    row = best.agg(F.max_by("cut", F.struct("gain", "cut")).alias("cut")).first()
    return float(row[0]) if row and row[0] is not None else 0.0


def trained(every: DataFrame, order: int) -> DataFrame:
    """Gains of the models of the labelled URLs among ``every`` (text, verdict, n, context, char); other URLs count nothing."""
    sums = {m: F.sum(F.when(F.col("verdict") == m, F.col("n")).otherwise(0)).alias(f"n_{m}") for m in ("allow", "block")}
    counts = staged(every.groupBy("context", "char").agg(*sums.values()), "counts")
    return staged(model(counts, order), "gains")


def scores(texts: DataFrame, every: DataFrame, gains: DataFrame) -> DataFrame:
    """``texts`` with the mean gain of their characters, 0 for an empty text."""
    each = every.select("text", "context", "char").join(gains, ["context", "char"]).groupBy("text").agg((F.sum("gain") / F.count("*")).alias("score"))
    return texts.join(each, "text", "left").select("text", "verdict", "n", F.coalesce("score", F.lit(0.0)).alias("score"))


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", order: int = ORDER, whole: bool = False) -> DataFrame:
    """The id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` and ``score`` of every URL.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins. Otherwise the models decide:
    allow from the threshold on, which is 0 where the held-out URLs do not have both labels. They are trained on and judge the ``whole`` URL with its query and fragment, or else host and
    path only. A null URL, or one without ``://``, has an empty host and path; a text that is empty has score 0. Repeated rows are
    judged alike and weigh as often as they occur; other columns are not read. No rows: no rows.
    """
    spark, url = pages.sparkSession, F.col(url_col)
    parts = pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"), *([whole_of(url).alias("text")] if whole else []))
    parts = parts.select("_id", "host", "path", F.col("text") if whole else F.concat("host", "path").alias("text"), ruling(F.col("host"), F.col("path"), rules).alias("_rule"))
    texts = staged(parts.groupBy("text", F.col("_rule.verdict").alias("verdict")).agg(F.count("*").alias("n")), "urls")  # the text settles the rule
    spread = texts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "text")  # few files of texts hold many characters
    every = spread.select("text", "verdict", "n", F.explode(grams(F.col("text"), order)).alias("g")).select("text", "verdict", "n", "g.*")
    scored = staged(scores(texts, every, trained(every, order)), "scores")
    held = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    kept = every.withColumn("verdict", F.when(~held, F.col("verdict")))  # grams of the held out stay known, with a count of 0
    apart = held & F.col("verdict").isNotNull()
    least = threshold_of(scores(texts.where(apart), every.where(apart), trained(kept, order)))
    judged = parts.join(scored.select("text", "score"), "text")
    verdict = F.coalesce("_rule.verdict", F.when(F.col("score") >= least, "allow").otherwise("block"))
    return judged.select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "score")
