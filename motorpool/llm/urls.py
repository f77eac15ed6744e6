"""URL filter by a ratio of character language models.

Two variable-order Markov models, of accepted and of rejected URLs, give each character a probability from the longest
context seen, mixed with those of all shorter contexts (Witten-Bell weights). The difference of the log-likelihoods,
divided by the number of characters, is compared with a limit calibrated on labelled URLs that were held back.
Everything is built-in column code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import written

#: Longest context in characters.
ORDER = 4
#: Grams up to this number are broadcast for scoring (about 40 bytes each); above it the join is by shuffle.
BROADCAST_GRAMS = 300_000
#: One labelled URL in so many is held back to calibrate the limit.
HOLD_BACK = 4
#: Characters of a URL that are cut into grams at once.
BLOCK = 256
#: In a shuffled join, grams above this share (one in so many) of all are spread over so many salts.
HOT, SALTS = 1000, 64
_START = "\x02"
_END = "\x03"


def host(url: F.Column) -> F.Column:
    """From after the first ``://`` up to / ? # or the end, A-Z lower-cased; empty for null and for URLs without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: F.Column) -> F.Column:
    """What follows the host, up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: F.Column) -> F.Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def matched(host_: F.Column, path_: F.Column, rules: list[tuple[str, str]]) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule is (verdict, "host/path...")."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, tail = text.split("/", 1)
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith("/" + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """A row per character of ``u`` and its end mark: the context of ``order`` characters and the character, as ``g``.
    Long URLs are cut into overlapping blocks first, so that no character is looked up from the start of its URL."""
    rest = [c for c in urls.columns if c != "u"]
    padded = F.concat(F.lit(_START * order), F.col("u"), F.lit(_END))
    blocks = F.explode(F.sequence(F.lit(0), F.floor(F.length("u") / BLOCK).cast("int")))
    cut = urls.select(*rest, padded.alias("_p"), blocks.alias("_b")).select(*rest, F.substring("_p", F.col("_b") * BLOCK + 1, F.lit(BLOCK + order)).alias("_p"))
    spots = F.explode(F.sequence(F.lit(1), F.length("_p") - order))
    return cut.select(*rest, "_p", spots.alias("_i")).select(*rest, F.substring("_p", F.col("_i"), F.lit(order + 1)).alias("g"))


def fit(labelled: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(g, gain) for every distinct gram of ``wanted``: log P(accepted) - log P(rejected) of its last character.

    ``labelled`` has the URLs ``u`` and ``good`` (boolean), repeated URLs count as often as they occur. The distinct
    endings of the grams are mixed length by length, each from the ending that is one character shorter. So a join key
    has at most one row per character of the alphabet, however common the character or the context is.
    """
    counted = written(_grams(labelled.select("good", "u"), order).groupBy("good", "g").agg(F.count("*").alias("n")), "grams")
    symbols = counted.select(F.substring("g", order + 1, 1)).distinct().count() + 1
    # every gram at every length, counted for both sides at once; its length tells the order of its context
    level = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k")
    ending = F.substring("g", F.lit(order + 1) - F.col("k"), F.col("k") + 1).alias("gk")
    one = lambda side: F.coalesce(F.sum(F.when(F.col("good") == side, F.col("n"))), F.lit(0))
    seen = written(counted.select("good", "n", "g", level).select("good", "n", ending).groupBy("gk").agg(one(True).alias("n1"), one(False).alias("n0")), "seen")
    before = F.expr("substring(gk, 1, length(gk) - 1)").alias("ck")
    context = seen.groupBy(before).agg(
        F.sum("n1").alias("all1"), F.count_if(F.col("n1") > 0).alias("kinds1"), F.sum("n0").alias("all0"), F.count_if(F.col("n0") > 0).alias("kinds0")
    )
    endings = wanted.select("g", level).select(ending).distinct().select("gk", before)
    stats = written(endings.join(seen, "gk", "left").join(context, "ck", "left").na.fill(0), "endings")

    def mixed(side: str) -> F.Column:
        total, kinds, p = F.col(f"all{side}"), F.col(f"kinds{side}"), F.col(f"p{side}")
        return F.when(total > 0, (F.col(f"n{side}") + kinds * p) / (total + kinds)).otherwise(p)

    shorter = None
    for k in range(order + 1):
        own = stats.where(F.length("gk") == k + 1)
        if shorter is None:
            own = own.withColumns({"p1": F.lit(1.0 / symbols), "p0": F.lit(1.0 / symbols)})
        else:
            own = own.withColumn("tail", F.expr("substring(gk, 2)")).join(shorter.withColumnRenamed("gk", "tail"), "tail")
        shorter = own.select("gk", mixed("1").alias("p1"), mixed("0").alias("p0"))
    return shorter.select(F.col("gk").alias("g"), (F.log("p1") - F.log("p0")).alias("gain"))


def scores(urls: DataFrame, gains: DataFrame, order: int = ORDER) -> DataFrame:
    """(u, score) for every distinct URL: the mean gain of its characters and end mark.

    Beyond ``BROADCAST_GRAMS`` the join is by shuffle; grams that are more than one in ``HOT`` of all (so fewer than
    ``HOT``) are spread over ``SALTS`` tasks there.
    """
    rows = _grams(urls.select("u", F.col("u").alias("url")), order)
    if gains.count() <= BROADCAST_GRAMS:
        rows = rows.join(F.broadcast(gains), "g")
    else:
        total = urls.agg(F.sum(F.length("u") + 1)).first()[0]
        hot = written(rows.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") * HOT > total).select("g", F.lit(SALTS).alias("salts")), "hot")
        spread = lambda df: df.join(F.broadcast(hot), "g", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        rows = spread(rows).withColumn("salt", F.pmod(F.xxhash64("url"), F.col("salts")).cast("int"))
        copies = spread(gains).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        rows = rows.drop("salts").join(copies.drop("salts"), ["g", "salt"])
    return rows.groupBy(F.col("url").alias("u")).agg(F.round(F.avg("gain"), 9).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The limit that best parts ``good`` from other rows, by balanced accuracy over hundredths of the score.

    The scores are counted in at most 4001 bins, so the last step reads a bounded table. Among equal limits the one in
    the middle is taken. With rows of one class only, the limit lets all of them pass or none.
    """
    bins = scored.groupBy(F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") * 100))).cast("int").alias("bin"))
    rows = bins.agg(F.sum(F.col("good").cast("long")).alias("yes"), F.sum((~F.col("good")).cast("long")).alias("no")).collect()
    yes, no = sum(r.yes for r in rows), sum(r.no for r in rows)
    if not yes or not no:
        return 0.0 if not rows else (-1e9 if yes else 1e9)
    by = {r.bin: r for r in rows}
    best, limits, above, under = -1.0, [], yes, 0
    for edge in range(min(by), max(by) + 2):
        quality = above / yes + under / no
        if quality > best + 1e-12:
            best, limits = quality, []
        if quality > best - 1e-12:
            limits.append(edge)
        if edge in by:
            above, under = above - by[edge].yes, under + by[edge].no
    return limits[len(limits) // 2] / 100


def judge(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", id_col: str = "page_id", order: int = ORDER) -> DataFrame:
    """Every row of ``pages``: its id, ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    A rule that fits decides; it also labels the URL for the models. Other URLs are allowed if their score reaches
    the calibrated limit. The models see the whole URL in lower case, after ``://`` where it has one. Null and empty URLs
    score as the empty text. Repeated rows get equal results; extra columns are not read. Without rows of both labels the
    score is 0 for all and what no rule fits is allowed.
    """
    base = pages.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"))
    parts = base.select("_id", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"), F.coalesce(_rest(F.col("_url")), F.col("_url"), F.lit("")).alias("seen"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    ruled = written(parts.withColumns({"rule": rule, "says": verdict, "u": F.lower("seen")}).drop("seen"), "urls")
    distinct = ruled.select("u").distinct()
    labelled = ruled.where("says is not null").select((F.col("says") == "allow").alias("good"), "u")
    held = F.crc32("u") % HOLD_BACK == 0
    kinds = {r.good for r in labelled.select("good").distinct().collect()}
    if len(kinds) == 2:
        grams = written(_grams(distinct, order).select("g").distinct(), "grams")
        gains = written(fit(labelled.where(~held), grams, order), "gains")
        scored = written(scores(distinct, gains, order), "scores")
        limit = calibrate(labelled.where(held).join(scored, "u"))
    else:
        limit, scored = 0.0, distinct.select("u", F.lit(0.0).alias("score"))
    own = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return ruled.join(scored, "u", "left").select(
        F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "score"
    )
