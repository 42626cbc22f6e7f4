"""URL filter: host and path rules, then gradient-boosted trees on lexical features.

Everything that touches rows is a DataFrame expression; the trees are fitted on the driver on at most ``most_rows`` URLs
(those with the smallest hash of the id) and become one CASE expression.

Labelled URLs are a parameter: a table of ``url, blocked``. Where there is none, weak labels stand in: a URL that a rule judges has
its action as label, a host with a word of BLOCK_WORDS is blocked, and all others count as allowed with weight UNLABELLED, as in
learning from positive and unlabelled examples. With a table, only its URLs are learned from.

Suffix statistics are the smoothed share of blocked URLs among those of a host's last two labels, over the whole table. URLs
fall into two halves by hash, and a URL's feature comes from the other half, so that no label is in its own feature.

A fifth of the sample is held out, of which the URLs that no rule judges count: the trees decide on no others. The least score whose calibrated probability (isotonic regression there) of being blocked is at least
``precision`` is the threshold; without one, nothing is blocked but by rules.

Rows: a null URL, or one without ``://``, has an empty host and path, no rule, and the verdict of its features. Repeated
rows give repeated results. With no rows to learn from, all that no rule blocks is allowed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import boosted
from traceloom.llm.registry import query
from traceloom.llm.store import materialize, smallest_by_hash
from traceloom.sources.tables import read_table

# The rules as action, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Words that mark a host as unwanted.
BLOCK_WORDS = ["spam", "pills", "casino", "porn", "viagra", "xxx", "poker", "warez", "malware", "phish", "payday", "escort"]
UNLABELLED = 0.3
#: Suffixes up to which their table is broadcast: about 60 bytes each.
BROADCAST_SUFFIXES = 200_000
FEATURES = ["length", "host_length", "depth", "digit_ratio", "entropy", "params", "hyphens", "dots", "path_length", "percent", "suffix"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url) -> tuple:
    """Host and path columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host, path, rules) -> tuple:
    """The longest rule that fits, as text, and its action; null where none does."""
    text = action = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones are longer and go before
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, action = F.when(fits, h + p).otherwise(text), F.when(fits, act).otherwise(action)
    return text, action


def with_features(pages: DataFrame, rules, labelled: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, action, label, weight, tail, half, held`` and the features but ``suffix``."""
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    given = F.lit(None).cast("int")
    if labelled is not None:
        one = labelled.where("url is not null and blocked is not null").groupBy(F.col("url").alias("url_")).agg(F.max(F.col("blocked").cast("int")).alias("given"))
        base = base.join(one, base["url"] == one["url_"], "left").drop("url_")
        given = F.col("given")
    host, path = split_url(F.col("url"))
    base = base.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"), given.alias("given"))
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "action": action})
    count = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    share = lambda c: (F.length("host") - F.length(F.replace(F.col("host"), c, F.lit("")))) / F.length("host")
    letters = F.array_distinct(F.filter(F.split("host", ""), lambda c: c != ""))
    word = F.col("host").rlike("(^|[^a-z])(" + "|".join(BLOCK_WORDS) + ")([^a-z]|$)")
    told = F.coalesce(F.col("given"), F.when(F.col("action") == "block", 1).when(F.col("action") == "allow", 0).when(word, 1)) if labelled is None else F.col("given")
    part = F.xxhash64("url")
    return base.withColumns(
        {
            "label": F.coalesce(told, F.lit(0)),
            "weight": F.when(told.isNotNull(), 1.0).otherwise(UNLABELLED if labelled is None else 0.0),
            "half": F.pmod(part, F.lit(2)),
            "held": F.pmod(F.shiftright(part, 8), F.lit(5)) == 0,
            "tail": F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0),
            "length": F.length("url").cast("double"),
            "host_length": F.length("host").cast("double"),
            "depth": count(F.col("path"), "/").cast("double"),
            "digit_ratio": F.coalesce(count(F.col("url"), "[0-9]") / F.nullif(F.length("url"), F.lit(0)), F.lit(0.0)),
            "entropy": F.aggregate(F.transform(letters, lambda c: -share(c) * F.log2(share(c))), F.lit(0.0), lambda a, x: a + x),
            "params": count(F.col("url"), "[&?]").cast("double"),
            "hyphens": count(F.col("host"), "-").cast("double"),
            "dots": count(F.col("host"), r"\.").cast("double"),
            "path_length": F.length("path").cast("double"),
            "percent": count(F.col("url"), "%").cast("double"),
        }
    )


def with_suffix(featured: DataFrame) -> DataFrame:
    """Adds ``suffix``: the smoothed share of blocked URLs with the same tail in the other half of the table."""
    in_half = lambda k, c: F.sum(F.when(F.col("half") == k, c).otherwise(0.0))
    w, wy = F.col("weight"), F.col("weight") * F.col("label")
    stats = featured.groupBy(F.col("tail").alias("tail_")).agg(*(in_half(k, c).alias(f"{n}{k}") for k in (0, 1) for n, c in (("n", w), ("b", wy))))
    stats = materialize(stats, "suffixes")
    n, block, size = stats.agg(F.sum(F.col("n0") + F.col("n1")), F.sum(F.col("b0") + F.col("b1")), F.count(F.lit(1))).first()
    prior = ((block or 0) + 1) / ((n or 0) + 2)
    joined = featured.join(F.broadcast(stats) if size <= BROADCAST_SUFFIXES else stats, featured["tail"] == stats["tail_"], "left")
    other = lambda c: F.when(F.col("half") == 0, F.col(c + "1")).otherwise(F.col(c + "0"))
    return joined.withColumn("suffix", (F.coalesce(other("b"), F.lit(0.0)) + 2 * prior) / (F.coalesce(other("n"), F.lit(0.0)) + 2)).drop("tail_", "n0", "n1", "b0", "b1")


def fit(featured: DataFrame, most_rows: int, trees: int, precision: float):
    """The model from a bounded sample, its threshold (None if no score is precise enough) and its held-out AUC."""
    sample = smallest_by_hash(featured.where("weight > 0").select("page_id", "url", "held", F.col("action").isNull().alias("free"), "label", "weight", *FEATURES), ["page_id", "url"], most_rows)
    rows = sample.select("held", "free", "label", "weight", *FEATURES).collect()
    out = np.array([r.held for r in rows], bool)
    held = out & np.array([r.free for r in rows], bool)
    x = np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    y, w = np.array([r.label for r in rows], float), np.array([r.weight for r in rows], float)
    model = boosted.fit(x[~out], y[~out], w[~out], trees=trees, least=3)
    if not model[1] or not held.any():
        return model, None, float("nan")
    p = boosted.predict(model, x[held])
    at, calibrated = boosted.isotonic(p, y[held], w[held])
    good = at[calibrated >= precision]
    return model, (float(good[0]) - 1e-9 if len(good) else None), boosted.auc(p, y[held], w[held])


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, most_rows: int = 20_000, trees: int = 30, precision: float = 0.8) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``: score is the trees' probability that the URL is to be blocked."""
    featured = with_suffix(with_features(pages, rules, labelled))
    model, least, _ = fit(featured, most_rows, trees, precision)
    scored = featured.withColumn("score", F.expr(boosted.to_sql(model, FEATURES)))
    own = F.when(F.col("score") >= least, "block").otherwise("allow") if least is not None else F.lit("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("action", own).alias("verdict"), "score")


@query("op8_url_filter")
def op8_url_filter(spark, sf_dir):
    """Verdict on every page's URL."""
    return judge(read_table(spark, sf_dir, "pages", "page_id", "url"))
