"""Quality rules: fixed rules, then robust multivariate outliers among the documents of one language and source.

Every step is a DataFrame expression. A document becomes six transformed statistics (FEATURES): the logarithm of the mean word length, and arcsine roots of
the shares of symbols, repeated lines, words in repeated windows, capitals, and punctuation with digits, each shrunk towards a prior of a few words so
that short texts don't stand out by chance. For each group the minimum-covariance-determinant estimate is found by concentration steps over all its rows that pass the fixed
rules: distances under the last estimate, then mean and covariance of the nearest ``share`` of rows, until the determinants no longer fall.
Two deterministic starts (medians with absolute deviations; correlations of hyperbolic tangents) take two steps each, the one of smaller
determinant goes on. A reweighting step follows. A row whose squared Mahalanobis distance is beyond the chi-square quantile
of ``1 - tail`` is rejected.

Scale: a concentration step reads the table of statistics once (about 150 bytes a document, no texts) and sums by group and distance bin, where
partial sums before the shuffle leave at most a few thousand rows a group and task; so the nearest share is whole bins, at least that
share (bins are a 32nd of a doubling wide). Estimates stay tables, inverted by expressions; the driver sees one number a round. They are broadcast up to
MOST_BROADCAST groups and joined by group and salt beyond.

FLOOR is added to every standard deviation: the resolution below which a statistic doesn't count as spread, so statistics that are nearly
always zero don't reject the first text that has one. Groups with fewer than ``least`` rows are pooled by language, then all
together; a pool still smaller has no estimate, and its rows stay.

Rows: a null text has no words and fails the fixed rules; null language or source counts as an empty name; repeated rows count each; an empty table
gives no rows; further columns are left out, whatever their names. Repeated windows are compared by 64-bit hash within a text.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.llm.registry import query
from traceloom.llm.store import discard, materialize
from traceloom.sources.tables import read_table

FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "upper", "marks"]
P = len(FEATURES)
CELLS = [(i, j) for i in range(P) for j in range(i + 1)]
FLOOR = 0.1
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Groups up to which estimates are broadcast: about 400 bytes each.
MOST_BROADCAST = 20_000
SALTS = 64
#: Distance bins in a doubling, and bins of a statistic in one unit.
FINE, STEPS = 32, 512


def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for k in range(1, p // 2):
        term *= x / 2 / k
        total += term
    return 1 - exp(-x / 2) * total


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return high


def consistency(share: float, p: int = P) -> float:
    """What the covariance of the central ``share`` of normal rows is multiplied by to estimate that of all."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def _number_of(chars: str):
    """How many of ``chars`` a text has. They are listed one by one: the regular expression then tests a bit for each character."""
    return F.length(F.regexp_replace("text", "[^" + "".join("\\" + x if not x.isalnum() else x for x in chars) + "]+", ""))


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and counts of every whole text: words, their characters, symbols, lines, repeated lines, words in
    repeated windows, capitals, punctuation marks and digits."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    base = docs.select("doc_id", name("lang"), name("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.select("*", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0).alias("words"), lines.alias("lines"))
    hashed = base.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # the array is named more than once, so the optimizer keeps it a column instead of computing it again for each window
    window = lambda h, i: F.xxhash64(h, *(F.get("hashes", i + k) for k in range(1, WINDOW)))
    windows = F.slice(F.transform("hashes", window), F.lit(1), F.greatest(F.size("hashes") - WINDOW + 1, F.lit(0)))
    hashed = hashed.select("*", windows.alias("windows"))
    # most texts repeat no window: only the others are sorted
    ordered = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    hashed = hashed.select("*", ordered.alias("ordered"))
    at = lambda i: F.get("ordered", i)["h"]
    twice = F.filter("ordered", lambda x, i: x["h"].eqNullSafe(at(i - 1)) | x["h"].eqNullSafe(at(i + 1)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    capitals = "".join(map(chr, [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
    punctuation = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in SYMBOLS)
    columns = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": _number_of(SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("lines"),
        "n_upper": _number_of(capitals),
        "n_marks": _number_of(punctuation + "0123456789"),
    }
    return hashed.select("doc_id", "lang", "source", *(c.cast("long").alias(k) for k, c in columns.items()))


def with_features(counted: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and FEATURES."""
    c = F.col
    root = lambda part, whole, prior: F.asin(F.sqrt(F.least(F.lit(1.0), part / (whole + prior))))
    features = {
        "word_length": F.log((c("word_chars") + 100) / (c("n_words") + 20)),
        "symbols": root(c("n_symbols"), c("word_chars"), 100),
        "dup_lines": root(c("n_dup_lines"), c("n_lines"), 4),
        "repeats": root(c("n_repeat_words"), c("n_words"), 20),
        "upper": root(c("n_upper"), c("word_chars"), 100),
        "marks": root(c("n_marks"), c("word_chars"), 100),
    }
    failed = (c("n_words") < 20) | (100 * c("n_repeat_words") > 30 * c("n_words"))
    return counted.withColumns({"base_failed": failed} | features)


def _beside(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table``, which has at most a few rows a key: broadcast when small, else by key and salt."""
    if table.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(table), keys, "left")
    return rows.join(table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"], "left")


def grouped(rows: DataFrame, least: int) -> DataFrame:
    """Adds ``grp``: the group whose estimate judges a row, and ``salt``. Groups of fewer than ``least`` rows are pooled."""
    rows = materialize(rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")), "statistics")
    sizes = rows.groupBy("lang", "source").agg(F.sum((~F.col("base_failed")).cast("long")).alias("size"))
    small = F.sum(F.when(F.col("size") < least, F.col("size")).otherwise(0))
    sizes = materialize(sizes, "groups")
    pools = sizes.groupBy("lang").agg(small.alias("pool"))
    key = F.when(F.col("size") >= least, F.concat(F.lit("2:"), F.length("lang"), F.lit(":"), "lang", F.lit(":"), "source")).when(F.col("pool") >= least, F.concat(F.lit("1:"), "lang")).otherwise("0")
    names = materialize(sizes.join(pools, "lang").select("lang", "source", key.alias("grp")), "groups")
    out = materialize(_beside(rows, names, ["lang", "source"]), "statistics")
    discard(rows, sizes, names)
    return out


def _number(x: float) -> str:
    return f"double('{x!r}')"


def _sums() -> list:
    """Aggregates as SQL text: hundreds of terms are one call to the JVM each, not one an operation."""
    return [F.expr(x) for x in ["count(1) as n", *(f"sum({f}) as s{i}" for i, f in enumerate(FEATURES)), *(f"sum({FEATURES[i]} * {FEATURES[j]}) as q{i}_{j}" for i, j in CELLS)]]


def _from_sums(table: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Mean and covariance, times ``factor`` and with the floor, from sums."""
    at = table.selectExpr(*keys, "n", *(f"round(s{i} / n, 12) as m{i}" for i in range(P)), *(f"q{i}_{j}" for i, j in CELLS))
    cov = lambda i, j: f"round({_number(factor)} * (q{i}_{j} / n - m{i} * m{j}), 12) + {_number(FLOOR**2 if i == j else 0.0)} as c{i}_{j}"
    return at.selectExpr(*keys, "n", *(f"m{i}" for i in range(P)), *(cov(i, j) for i, j in CELLS))


def _whitened(table: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n, m*, w*_*, logdet`` from mean and covariance: w is the inverse of the covariance's Cholesky factor."""
    for j in range(P):  # the factor, a column at a time
        minus = lambda i: "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))  # noqa: B023, E731
        table = table.selectExpr("*", f"sqrt(greatest(c{j}_{j}{minus(j)}, {_number(FLOOR**2 / 2)})) as l{j}_{j}")
        if j + 1 < P:
            table = table.selectExpr("*", *(f"(c{i}_{j}{minus(i)}) / l{j}_{j} as l{i}_{j}" for i in range(j + 1, P)))
    for i in range(P):  # its inverse, a row at a time
        total = lambda j: " + ".join(f"l{i}_{k} * w{k}_{j}" for k in range(j, i))  # noqa: B023, E731
        table = table.selectExpr("*", f"1 / l{i}_{i} as w{i}_{i}", *(f"-({total(j)}) / l{i}_{i} as w{i}_{j}" for j in range(i)))
    logdet = " + ".join(f"2 * ln(l{i}_{i})" for i in range(P))
    return table.selectExpr(*keys, "n", *(f"m{i}" for i in range(P)), *(f"w{i}_{j}" for i, j in CELLS), f"{logdet} as logdet")


def distance():
    """Squared Mahalanobis distance of FEATURES under the columns m and w."""
    z = lambda i: " + ".join(f"w{i}_{j} * ({FEATURES[j]} - m{j})" for j in range(i + 1))
    return F.expr(" + ".join(f"pow({z(i)}, 2)" for i in range(P)))


def starts(rows: DataFrame) -> DataFrame:
    """Two estimates a group: start 0 from medians and absolute deviations, start 1 with correlations of hyperbolic tangents."""
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.round(F.col(f) * STEPS).cast("int").alias("b")) for i, f in enumerate(FEATURES))))
    binned = materialize(rows.select("grp", cells.alias("x")).select("grp", "x.*").groupBy("grp", "i", "b").agg(F.count(F.lit(1)).alias("n")), "bins")

    def median(table, value):
        own = Window.partitionBy("grp", "i")
        ranked = table.withColumn("upto", F.sum("n").over(own.orderBy(value))).withColumn("all", F.sum("n").over(own))
        return ranked.where(2 * F.col("upto") >= F.col("all")).groupBy("grp", "i").agg(F.min(value).alias("mid"))

    mid = median(binned, "b")
    off = binned.join(mid, ["grp", "i"]).select("grp", "i", "n", F.abs(F.col("b") - F.col("mid")).alias("off"))
    spread = median(off, "off").withColumnRenamed("mid", "mad")
    pick = lambda c, i: f"max(case when i = {i} then {c} end) / {STEPS}"
    wide = mid.join(spread, ["grp", "i"]).groupBy("grp").agg(*(F.expr(f"{pick('mid', i)} as m{i}") for i in range(P)), *(F.expr(f"sqrt(pow(1.4826 * {pick('mad', i)}, 2) + {_number(FLOOR**2)}) as d{i}") for i in range(P)))
    wide = materialize(wide, "medians")
    told = _beside(rows.select("grp", "salt", *FEATURES), wide, ["grp"]).selectExpr("grp", *(f"tanh(({f} - m{i}) / d{i}) as y{i}" for i, f in enumerate(FEATURES)))
    sums = told.groupBy("grp").agg(*(F.expr(x) for x in ["count(1) as k", *(f"sum(y{i}) as s{i}" for i in range(P)), *(f"sum(y{i} * y{j}) as q{i}_{j}" for i, j in CELLS)]))
    moment = lambda i, j: f"(k * q{i}_{j} - s{i} * s{j})"
    # a statistic that doesn't vary correlates with none
    related = lambda i, j: f"coalesce(try_divide({moment(i, j)}, sqrt(greatest({moment(i, i)} * {moment(j, j)}, {_number(0.0)}))), {_number(0.0)})"
    corr = sums.selectExpr("grp", *(f"round(greatest(-1, least(1, {related(i, j)})), 9) as r{i}_{j}" for i, j in CELLS if i != j))
    both = wide.join(corr, "grp").withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    # shrunk towards the diagonal, so that the matrix is positive definite
    cov = lambda i, j: f"pow(d{i}, 2) as c{i}_{j}" if i == j else f"case when start = 1 then {_number(0.9)} * r{i}_{j} * d{i} * d{j} else {_number(0.0)} end as c{i}_{j}"
    table = both.selectExpr("grp", "start", "cast(0 as bigint) as n", *(f"m{i}" for i in range(P)), *(cov(i, j) for i, j in CELLS))
    out = materialize(_whitened(table, ["grp", "start"]), "estimates")
    discard(binned, wide)
    return out


def concentrated(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One concentration step for every group and start."""
    keys = ["grp", "start"]
    bin_ = F.floor(F.log2(distance() + 1e-6) * FINE).cast("int")
    binned = _beside(rows.select("grp", "salt", *FEATURES), estimates, ["grp"]).withColumn("bin", bin_).groupBy(*keys, "bin").agg(*_sums())
    own = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = binned.withColumn("before", before).withColumn("all", F.sum("n").over(own)).where(F.col("before") < share * F.col("all"))
    sums = ["n", *(f"s{i}" for i in range(P)), *(f"q{i}_{j}" for i, j in CELLS)]
    total = near.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))
    return materialize(_whitened(_from_sums(total, keys, consistency(share)), keys), "estimates")


def estimates(rows: DataFrame, share: float = 0.75, most_rounds: int = 12) -> DataFrame:
    """The reweighted minimum-covariance-determinant estimate of every ``grp`` of ``rows(grp, salt, FEATURES)``."""
    now, last = starts(rows), None
    for turn in range(most_rounds):
        new = concentrated(rows, now, share)
        discard(now)
        now = new
        if turn == 1:
            best = now.groupBy("grp").agg(F.min_by(F.struct(*now.columns), F.struct("logdet", "start")).alias("e")).select("e.*")
            best = materialize(best, "estimates")
            discard(now)
            now = best
        total = now.agg(F.sum("logdet")).first()[0] or 0.0
        if turn > 1 and last is not None and abs(total - last) < 1e-9:
            break
        last = total if turn else None
    central = chi2_quantile(0.975, P)
    weighted = _beside(rows.select("grp", "salt", *FEATURES), now, ["grp"]).where(distance() <= central).drop("n").groupBy("grp").agg(*_sums())
    out = materialize(_whitened(_from_sums(weighted, ["grp"], consistency(0.975)), ["grp"]), "estimates")
    discard(now)
    return out


def judge(docs: DataFrame, share: float = 0.75, tail: float = 1e-6, least: int = 50) -> DataFrame:
    """``doc_id, lang, source``, all counts, ``base_failed, kept, distance`` (null where the fixed rules fail, or no estimate is to be had)."""
    rows = grouped(with_features(counts(docs)), least)
    fine = rows.where(~F.col("base_failed"))
    # only the last pool can be too small
    enough = fine.where("grp <> '0'") if fine.where("grp = '0'").limit(least).count() < least else fine
    found = estimates(enough, share)
    judged = _beside(rows, found.drop("n", "logdet"), ["grp"]).withColumn("distance", F.when(~F.col("base_failed"), distance()))
    far = F.coalesce(F.col("distance") > chi2_quantile(1 - tail, P), F.lit(False))
    made = [c for c in rows.columns if c.startswith("n_") or c == "word_chars"]
    return judged.select("doc_id", "lang", "source", *made, "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "distance")


@query("op12_quality_rules")
def op12_quality_rules(spark, sf_dir):
    """Counts, fixed rules and the outlier verdict of every document."""
    rows = judge(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 6).alias("distance"))
