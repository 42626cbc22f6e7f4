"""Personal data: fixed patterns, and further candidates chosen by calibrated gradient-boosted trees.

All work on rows is SQL expressions. A pattern's places are found by marking its matches in the text and adding up the
lengths between marks, in two levels, so a text with very many matches costs little more than one with few.

Candidates. Generators with high recall propose overlapping spans: digit groups with separators, a number after a word like
``phone``, and spelled-out addresses (``name at host dot com``, brackets or not). Their lengths have no bound. Features are
the candidate's format, its check digit and its context.

Trees learn from the documents of a bounded sample (``most_docs``), of whose candidates at most eight times as many, by hash, are read for fitting. Positives are the fixed patterns' own valid spans with their format taken
away and their context kept: a phone number without its plus sign, a card number with a wrong check digit or points for
separators, an address number without its points, an e-mail address spelled out; and candidates that a fixed span overlaps.
Negatives are the other candidates as they occur. Some of those are personal data that no pattern knows, so the measured
precision is a lower bound. On a third of the sample the trees' probabilities are calibrated (isotonic regression), and a
generator's threshold is the least score whose calibrated probability is at least ``precision``, reached by MIN_HELD
candidates; if there is none, the generator adds nothing. All candidates are scored. Chosen ones that overlap a fixed span,
or a candidate chosen before them, are left out: the fixed span stands for them.

Rows: a null text counts as empty. Repeated rows give repeated results. Only the id and text columns are read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import boosted
from traceloom.llm.registry import query
from traceloom.llm.store import smallest_by_hash
from traceloom.sources.tables import read_table

# The patterns, in the order in which kinds are listed. They are written so that Java's engine neither
# recurses (possessive groups) nor starts anew inside a run it has tried (look-behind, or the end of the match before).
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+|(?<=[0-9])(?!)",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
VALID = {
    "email": "true",
    "ip": rf"v rlike r'^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$'",
    "card": "length(regexp_replace(v, '[ -]', '')) between 16 and 19 and luhn_check(regexp_replace(v, '[ -]', ''))",
    "phone": "length(regexp_replace(v, '[^0-9]', '')) between 8 and 15",
}
# The generators of further candidates.
GENERATORS = {
    "number": r"(?<![0-9A-Za-z+.])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){7,}+",
    "labelled": r"(?i)(?<![a-z])(?:tel|phone|mobile|fax|call|card|iban|account|passport|ssn)[.:#\x20]{1,3}[0-9A-Z](?:[\x20-]?[0-9]){6,}+",
    "spelled": r"(?i)(?<![a-z0-9._%+-])[a-z0-9][a-z0-9._%+-]*+(?:\x20|\x20?[(\[]\x20?)at(?:\x20|\x20?[)\]]\x20?)[a-z0-9-]++(?:(?:\x20|\x20?[(\[]\x20?)dot(?:\x20|\x20?[)\]]\x20?)[a-z0-9-]{2,}+)++",
}
#: What may not follow a candidate; tested after the match, so that no generator tries a run of digits again from within.
NOT_AFTER = {"number": "^[0-9A-Za-z]", "labelled": "^[0-9A-Za-z]", "spelled": "^[0-9A-Za-z]"}
#: Per fixed kind: SQL of the same value v in a format that its pattern doesn't match, and the generator that proposes it.
DISGUISES = [
    ("phone", "number", "substr(v, 2)"),
    ("phone", "labelled", r"concat('phone ', regexp_replace(substr(v, 2), '[().]|(?<=[ -])[ -]+', ''))"),
    ("card", "number", "concat(left(v, length(v) - 1), cast((cast(right(v, 1) as int) + 1) % 10 as string))"),
    ("card", "number", "regexp_replace(v, '[ -]', '.')"),
    ("card", "labelled", "concat('card ', v)"),
    ("ip", "number", "replace(v, '.', ' ')"),
    ("email", "spelled", "replace(replace(v, '@', ' at '), '.', ' dot ')"),
    ("email", "spelled", "replace(replace(v, '@', ' (at) '), '.', ' (dot) ')"),
]
FEATURES = ["len", "digits", "groups", "seps", "dashes", "spaces", "brackets", "first", "longest", "luhn", "alone", "word_before", "label_before", "word_after"]
FEATURE_SQL = {
    "len": "length(v)",
    "digits": "length(regexp_replace(v, '[^0-9]', ''))",
    "groups": "size(regexp_extract_all(v, '([0-9]+)', 1))",
    "seps": "length(regexp_replace(v, '[0-9A-Za-z]', ''))",
    "dashes": "length(v) - length(replace(v, '-', ''))",
    "spaces": "length(v) - length(replace(v, ' ', ''))",
    "brackets": "length(regexp_replace(v, '[^()]', ''))",
    "first": "coalesce(try_cast(regexp_extract(v, '([0-9])', 1) as int), -1)",
    "longest": "coalesce(array_max(transform(regexp_extract_all(v, '([0-9]+)', 1), x -> length(x))), 0)",
    "luhn": "if(luhn_check(regexp_replace(v, '[^0-9]', '')), 1, 0)",
    "alone": r"if(before rlike '^\\s*$' and after rlike '^\\s*$', 1, 0)",
    "word_before": r"if(before rlike r'[A-Za-z],?\x20?$', 1, 0)",
    "label_before": r"if(lower(before) rlike r'(tel|phone|mobile|fax|call|card|iban|account|acct|passport|ssn|id)[^a-z0-9]*$', 1, 0)",
    "word_after": r"if(after rlike r'^\x20?[A-Za-z]', 1, 0)",
}
MIN_HELD = 20
BLOCK = 512
NEAR = 24


def running(lengths: str) -> str:
    """SQL for the sums before each element of an array, and the whole sum; block sums first, then within blocks."""
    within = "aggregate({0}, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + x)))"
    blocks = f"transform(sequence(0, greatest(0, cast(ceil(size({lengths}) / {BLOCK}) as int) - 1)), b -> slice({lengths}, b * {BLOCK} + 1, {BLOCK}))"
    sums = f"transform({blocks}, s -> aggregate(s, 0L, (a, x) -> a + x))"
    bases = within.format(sums)
    return f"flatten(transform(zip_with({blocks}, slice({bases}, 1, greatest(1, size({sums}))), (s, b) -> named_struct('s', s, 'b', b)), e -> transform(slice({within.format('e.s')}, 1, size(e.s)), x -> x + e.b)))"


def located(df: DataFrame, kinds: dict[str, str], context: bool) -> DataFrame:
    """``df`` with an array column for each kind: spans with start, end and value, and with ``context`` the text around."""
    put = {}
    for k, p in kinds.items():
        marked = F.regexp_replace("t", F.lit(p), F.lit("\u0001$0\u0002"))
        put[f"p_{k}"] = F.split(marked, "\u0001")
    df = df.withColumns(put)
    df = df.withColumns({f"l_{k}": F.expr(f"if(size(p_{k}) > 1, transform(p_{k}, x -> cast(length(x) as bigint)), array())") for k in kinds})
    df = df.withColumns({f"o_{k}": F.expr(f"if(size(p_{k}) > 1, {running(f'l_{k}')}, array())") for k in kinds})
    out = {}
    for k in kinds:
        more = f", 'before', right(p_{k}[i], {NEAR}), 'after', left(substring_index(x, '\u0002', -1), {NEAR})" if context else ""
        out[k] = F.expr(
            f"transform(slice(p_{k}, 2, greatest(0, size(p_{k}) - 1)), (x, i) -> named_struct('s', cast(o_{k}[i + 1] - i as int),"
            f" 'e', cast(o_{k}[i + 1] - i + length(substring_index(x, '\u0002', 1)) as int), 'v', substring_index(x, '\u0002', 1){more}))"
        )
    return df.withColumns(out).drop(*(f"{c}_{k}" for c in "plo" for k in kinds))


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, t``: whole texts, null as empty; the two marks can't occur in them, another control character stands in."""
    t = F.coalesce(df[text_col].cast("string"), F.lit(""))
    clean = F.when(F.contains(t, F.lit("\u0001")) | F.contains(t, F.lit("\u0002")), F.translate(t, "\u0001\u0002", "\u0003\u0003")).otherwise(t)
    return df.select(df[id_col].cast("long").alias("doc_id"), clean.alias("t"))


def base_spans(df: DataFrame, context: bool = False) -> DataFrame:
    """``doc_id, t`` and the valid spans of each fixed kind."""
    found = located(df, PATTERNS, context)
    return found.withColumns({k: F.expr(f"filter({k}, x -> {VALID[k].replace('v rlike', 'x.v rlike').replace('(v,', '(x.v,')})") for k in KINDS})


def feature_sql(of: str) -> str:
    """Fields of a struct with all features of the struct expression ``of``."""
    put = lambda sql: re.sub(r"\b(v|before|after)\b(?=[ ,)])", lambda m: f"{of}.{m[1]}", sql)
    return ", ".join(f"'{f}', cast({put(FEATURE_SQL[f])} as double)" for f in FEATURES)


def candidates(found: DataFrame) -> DataFrame:
    """Adds for each generator the candidates with features, and ``hit``: whether a fixed span overlaps it."""
    made = located(found, GENERATORS, context=True)
    overlap = " or ".join(f"exists({k}, b -> b.s < x.e and x.s < b.e)" for k in KINDS)
    alone = lambda g: f"filter({g}, x -> not x.after rlike '{NOT_AFTER[g]}')"
    return made.withColumns({g: F.expr(f"transform({alone(g)}, x -> named_struct('s', x.s, 'e', x.e, 'v', x.v, 'hit', {overlap}, {feature_sql('x')}))") for g in GENERATORS})


def disguised(found: DataFrame) -> list:
    """Array columns of ``g, hit`` and features: the fixed spans of ``found``, with context, in other formats."""
    out = []
    for kind, g, sql in DISGUISES:
        value = re.sub(r"\bv\b", "x.v", sql)
        pattern = GENERATORS[g].replace("\\", "\\\\")
        made = f"transform({kind}, x -> named_struct('v', {value}, 'before', x.before, 'after', x.after))"
        whole = f"filter({made}, x -> x.v = regexp_extract(x.v, '{pattern}', 0))"
        out.append(F.expr(f"transform({whole}, x -> named_struct('g', '{g}', 'hit', true, {feature_sql('x')}))"))
    return out


def fit(df: DataFrame, id_col: str, text_col: str, most_docs: int, precision: float) -> dict:
    """Per generator the model and its threshold; a generator without a threshold is left out."""
    own = texts(df, id_col, text_col)
    ids = smallest_by_hash(own.select(F.col("doc_id").alias("sample_id")).where("sample_id is not null"), ["sample_id"], most_docs)
    some = own.join(F.broadcast(ids), own["doc_id"] == F.col("sample_id"), "left_semi")  # most_docs ids
    found = candidates(base_spans(some, context=True))
    plain = [F.expr(f"transform({g}, x -> named_struct('g', '{g}', 'hit', x.hit, {', '.join(f"'{f}', x.{f}" for f in FEATURES)}))") for g in GENERATORS]
    rows = found.select("doc_id", F.explode(F.concat(*plain, *disguised(found))).alias("c")).select("doc_id", "c.*")
    rows = rows.orderBy(F.xxhash64("doc_id", "g", *FEATURES), "hit").limit(8 * most_docs).collect()
    chosen = {}
    for g in GENERATORS:
        mine = [r for r in rows if r.g == g]
        held = np.array([r.doc_id % 3 == 0 for r in mine], bool)
        x = np.array([[r[f] for f in FEATURES] for r in mine], float).reshape(len(mine), len(FEATURES))
        y = np.array([r.hit for r in mine], float)
        if held.sum() < MIN_HELD or (~held).sum() < MIN_HELD:
            continue
        model = boosted.fit(x[~held], y[~held], trees=20)
        p = boosted.predict(model, x[held])
        at, calibrated = boosted.isotonic(p, y[held])
        good = [t for t, c in zip(at.tolist(), calibrated.tolist(), strict=True) if c >= precision and (p >= t).sum() >= MIN_HELD]
        if good:
            chosen[g] = (model, good[0] - 1e-9)
    return chosen


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_docs: int = 4_000, precision: float = 0.9) -> DataFrame:
    """``doc_id``, the fixed kinds' spans as array columns ``email, ip, card, phone``, and ``extra``: chosen candidates with
    their generator's name as kind. Spans have start, end (exclusive, code points) and value."""
    chosen = fit(df, id_col, text_col, most_docs, precision)
    found = base_spans(texts(df, id_col, text_col))
    if chosen:
        found = candidates(found)
        extra = F.expr("cast(array() as array<struct<kind:string,s:int,e:int,v:string>>)")
        for g, (model, least) in chosen.items():
            score = boosted.to_sql(model, [f"x.{f}" for f in FEATURES])
            found = found.withColumn(g, F.expr(f"transform(filter({g}, x -> not x.hit and ({score}) >= {least!r}D), x -> named_struct('kind', '{g}', 's', x.s, 'e', x.e, 'v', x.v))"))
        names = list(chosen)
        for i, g in enumerate(names):
            before = " or ".join(f"exists({h}, b -> b.s < x.e and x.s < b.e)" for h in names[:i]) or "false"
            found = found.withColumn(f"k_{g}", F.expr(f"filter({g}, x -> not ({before}))"))
        extra = F.concat(*(F.col(f"k_{g}") for g in names))
    else:
        extra = F.expr("cast(array() as array<struct<kind:string,s:int,e:int,v:string>>)")
    return found.select("doc_id", *KINDS, extra.alias("extra"))


@query("op9_pii")
def op9_pii(spark, sf_dir):
    """Counts and digests of the personal data of every document."""
    found = find_pii(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    each = F.concat(*(F.expr(f"transform({k}, x -> concat_ws(':', '{k}', x.s, x.e))") for k in KINDS))
    more = F.expr("transform(array_sort(extra, (a, b) -> case when a.kind < b.kind then -1 when a.kind > b.kind then 1 else a.s - b.s end), x -> concat_ws(':', x.kind, x.s, x.e))")
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(each, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(each, more), ",").alias("spans"),
    )
