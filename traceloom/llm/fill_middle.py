"""Fill-in-the-middle transformation in Spark SQL expressions alone: no row leaves the JVM, nothing is shuffled.

A text is cut into units, each a word with the separators before it (separators at the end are a unit of their own). The first
four 8-digit groups of sha256(``<seed>:<doc_id>``) choose: two cuts, whether the text is transformed (``rate`` per cent), and which
arrangement it gets (``spm`` per cent suffix first, else prefix first). So a document's output depends on its id and text alone, on
every machine and after every retry.

Rows: a null text counts as empty; an empty text, or one that already holds a sentinel, stays plain. A null id counts as an empty
one. Repeated rows give repeated results; further columns of the input are left out, whatever their names. Very long texts cost memory
in proportion to their units.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm.registry import query
from traceloom.sources.tables import read_table

# Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


def _joined(units):
    return F.array_join(units, "")


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``doc_id, n, form, prefix, middle, suffix, output`` for every row of ``docs(doc_id, text)``.

    ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle). The three parts are null where it is plain.
    """
    p, s, m = map(F.lit, sentinels)
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    base = base.select("*", digest.alias("digest"), F.regexp_extract_all("text", F.lit(UNIT), 0).alias("units"))
    h1, h2, h3, h4 = (F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4))
    n = F.size("units")
    a, b = h1 % (n + 1), h2 % (n + 1)
    held = F.col("text").contains(p) | F.col("text").contains(s) | F.col("text").contains(m)
    plain = (F.col("text") == "") | held | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    cut = base.select("doc_id", "text", "units", n.cast("long").alias("n"), form.alias("form"), F.least(a, b).cast("int").alias("a"), F.greatest(a, b).cast("int").alias("b"))
    some = lambda part: F.when(F.col("form") != "plain", part)
    prefix = F.slice("units", F.lit(1), F.col("a"))
    middle = F.slice("units", F.col("a") + 1, F.col("b") - F.col("a"))
    suffix = F.slice("units", F.col("b") + 1, F.col("n").cast("int") - F.col("b"))
    parts = cut.select("doc_id", "text", "n", "form", some(_joined(prefix)).alias("prefix"), some(_joined(middle)).alias("middle"), some(_joined(suffix)).alias("suffix"))
    output = F.when(F.col("form") == "psm", F.concat(p, "prefix", s, "suffix", m, "middle")).when(F.col("form") == "spm", F.concat(s, "suffix", p, "prefix", m, "middle")).otherwise(F.col("text"))
    return parts.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(rows: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Adds ``restored``: the exact text, from ``form`` and ``output`` alone. A transformed output holds each sentinel once, since a text
    that held one stayed plain; one that doesn't is damaged and gives null, as does a null output."""
    split = F.split("output", "|".join(map(re.escape, sentinels)), -1)
    with_parts = rows.withColumn("_parts", F.when(F.col("form") != "plain", split))
    p, s, m = sentinels
    order = {"psm": (p, s, m), "spm": (s, p, m)}
    at = lambda form, mark: F.get("_parts", F.lit(order[form].index(mark) + 1))
    text = lambda form: F.concat(at(form, p), at(form, m), at(form, s))
    whole = lambda form: (F.size("_parts") == 4) & F.col("output").rlike("(?s)^" + ".*?".join(map(re.escape, order[form])))
    restored = F.when(F.col("form") == "plain", F.col("output"))
    for form in order:
        restored = restored.when((F.col("form") == form) & whole(form), text(form))
    return with_parts.withColumn("restored", restored).drop("_parts")


@query(
    "op11_fill_middle",
    r"""with u as (select doc_id, coalesce(text, '') as text, sha256('42:' || cast(doc_id as varchar)) as d,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units from documents),
      h as (select *, len(units) as n, cast('0x' || d[1:8] as bigint) as h1, cast('0x' || d[9:16] as bigint) as h2, cast('0x' || d[17:24] as bigint) as h3, cast('0x' || d[25:32] as bigint) as h4 from u),
      c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from h),
      p as (select *, coalesce(array_to_string(units[1:a], ''), '') as pre, coalesce(array_to_string(units[a + 1:b], ''), '') as mid, coalesce(array_to_string(units[b + 1:n], ''), '') as suf from c),
      o as (select *, case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end as output from p),
      r as (select *, case form when 'plain' then output
        when 'psm' then split_part(split_part(output, '<P>', 2), '<S>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
        else split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<P>', 1) end as restored from o)
      select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
        sha256(output) as output_sha256, sha256(restored) as restored_sha256 from r""",
)
def op11_fill_middle(spark, sf_dir):
    """Digests of every document's output and of the text restored from it."""
    rows = restore(transform(read_table(spark, sf_dir, "documents", "doc_id", "text")))
    chars = lambda c: F.length(c).cast("long")
    return rows.select("doc_id", "n", "form", chars("prefix").alias("prefix_chars"), chars("middle").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
