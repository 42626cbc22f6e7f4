"""Column functions over text: tokens, n-grams, shingles, signatures, masks, redaction, estimates. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"([\p{L}\p{N}_]+)"
# Characters that a text signature leaves out.
SIGNATURE_DROPS = " \t\n\r.,;:!?'\"-()"
# Redaction patterns, applied in this order.
REDACTIONS = [
    ("<EMAIL>", r"\b[\w.+-]+@[\w-]+\.[\w.]{2,}\b"),
    ("<CREDIT_CARD>", r"\b(?:\d[ -]?){13,19}\b"),
    ("<SSN>", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("<PHONE>", r"\b(?:\+?\d{1,2}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}\b"),
    ("<IP>", r"\b(?:\d{1,3}\.){3}\d{1,3}\b"),
]
# How a tool result that reports a failed call begins.
ERROR_PREFIXES = ("error:", "error ", "exception:", "traceback", "failed:", "tool error")
# Id-like words and numbers, and how whole-string ids and times look.
IDENTIFIER = r"\b[A-Za-z][A-Za-z0-9_]*\d[A-Za-z0-9_]*\b"
NUMBER = r"\b\d+(?:\.\d+)?\b"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?(?:\.\d+)?(?:Z|z|[+-]\d{2}:?\d{2})?)?$"


def let(value, use) -> Column:
    """``use(value)`` with the value computed once: an expression that a lambda mentions would be computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text) -> Column:
    """Lower-case word tokens in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 1)


def grams(tokens, n: int) -> Column:
    """Distinct runs of n tokens joined by a space; one run of all tokens when there are fewer; none for none."""
    def runs(t):
        made = F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - n, F.lit(0))), lambda i: F.array_join(F.slice(t, i + 1, n), " "))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(made))

    return let(tokens, runs)


def shingles(text, n: int = 5) -> Column:
    """Distinct whitespace shingles."""
    parts = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    return grams(parts, n)


def exact_key(text) -> Column:
    """sha256 of the word tokens joined by a space."""
    return F.sha2(F.array_join(words(text), " "), 256)


def jaccard(a, b) -> Column:
    """Jaccard similarity of two arrays as sets; 1.0 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def text_signature(text) -> Column:
    """Lower case without spaces and common punctuation."""
    return F.lower(F.translate(text, SIGNATURE_DROPS, ""))


def mask_literals(text) -> Column:
    """Id-like words become <ID>, numbers <NUM>."""
    return F.regexp_replace(F.regexp_replace(text, IDENTIFIER, "<ID>"), NUMBER, "<NUM>")


def redact(text, patterns=REDACTIONS) -> Column:
    """Each pattern's matches replaced by its placeholder, in order."""
    for mark, pattern in patterns:
        text = F.regexp_replace(text, pattern, mark)
    return text


def normalize_string(text) -> Column:
    """Trimmed; a whole UUID becomes <uuid>, a whole ISO-8601 time <ts>; the UUID is tried first."""
    s = F.trim(text)
    return F.when(s.rlike(UUID), "<uuid>").when(s.rlike(ISO_TIME), "<ts>").otherwise(s)


def estimate_tokens(text) -> Column:
    """At least one token, else a quarter of the characters, rounded down."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


def json_tokens(text) -> Column:
    """A quarter of the characters, rounded up."""
    return F.ceil(F.length(text) / 4).cast("long")


def prefix_tokens(text) -> Column:
    """A quarter of the characters, rounded down."""
    return F.floor(F.length(text) / 4).cast("long")


def amounts(text) -> Column:
    """Amounts like $1,234.50 as doubles."""
    found = F.regexp_extract_all(text, F.lit(r"\$([0-9][0-9,]*(?:\.[0-9]{1,2})?)"), 1)
    return F.transform(found, lambda x: F.regexp_replace(x, ",", "").cast("double"))


def bucket(key, buckets: int = 100) -> Column:
    """Stable bucket: the first eight hex digits of sha256, modulo."""
    return (F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def duration_seconds(text) -> Column:
    """Seconds of a duration such as 30d; null if it isn't one."""
    n = F.regexp_extract(text, r"^(\d+)([smhdw])$", 1)
    unit = F.regexp_extract(text, r"^(\d+)([smhdw])$", 2)
    by = F.create_map(*(F.lit(x) for kv in {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}.items() for x in kv))
    return F.when(n != "", n.cast("long") * by[unit])


def is_error_result(text) -> Column:
    """Whether a tool result reports a failed call: known prefixes, or a JSON object with an error, a failed status or a
    status code of 400 and more."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    prefix = F.lit(False)
    for p in ERROR_PREFIXES:
        prefix = prefix | low.startswith(p)
    whole = F.try_parse_json(text)
    kind = lambda k: F.schema_of_variant(F.try_variant_get(whole, f"$.{k}", "variant"))
    field = lambda k, t="string": F.try_variant_get(whole, f"$.{k}", t)
    # an error that is null, false, 0, or an empty string or list is none; the string "false" is one
    none = (kind("error") == "VOID") | ((kind("error") == "BOOLEAN") & (field("error") == "false")) | (field("error") == "") | (field("error") == "[]")
    zero = (kind("error").isin("BIGINT", "DOUBLE") | kind("error").startswith("DECIMAL")) & (field("error", "double") == 0)
    said = kind("error").isNotNull() & ~(F.coalesce(none, F.lit(False)) | F.coalesce(zero, F.lit(False)))
    status = (kind("status") == "STRING") & F.lower(field("status")).isin("error", "failed", "failure")
    code = (kind("status_code") == "BIGINT") & (field("status_code", "long") >= 400)
    return prefix | F.coalesce(said, F.lit(False)) | F.coalesce(status, F.lit(False)) | F.coalesce(code, F.lit(False))
