"""Spelling variant grouping: words one edit apart, found by automata over their halves.

If two words differ by one inserted, deleted or replaced code point, one of the halves of the first is untouched in the second: its
first half as the second word's beginning, or its second half as the second word's end. So every word's two halves go into
Aho-Corasick automata, every word is scanned by them, and a hit counts where its place fits (a first half at the start, a second half
at the end) and the lengths differ by one at most. The rest of the two words is then compared exactly.

Shards: a first half can only hit words with the same three first code points, a second half only those with the same three last ones
(halves have three code points or more), so automata are dealt by (side, those three). A key with more than ``shard_words`` words is
split by hash into several automata, and its words go to each of them: an automaton holds about ``shard_words`` words at most, and a word is
scanned by two automata, or by more under a hot key. Inside a hit, the words that share the half are looked up by
what is left of the scanned word with at most one edit, never all compared, so a half that very many words share costs each of them
its own length and not their number. A task gives one row a scanned word, its count and best form, never pairs.

Counting is in Spark SQL: runs of letters, lower-cased in A-Z, with one code point deleted where a checksum of id and run
says so (``every``; None leaves words as they are). Roots are found by doubling: each round joins the words that have a form
with their form's own, so a chain's length halves.

Rows: a null text has no words; a null id counts as an empty one; repeated rows count each; an empty table gives no rows; further columns are left
out. Words are compared by code points, ties go to the smaller word in that order. Words given to ``group_variants`` with fewer than six code points
have no near words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm.registry import query
from traceloom.llm.store import discard, materialize
from traceloom.session import workers_find_package
from traceloom.sources.tables import read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LATIN = "".join(map(chr, range(0xC0, 0x100)))
#: Listed one by one: the regular expression then tests a bit for each character.
RUN = f"[{UPPER}{LOWER}{LATIN}]+"
#: Code points of a half that all words of a shard share; halves of the shortest word have as many.
KEY = 3
#: Hot keys up to which their table is broadcast.
MOST_BROADCAST = 50_000
PARTIAL = "shard long, word string, n_near long, best_n long, best string"


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, every: int | None = 31) -> DataFrame:
    """``word, n`` of ``docs(doc_id, text)``: words of at least ``least_length`` code points that occur ``least_count`` times or more."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = F.filter(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), 0), lambda w: F.length(w) >= least_length)
    runs = docs.select(ids.alias("id"), F.explode(found).alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run")
    if every is not None:
        runs = runs.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % every == 0, F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, cast(h % length(run) as int) + 2)"))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def deletions(word: str) -> set[str]:
    """The word without each of its code points."""
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def differ_by_one(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


class Rests:
    """The words that share a half, by what else they have: those one edit from a given rest, without a look at all of them.

    A rest one code point longer or shorter is found among deletions of either; one of equal length shares a deletion. The two
    small tables hold the rest itself and, once the half is shared by more than FEW words, its deletions."""

    FEW = 12

    def __init__(self):
        self.words: dict[str, tuple[str, int]] = {}
        self.less: dict[str, list[str]] | None = None

    def add(self, rest: str, word: str, n: int) -> None:
        self.words[rest] = (word, n)

    def near(self, rest: str) -> Iterator[tuple[str, int]]:
        if len(self.words) <= self.FEW:
            candidates = self.words
        else:
            if self.less is None:
                self.less = defaultdict(list)
                for other in self.words:
                    for d in deletions(other):
                        self.less[d].append(other)
            mine = deletions(rest)
            candidates = {x for d in mine for x in self.less.get(d, ())} | {d for d in mine if d in self.words} | set(self.less.get(rest, ()))
        for other in candidates:
            if abs(len(other) - len(rest)) <= 1 and differ_by_one(rest, other):
                yield self.words[other]


class Automaton:
    """One shard: an Aho-Corasick automaton over the halves of its words, all of one side."""

    def __init__(self, side: int, words: list[tuple[str, int]]):
        self.side, self.halves = side, ahocorasick.Automaton()
        for word, n in words:
            k = len(word) // 2
            half, rest = (word[:k], word[k:]) if side == 0 else (word[k:], word[:k])
            if half not in self.halves:
                self.halves.add_word(half, (half, Rests()))
            self.halves.get(half)[1].add(rest, word, n)
        self.halves.make_automaton()

    def near(self, word: str) -> Iterator[tuple[str, int]]:
        """``other, n`` for each word of the shard that is one edit away and shares this side's half. The second side leaves out what the
        first finds, words of which both halves fit."""
        for end, (half, rests) in self.halves.iter(word):
            start = end + 1 - len(half)
            if start != 0 if self.side == 0 else end + 1 != len(word):
                continue
            rest = word[len(half) :] if self.side == 0 else word[:start]
            for other, n in rests.near(rest):
                if self.side == 0 or not word.startswith(other[: len(other) // 2]):
                    yield other, n


def _scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole shards ``shard, side, half (whether the row's half is held), word, n``, in order of shard with halves first."""

    def found(shard, automaton, words):
        for word in words:
            count, best = 0, None
            for other, n in automaton.near(word):
                count += 1
                if best is None or (-n, other) < (-best[0], best[1]):
                    best = (n, other)
            if count:
                yield shard, word, count, *best

    def batches(results):
        held = []
        for r in results:
            held.append(r)
            if len(held) == 5_000:
                yield held
                held = []
        if held:
            yield held

    def results():
        shard = automaton = None
        held = []
        for batch in rows:
            scanned = []
            for s, side, half, word, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "side", "half", "word", "n"))):
                if s != shard:
                    if scanned and automaton is not None:
                        yield from found(shard, automaton, scanned)
                    shard, automaton, held, scanned, of = s, None, [], [], side
                if half:
                    held.append((word, n))
                    continue
                if automaton is None and held:
                    automaton, held = Automaton(of, held), []
                scanned.append(word)
            if scanned and automaton is not None:
                yield from found(shard, automaton, scanned)

    for some in batches(results()):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))], ["shard", "word", "n_near", "best_n", "best"])


def neighbours(words: DataFrame, shard_words: int = 20_000) -> DataFrame:
    """``word, n_near, best, best_n`` for every word of ``words(word, n)`` with a near word: how many are near, and the one of largest n."""
    workers_find_package(words.sparkSession)
    first, last = F.substring("word", 1, KEY), F.expr(f"right(word, {KEY})")
    sides = F.explode(F.array(*(F.struct(F.lit(i).alias("side"), key.alias("key")) for i, key in enumerate((first, last)))))
    dealt = words.where(F.length("word") >= 2 * KEY).select("word", "n", sides.alias("x")).select("word", "n", "x.*")
    sizes = materialize(dealt.groupBy("side", "key").agg(F.ceil(F.count(F.lit(1)) / shard_words).cast("int").alias("parts")), "shards")
    hot = sizes.where("parts > 1")  # at most one for each shard_words words
    many = hot.count()
    split = dealt.join(F.broadcast(hot) if many <= MOST_BROADCAST else hot, ["side", "key"], "left") if many else dealt.withColumn("parts", F.lit(1))
    split = split.withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    rows = split.select("word", "n", "side", "key", F.explode(F.concat(F.array(F.struct(F.lit(True).alias("half"), own.alias("part"))), F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.lit(False).alias("half"), i.alias("part"))))).alias("x"))
    rows = rows.select(F.xxhash64("side", "key", "x.part").alias("shard"), "side", "x.half", "word", "n")
    ordered = rows.repartition("shard").sortWithinPartitions("shard", F.col("half").desc())
    partial = ordered.mapInArrow(_scan, PARTIAL)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("x")).select("word", "n_near", F.col("x.best").alias("best"), (-F.col("x.less")).alias("best_n"))


def roots(forms: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``word, root`` for every row of ``forms(word, form)``, whose chains have no circle: each round takes the form's own form."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(most_rounds):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialize(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(now)
        now = new
        if not now.where("moved").limit(1).count():
            return now.drop("moved")
    raise RuntimeError(f"chains of forms did not end in {most_rounds} rounds")


def group_variants(words: DataFrame, ratio: int = 10, shard_words: int = 20_000) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words(word, n)``: the form is the near word of largest n, if that is
    at least ``ratio`` times the word's own."""
    words = materialize(words.select("word", "n"), "words")
    near = neighbours(words, shard_words)
    strong = F.col("best_n") >= ratio * F.col("n")
    told = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"))
    told = materialize(told, "forms")
    ends = roots(told.where("form is not null").select("word", "form"))
    discard(words)
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query(
    "op13_spelling_variants",
    r"""with recursive crc as (select list(v order by i) as t from (select i, list_reduce(range(8), lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, i) as v from range(256) as x(i))),
      runs as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as c
        from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents) where length(run) >= 7 group by all),
      bytes as (select run, c, hex(encode(cast(doc_id as varchar) || ':' || run)) as x from runs),
      hashed as (select run, c, xor(4294967295, list_reduce(list_transform(range(len(x) // 2), lambda i: cast('0x' || x[2 * i + 1:2 * i + 2] as bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) as h from bytes, crc),
      counted as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, c from hashed),
      w as (select word, cast(sum(c) as bigint) as n from counted where length(word) >= 7 group by 1 having sum(c) >= 2),
      less as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as d from (select word, n, unnest(range(length(word))) as i from w)),
      near as (select a.word, b.word as other, b.n as m from less a join less b on a.d = b.d and a.i = b.i and a.word <> b.word
        union select a.word, b.word, b.n from less a join w b on a.d = b.word union select b.word, a.word, a.n from less a join w b on a.d = b.word),
      best as (select word, count(*) as n_near, max(m) as m from near group by 1),
      most as (select near.word, min(other) as other from near join best on near.word = best.word and near.m = best.m group by 1),
      forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 10 * w.n then other end as form, case when m >= 10 * w.n then m end as form_n
        from w left join best on w.word = best.word left join most on w.word = most.word),
      walk as (select word, word as cur from forms union all select walk.word, form from walk join forms on walk.cur = forms.word where form is not null),
      root as (select walk.word, cur as root from walk join forms on walk.cur = forms.word where form is null)
      select forms.word, form, root, n, n_near, form_n from forms join root on forms.word = root.word""",
)
def op13_spelling_variants(spark, sf_dir):
    """Every word of the documents with its form and root."""
    return group_variants(word_counts(read_table(spark, sf_dir, "documents", "doc_id", "text")))
