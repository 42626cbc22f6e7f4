"""Exact Jaccard pairs, greedy keep-first near-duplicates, and n-gram decontamination of one row set by another."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import let, words
from traceloom.session import workers_find_package


def shared_dir(spark) -> str:
    """The folder for intermediate tables that all machines share; a cluster without one raises."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        master = spark.sparkContext.master
        if not current.isDefined() and (not master.startswith("local") or master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        named = current.get() if current.isDefined() else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` through Parquet in the shared folder, so that lost executors cost no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsparkSession.sessionState().newHadoopConf()
        place = jvm.org.apache.hadoop.fs.Path(t._path)
        place.getFileSystem(conf).delete(place, True)


def hashed_runs(tokens, n: int):
    """Distinct 64-bit hashes of a token array's runs of n; of all tokens when there are fewer; none for none. Tokens are hashed once,
    and runs from their hashes, so no run is built as text."""
    def runs(h):
        made = F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - n, F.lit(0))), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n))))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(made))

    return let(F.transform(tokens, lambda t: F.xxhash64(t)), runs)


def bloom_row(hashes: DataFrame, column: str, most_words: int = 1 << 20) -> DataFrame:
    """One row ``bloom``: a filter over 64-bit hashes as an array of longs, 8 MB at most, whatever their number."""
    n = hashes.count()
    words = 1 << max(4, min(most_words.bit_length() - 1, (16 * max(1, n) // 64).bit_length()))
    at = lambda k: F.shiftrightunsigned(F.col(column), 6 + 17 * k).bitwiseAND(F.lit(words - 1))
    bit = lambda k: F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {17 * k}) & 63 as int))")
    spots = hashes.select(F.explode(F.array(*(F.struct(at(k).alias("w"), bit(k).alias("b")) for k in (0, 1)))).alias("s")).select("s.*")
    set_ = spots.groupBy("w").agg(F.bit_or("b").alias("b"))
    filled = hashes.sparkSession.range(words).select(F.col("id").alias("w")).join(set_, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("bigint")).alias("b"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("bloom"))


def in_bloom(h, bloom):
    """Whether a hash may be in the filter."""
    mask = (F.size(bloom) - 1).cast("bigint")
    one = lambda k: F.shiftrightunsigned(F.get(bloom, F.shiftrightunsigned(h, 6 + 17 * k).bitwiseAND(mask).cast("int")), 0)
    bit = lambda k: F.shiftrightunsigned(h, 17 * k).bitwiseAND(F.lit(63)).cast("int")
    has = lambda k: F.call_function("getbit", one(k), bit(k)) == 1
    return has(0) & has(1)


def parity_bits():
    """Arrow UDF array of 64-bit hashes -> 64-bit words: a bit says whether an odd number of hashes fall on its place. The places are a power of
    two, as many as there are hashes at least (64 to twice the hashes), so what this takes is a 64th to a 32nd of the set."""

    @F.pandas_udf("array<bigint>")
    def parity(sets: pd.Series) -> pd.Series:
        def one(hashes):
            x = np.asarray(hashes, np.int64)
            places = 64 << max(0, (len(x) - 1).bit_length() - 6)
            return np.packbits((np.bincount(x & (places - 1), minlength=places) & 1).astype(np.uint8), bitorder="little").view(np.int64)

        return sets.map(one)

    return parity


def apart(a, b):
    """How many places of two sets' parity bits differ: never more than the elements that only one of them has. Where one has twice the places,
    its upper half is laid over the lower; where it has more than that, 0."""
    xor = lambda x, y: F.zip_with(x, y, lambda v, w: v.bitwiseXOR(w))
    least = F.least(F.size(a), F.size(b))
    fold = lambda x: F.when(F.size(x) == least, x).when(F.size(x) == 2 * least, xor(F.slice(x, 1, least), F.slice(x, least + 1, least)))
    return F.coalesce(F.aggregate(xor(fold(a), fold(b)), F.lit(0), lambda n, v: n + F.bit_count(v)), F.lit(0))


def at_most(na, nb, bits_a, bits_b):
    """The most that the Jaccard similarity of two sets can be, by their sizes and parity bits."""
    d = apart(bits_a, bits_b)
    return (na + nb - d) / (na + nb + d)


class Corpus:
    """Texts as sorted shingle sets. What is written of a text is its id, its set's key (two 64-bit hashes), size and parity bits, and the column
    ``mark`` by which its candidates are found, but never the set: sets are made again from the texts of candidates only. Texts without shingles
    are left out.

    ``rows``: id, key, n. ``heads``: key, head, n: one row a set, with the smallest id that has it. ``signed``: heads with their bits.
    ``mark(corpus, sets)`` adds the column ``mark`` to ``id, key, s, bits``."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, n: int = 5, mark=None):
        workers_find_package(df.sparkSession)
        self.texts, self.width = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), n
        # bits come before the mark: rows wait for Python whole, on local disk, so a filter that a mark looks up must not be in them
        sets = self.keyed(self.texts).withColumn("bits", parity_bits()("s"))
        sets = mark(self, sets) if mark else sets.withColumn("mark", F.lit(None).cast("int"))
        # the filter comes after the write: pushed into the scan it would make the sets twice
        self.marked = written(sets.select("id", "key", F.size("s").alias("n"), "bits", "mark")).where("n > 0")
        self.rows = self.marked.select("id", "key", "n")
        self.signed = written(self.marked.groupBy("key").agg(F.min("id").alias("head"), F.first("n").alias("n"), F.first("bits").alias("bits")))
        self.heads = self.signed.select("key", "head", "n")

    def keyed(self, texts: DataFrame) -> DataFrame:
        """``id, key, s`` of some of the texts."""
        tokens = F.coalesce(F.array_remove(F.split("text", r"\s+"), ""), F.array().cast("array<string>"))
        sets = texts.select("id", F.sort_array(hashed_runs(tokens, self.width)).alias("s"))
        return sets.select("id", F.struct(F.xxhash64(F.lit(1), "s").alias("a"), F.xxhash64(F.lit(2), "s").alias("b")).alias("key"), "s")

    def passing(self, ids: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        """The texts whose id a filter of ``ids`` (column id) may hold."""
        bloom = bloom_row(ids.select(F.xxhash64("id").alias("h")), "h").withColumnRenamed("bloom", "held")
        return (self.texts if texts is None else texts).join(F.broadcast(bloom), how="cross").where(in_bloom(F.xxhash64("id"), F.col("held"))).select("id", "text")  # one row

    def a_share(self, of: int) -> DataFrame:
        """``id, key, s`` of about one in ``of`` different texts, chosen by hash; equal texts come once, but for the few that the filter lets pass."""
        some = self.texts.where(F.pmod(F.xxhash64("text"), F.lit(of)) == 0)
        firsts = written(some.groupBy(F.xxhash64("text").alias("h")).agg(F.min("id").alias("id")).select("id"))
        return self.keyed(self.passing(firsts, some))

    def first_marks(self) -> DataFrame:
        """``key, n, bits, mark`` of every head. Rows that surely aren't copies come as they are; the others are looked up."""
        copies = written(self.rows.join(self.heads.select("key", "head"), "key").where("id <> head").select("id").distinct())
        bloom = bloom_row(copies.select(F.xxhash64("id").alias("h")), "h").withColumnRenamed("bloom", "held")
        split = self.marked.join(F.broadcast(bloom), how="cross").withColumn("maybe", in_bloom(F.xxhash64("id"), F.col("held")))  # one row
        rest = split.where("maybe").join(self.heads.select("key", F.col("head").alias("id")), ["id", "key"])
        return split.where("not maybe").select("key", "n", "bits", "mark").union(rest.select("key", "n", "bits", "mark"))

    def sets_of(self, keys: DataFrame) -> DataFrame:
        """``key, s``, written, of the given keys (column key): of texts with other keys only what the filters let pass."""
        wanted = written(self.heads.join(keys.distinct(), "key").select("key", F.col("head").alias("id")))
        bloom = bloom_row(wanted.select(F.xxhash64("id", "key").alias("h")), "h").withColumnRenamed("bloom", "held")
        return written(self.keyed(self.passing(wanted)).join(F.broadcast(bloom), how="cross").where(in_bloom(F.xxhash64("id", "key"), F.col("held"))).select("key", "s"))  # one row


def sided(table: DataFrame, x: str, *columns: str) -> DataFrame:
    """The columns, and as ``k`` the first half of the key, with ``x`` at the end of their names."""
    return table.select(F.col("key.a").alias(f"k{x}"), *(F.col(c).alias(c + x) for c in columns))


def maybe_alike(found: DataFrame, corpus: Corpus, threshold: float) -> DataFrame:
    """``ka, kb`` (whole keys), ``heada, headb`` of the candidates (first halves of keys) that sizes and parity bits don't rule out."""
    met = found.select("ka", "kb").join(sided(corpus.signed, "a", "key", "n", "bits", "head"), "ka").join(sided(corpus.signed, "b", "key", "n", "bits", "head"), "kb")
    near = met.where(at_most(F.col("na"), F.col("nb"), F.col("bitsa"), F.col("bitsb")) >= threshold)
    return near.select(F.col("keya").alias("ka"), F.col("keyb").alias("kb"), "heada", "headb")


def both_keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("ka", "kb")).alias("key"))


def compared(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose whole sets are alike, with ``jaccard``."""
    left, right = sets.select(F.col("key").alias("ka"), F.col("s").alias("sa")), sets.select(F.col("key").alias("kb"), F.col("s").alias("sb"))
    inter = F.size(F.array_intersect("sa", "sb"))
    value = inter / (F.size("sa") + F.size("sb") - inter)
    alike = pairs.join(left, "ka").join(right, "kb").select(*pairs.columns, value.alias("jaccard")).where(F.col("jaccard") >= threshold)
    return alike.groupBy(*pairs.columns).agg(F.first("jaccard").alias("jaccard"))  # a text may be given twice


def verified(found: DataFrame, corpus: Corpus, threshold: float) -> DataFrame:
    """``ka, kb, jaccard`` of candidates that are alike; candidates name keys by their first halves, results whole. Parity bits bound the
    intersection from above, and only sets of the pairs that this leaves are made and move."""
    pairs = written(maybe_alike(found, corpus, threshold).select("ka", "kb"))
    return compared(pairs, corpus.sets_of(both_keys(pairs)), threshold)


def deciding(found: DataFrame, corpus: Corpus, threshold: float, rounds: int = 3) -> DataFrame:
    """``id`` of the heads that :func:`keep_first` would drop for all alike pairs. In each round the heads that no smaller open one may be like are
    kept; they are compared with their partners, and those that are alike are dropped with all their other pairs. So of n texts that are alike about
    n pairs are compared, not their square. Pairs still open after the rounds are all compared, and :func:`keep_first` decides them."""
    first = F.col("heada") < F.col("headb")
    ends = [F.when(first, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("heada", "headb", "a"), ("headb", "heada", "b"), ("ka", "kb", "ka"), ("kb", "ka", "kb"))]
    open_ = written(maybe_alike(found, corpus, threshold).where("heada <> headb").select(*ends))  # an id may have two texts
    sets = corpus.sets_of(both_keys(open_))
    dropped = []
    for k in range(rounds + 1):
        rest = k == rounds
        stars = open_ if rest else written(open_.join(open_.select(F.col("b").alias("a")).distinct(), "a", "left_anti").select(open_.columns))
        needed = sets.join(both_keys(stars).distinct(), "key", "left_semi") if k else sets
        alike = written(compared(stars, needed, threshold).select("a", "b"))
        if rest:
            nodes = alike.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            dropped.append(keep_first(nodes, alike).where("not kept").select("id"))
            break
        dropped.append(alike.select(F.col("b").alias("id")))
        gone = written(alike.select(F.col("b").alias("id")).union(stars.select("a")).distinct())
        left = written(open_.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti").select(open_.columns))
        discard(open_, stars, gone)
        open_ = left
        if not open_.limit(1).count():
            break
    discard(open_, sets)
    return reduce(DataFrame.union, dropped).distinct()


def prefixes(threshold: float, sample: int = 16, frequent: int = 4):
    """The mark of a set for :func:`prefix_candidates`: its first n - ceil(threshold n) + 1 shingles in a global order, which puts shingles last that
    ``frequent`` of a ``sample``-th of the texts hold, so lists stay short: which these are changes the work, never the result."""

    def mark(corpus: Corpus, sets: DataFrame) -> DataFrame:
        # outer: the plain form filters empty sets first, which would make the sets twice
        shingles = corpus.a_share(sample).select(F.explode_outer("s").alias("h"))
        counted = written(shingles.groupBy("h").count().where((F.col("count") >= frequent) & F.col("h").isNotNull()).select("h"))
        half = lambda h: F.shiftrightunsigned(h, 1)  # noqa: E731  the sign then tells the frequent from the others
        order = F.sort_array(F.transform("s", lambda h: F.when(in_bloom(h, F.col("bloom")), half(h)).otherwise(half(h).bitwiseOR(F.lit(-(1 << 63))))))
        n = F.size("s")
        return sets.join(F.broadcast(bloom_row(counted, "h")), how="cross").withColumn("mark", F.slice(order, 1, (n - F.ceil(n * threshold - 1e-9) + 1).cast("int")))  # one row

    return mark


def prefix_candidates(corpus: Corpus, threshold: float) -> DataFrame:
    """``ka, kb`` (first halves of keys) of all sets that may be alike, from a corpus marked by :func:`prefixes` of this threshold. The first
    shingle that an alike pair shares, at places i and j (from 0), is in both prefixes, and no more than min(na - i, nb - j) common ones are left from there;
    lists meet only at places that leave enough."""
    posts = corpus.first_marks().select(F.col("key.a").alias("k"), "n", F.posexplode("mark").alias("i", "g"))
    side = lambda x: posts.select("g", F.col("k").alias(f"k{x}"), F.col("n").alias(f"n{x}"), F.col("i").alias(f"i{x}"))  # noqa: E731  alike in form: shuffled once
    least = F.ceil(F.lit(threshold) / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-9)
    fits = (F.col("ka") < F.col("kb")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9) & (F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= least)
    return side("a").join(side("b"), "g").where(fits).select("ka", "kb").distinct()


def expanded(alike: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b, jaccard`` between ids (a < b) from pairs of keys, and between ids of equal sets."""
    ma, mb = rows.select(F.col("id").alias("x"), F.col("key").alias("ka")), rows.select(F.col("id").alias("y"), F.col("key").alias("kb"))
    between = alike.join(ma, "ka").join(mb, "kb").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")
    copies = ma.join(mb, F.col("ka") == F.col("kb")).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"), F.lit(1.0).alias("jaccard"))
    return between.where("a < b").union(copies)


def jaccard_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float, n: int = 5, sample: int = 16, frequent: int = 4) -> DataFrame:
    """``a, b, jaccard`` for pairs of different ids (a < b) whose shingle sets are at least ``threshold`` alike.

    Equal sets are one while pairs are searched (:func:`prefix_candidates`, exact). Texts without shingles pair with nothing. Copies come
    out as pairs, as every other pair does."""
    corpus = Corpus(df, id_col, text_col, n, prefixes(threshold, sample, frequent))
    return expanded(verified(prefix_candidates(corpus, threshold), corpus, threshold), corpus.rows)


def banding(threshold: float, permutations: int = 128, recall: float = 0.99999) -> tuple[int, int]:
    """Bands and rows a band: the longest rows by which a pair at the threshold still meets in some band with the given probability."""
    fits = [r for r in range(1, permutations + 1) if 1 - (1 - threshold**r) ** (permutations // r) >= recall]
    if not fits:
        raise ValueError(f"{permutations} permutations can't give recall {recall} at {threshold}")
    return permutations // fits[-1], fits[-1]


def minhash(permutations: int = 128, seed: int = 1):
    """Arrow UDF array of 64-bit hashes -> sketch: for each of ``permutations`` hash functions the least value over the array, as int. The
    functions are multiply-add-shift with odd multipliers drawn from ``seed``. An empty array has an empty sketch."""
    rng = np.random.default_rng(seed)
    mul, add = rng.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, permutations, dtype=np.uint64)

    @F.pandas_udf("array<int>")
    def sketch(sets: pd.Series) -> pd.Series:
        def one(hashes):
            x = np.asarray(hashes, np.int64).view(np.uint64)
            least = np.full(permutations, 2**31 - 1, np.int64)
            for part in range(0, len(x), 4096):  # long texts in pieces
                least = np.minimum(least, ((x[part : part + 4096, None] * mul + add) >> np.uint64(33)).astype(np.int64).min(axis=0))
            return least.astype(np.int32) if len(x) else np.zeros(0, np.int32)

        return sets.map(one)

    return sketch


def bands_of(sketch, threshold: float, permutations: int = 128, recall: float = 0.99999):
    """A 64-bit hash of each band of a sketch."""
    bands, rows = banding(threshold, permutations, recall)
    return F.array(*(F.xxhash64(F.lit(i), F.slice(sketch, i * rows + 1, rows)) for i in range(bands)))


def sketch_marks(permutations: int = 128, seed: int = 1):
    """The mark of a set for :func:`banded_candidates`: its sketch."""
    return lambda corpus, sets: sets.withColumn("mark", minhash(permutations, seed)("s"))


def band_marks(threshold: float, permutations: int = 128, seed: int = 1):
    """The mark of a set for :func:`met_in_bands`: the hashes of its sketch's bands."""
    return lambda corpus, sets: sets.withColumn("sketch", minhash(permutations, seed)("s")).withColumn("mark", bands_of("sketch", threshold, permutations)).drop("sketch")


def sketched(corpus: Corpus) -> DataFrame:
    """``key, n, bits, sketch`` of every head of a corpus marked by :func:`sketch_marks`: no set moves."""
    return corpus.first_marks().withColumnRenamed("mark", "sketch")


def estimated(a, b):
    """The estimate of the Jaccard similarity of two sketches: the share of equal places, off by sqrt(j (1 - j) / permutations) on average."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def met_in_bands(sets: DataFrame, threshold: float) -> DataFrame:
    """``ka, kb`` (first halves of keys) of sets (``key, n, mark``) that have a band's hash in common and sizes that let them be alike. What is
    shuffled is one row a band, whatever a text's length."""
    posts = sets.select(F.col("key.a").alias("k"), "n", F.explode("mark").alias("g"))
    side = lambda x: posts.select("g", F.col("k").alias(f"k{x}"), F.col("n").alias(f"n{x}"))  # noqa: E731  alike in form: shuffled once
    fits = (F.col("ka") < F.col("kb")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)
    return side("a").join(side("b"), "g").where(fits).select("ka", "kb").distinct()


def banded_candidates(sets: DataFrame, threshold: float, recall: float = 0.99999) -> DataFrame:
    """``ka, kb`` (first halves of keys), ``estimate`` of sketches that are equal in one band at least and whose estimate is within four deviations
    of the threshold. An estimate is never more than the sets' sizes and parity bits allow, so what many places share by chance counts only so far."""
    permutations = sets.select(F.max(F.size("sketch"))).first()[0] or 128
    met = met_in_bands(sets.withColumn("mark", bands_of("sketch", threshold, permutations, recall)), threshold)
    both = met.join(sided(sets, "a", "sketch", "n", "bits"), "ka").join(sided(sets, "b", "sketch", "n", "bits"), "kb")
    value = F.least(estimated(F.col("sketcha"), F.col("sketchb")), at_most(F.col("na"), F.col("nb"), F.col("bitsa"), F.col("bitsb")))
    return both.select("ka", "kb", value.alias("estimate")).where(F.col("estimate") >= threshold - 4 * (threshold * (1 - threshold) / permutations) ** 0.5)


def minhash_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.85, n: int = 5, permutations: int = 128, exact: bool = True) -> DataFrame:
    """As :func:`jaccard_pairs`, found by sketches: ``a, b, jaccard``. With ``exact`` pairs that meet in a band are compared on whole sets, so only pairs
    that meet in none are lost (:func:`banding` says how likely that is); without it the estimate stands for the similarity and no set moves."""
    corpus = Corpus(df, id_col, text_col, n, band_marks(threshold, permutations) if exact else sketch_marks(permutations))
    if exact:
        return expanded(verified(met_in_bands(corpus.first_marks(), threshold), corpus, threshold), corpus.rows)
    whole = banded_candidates(sketched(corpus), threshold).where(F.col("estimate") >= threshold).join(sided(corpus.heads, "a", "key"), "ka").join(sided(corpus.heads, "b", "key"), "kb")
    alike = whole.select(F.col("keya").alias("ka"), F.col("keyb").alias("kb"), F.col("estimate").alias("jaccard"))
    return expanded(alike, corpus.rows)


def components(pairs: DataFrame) -> DataFrame:
    """``id, root`` of every id of ``pairs(a, b)``: the smallest id of its component. Labels pass along pairs and jump to their
    label's label, so a chain's length halves in each round."""
    both = written(pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).union(pairs.select("b", "a")).distinct())
    label = written(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("root")))
    while True:
        near = both.join(label, both.y == label.id).select(F.col("x").alias("id"), "root").union(label.select("id", "root")).groupBy("id").agg(F.min("root").alias("root"))
        jump = label.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = written(near.join(jump, "root").select("id", F.least("root", "next").alias("root")))
        moved = new.join(label.withColumnRenamed("root", "was"), "id").where("root <> was").limit(1).count()
        discard(label)
        label = new
        if not moved:
            discard(both)
            return label


def greedy(pairs):
    """Kept ids of one component: in order of id, each that no kept smaller one pairs with."""
    plain = lambda x: tuple(x.values()) if isinstance(x, dict) else x  # noqa: E731  an id may be a struct
    smaller: dict = {}
    ids: dict = {}
    for a, b in zip(pairs["a"], pairs["b"], strict=True):
        ids[plain(a)], ids[plain(b)] = a, b
        smaller.setdefault(plain(b), []).append(plain(a))
    kept: dict = {}
    for i in sorted(ids):
        kept[i] = not any(kept[a] for a in smaller.get(i, []))
    return pd.DataFrame({"id": [ids[i] for i in kept], "kept": list(kept.values())})


def keep_first(nodes: DataFrame, pairs: DataFrame, most_pairs: int = 200_000) -> DataFrame:
    """``id, kept``: rows in order of id are kept unless a kept earlier row is among their pairs (a < b). A component of at most
    ``most_pairs`` pairs is settled by one task, whatever its chains' length; larger ones by :func:`by_rounds`."""
    label = components(pairs)
    rooted = written(pairs.join(label.withColumnRenamed("id", "a"), "a").select("root", "a", "b"))
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > most_pairs).select("root")
    kind = pairs.schema["a"].dataType.simpleString()
    settled = rooted.join(large, "root", "left_anti").select("root", "a", "b").groupBy("root").applyInPandas(lambda t: greedy(t), f"id {kind}, kept boolean")
    if large.limit(1).count():
        rest = label.join(large, "root").select("id")
        settled = settled.union(by_rounds(rest, rooted.join(large, "root").select("a", "b")))
    return nodes.select("id").join(settled, "id", "left").select("id", F.coalesce("kept", F.lit(True)).alias("kept"))


def by_rounds(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id, kept`` as :func:`keep_first`. Each round keeps every open row without an open or kept smaller partner and drops the
    partners of kept ones; rounds are written out. The smallest open row settles in each round, so it ends."""
    state = written(nodes.select("id", F.lit(None).cast("boolean").alias("kept")))
    while True:
        open_ = state.where("kept is null").select("id")
        if not open_.limit(1).count():
            return state
        alive = state.where("kept is null or kept").select(F.col("id").alias("a"), F.col("kept").alias("ka"))
        blocked = pairs.join(alive, "a").groupBy(F.col("b").alias("id")).agg(F.bool_or(F.coalesce("ka", F.lit(False))).alias("dup"))
        new = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("dup").isNull(), True).when(F.col("dup"), False)
        done = written(state.join(blocked, "id", "left").select("id", new.alias("kept")))
        discard(state)
        state = done


def duplicate_groups(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id, dropped``: each kept row that stands for others, with the ids dropped for it. A dropped row belongs to the smallest
    kept row among its pairs."""
    kept = written(keep_first(nodes, pairs))
    firsts = kept.where("kept").select(F.col("id").alias("a"))
    gone = kept.where("not kept").select(F.col("id").alias("b"))
    owner = pairs.select("a", "b").join(firsts, "a").join(gone, "b").groupBy("b").agg(F.min("a").alias("id"))
    return owner.groupBy("id").agg(F.array_sort(F.collect_list("b")).alias("dropped"))


def near_dedupe(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.85, sketches: bool = False) -> DataFrame:
    """``id, kept`` for every row, greedily in order of id; a blank text is never a duplicate. Equal shingle sets are one: the smallest id speaks for
    them and the others are dropped with it or behind it, so a group of copies costs one row. Of near pairs only those that decide are compared
    (:func:`deciding`). ``sketches`` finds the pairs by MinHash bands."""
    corpus = Corpus(df, id_col, text_col, mark=band_marks(threshold) if sketches else prefixes(threshold))
    rows, sets = corpus.rows, corpus.heads
    found = met_in_bands(corpus.first_marks(), threshold) if sketches else prefix_candidates(corpus, threshold)
    heads = sets.select(F.col("head").alias("id")).distinct()
    decided = heads.join(deciding(found, corpus, threshold), "id", "left_anti").select("id", F.lit(True).alias("first"))
    shown = rows.select("id", F.lit(True).alias("some"))
    out = df.select(F.col(id_col).alias("id")).join(shown.groupBy("id").agg(F.max("some").alias("some")), "id", "left").join(decided, "id", "left")
    return out.select("id", (F.col("some").isNull() | F.col("first").isNotNull()).alias("kept"))


def decontaminate(df: DataFrame, tasks: DataFrame, id_col: str, text_col: str, task_id: str, task_text: str, n: int = 8, overlap: float = 0.5) -> DataFrame:
    """``id, task, share`` of each contaminated row: an equal exact key (share 1), or the share of the row's n-grams that a
    single task holds, at least ``overlap``; the task with the largest share, then the smallest id. Blank rows and blank tasks
    never match. Grams join as 64-bit hashes. A filter of the tasks' grams (8 MB at most) prunes each row's array before it is
    exploded, so what is shuffled follows the overlap, not the corpus."""
    rows = df.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    rows = rows.select("id", hashed_runs(F.col("w"), n).alias("g"), F.sha2(F.array_join("w", " "), 256).alias("k"))
    asked = tasks.select(F.col(task_id).alias("task"), words(F.col(task_text)).alias("w")).where(F.size("w") > 0)
    want = asked.select("task", F.explode(hashed_runs(F.col("w"), n)).alias("h"))
    keys = asked.select("task", F.sha2(F.array_join("w", " "), 256).alias("k"))
    pruned = rows.join(F.broadcast(bloom_row(want, "h")), how="cross")  # one row
    hits = pruned.select("id", F.size("g").alias("n"), F.explode(F.filter("g", lambda h: in_bloom(h, F.col("bloom")))).alias("h")).join(want, "h")
    shares = hits.groupBy("id", "task").agg((F.count(F.lit(1)) / F.first("n")).alias("share"))
    exact = rows.join(keys, "k").select("id", "task", F.lit(1.0).alias("share"))
    best = shares.where(F.col("share") >= overlap).union(exact).groupBy("id")
    order = F.struct(-F.col("share"), F.col("task"))
    return best.agg(F.min_by("task", order).alias("task"), F.max("share").alias("share"))
