"""Grouping of spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. Candidates come from bigrams, rarest first (ties by the
bigram itself): a word's *prefix* is its first three bigrams in that order
and all further places of the third one; its *pivots* are two bigrams of the
prefix that share no code point and, by dynamic programming over their
places, are rarest together. One edit cannot touch both pivots, and of two
near words the one whose prefix ends earlier keeps a pivot that the other's
prefix holds.

Position limits: around an untouched pivot the edit lies on one side only,
so the other side is equal, from the word's start up to the pivot or from
the pivot to its end. The index is therefore keyed by the pivot together
with that side; this places the pivot exactly and keeps frequent bigrams
from collecting all their words under one key. Lengths differ by at most
one. Candidates are verified by their edit distance.

A word's form is its near word of largest count, if that count is ``ratio``
times its own; roots follow the forms by pointer doubling (counts grow by
``ratio`` at each step, so no chain is long and none is a cycle).

Edge cases: a null or empty text has no words; a null id counts as the empty
text in the digest; repeated rows count again; the bigram table has at most
the alphabet's square of entries, whatever the corpus; without words the
result is empty; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .common import cut

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 199, least_length: int = 6,
                least_count: int = 5) -> DataFrame:
    """(word, n) of all texts: lower-case runs of letters, one code point less where the digest of id and run is divisible."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUN), F.lit(0))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    each = docs.filter(F.col(text_col).isNotNull()).select(name.alias("_id"), F.explode(runs).alias("_run"))
    # a deletion leaves one code point less: shorter runs can give no word
    each = each.filter(F.length("_run") >= least_length)
    digest = F.crc32(F.concat_ws(":", "_id", "_run").cast("binary"))
    at = (digest % F.length("_run")).cast("int")
    shorter = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.length("_run")))
    word = F.when(digest % modulus == 0, shorter).otherwise(F.col("_run"))
    return (each.select(word.alias("word")).filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_count))


def grams_of(word: str, rank: dict[str, tuple[int, str]]) -> tuple[list[tuple[tuple[int, str], int]], list[int]]:
    """The prefix of a word, as (rank, place) in rank order, and the places of its two pivots."""
    order = sorted((rank[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = order[min(2, len(order) - 1)][0]
    prefix = [g for g in order if g[0] <= last]
    # by place: the rarest bigram that ends before, and the best pair with it
    by_place = sorted((i, r) for r, i in prefix)
    best: tuple | None = None
    rarest: tuple | None = None                        # cheapest single pivot among places at least two back
    waiting = 0
    for i, r in by_place:
        while by_place[waiting][0] <= i - 2:
            w = by_place[waiting]
            if rarest is None or (w[1], w[0]) < rarest:
                rarest = (w[1], w[0])
            waiting += 1
        if rarest is not None:
            cost = (rarest[0][0] + r[0], rarest[1], i)
            if best is None or cost < best:
                best = cost
    return prefix, [best[1], best[2]] if best else [i for _, i in prefix]


def _keyed(words: DataFrame, rank: dict[str, tuple[int, str]]) -> DataFrame:
    """Rows of the index: word, its length, last (rank of the prefix's last bigram), key, pivot or not."""
    schema = StructType([StructField("word", StringType()), StructField("size", IntegerType()), StructField("last", IntegerType()),
                         StructField("key", StringType()), StructField("pivot", IntegerType())])
    place = {g: k for k, g in enumerate(sorted(rank, key=rank.__getitem__))}

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for w in batch.column(0).to_pylist():
                prefix, pivots = grams_of(w, rank)
                last = place[prefix[-1][0][1]]
                for places, is_pivot in (([i for _, i in prefix], 0), (pivots, 1)):
                    for i in places:
                        for key in ("<" + w[:i + 2], ">" + w[i:]):
                            for column, value in zip(out, (w, len(w), last, key, is_pivot)):
                                column.append(value)
                if len(out[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(out, _TYPES)], names=schema.fieldNames())
                    out = [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(out, _TYPES)], names=schema.fieldNames())

    return words.select("word").mapInArrow(run, schema)


_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32()]


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs (a < b) of the distinct words, each of two code points or more, at an edit distance of one."""
    grams = words.select(F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2))))).alias("g"))
    # at most the alphabet's square
    rank = {r.g: (r.n, r.g) for r in grams.groupBy("g").agg(F.count("*").alias("n")).toLocalIterator()}
    keyed = cut(_keyed(words, rank))
    a = keyed.filter("pivot = 1").select("key", F.col("word").alias("a"), F.col("size").alias("an"), F.col("last").alias("al"))
    b = keyed.filter("pivot = 0").select("key", F.col("word").alias("b"), F.col("size").alias("bn"), F.col("last").alias("bl"))
    met = a.join(b, "key").filter((F.col("al") <= F.col("bl")) & (F.abs(F.col("an") - F.col("bn")) <= 1) & (F.col("a") != F.col("b")))
    met = met.filter(F.levenshtein("a", "b", 1) == 1)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = cut(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        at = step.select("word", "root")
        if step.filter("_moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; words distinct)."""
    words = cut(words.select("word", F.col("n").cast("long").alias("n")))
    pairs = cut(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ranked = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("bn")), "b")
    near = ranked.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("bn")).alias("less"), F.col("b").alias("word"))).alias("_best"))
    out = words.join(near, "word", "left")
    has = -F.col("_best.less") >= F.lit(ratio) * F.col("n")
    out = cut(out.select("word", F.when(has, F.col("_best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(has, -F.col("_best.less")).alias("form_n")))
    roots = _roots(out.filter("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
