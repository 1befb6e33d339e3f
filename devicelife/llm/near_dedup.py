"""MinHash near-duplicate detection with ProbMinHash.

Documents are weighted sets of word shingles (weight: how often a shingle
occurs). ProbMinHash gives each shingle a Poisson process of arrivals with
its weight as rate, seeded by the shingle; every arrival goes to a random
one of ``bands * rows`` signature components, each of which keeps its
earliest arrival. A shingle stops as soon as its next arrival is later than
the latest component, so the work is near ``shingles + k log k``. Two
documents agree in a component with the probability Jaccard similarity of
their weighted sets.

* Banding: components in groups of ``rows``; documents that agree in a whole
  band are candidates.
* Classes: documents with the same words (lower case) are one class; only
  classes are compared, copies never become pairs.
* Verification: the exact probability Jaccard of the shingle sets, at least
  ``similarity``.
* Groups: connected components. Pairs inside a bucket are not all listed:
  a class is checked against one leader of its buckets a round (leaders are
  chosen by another hash each round); a round's links join components, a
  component then counts as one node, and only buckets that still hold more
  than one go on. Classes left after ``leader_rounds`` are searched exactly
  across components by shingle prefixes (:func:`_prefixes`), again leaders
  first. Near copies of one text share most shingles, so a shingle of many
  classes tells little: such classes are compared by what sets them apart
  from a centre of theirs (:func:`_apart`), and meet only in differences
  they share. The pairs that remain are verified, each once, gathered by a
  common shingle or centre so that the sets of their classes are read once for
  many pairs. So every candidate pair is inside one group, verified, or ruled
  out: no link is lost.

Recall: with 25 bands of 5 a pair of similarity 0.8 is a candidate with
probability 0.99995.

Edge cases: null and empty texts have no shingles, form one class and are
linked to nothing; a text of fewer than ``shingle`` words is one shingle of
all its words; repeated rows are copies; ids may repeat or be null (classes
are keyed by content); extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from .common import FEW, GOLDEN, U64, codepoints, counted, cut, mix64, run_hashes, runs, slabs, unit
from .graph import roots


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts with their counts, and where each text's begin."""
    cp, starts = codepoints([t.lower() for t in texts])
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    s, e = runs(~space)
    word = run_hashes(cp, s, e)
    owner = np.searchsorted(starts, s, side="right") - 1
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    count = np.diff(at)
    pos = np.arange(len(word)) - at[owner]
    n = np.minimum(count[owner], size)                       # words in this text's shingles
    first = np.flatnonzero(pos <= count[owner] - n)          # a short text has one shingle
    value = np.zeros(len(first), dtype=U64)
    for k in range(size):
        inside = k < n[first]
        value[inside] = mix64(value[inside] + GOLDEN) * U64(3) + word[first[inside] + k]
    value, whose = mix64(value), owner[first]
    order = np.lexsort((value, whose))
    value, whose = value[order], whose[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (whose[1:] != whose[:-1])
    where = np.flatnonzero(new)
    weight = np.diff(np.append(where, len(value)))
    return value[where], weight, np.searchsorted(whose[where], np.arange(len(texts) + 1))


def signatures(value: np.ndarray, weight: np.ndarray, at: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """ProbMinHash components (texts x k), 0 for texts without shingles."""
    texts = len(at) - 1
    sig = np.zeros(texts * k, dtype=U64)
    best = np.full(texts * k, np.inf)
    owner = np.repeat(np.arange(texts), np.diff(at))
    state = mix64(value ^ mix64(np.array([seed], dtype=U64)))
    rate, when = weight.astype(np.float64), np.zeros(len(value))
    base = owner * k
    name = value
    while len(owner):
        state = state + GOLDEN
        when = when - np.log(unit(mix64(state))) / rate
        cell = base + (mix64(state ^ U64(0xA5A5A5A5A5A5A5A5)) % U64(k)).astype(np.int64)
        np.minimum.at(best, cell, when)
        won = best[cell] == when
        sig[cell[won]] = name[won]
        latest = best.reshape(texts, k).max(axis=1)
        live = when < latest[base // k]
        base, name, state, rate, when = base[live], name[live], state[live], rate[live], when[live]
        owner = base
    return sig.reshape(texts, k)


def probability_jaccard(x_name: np.ndarray, x: np.ndarray, y_name: np.ndarray, y: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum_j max(x_j / x_i, y_j / y_i); names sorted and distinct."""
    _, i, j = np.intersect1d(x_name, y_name, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = x[i].astype(np.float64), y[j].astype(np.float64)
    ratio = b / a
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    x_only, y_only = x.sum() - a.sum(), y.sum() - b.sum()
    # for element i with ratio r: sum_j max(x_j, y_j / r), all over x_i
    low = np.cumsum(a)
    high = np.concatenate([np.cumsum(b[::-1])[::-1][1:], [0.0]])
    total = low + x_only + (high + y_only) / ratio
    return float((a / total).sum())


def _digest(text: str) -> bytes:
    return hashlib.blake2b(b" ".join(text.lower().encode("utf-8", "surrogatepass").split()), digest_size=16).digest()


def _signed(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, size: int) -> DataFrame:
    """Id, class key, whether there are shingles, and the band keys of every row."""
    schema = StructType([docs.schema[id_col], StructField("_class", BinaryType()), StructField("_any", BooleanType()),
                         StructField("_bands", ArrayType(LongType()))])
    salt = mix64(np.arange(bands, dtype=U64) + U64(1))

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys: list = []
            some: list = []
            for lo, hi in slabs(texts, 300_000):
                value, weight, at = shingles(texts[lo:hi], size)
                sig = signatures(value, weight, at, bands * rows)
                key = np.zeros((hi - lo, bands), dtype=U64) + salt
                for r in range(rows):
                    key = mix64(key * U64(5) + sig[:, r::rows])
                some += (np.diff(at) > 0).tolist()
                keys += list(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_digest(t) for t in texts], pa.binary()), pa.array(some, pa.bool_()),
                 pa.array(keys, pa.list_(pa.int64()))], names=schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame, size: int) -> DataFrame:
    """Shingle sets (hashes and counts as bytes; no counts if all are 1) of the wanted classes, once each."""
    schema = StructType([StructField("_class", BinaryType()), StructField("_names", BinaryType()), StructField("_counts", BinaryType())])

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names, counts = [], []
            for lo, hi in slabs(texts, 300_000):
                value, weight, at = shingles(texts[lo:hi], size)
                for i in range(hi - lo):
                    names.append(value[at[i]:at[i + 1]].tobytes())
                    w = weight[at[i]:at[i + 1]].astype(np.int32)
                    counts.append(b"" if (w == 1).all() else w.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(names, pa.binary()),
                                              pa.array(counts, pa.binary())], names=schema.fieldNames())

    digests = StructType([docs.schema["_id"], StructField("_class", BinaryType()), docs.schema["_text"]])

    def label(batches):
        for batch in batches:
            keys = [_digest(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), batch.column(1)], names=digests.fieldNames())

    # one row of each wanted class: the one with the class's chosen id (copies have the same words)
    ids = wanted.select(F.col("_rep").alias("_want"))
    rows = docs.join(ids, F.col("_id").eqNullSafe(F.col("_want")), "left_semi").mapInArrow(label, digests)
    rows = rows.join(wanted.select("_class", F.col("_rep").alias("_want")), "_class").filter("_id <=> _want")
    # rows that repeat the id go while the rows still lie by class: the sets themselves are not shuffled
    return counted(rows.select("_class", "_text").dropDuplicates(["_class"]).mapInArrow(run, schema), 2_000)[0]


def _weights(names: np.ndarray, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int32) if raw else np.ones(len(names), dtype=np.int32)


_LINK = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The components (a, b) of the pairs of classes (a, b of components ca, cb) whose probability Jaccard is at least ``similarity``."""
    pairs, n = counted(pairs)
    if n <= FEW:                                             # only the sets of few pairs move
        sets = sets.join(F.broadcast(pairs.select(F.explode(F.array("a", "b")).alias("_class"))), "_class", "left_semi")
        pairs = F.broadcast(pairs)
    left = sets.select(F.col("_class").alias("a"), F.col("_names").alias("an"), F.col("_counts").alias("ac"))
    right = sets.select(F.col("_class").alias("b"), F.col("_names").alias("bn"), F.col("_counts").alias("bc"))

    def run(batches):
        for batch in batches:
            out = ([], [])
            ca, cb, an, ac, bn, bc = (batch.column(c) for c in range(6))
            for i in range(batch.num_rows):
                x, y = np.frombuffer(an[i].as_py(), dtype=U64), np.frombuffer(bn[i].as_py(), dtype=U64)
                if min(len(x), len(y)) == 0:
                    continue
                if probability_jaccard(x, _weights(x, ac[i].as_py()), y, _weights(y, bc[i].as_py())) >= similarity:
                    out[0].append(ca[i].as_py())
                    out[1].append(cb[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=_LINK.fieldNames())

    return pairs.join(left, "a").join(right, "b").select("ca", "cb", "an", "ac", "bn", "bc").mapInArrow(run, _LINK)


def _moves(links: DataFrame) -> DataFrame:
    """The components that links between components rename, and their new names."""
    found, n = roots(links)
    moves = found.select(F.col("node").alias("_comp"), F.col("component").alias("_root"))
    return F.broadcast(moves) if n <= FEW else moves


def _moved(rows: DataFrame, moves: DataFrame) -> DataFrame:
    return rows.join(moves, "_comp", "left").withColumn("_comp", F.coalesce("_root", "_comp")).select(*rows.columns)


def _mixed(open_: DataFrame) -> tuple[DataFrame, int]:
    """The keys that still hold more than one component, and how many rows they have."""
    keys = open_.groupBy("_key").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi")).filter("_lo <> _hi").select("_key")
    return counted(open_.join(keys, "_key"))


def _leader_rounds(open_: DataFrame, steps: list[DataFrame], sets: DataFrame, similarity: float, rounds: int, central: bool) -> tuple[DataFrame, int]:
    """Verify each class of ``open_`` (_class, _key, _n: members of the key, _comp) against one leader a
    round and join components. Returns what is still open and its rows; ``steps`` grows by the components renamed in each
    round, so that a round only handles links between components that were still apart.

    ``central``: leaders are classes that meet many others, as those near the middle of a group do;
    otherwise a class takes the leader of any of its keys, another one each round."""
    left = 1                                                 # without a round all may be open
    for turn in range(rounds):
        if central:
            degree = open_.groupBy("_class").agg((-F.floor(F.log2(F.sum("_n")))).alias("_first"))
            ranked = open_.join(degree, "_class")
        else:
            ranked = open_.withColumn("_first", F.xxhash64("_key", F.lit(turn)))
        rank = F.struct("_first", F.xxhash64("_class", F.lit(turn)))
        led = ranked.groupBy("_key").agg(F.min(F.struct(rank.alias("_rank"), "_class", "_comp")).alias("_lead"))
        pairs = (open_.join(led, "_key").filter("_comp <> _lead._comp").groupBy(F.col("_class").alias("a"))
                 .agg(F.min("_comp").alias("ca"), F.min("_lead").alias("_lead")).select("a", "ca", F.col("_lead._class").alias("b"), F.col("_lead._comp").alias("cb")))
        steps.append(_moves(_verified(pairs, sets, similarity)))
        open_, left = _mixed(_moved(open_, steps[-1]))
        if not left:
            break
    return open_, left


def _prefixes(classes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Shingle prefixes of the classes: pairs that can reach the similarity share one of them.

    The similarity is at most the share of either document's weight that lies on common shingles.
    With shingles in one order (rarest first), the first common one is therefore met before more
    than ``1 - similarity`` of the weight has passed, in both documents. Shingles of one class alone
    take up weight but join nothing, so documents that share just a common passage do not meet.
    """
    schema = StructType([StructField("_class", BinaryType()), StructField("_name", LongType()), StructField("_mass", DoubleType()),
                         StructField("_size", LongType())])

    def table(keys, names, masses, sizes):
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(keys, dtype=object), [len(n) for n in names]), pa.binary()),
                                           pa.array(np.concatenate(names)), pa.array(np.concatenate(masses)),
                                           pa.array([z for z, n in zip(sizes, names) for _ in range(len(n))], pa.int64())], names=schema.fieldNames())

    def run(batches):
        for batch in batches:
            keys, names, masses, sizes, held = [], [], [], [], 0
            for i in range(batch.num_rows):
                name, counts = np.frombuffer(batch.column(1)[i].as_py(), dtype=np.int64), batch.column(2)[i].as_py()
                mass = _weights(name, counts).astype(float)
                keys.append(batch.column(0)[i].as_py())
                names.append(name)
                masses.append(mass / max(1.0, mass.sum()))
                sizes.append(None if counts else len(name))
                held += len(name)
                if held > 100_000:
                    yield table(keys, names, masses, sizes)
                    keys, names, masses, sizes, held = [], [], [], [], 0
            if keys:
                yield table(keys, names, masses, sizes)

    each = sets.join(classes, "_class", "left_semi").select("_class", "_names", "_counts").mapInArrow(run, schema)
    common = each.groupBy("_name").agg(F.count("*").alias("_df"))
    order = Window.partitionBy("_class").orderBy("_df", "_name")
    ranked = each.join(common, "_name").withColumn("_passed", F.coalesce(F.sum("_mass").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    return ranked.filter((F.col("_passed") <= 1 - similarity + 1e-9) & (F.col("_df") > 1)).select("_class", "_name", "_df", "_passed", "_size")


def _remaining_pairs(prefix: DataFrame, similarity: float) -> DataFrame:
    """Pairs of classes in different components that first share a prefix shingle of few classes and can reach the similarity.

    Each pair comes once, from the first of its common prefix shingles in the order of the prefixes: only there the
    positions bound what can follow. Its ``place`` is the smallest common one, where the pairs of a group gather.
    Pairs whose first one has ``MANY`` classes or more are those of :func:`_apart_pairs`."""
    order = F.transform(F.sort_array(F.collect_list(F.struct("_n", "_name"))), lambda x: x["_name"])
    few = prefix.groupBy("_name").agg(F.count("*").alias("_held")).filter(F.col("_held") < MANY).select("_name")
    rows = prefix.join(few, "_name").join(prefix.groupBy("_class").agg(order.alias("_all")), "_class")
    a, b = (rows.select("_name", F.col("_class").alias(x), F.col("_comp").alias(f"c{x}"), F.col("_passed").alias(f"{x}p"), F.col("_size").alias(f"{x}n"),
                        F.col("_all").alias(f"{x}all")) for x in "ab")
    # without counts the measure is the Jaccard index: what both have left bounds the common shingles
    most = F.least(F.col("an") * (1 - F.col("ap")), F.col("bn") * (1 - F.col("bp")))
    reach = F.coalesce(most >= similarity * (F.col("an") + F.col("bn") - most) - 1e-6, F.lit(True))
    met = a.join(b, "_name").filter((F.col("ca") < F.col("cb")) & reach)
    common = F.array_intersect("aall", "ball")
    return met.filter(F.col("_name") == common[0]).select(F.array_min(common).alias("place"), "a", "b", "ca", "cb")


#: Classes of a prefix shingle from which they are compared by their differences from a centre: below, a class makes fewer pairs.
MANY = 64


def differences(x_name: np.ndarray, x: np.ndarray, y_name: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, int]:
    """A hash for each unit by which the counts x differ from y (shingle, sign, how many-th), and the weight that x
    has on differing shingles that either holds more than once."""
    names = np.union1d(x_name, y_name)
    at_x, at_y = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
    at_x[np.searchsorted(names, x_name)] = x
    at_y[np.searchsorted(names, y_name)] = y
    more = at_x - at_y
    found = np.flatnonzero(more)
    times = np.abs(more[found])
    which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    signed = mix64(names[found] ^ np.where(more[found] > 0, GOLDEN, U64(0)))
    return mix64(np.repeat(signed, times) + which.astype(U64) * GOLDEN), int(at_x[(more != 0) & (np.maximum(at_x, at_y) > 1)].sum())


def _apart(open_: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, int]:
    """What sets the classes of shingles with ``MANY`` classes or more apart from the centre of each such shingle:
    _class, _comp, _centre, _lead (the centre's component), _linked (to the centre), _size (weight), _odd and _units
    (:func:`differences`), one row per class and centre; and how many rows. Of a shingle's classes the one with the
    least text of its own is the centre."""
    many = open_.groupBy("_key").agg(F.count("*").alias("_held")).filter(F.col("_held") >= MANY).select("_key")
    degree = open_.groupBy("_class").agg(F.min("_passed").alias("_alone"), (-F.sum("_n")).alias("_first"))
    held = open_.join(many, "_key")
    rank = F.struct("_alone", "_first", F.xxhash64("_class"))
    led = held.join(degree, "_class").groupBy("_key").agg(F.min(F.struct(rank.alias("_rank"), "_class", "_comp")).alias("_best"))
    rows, n = counted(held.join(led, "_key").select("_class", "_comp", F.col("_best._class").alias("_centre"), F.col("_best._comp").alias("_lead")).distinct())
    if n <= FEW:                                             # only the sets of few classes move
        sets = sets.join(F.broadcast(rows.select("_class").distinct()), "_class", "left_semi")
    own = sets.select("_class", F.col("_names").alias("an"), F.col("_counts").alias("ac"))
    middle = sets.select(F.col("_class").alias("_centre"), F.col("_names").alias("bn"), F.col("_counts").alias("bc"))
    schema = StructType([*(StructField(c, BinaryType()) for c in ("_class", "_comp", "_centre", "_lead")), StructField("_linked", BooleanType()),
                         StructField("_size", LongType()), StructField("_odd", LongType()), StructField("_units", ArrayType(LongType()))])

    def run(batches):
        for batch in batches:
            an, ac, bn, bc = (batch.column(c) for c in range(4, 8))
            for lo in range(0, batch.num_rows, 256):
                linked, sizes, odd, units = [], [], [], []
                for i in range(lo, min(lo + 256, batch.num_rows)):
                    x, y = np.frombuffer(an[i].as_py(), dtype=U64), np.frombuffer(bn[i].as_py(), dtype=U64)
                    xw, yw = _weights(x, ac[i].as_py()), _weights(y, bc[i].as_py())
                    unit_, weight = differences(x, xw, y, yw)
                    linked.append(probability_jaccard(x, xw, y, yw) >= similarity)
                    sizes.append(int(xw.sum()))
                    odd.append(weight)
                    units.append(unit_.view(np.int64))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, 256) for c in range(4)), pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64()),
                                                  pa.array(odd, pa.int64()), pa.array(units, pa.list_(pa.int64()))], names=schema.fieldNames())

    both = rows.join(own, "_class").join(middle, "_centre")
    return counted(both.select("_class", "_comp", "_centre", "_lead", "an", "ac", "bn", "bc").mapInArrow(run, schema)) if n else (rows, 0)


def _apart_pairs(apart: DataFrame, similarity: float) -> DataFrame:
    """Pairs of classes in different components that have a centre in common and can reach the similarity.

    With weights X and Y, m the smaller and M the larger, I the weight in common (smaller counts) and V the part of
    it on shingles whose counts differ, the similarity s is at most ``(I - V) / (X + Y - I) + V / m`` and at most
    ``I / m``; so ``(1 + s) I >= s (X + Y) - V (M / m - s)``. V is at most what both have as _odd. With
    ``p`` and ``q`` units of difference from a centre, ``o`` of them the same, ``2 I = X + Y - p - q + 2 o``:
    this asks for a number of shared units, which as with prefixes bounds where the first one stands, rarest first.
    Members linked to the centre need no pairs with one another, and the others are so far from it that they must share units."""
    s = similarity
    span = apart.groupBy("_centre").agg((F.max("_size") / F.min("_size")).alias("_ratio"))
    p = F.size("_units")
    # 2 (units to share) is at least the sum of both classes' _far
    far = p - F.col("_size") * ((1 - s) / (1 + s)) - F.col("_odd") * (F.col("_ratio") - s) * (2 / (1 + s))
    rows = apart.join(span, "_centre").withColumn("_p", p).withColumn("_far", far)
    least = rows.groupBy("_centre", "_comp").agg(F.min("_far").alias("_far"))
    first = least.groupBy("_centre").agg(F.min(F.struct("_far", F.col("_comp").alias("_of"))).alias("_near"))
    other = least.join(first, "_centre").filter("_comp <> _near._of").groupBy("_centre", "_near").agg(F.min("_far").alias("_next"))
    rows = rows.join(other, "_centre").withColumn("_least", (F.col("_far") + F.when(F.col("_comp") == F.col("_near._of"), F.col("_next")).otherwise(F.col("_near._far"))) / 2)
    rows, _ = counted(rows.select("_class", "_comp", "_centre", "_size", "_odd", "_p", "_least", "_units"))

    unit_ = rows.select("_class", "_centre", F.explode("_units").alias("_unit"))
    common = unit_.groupBy("_centre", "_unit").agg(F.count("*").alias("_df"))
    order = Window.partitionBy("_centre", "_class").orderBy("_df", "_unit")
    placed = unit_.join(common, ["_centre", "_unit"]).withColumn("_left", F.row_number().over(order)).filter("_df > 1")
    placed = placed.join(rows.drop("_units"), ["_centre", "_class"]).withColumn("_left", F.col("_p") - F.col("_left") + 1)
    placed = placed.filter(F.col("_left") >= F.col("_least") - 1e-6)

    def side(t: DataFrame, x: str) -> DataFrame:
        names = {"_class": x, "_comp": f"c{x}", "_size": f"{x}n", "_odd": f"{x}v", "_p": f"{x}p", "_left": f"{x}l"}
        return t.withColumnsRenamed({k: v for k, v in names.items() if k in t.columns}).drop("_least", "_units", "_df")

    small, large, total = F.least("an", "bn"), F.greatest("an", "bn"), F.col("an") + F.col("bn")
    needed = F.greatest(s * small, (s * total - (F.col("av") + F.col("bv")) * (large / small - s)) / (1 + s))
    share = needed - (total - F.col("ap") - F.col("bp")) / 2 - 1e-6
    met = side(placed, "a").join(side(placed, "b"), ["_centre", "_unit"]).filter((F.col("ca") < F.col("cb")) & (F.least("al", "bl") >= share))
    # those that need not share any
    near = rows.filter("_least <= 1e-6")
    near = side(near, "a").join(side(near, "b"), "_centre").filter((F.col("ca") < F.col("cb")) & (share <= 0))
    pair = [F.xxhash64("_centre").alias("place"), "a", "b", "ca", "cb"]
    return met.select(*pair).unionByName(near.select(*pair))


def _verified_together(pairs: DataFrame, sets: DataFrame, similarity: float, members: int = 512) -> DataFrame:
    """:func:`_verified` for many pairs among the classes of a place: a set moves once per place and block of
    ``members`` classes, not once per pair."""
    pairs, _ = counted(pairs)
    classes = pairs.select("place", F.col("a").alias("_class")).unionByName(pairs.select("place", F.col("b").alias("_class"))).distinct()
    blocks = classes.groupBy("place").agg(F.ceil(F.count("*") / members).alias("_blocks"))
    at = lambda c: F.pmod(F.xxhash64(c), F.col("_blocks"))
    keyed = pairs.join(blocks, "place").select("place", at("a").alias("i"), at("b").alias("j"), "a", "b", "ca", "cb")
    needed = keyed.select("place", "i", "j", F.col("a").alias("_class")).unionByName(keyed.select("place", "i", "j", F.col("b").alias("_class"))).distinct()

    def run(left, right):
        held = {k: (np.frombuffer(n, dtype=U64), c) for k, n, c in zip(right["_class"], right["_names"], right["_counts"])}
        keep = []
        for a, b in zip(left["a"], left["b"]):
            (x, xc), (y, yc) = held.get(a, _NONE), held.get(b, _NONE)
            keep.append(min(len(x), len(y)) > 0 and probability_jaccard(x, _weights(x, xc), y, _weights(y, yc)) >= similarity)
        found = left[np.array(keep, dtype=bool)]
        return found[["ca", "cb"]].rename(columns={"ca": "a", "cb": "b"}).drop_duplicates()

    key = ["place", "i", "j"]
    held = needed.join(sets, "_class").select(*[F.col(k).alias(f"_{k}") for k in key], "_class", "_names", "_counts")
    return keyed.groupBy(*key).cogroup(held.groupBy(*[f"_{k}" for k in key])).applyInPandas(run, _LINK)


_NONE = (np.zeros(0, dtype=U64), b"")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, shingle: int = 5,
                bands: int = 25, rows: int = 5, leader_rounds: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id with the same words), group_id (smallest
    id of the group), group_size (rows of the group), kept (id is the group's; one of repeated rows)."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    signed = cut(_signed(src, "_id", "_text", bands, rows, shingle))
    classes, _ = counted(signed.groupBy("_class").agg(F.min("_id").alias("_rep"), F.count("*").alias("_rows"),
                                                      F.first("_any").alias("_any"), F.first("_bands").alias("_bands")))
    # buckets of two classes or more
    member = classes.filter("_any").select("_class", F.explode("_bands").alias("_key"))
    shared = member.groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1")
    member, _ = counted(member.join(shared, "_key"))
    sets = _sets(src, "_text", classes.join(member.select("_class").distinct(), "_class", "left_semi"), shingle)

    steps: list[DataFrame] = []
    open_, left = _leader_rounds(member.withColumn("_comp", F.col("_class")), steps, sets, similarity, leader_rounds, central=True)
    if left:
        # what band leaders did not join: the same by shared prefix shingles, then all pairs that remain
        prefix, _ = counted(_prefixes(open_.select("_class").distinct(), sets, similarity))
        named = prefix.join(open_.select("_class", "_comp").distinct(), "_class").withColumnsRenamed({"_name": "_key", "_df": "_n"})
        open_, left = _leader_rounds(_mixed(named)[0], steps, sets, similarity, 1, central=False)
        if left:
            apart, many = _apart(open_, sets, similarity)
            if many:
                steps.append(_moves(apart.filter("_linked and _comp <> _lead").select(F.col("_comp").alias("a"), F.col("_lead").alias("b"))))
                open_, _ = _mixed(_moved(open_, steps[-1]))
            pairs = _remaining_pairs(open_.withColumnRenamed("_key", "_name"), similarity)
            if many:
                pairs = pairs.unionByName(_apart_pairs(_moved(apart, steps[-1]), similarity))
                pairs = pairs.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in ("place", "ca", "cb")])
            steps.append(_moves(_verified_together(pairs, sets, similarity)))
    grouped = classes.select("_class", "_rep", "_rows", F.col("_class").alias("_comp"))
    for moves in steps:
        grouped = _moved(grouped, moves)
    grouped = cut(grouped)
    summary = grouped.groupBy("_comp").agg(F.min("_rep").alias("group_id"), F.sum("_rows").alias("group_size"))
    named = grouped.join(summary, "_comp").select("_class", F.col("_rep").alias("class_id"), "group_id", "group_size")
    return signed.select("_id", "_class").join(named, "_class").select(
        F.col("_id").alias(id_col), "class_id", "group_id", "group_size", F.col("_id").eqNullSafe(F.col("group_id")).alias("kept"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose id is their group's (rows that share an id stay or go together)."""
    kept = cut(near_groups(docs, id_col, text_col, **settings).filter("kept").select(F.col(id_col).alias("__id")))
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi").select(*docs.columns)
