"""Mixing sources to target weights by Sainte-Lague apportionment.

The wanted number of tokens is cut into equal blocks. Blocks are seats: each
goes to the source with the highest quotient ``target / (2 * seats + 1)``,
and a source's blocks go to its shards (hash pieces of a source, so that a
hot source is many tasks) in the same way by shard size, in two deals: to
about as many groups of shards as a group has shards, then inside each group,
so that no task ranks all shards of a source. Quotas are whole blocks per
shard; a source's last block is cut so that rounding does not move it from
its target.

A shard's documents, in a seeded order, form one stream of words cut into
blocks. A quota of more than the stream takes whole passes first; the rest
is a seeded choice of blocks (lowest hashes). A document takes what its
words have in the chosen blocks, so none is taken more often than the cap
allows.

Distributed plan: the documents are read once (size, source, shard key),
then only numbers move. Highest quotients are not drawn seat by seat: a
divisor that surely gives no source too many seats fixes all but about two
seats a source, and only those are ranked.

Edge cases: null text has size 0 and takes 0; a null source is a source of
its own, ordered last; an empty table gives an empty mix; repeated rows are
separate documents, numbered so that they spread over the shards; sources without words have target 0; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, cut

WORD = r"[^\x20\x09-\x0D]+"


def word_count(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, total: Column, cap: float, size: str = "size", weight: str = "weight") -> DataFrame:
    """Add ``target``: ``total`` shared by weight, no source above ``cap`` times its size,
    the excess reshared by weight until none is above.

    Sources in order of ``cap * size / weight`` reach their cap one after the other while the
    total rises, so the capped ones are a prefix of that order: running sums find it.
    """
    top = F.lit(float(cap)) * F.col(size)
    ratio = Window.orderBy(top / F.col(weight), F.col("position"))
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    d = sources.withColumn("_top", top).withColumn("_total", total)
    d = (d.withColumn("_spent", F.coalesce(F.sum("_top").over(before), F.lit(0.0)))
         .withColumn("_open", F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), F.lit(0.0))))
    # the level (words a unit of weight) if everything before this source is capped
    d = d.withColumn("_level", (F.col("_total") - F.col("_spent")) / F.col("_open"))
    d = d.withColumn("_capped", F.col("_top") <= F.col("_level") * F.col(weight))
    level = F.min(F.when(~F.col("_capped"), F.struct(F.col("_top") / F.col(weight), "position", "_level"))).over(whole)
    return (d.withColumn("_at", level.getField("_level"))
            .withColumn("target", F.when(F.col("_capped") | F.col("_at").isNull(), F.col("_top"))
                        .otherwise(F.least("_top", F.col("_at") * F.col(weight))))
            .drop("_top", "_total", "_spent", "_open", "_level", "_capped", "_at"))


def sainte_lague(df: DataFrame, share: str, seats: str, order: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """Add ``quota``: ``seats`` (equal for all rows of one ``within`` group) dealt by the highest
    quotients ``share / (2 k + 1)``, k = 0, 1, ...; ties go to the earlier row in ``order``.

    With T the sum of shares, S the seats and n the rows, a divisor of T / (S - n / 2) gives at most
    S seats and one of T / (S + n / 2) at least S, so only the seats between them are ranked. Groups
    meet in a window: rows of a group are sources or shards, about two candidate seats each.
    """
    key = [F.col(c) for c in within]
    group = Window.partitionBy(*key)
    d = df.withColumn("_t", F.sum(share).over(group)).withColumn("_n", F.count("*").over(group))
    few, many = F.col(seats) - F.col("_n") / 2, F.col(seats) + F.col("_n") / 2
    per = F.when(F.col("_t") > 0, F.col(share) / F.col("_t")).otherwise(0.0)
    d = (d.withColumn("_sure", F.greatest(F.lit(0), F.floor(per * few + 0.5) - 1).cast("long"))
         .withColumn("_most", F.greatest(F.col("_sure"), F.floor(per * many + 0.5).cast("long") + 1)))
    d = d.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
    seat = d.filter(F.col(share) > 0).select("*", F.explode(F.sequence("_sure", "_most")).alias("_k"))
    best = Window.partitionBy(*key).orderBy((F.col(share) / (2 * F.col("_k") + 1)).desc(), *order)
    won = (seat.withColumn("_rank", F.row_number().over(best)).filter("_rank <= _left")
           .groupBy(*within, *order).agg(F.count("*").alias("_won")))
    on = None
    w = won
    for c in dict.fromkeys([*within, *order]):
        w = w.withColumnRenamed(c, f"_w_{c}")
        e = F.col(c).eqNullSafe(F.col(f"_w_{c}"))
        on = e if on is None else on & e
    return (d.join(w, on, "left").withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
            .drop("_t", "_n", "_sure", "_most", "_left", "_won", *[c for c in w.columns if c.startswith("_w_")]))


def _numbered(rows: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """One row for each of a row's ``_copies``, numbered by ``_copy`` from 0. Rows of more than ``chunk``
    copies are dealt to many tasks first, ``chunk`` copies at a time."""
    chunks = F.floor((F.col("_copies") - 1) / chunk)
    first = rows.withColumn("_chunk", F.lit(0).cast("long"))
    many = rows.filter(chunks > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(1).cast("long"), chunks)))
    each = first.unionByName(many.repartition("_key", "_chunk"))
    last = F.least(F.col("_copies") - 1, (F.col("_chunk") + 1) * chunk - 1)
    return each.withColumn("_copy", F.explode(F.sequence(F.col("_chunk") * chunk, last))).drop("_chunk")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: int = 2, block: int = 32,
        shard_words: int = 1 << 18, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken, n_blocks (chosen blocks its
    words are in), passes (whole ones) and ranges (words taken besides, as at and words), _key.

    ``weights`` repeat over the sources in code point order (null last);
    ``share`` times all words are wanted; ``cap`` bounds how often a source
    and a document are used; ``block`` tokens is the apportioned unit;
    ``shard_words`` the aimed size of a shard.
    """
    base = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(text_col).alias("_size"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("_key"))
    # rows that repeat id and text are counted first and numbered later
    base = cut(base.groupBy("_id", "_source", "_size", "_key").agg(F.count("*").alias("_copies")))

    sources = base.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_copies")).alias("size"))
    by_code = Window.orderBy(F.col("_source").cast("binary").asc_nulls_last())
    sources = sources.withColumn("position", F.row_number().over(by_code) - 1)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(listed, (F.col("position") % len(weights) + 1).cast("int")))
    every = Window.partitionBy()
    sources = targets(sources, F.lit(float(share)) * F.sum("size").over(every), cap)
    sources = sources.withColumn("_seats", F.round(F.sum("target").over(every) / block).cast("long"))
    sources = cut(sainte_lague(sources, "target", "_seats", ["position"])
                  .withColumn("_words", F.round("target").cast("long"))
                  .withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("size") / shard_words)).cast("long"))
                  .select(F.col("_source").alias("_of"), "position", F.col("size").alias("source_size"), "target",
                          "quota", "_words", "_shards"))

    rows = base.join(sources, F.col("_source").eqNullSafe(F.col("_of"))).select(
        "_id", "_size", "_key", "_copies", "position", "source_size", "target", "_shards")
    rows = _numbered(rows)
    place = F.when(F.col("_copy") == 0, F.col("_key")).otherwise(F.xxhash64("_key", "_copy"))
    rows = rows.withColumn("_place", place).withColumn("_shard", F.pmod("_place", "_shards")).drop("_copies", "_copy", "_shards")
    rows = cut(rows)

    shards = rows.groupBy("position", "_shard").agg(F.sum("_size").alias("_stream"))
    shards = shards.join(sources.select("position", F.col("quota").alias("_seats"), "_words", "_shards",
                                        (F.col("_words") >= F.lit(cap) * F.col("source_size")).alias("_full")), "position")
    shards = shards.withColumn("_group", F.col("_shard") % F.ceil(F.sqrt("_shards"))).drop("_shards")
    # the closing block: the source's largest shard absorbs what rounding to blocks moved
    largest = shards.groupBy("position").agg(F.max(F.struct("_stream", (-F.col("_shard")).alias("_minus"))).alias("_largest"))
    shards = cut(shards.join(largest, "position").withColumn(
        "_close", F.when(F.col("_shard") == -F.col("_largest._minus"), F.col("_words") - F.col("_seats") * block).otherwise(0)).drop("_largest"))
    groups = shards.groupBy("position", "_group", "_seats").agg(F.sum("_stream").alias("_mass"))
    groups = sainte_lague(groups, "_mass", "_seats", ["_group"], ("position",)).select("position", "_group", F.col("quota").alias("_dealt"))
    shards = sainte_lague(shards.join(groups, ["position", "_group"]), "_stream", "_dealt", ["_shard"], ("position", "_group"))
    # a source at its cap takes all it has as often as it may, whatever the blocks
    top = F.lit(cap) * F.col("_stream")
    wanted = F.when(F.col("_full"), top).otherwise(F.least(top, F.greatest(F.lit(0), F.col("quota") * block + F.col("_close"))))
    shards = shards.filter("_stream > 0").withColumn("_want", wanted)
    shards = cut(shards.select("position", "_shard", "_stream", F.floor(F.col("_want") / F.col("_stream")).alias("_passes"),
                               (F.col("_want") % F.col("_stream")).alias("_rest")))

    # seeded choice of blocks: lowest hashes first, until the rest of the quota is filled
    b = F.lit(block)
    blocks = shards.filter("_rest > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_stream") - 1) / b))).alias("_block"))
    blocks = blocks.withColumn("_tokens", F.least(b, F.col("_stream") - F.col("_block") * b))
    drawn = Window.partitionBy("position", "_shard").orderBy(F.xxhash64("position", "_shard", "_block", F.lit(seed)), "_block")
    blocks = blocks.withColumn("_before", F.sum("_tokens").over(drawn.rowsBetween(Window.unboundedPreceding, -1)))
    blocks = blocks.withColumn("_take", F.least("_tokens", F.col("_rest") - F.coalesce("_before", F.lit(0)))).filter("_take > 0")
    blocks = blocks.select("position", "_shard", "_block", "_take")

    order = Window.partitionBy("position", "_shard").orderBy("_place", "_id", "_size")
    placed = rows.withColumn("_stop", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("_start", F.col("_stop") - F.col("_size"))
    pieces = placed.filter("_size > 0").select(
        "position", "_shard", "_start", "_stop",
        F.explode(F.sequence(F.floor(F.col("_start") / b), F.floor((F.col("_stop") - 1) / b))).alias("_block"))
    # a partly taken block gives its first words
    hit = pieces.join(blocks, ["position", "_shard", "_block"])
    part = F.least("_stop", F.col("_block") * b + F.col("_take")) - F.greatest("_start", F.col("_block") * b)
    # the words taken of the last pass, as ranges of the document's words
    lo = F.greatest("_start", F.col("_block") * b) - F.col("_start")
    hit = hit.select("position", "_shard", "_start", lo.alias("_lo"), F.greatest(F.lit(0), part).alias("_n"))
    got = hit.filter("_n > 0").groupBy("position", "_shard", "_start").agg(
        F.sum("_n").alias("_part"), F.count("*").alias("n_blocks"),
        F.array_sort(F.collect_list(F.struct(F.col("_lo").alias("at"), F.col("_n").alias("words")))).alias("_ranges"))
    full = shards.select("position", "_shard", "_passes")
    out = (placed.join(full, ["position", "_shard"], "left")
           .join(got.withColumn("_some", F.lit(True)), ["position", "_shard", "_start"], "left"))
    some = F.col("_size") > 0                            # rows without words share a start with others
    return out.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target",
        F.when(some, F.col("_size") * F.coalesce("_passes", F.lit(0)) + F.coalesce("_part", F.lit(0)))
        .otherwise(0).cast("long").alias("taken"),
        F.when(some, F.coalesce("n_blocks", F.lit(0))).otherwise(0).cast("long").alias("n_blocks"),
        F.when(some, F.coalesce("_passes", F.lit(0))).otherwise(0).cast("long").alias("passes"),
        F.when(some, F.col("_ranges")).alias("ranges"), "_key")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole pass over a document and
    one with the words taken of it besides. Documents without taken words go; rows that repeat id
    and text are treated alike."""
    seed = settings.get("seed", 17)
    plan = mix(docs, id_col, text_col, **settings).filter("taken > 0")
    plan = plan.groupBy(F.col(id_col).alias("__id"), F.col("_key").alias("__key")).agg(F.max(F.struct("passes", "ranges")).alias("__plan"))
    key = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))
    joined = docs.withColumn("__own", key).join(plan, (F.col("__own") == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id")))
    copies = F.transform(F.sequence(F.lit(1), F.col("__plan.passes").cast("int")), lambda _: F.lit(None).cast(plan.schema["__plan"].dataType["ranges"].dataType))
    copies = F.when(F.col("__plan.passes") > 0, copies).otherwise(F.slice(copies, 1, 0))
    rest = F.when(F.col("__plan.ranges").isNotNull(), F.array("__plan.ranges")).otherwise(F.slice(copies, 1, 0))
    joined = joined.withColumn("__part", F.explode(F.concat(copies, rest)))
    words = F.regexp_extract_all(F.col(text_col), F.lit(SPACE_CLASS + "*" + WORD), F.lit(0))
    # bound as the one element of a list, the words are cut once a row and not once a range
    some = F.transform(F.array(words), lambda w: F.array_join(F.transform("__part", lambda r: F.ltrim(F.array_join(
        F.slice(w, (r.at + 1).cast("int"), r.words.cast("int")), ""))), "\n"))[0]
    out = joined.withColumn(text_col, F.when(F.col("__part").isNull(), F.col(text_col)).otherwise(some))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__part").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
