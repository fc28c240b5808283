"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target number of words, by weight and limited by how often
its words may repeat. Whole passes over a source and a part of one more pass
make up the target. Documents are cut into blocks of words; each pass over a
source has its own permutation of the source's blocks, and the last pass takes
its first blocks, the last of them cut so that the target is met to the word.

A tree deals the taken blocks out to shards. Its root holds how many blocks
each source gives; a node with several shards splits these quotas between its
halves by a multivariate hypergeometric draw, as if all blocks were shuffled
and cut in two. A leaf's quotas are exact. Each shard then draws its quota of
every source as a range of the permuted blocks, disjoint from the others', and
is shuffled by itself.

Only DataFrame functions are used. Positions in a permutation come from totals
over 4,096 hash buckets and a window in each bucket, so no source is sorted in
one task. Tables of a row per source, or of a source and shard, are planned in
single windows: their sizes depend on the mix and not on the documents.

Cases: a null text has no words and is never taken; a null source is a source
of its own and comes last; null and repeated doc_ids are separate rows. Without
documents the mix is empty. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadwarden.llm.rows import BLANKS, ROW_ID, WORD, join_side, packed, row_id, stored, unpacked

BLOCK_WORDS = 1024
SHARDS = 16
#: Words that a task orders and writes; a shard of more is written as several ranges of its order.
RANGE_WORDS = 1 << 20
MAX_REPEATS = 3
SEED = 17
#: The last sources or shards that a plan may have to be broadcast; a row of it has some 100 bytes.
BROADCAST_ROWS = 100_000
#: Standard deviations around its mode within which a hypergeometric count is drawn.
REACH = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """Each document with a row number and its number of words, stored."""
    return stored(
        docs.select(
            row_id().alias(ROW_ID),
            F.col("doc_id"),
            F.col("source"),
            word_count(F.col("text")).alias("size"),
        ),
        "sizes",
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: its weight, size in words and target.

    Weights go round over the sources in code point order. A target is at most
    ``max_repeats`` times the source's size; what is cut off there is shared
    among the others by weight. That is the level at which sources, filled in
    the order of limit by weight, use up all words.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights are positive numbers")
    if max_repeats < 1:
        raise ValueError("a mix as large as its sources needs max_repeats of 1 at least")
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    filling = W.orderBy("_limit_by_weight", "source_no")
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn(
            "weight",
            F.element_at(
                F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int")
            ),
        )
        .withColumn("_limit", F.col("source_size") * max_repeats)
        .withColumn("_limit_by_weight", F.col("_limit") / F.col("weight"))
    )
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(W.partitionBy()) - F.coalesce(
        F.sum("_limit").over(before), F.lit(0)
    )
    weight_left = F.sum("weight").over(W.partitionBy()) - F.coalesce(
        F.sum("weight").over(before), F.lit(0)
    )
    levels = sources.withColumn("_level", left / weight_left).withColumn(
        "_place", F.row_number().over(filling)
    )
    level = F.min_by(
        F.when(F.col("_limit_by_weight") >= F.col("_level"), F.col("_level")),
        F.when(F.col("_limit_by_weight") >= F.col("_level"), F.col("_place")),
    ).over(W.partitionBy())
    return levels.select(
        "source_no",
        "source",
        "weight",
        "source_size",
        F.least(F.col("_limit").cast("double"), F.col("weight") * level).alias("target"),
    )


def mix_blocks(
    sizes: DataFrame,
    targets: DataFrame,
    *,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """The blocks that the mix takes, each with its shard and its place there, ``position``.

    ``sizes`` is a result of ``measured``, ``targets`` one of ``source_targets``. A row is
    one block in one pass over its source: ``start`` is its first word in the document,
    ``words`` how many words of it are taken.
    """
    placed = _dealt(sizes, targets, block_words, shards, seed)
    within = W.partitionBy("shard").orderBy("_place", ROW_ID, "pass", "block")
    return placed.withColumn("position", F.row_number().over(within) - 1).drop("_place")


def _dealt(sizes: DataFrame, targets: DataFrame, block_words: int, shards: int, seed: int) -> DataFrame:
    """The blocks with their shards; ``_place`` is a hash that gives their order there."""
    if block_words < 1 or shards < 1:
        raise ValueError("block_words and shards are 1 at least")
    passes = targets.select(
        "source_no",
        "source",
        "source_size",
        F.floor(F.col("target") + 0.5).alias("_take"),
    ).withColumn("_whole", F.expr("if(source_size = 0, 0, _take div source_size)"))
    passes = passes.withColumn("_rest", F.col("_take") - F.col("_whole") * F.col("source_size"))
    n_sources = targets.count()
    small = F.broadcast if n_sources <= BROADCAST_ROWS else (lambda df: df)
    known = small(passes.withColumnRenamed("source", "_source"))
    blocks = (
        sizes.where("size > 0")
        .join(known, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("pass", F.explode(F.expr("sequence(0, _whole - if(_rest > 0, 0, 1))")))
        .where("pass >= 0 and pass < _whole + if(_rest > 0, 1, 0)")
        .withColumn("block", F.explode(F.expr(f"sequence(0, (size - 1) div {block_words})")))
        .select(
            ROW_ID,
            "doc_id",
            "source_no",
            "pass",
            "block",
            F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words).alias("_has"),
            F.when(F.col("pass") < F.col("_whole"), F.col("source_size"))
            .otherwise(F.col("_rest"))
            .alias("_limit"),
            F.md5(_key(seed, "pass")).alias("_order"),
        )
        .withColumn("_bucket", F.substring("_order", 1, 3))
    )
    drawn = stored(_drawn(blocks, block_words), "drawn")
    leaves = stored(_leaves(_quotas(drawn, n_sources), shards, seed), "quotas")
    starts = (
        leaves.withColumn(
            "_start",
            F.sum("_quota").over(W.partitionBy("source_no").orderBy("shard")) - F.col("_quota"),
        )
        .groupBy("source_no")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "_start"))), lambda x: x["_start"]).alias("_starts"))
    )
    starts = small(starts) if n_sources * shards <= BROADCAST_ROWS * 10 else starts
    placed = drawn.join(starts, "source_no").withColumn(
        "shard", F.size(F.filter("_starts", lambda start: start <= F.col("_rank"))) - 1
    )
    return placed.select(
        ROW_ID,
        "doc_id",
        "source_no",
        "pass",
        "block",
        (F.col("block") * block_words).alias("start"),
        "words",
        "shard",
        F.md5(_key(seed, "shard")).alias("_place"),
    )


def _key(seed: int, use: str) -> Column:
    return F.concat_ws(
        "|",
        F.lit(f"{seed}|{use}"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.col("pass").cast("string"),
        F.col("block").cast("string"),
    )


def _drawn(blocks: DataFrame, block_words: int) -> DataFrame:
    """The blocks before each pass's limit, with their rank among those their source gives."""
    bucket = ["source_no", "pass", "_bucket"]
    before = W.partitionBy("source_no", "pass").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # A pass has all blocks of its source, so the passes before have as many each.
    totals = (
        blocks.groupBy(*bucket)
        .agg(F.sum("_has").alias("_bucket_words"), F.count(F.lit(1)).alias("_bucket_blocks"))
        .select(
            *bucket,
            F.coalesce(F.sum("_bucket_words").over(before), F.lit(0)).alias("_words_before"),
            (
                F.coalesce(F.sum("_bucket_blocks").over(before), F.lit(0))
                + F.col("pass") * F.sum("_bucket_blocks").over(W.partitionBy("source_no", "pass"))
            ).alias("_blocks_before"),
        )
    )
    within = W.partitionBy(*bucket).orderBy("_order", "_has", ROW_ID, "block")
    so_far = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        blocks.withColumn("_so_far", F.sum("_has").over(so_far))
        .withColumn("_place", F.row_number().over(within))
        .join(totals, bucket)
        .withColumn("_first", F.col("_words_before") + F.col("_so_far") - F.col("_has"))
        .where("_first < _limit")
        .select(
            ROW_ID,
            "doc_id",
            "source_no",
            "pass",
            "block",
            F.least(F.col("_has"), F.col("_limit") - F.col("_first")).alias("words"),
            (F.col("_blocks_before") + F.col("_place") - 1).alias("_rank"),
        )
    )


def _quotas(drawn: DataFrame, n_sources: int) -> DataFrame:
    """One row: how many blocks each source gives, in the order of source_no."""
    counted = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("n"))
    every = drawn.sparkSession.range(n_sources).select(F.col("id").cast("int").alias("source_no"))
    return (
        every.join(counted, "source_no", "left")
        .groupBy()
        .agg(F.sort_array(F.collect_list(F.struct("source_no", F.coalesce("n", F.lit(0)).alias("n")))).alias("_q"))
        .select(F.transform("_q", lambda x: x["n"]).alias("_quotas"))
    )


def _leaves(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """The quota of each source in each shard."""
    nodes = quotas.select(F.lit(0).alias("_from"), F.lit(shards).alias("_to"), "_quotas")
    width = shards
    while width > 1:
        nodes = _split(nodes, seed)
        width = -(-width // 2)
    return nodes.select(F.col("_from").alias("shard"), F.posexplode("_quotas").alias("source_no", "_quota"))


def _split(nodes: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: every node of several shards becomes two."""
    middle = F.expr("_from + (_to - _from) div 2")
    total = F.aggregate("_quotas", F.lit(0).cast("long"), lambda a, x: a + x)
    share = F.expr("(_to - _from) div 2")
    nodes = nodes.withColumn("_total", total).withColumn(
        "_left_n", F.floor(F.col("_total") * share / (F.col("_to") - F.col("_from"))).cast("long")
    )
    start = F.struct(
        F.col("_total").alias("all"),
        F.col("_left_n").alias("n"),
        F.array().cast("array<bigint>").alias("left"),
    )

    def draw(state: Column, quota: Column) -> Column:
        uniform = (
            F.shiftrightunsigned(
                F.xxhash64(F.lit(seed), F.col("_from"), F.col("_to"), F.size(state["left"])), 11
            )
            / F.lit(2.0**53)
        )
        count = hypergeometric(quota, state["all"], state["n"], uniform)
        return F.struct(
            (state["all"] - quota).alias("all"),
            (state["n"] - count).alias("n"),
            F.concat(state["left"], F.array(count)).alias("left"),
        )

    def node(begin: Column, end: Column, quotas: Column) -> Column:
        return F.struct(begin.alias("f"), end.alias("t"), quotas.alias("q"))

    halves = _let(
        F.aggregate("_quotas", start, draw, lambda state: state["left"]),
        lambda left: F.array(
            node(F.col("_from"), middle, left),
            node(middle, F.col("_to"), F.zip_with("_quotas", left, lambda a, b: a - b)),
        ),
    )
    whole = F.array(node(F.col("_from"), F.col("_to"), F.col("_quotas")))
    return nodes.select(
        F.explode(F.when(F.col("_to") - F.col("_from") > 1, halves).otherwise(whole)).alias("h")
    ).select(F.col("h.f").alias("_from"), F.col("h.t").alias("_to"), F.col("h.q").alias("_quotas"))


def _let(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), function), 1)


def hypergeometric(marked: Column, total: Column, n: Column, uniform: Column) -> Column:
    """How many of ``n`` drawn out of ``total`` without replacement are among the ``marked``.

    The inverse of the distribution at ``uniform``, its values taken from the mode upwards
    and then downwards, each weighed against the mode by the ratio to its neighbour. Values
    over ``REACH`` standard deviations (and 20) from the mode, with a probability below
    1e-20 in all, are not drawn.
    """
    given = F.struct(
        marked.cast("double").alias("marked"),
        total.cast("double").alias("total"),
        n.cast("double").alias("n"),
        uniform.alias("uniform"),
    )

    def range_of(p: Column) -> Column:
        k, t, m = p["marked"], p["total"], p["n"]
        low, high = F.greatest(F.lit(0.0), m - (t - k)), F.least(m, k)
        share = k / F.greatest(t, F.lit(1.0))
        mode = F.floor((m + 1) * (k + 1) / (t + 2)).cast("double")
        return F.struct(
            *(p[x].alias(x) for x in ("marked", "total", "n", "uniform")),
            low.alias("low"),
            high.alias("high"),
            F.least(high, F.greatest(low, mode)).alias("mode"),
            F.ceil(F.sqrt(m * share * (1 - share)) * REACH + 20).cast("double").alias("reach"),
        )

    def steps(length: Column) -> Column:
        return F.when(length >= 1, F.sequence(F.lit(1), length.cast("int"))).otherwise(
            F.array().cast("array<int>")
        )

    def up(p: Column) -> Column:
        return steps(F.least(p["high"], p["mode"] + p["reach"]) - p["mode"])

    def down(p: Column) -> Column:
        return steps(p["mode"] - F.greatest(p["low"], p["mode"] - p["reach"]))

    def weight(p: Column, w: Column, i: Column, upwards: bool) -> Column:
        """That of the value ``i`` steps from the mode, out of that of the value before."""
        k, t, m = p["marked"], p["total"], p["n"]
        if upwards:
            x = p["mode"] + i
            return w * ((k - x + 1) * (m - x + 1)) / (x * (t - k - m + x))
        x = p["mode"] - i
        return w * ((x + 1) * (t - k - m + x + 1)) / ((k - x) * (m - x))

    def side(p: Column, upwards: bool) -> Column:
        """The sum of the weights on one side of the mode."""

        def one(s: Column, i: Column) -> Column:
            return _let(
                weight(p, s["w"], i, upwards),
                lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")),
            )

        begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(up(p) if upwards else down(p), begin, one, lambda s: s["sum"])

    def find(p: Column, upwards: bool, aim: Column) -> Column:
        """The value on one side at which the weights so far reach ``aim``, or null."""

        def one(s: Column, i: Column) -> Column:
            x = p["mode"] + i if upwards else p["mode"] - i
            return _let(
                weight(p, s["w"], i, upwards),
                lambda w: F.struct(
                    w.alias("w"),
                    (s["sum"] + w).alias("sum"),
                    F.when(s["at"].isNull() & (s["sum"] + w >= aim), x)
                    .otherwise(s["at"])
                    .alias("at"),
                ),
            )

        none = F.lit(None).cast("double")
        begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), none.alias("at"))
        return F.aggregate(up(p) if upwards else down(p), begin, one, lambda s: s["at"])

    def drawn(p: Column) -> Column:
        sums = F.struct(side(p, True).alias("above"), side(p, False).alias("below"))

        def at(s: Column) -> Column:
            return _let(
                p["uniform"] * (1 + s["above"] + s["below"]),
                lambda aim: F.when(aim <= 1, p["mode"])
                .when(aim <= 1 + s["above"], find(p, True, aim - 1))
                .otherwise(find(p, False, aim - 1 - s["above"])),
            )

        return F.coalesce(_let(sums, at), p["mode"]).cast("long")

    return _let(_let(given, range_of), drawn)


def taken_words(sizes: DataFrame, targets: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes."""
    taken = blocks.groupBy(ROW_ID).agg(F.sum("words").alias("taken"))
    small = F.broadcast if targets.count() <= BROADCAST_ROWS else (lambda df: df)
    known = small(targets.select(F.col("source").alias("_source"), "source_size", "target"))
    return (
        sizes.join(known, F.col("source").eqNullSafe(F.col("_source")))
        .join(taken, ROW_ID, "left")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mix_documents(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    *,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as documents: a row per taken block, with the columns of ``docs``.

    A block that is a whole document keeps its text as it is; another one has its own words
    with the blanks before each. ``n_chars``, where there, counts the row's own text. The rows
    of a shard are written in their shuffled order, by as many tasks as its words need, each with
    a range of it. A text is split into its blocks once, however many of them are taken.
    """
    kept = stored(packed(docs).withColumn("_size", word_count(F.col("doc.text"))), "mixed", "zstd")
    sizes = kept.select(ROW_ID, "doc.doc_id", "doc.source", F.col("_size").alias("size"))
    targets = stored(source_targets(sizes, weights, max_repeats), "targets")
    blocks = _dealt(sizes, targets, block_words, shards, seed)
    words = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    ranges = -(-words // (RANGE_WORDS * shards)) or 1
    place = F.conv(F.substring("_place", 1, 8), 16, 10).cast("long")
    taken = blocks.select(
        ROW_ID, "block", "words", "shard", "pass", "_place", F.floor(place * ranges / F.lit(1 << 32)).alias("_range")
    )
    blank_words = F.lit(f"{BLANKS}{WORD}")
    cut = _let(
        F.regexp_extract_all("doc.text", blank_words, F.lit(0)),
        lambda words: F.transform(
            F.expr(f"sequence(0L, (_size - 1) div {block_words})"),
            lambda b: F.array_join(F.slice(words, (b * block_words + 1).cast("int"), F.lit(block_words)), ""),
        ),
    )
    # A text of one block stays as it is, with the blanks at its end.
    parts = kept.where("_size > 0").select(
        ROW_ID,
        F.col("doc").withField("text", F.lit(None).cast(docs.schema["text"].dataType)).alias("doc"),
        F.posexplode(F.when(F.col("_size") > block_words, cut).otherwise(F.array("doc.text"))).alias("block", "_part"),
    )
    first_words = F.array_join(
        F.slice(F.regexp_extract_all("_part", blank_words, F.lit(0)), F.lit(1), F.col("words").cast("int")), ""
    )
    mixed = parts.join(join_side(taken), [ROW_ID, "block"]).withColumn(
        "_part", F.when(F.regexp_count("_part", F.lit(WORD)) > F.col("words"), first_words).otherwise(F.col("_part"))
    )
    new = {"text": F.col("_part"), "n_chars": F.length("_part")}
    order = ["shard", "_range", "_place", ROW_ID, "pass", "block"]
    ordered = mixed.repartition("shard", "_range").sortWithinPartitions(*order)
    return unpacked(ordered, docs, new)
