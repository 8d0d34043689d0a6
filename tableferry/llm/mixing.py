"""Mixing sources to target weights, block by block.

The words of a source, in a fixed order of its documents, are packed into blocks
of fixed length. Every output shard draws how many blocks it takes of each source
(the whole part of the expectation, and a multinomial draw of the remainders); the
n-th slot of a source is mapped through the source's pseudorandom permutation of
block numbers, one per pass over the source, and joined with the block. Only
DataFrame functions are used. Hashes are MD5, so that reruns and other engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tableferry.llm.components import stored

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
SHARD_BLOCKS = 16384
#: Slots that one task makes of its shards' counts, and the most tasks this may ask for.
TASK_SLOTS, MOST_TASKS = 50_000, 20_000
#: Multipliers of the permutations: the first that does not divide the number of blocks serves.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)


def _hashed(*parts: Column) -> Column:
    """A whole number below 2^52 from the MD5 of the parts."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def sized(documents: DataFrame) -> DataFrame:
    """``(doc_id, src, source, size)``; ``src`` is the source as a text that is never null."""
    return documents.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("src"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: size, target, number of blocks and of slots to fill.

    Sources stop at ``most`` times their size; taking them by rising size for their
    weight, the excess of those before is shared among those after. The table has a
    row per source name, so its windows hold names, not documents.
    """
    each = sizes.groupBy("src", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = W.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = each.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast("bigint"))
    rising = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    rest = rising.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(rest)
    # Sharing rises while sources stop and falls after the first that does not: the greatest is the one that holds.
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least((F.col("source_size") * most).cast("double"), F.col("level") * F.col("weight")))
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn(
            "slots",
            F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0),
        )
        .select("src", "source", "source_size", "docs", "target", "blocks", "slots")
    )


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the number of words of their source before them.

    Documents of a source are dealt over as many buckets as the root of their
    number; sums over buckets, then within them, keep every window small.
    """
    dealt = (
        sizes.where("size > 0")
        .join(sources.select("src", "docs"), "src")
        .withColumn("bucket", _hashed(F.coalesce("doc_id", F.lit(0))) % F.ceil(F.sqrt("docs")))
        .drop("docs")
    )
    before = W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = dealt.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = W.partitionBy("src", "bucket").orderBy("doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return dealt.join(sums, ["src", "bucket"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    ).select("doc_id", "src", "source", "size", "start")


def drawn(spark: SparkSession, sources: DataFrame, most: int = MOST, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """``(shard, src, slot, pass, block)``: one row per block of the mix.

    ``slot`` counts the blocks taken of a source over all shards. Slots beyond
    ``most`` passes over a source, which a draw may rarely give, stay empty.
    """
    open_ = sources.where("blocks > 0")
    total = open_.agg(F.sum("slots"), F.count("*")).first()
    shards = max(1, round((total[0] or 0) / shard_blocks))
    open_ = open_.withColumn("whole", F.floor(F.col("slots") / shards)).withColumn(
        "part", F.col("slots") / shards - F.col("whole")
    )
    by_name = W.orderBy("src")
    ranges = open_.select(
        "src",
        F.coalesce(F.sum("part").over(by_name.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("low"),
        F.sum("part").over(by_name).alias("high"),
    )
    rest = open_.agg(F.sum("part")).first()[0] or 0.0
    # Draws meet the sources' ranges by cells of equal width, several for each source.
    cells = 4 * total[1] + 64
    width = (rest or 1.0) / cells
    cell = lambda x: F.least(F.floor(x / width), F.lit(cells - 1))
    ranges = ranges.where("high > low").withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    draws = (
        spark.range(shards)
        .select(
            F.col("id").alias("shard"),
            F.explode(
                F.expr(
                    f"filter(sequence(cast(floor(id * {rest!r}D) as bigint), cast(floor((id + 1) * {rest!r}D) as bigint)),"
                    f" x -> x < floor((id + 1) * {rest!r}D))"
                )
            ).alias("draw"),
        )
        .withColumn("at", _hashed(F.lit("draw"), F.col("draw")) / float(1 << 52) * rest)
        .withColumn("cell", cell(F.col("at")))
        .join(ranges.hint("merge"), "cell")
        .where("low <= at and at < high")
        .groupBy("src", "shard")
        .agg(F.count("*").alias("extra"))
    )
    counts = (
        open_.select("src", "blocks", "whole", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"))
        # Planning takes what comes of few sources for small; these rows grow with the words, so nothing is broadcast.
        .join(draws.hint("merge"), ["src", "shard"], "left")
        .withColumn("count", F.col("whole") + F.coalesce("extra", F.lit(0)))
    )
    before = W.partitionBy("src").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    tasks = min(MOST_TASKS, max(1, -(-int(total[0] or 0) // TASK_SLOTS)))
    slots = (
        counts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .where("count > 0")
        # A window over a source's shards is one task; what they are made into is dealt out first.
        .repartition(tasks, "src", "shard")
        .withColumn("slot", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("count") - 1)))
        .where(F.col("slot") < most * F.col("blocks"))
        .withColumn("pass", F.floor(F.col("slot") / F.col("blocks")))
    )
    fits = F.expr(f"filter(array({', '.join(f'{p}L' for p in PRIMES)}), p -> blocks = 1 or p % blocks <> 0)")
    step = F.element_at(fits, (_hashed(F.col("src"), F.col("pass"), F.lit("a")) % F.size(fits) + 1).cast("int"))
    shift = _hashed(F.col("src"), F.col("pass"), F.lit("b")) % F.col("blocks")
    product = (step % F.col("blocks")).cast("decimal(18,0)") * (F.col("slot") % F.col("blocks")).cast("decimal(18,0)")
    return slots.select(
        "shard", "src", "slot", "pass", ((product + shift) % F.col("blocks")).cast("bigint").alias("block")
    )


def pieces(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` from :func:`placed` cut at block borders: block number, first word in the source, words."""
    blocks = F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))
    cut = documents.withColumn("block", F.explode(blocks))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.withColumn("first_word", low - F.col("start")).withColumn("words", high - low)


def mix_blocks(spark: SparkSession, documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: ``(shard, slot, source, doc_id, first_word, words)``, a row per piece of a slot's block."""
    sizes = stored(spark, sized(documents), "sizes")
    sources = stored(spark, source_targets(sizes, block_words=block_words), "sources")
    cut = pieces(placed(sizes, sources), block_words)
    return drawn(spark, sources).hint("merge").join(cut, ["src", "block"]).select(
        "shard", "slot", "source", "doc_id", "first_word", "words"
    )


def mix_report(
    spark: SparkSession, documents: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS
) -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken)`` per row of documents.

    Null and blank texts have size 0 and give nothing. A null source is a source
    of its own, the last. A source without words has target 0. Repeated rows are
    documents of their own; no rows give no rows.
    """
    sizes = stored(spark, sized(documents), "sizes")
    sources = stored(spark, source_targets(sizes, block_words=block_words), "sources")
    used = drawn(spark, sources, shard_blocks=shard_blocks).groupBy("src", "block").agg(F.count("*").alias("uses"))
    took = (
        pieces(placed(sizes, sources), block_words)
        .join(used.hint("merge"), ["src", "block"], "left")
        .groupBy("src", "start", "doc_id", "size")
        .agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
        .select("doc_id", "src", "size", "taken")
    )
    rows = took.unionByName(
        sizes.where("size = 0").select("doc_id", "src", "size", F.lit(0).cast("bigint").alias("taken"))
    )
    return rows.join(sources.select("src", "source", "source_size", "target"), "src").select(
        "doc_id", "size", "source", "source_size", "target", "taken"
    )


ORACLE = r"""
with sizes as (
    select doc_id, coalesce('=' || source, '') as src, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
    from documents),
named as (
    select src, source, sum(size)::bigint as source_size, count(*) as docs from sizes group by src, source),
weighed as (
    select *, ([5, 2, 1])[((row_number() over (order by source is null, source) - 1) % 3 + 1)::bigint]::bigint as weight from named),
levelled as (
    select *,
        (sum(source_size) over () - 3 * coalesce(sum(source_size) over (
            order by source_size / weight, source is null, source rows between unbounded preceding and 1 preceding), 0))::double
        / (sum(weight) over (order by source_size / weight, source is null, source rows between current row and unbounded following))::double as level
    from weighed),
aimed as (
    select *, least((source_size * 3)::double, (max(level) over ()) * weight) as target from levelled),
sources as (
    select *, ceil(source_size / 64)::bigint as blocks,
        case when source_size > 0 then target * ceil(source_size / 64)::bigint / source_size else 0e0 end as slots
    from aimed),
shape as (select greatest(1, round_even(coalesce(sum(slots), 0) / 16384, 0))::bigint as shards from sources where blocks > 0),
opened as (
    select src, blocks, shards, floor(slots / shards)::bigint as whole, slots / shards - floor(slots / shards) as part
    from sources, shape where blocks > 0),
ranges as (
    select src, coalesce(sum(part) over (order by src rows between unbounded preceding and 1 preceding), 0e0) as low,
        sum(part) over (order by src rows between unbounded preceding and current row) as high from opened),
rest as (select max(high) as rest from ranges),
draws as (
    select shard, unnest(range(floor(shard * rest)::bigint, floor((shard + 1) * rest)::bigint)) as draw, rest
    from (select unnest(range(shards)) as shard from shape), rest),
placed_draws as (
    select shard, ('0x' || substr(md5('draw:' || draw), 1, 13))::bigint / 4503599627370496e0 * rest as place from draws),
extras as (
    select src, shard, count(*) as extra from placed_draws join ranges on low <= place and place < high group by src, shard),
counts as (
    select o.src, o.blocks, s.shard, o.whole + coalesce(e.extra, 0) as n
    from opened o cross join (select unnest(range(shards)) as shard from shape) s
    left join extras e on e.src = o.src and e.shard = s.shard),
based as (
    select *, coalesce(sum(n) over (partition by src order by shard rows between unbounded preceding and 1 preceding), 0)::bigint as base
    from counts),
slots as (select src, blocks, unnest(range(base, base + n)) as slot from based where n > 0),
passed as (
    select *, slot // blocks as pass,
        list_filter([2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497], lambda p: blocks = 1 or p % blocks <> 0) as fits
    from slots where slot < 3 * blocks),
mapped as (
    select src, ((fits[('0x' || substr(md5(src || ':' || pass || ':a'), 1, 13))::bigint % len(fits) + 1] % blocks)::hugeint * (slot % blocks)
        + ('0x' || substr(md5(src || ':' || pass || ':b'), 1, 13))::bigint % blocks) % blocks as block from passed),
used as (select src, block, count(*) as uses from mapped group by src, block),
dealt as (
    select s.doc_id, s.src, s.size, ('0x' || substr(md5(coalesce(s.doc_id, 0)::varchar), 1, 13))::bigint % ceil(sqrt(n.docs))::bigint as bucket
    from sizes s join named n on n.src = s.src where size > 0),
placed as (
    select *, coalesce(sum(size) over (
        partition by src order by bucket, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0)::bigint as start from dealt),
cut as (
    select *, unnest(range(start // 64, (start + size - 1) // 64 + 1)) as block from placed),
took as (
    select c.doc_id, c.src, c.size, c.start,
        sum((least(c.start + c.size, (c.block + 1) * 64) - greatest(c.start, c.block * 64)) * coalesce(u.uses, 0))::bigint as taken
    from cut c left join used u on u.src = c.src and u.block = c.block group by all)
select r.doc_id, r.size, s.source, s.source_size, s.target, r.taken
from (select doc_id, src, size, taken from took
    union all select doc_id, src, size, 0 from sizes where size = 0) r join sources s on s.src = r.src
"""
