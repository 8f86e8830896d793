"""Mixing sources to target weights, in DataFrame expressions alone.

Every source is a stream of words: its documents one after the other, packed into blocks of fixed
length (the last one may be shorter). Targets: each source gets its weight's part of all words, but at most
``cap`` times its own; what is over is shared again by weight among the others, until none is above.

A source needs as many block slots as its target takes: whole passes over its blocks, and in one more pass as many
blocks as hold the rest. Output shards hold a fixed number of slots. For every slot of a shard a source is drawn, with the
needed slots as weights, so the sources' counts in a shard are multinomial. A source that was drawn too often gives the last
of its slots to sources drawn too rarely, in a fixed order, so each has exactly the slots it needs. A source's
slots are numbered through all shards; the number, taken modulo the source's blocks, goes through a pseudorandom
permutation of the block indices (another one for each pass over the source), and blocks are joined by source and
index. The block in which the target is reached is cut there. A document's share is the overlap of its words with
the drawn blocks.

Defined results: a null text has no words. A null source is a source of its own, ordered last. Rows are
never merged; rows that repeat follow one another in the stream. Of a target the whole words are taken. All draws are
hashes of indices, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.llm.common import WORD, numbered, pick, place
from fareflow.operators.joins import lookup
from fareflow.sources.tables import RunFolder

BLOCK = 64
SHARD_SLOTS = 4096
CHUNK_ROWS = 10_000
CHUNK_SLOTS = 20_000
WALK = 64
DRAWS_AT_ONCE = 250_000
ROUNDS = 4


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A permutation of 0 .. size - 1 (at most 2**50), chosen by ``key``.

    A Feistel network on pairs of digits, whose first base is the rounded-up root of ``size``. The few pairs
    that stand for numbers from ``size`` on are walked further until they lead below it.
    """
    wide = F.ceil(F.sqrt(size.cast("double")))
    high = F.ceil(size / wide)

    def once(x):
        left, right = F.floor(x / high), x % high
        for turn in range(ROUNDS):
            if turn % 2:
                right = (right + F.pmod(F.xxhash64(left, key, F.lit(turn)), high)) % high
            else:
                left = (left + F.pmod(F.xxhash64(right, key, F.lit(turn)), wide)) % wide
        return left * high + right

    first = once(index.cast("long"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda x, _: F.when(x >= size, once(x)).otherwise(x))
    # Fewer pairs than the root of the size stand for numbers from it on: up to WALK ** 2 the walk always ends in time, and
    # beyond it would need WALK steps of a chance below 1 / WALK each.
    return F.when(first < size, first).when(last < size, last).otherwise(
        F.raise_error(F.lit("the walk of a permutation did not end")).cast("long"))


def running_start(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, rows: str) -> DataFrame:
    """``df`` with _start: the sum of ``size`` over the rows before, by ``keys``.

    No key meets in one task: rows are cut into chunks by a hash of ``order``, in proportion to the
    key's ``rows``; chunks are summed first, and only their totals are run through per key.
    """
    cut = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.ceil(F.col(rows) / CHUNK_ROWS).cast("long")))
    totals = cut.groupBy(*keys, "_chunk").agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_c"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    same = F.expr(" AND ".join(["_chunk = _c", *(f"{k} = _k{i}" for i, k in enumerate(keys))]))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order, size).rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return ranked.join(starts, same).withColumn("_start", F.col("_first") + F.col("_inside")).drop(
        "_chunk", "_c", "_first", "_inside", *[f"_k{i}" for i in range(len(keys))])


def ranked(sources: DataFrame, run: RunFolder) -> DataFrame:
    """``sources`` with their place by code point, null last; sorted in ranges, never in one task."""
    ordered = sources.withColumn("_last", F.col("source").isNull()).repartitionByRange("_last", "source")
    parts = run.write("source_ranges", ordered.withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_part").orderBy("_last", "source")
    return parts.withColumn("_place", F.row_number().over(inside) - 1).join(first, "_part").withColumn(
        "place", F.col("_first") + F.col("_place")).drop("_part", "_place", "_first", "_last")


def with_targets(sources: DataFrame, cap: int) -> DataFrame:
    """``sources`` (source_size, weight) with target; one small aggregate a round finds what is left."""
    size, top = F.col("source_size"), F.col("source_size") * cap
    total, level = int(sources.agg(F.sum("source_size")).first()[0] or 0), 0.0
    while True:  # level: words for a unit of weight
        full = F.col("weight") * F.lit(level) >= top
        held, weight = sources.agg(F.sum(F.when(full, top)), F.sum(F.when(~full, F.col("weight")))).first()
        if not weight or (new := (total - int(held or 0)) / float(weight)) <= level:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), top).cast("double"))
        level = new


def source_table(sized: DataFrame, weights: Sequence[int], cap: int, run: RunFolder) -> DataFrame:
    """source, place, n_docs, source_size, weight, target, n_blocks: one row for each source of ``sized``."""
    sums = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    cycle = F.array(*map(F.lit, weights))
    placed = ranked(sums, run).withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    last = F.least("n_blocks", F.ceil(F.col("rest") / BLOCK) + 1)  # one to spare, since a shorter block may be among them
    return run.write("sources", with_targets(run.write("placed", placed), cap).withColumns({
        "n_blocks": F.ceil(F.col("source_size") / BLOCK), "passes": passes}).withColumn(
        "rest", F.floor("target") - F.col("passes") * F.col("source_size")).withColumn(
        "n_slots", F.col("passes") * F.col("n_blocks") + F.when(F.col("rest") > 0, last).otherwise(0)))


def drawn_counts(sources: DataFrame, run: RunFolder) -> DataFrame:
    """place, shard, n: how many slots of each shard were drawn for each source."""
    spark = sources.sparkSession
    needing = sources.where("n_slots > 0")
    n_sources, total = needing.agg(F.count(F.lit(1)), F.sum("n_slots")).first()
    # The sources lie side by side, each as wide as its slots; a draw falls on one of them. Both sides are cut
    # into cells, so that the look-up is a join by cell.
    width = max(1, -(-int(total or 0) // (4 * max(1, n_sources))))
    lots = running_start(needing.withColumns({"all": F.lit(0), "n": F.lit(n_sources)}), ["all"], ["place"], "n_slots", "n")
    end = F.col("_start") + F.col("n_slots")
    lots = lots.select("place", F.col("_start").alias("lo"), end.alias("hi"), F.explode(F.sequence(
        F.floor(F.col("_start") / width), F.floor((end - 1) / width))).alias("cell"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-int(total or 0) // DRAWS_AT_ONCE))
    draws = spark.range(0, int(total or 0), 1, tasks).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"),
        F.pmod(F.xxhash64("id"), F.lit(max(1, int(total or 0)))).alias("lot")).withColumn("cell", F.floor(F.col("lot") / width))
    return run.write("drawn", draws.join(lots, "cell").where("lo <= lot AND lot < hi").groupBy("place", "shard").agg(
        F.count(F.lit(1)).alias("n")))


def drawn_slots(sources: DataFrame, run: RunFolder) -> DataFrame:
    """place, slot, shard: for every source slots 0 to n_slots - 1, and the shards that they are in."""
    drawn = drawn_counts(sources, run)
    per_source = run.write("drawn_sums", sources.where("n_slots > 0").select("place", "n_slots").join(
        drawn.groupBy("place").agg(F.sum("n").alias("n_drawn"), F.count(F.lit(1)).alias("n_shards")), "place", "left"
    ).na.fill(0, ["n_drawn", "n_shards"]))
    ranges = run.write("slot_ranges", running_start(
        lookup(drawn, per_source, ["place"], ["n_slots", "n_shards"], "n_shards"), ["place"], ["shard"], "n", "n_shards"))
    first, end, wanted = F.col("_start"), F.col("_start") + F.col("n"), F.col("n_slots")
    # A sequence is as long as a shard at most.
    own = ranges.where(first < wanted).select(
        "place", F.explode(F.sequence(first, F.least(end, wanted) - 1)).alias("slot"), "shard")
    over = run.write("slots_over", ranges.where(end > wanted).select(
        "place", F.explode(F.sequence(F.greatest(first, wanted), end - 1)).alias("slot"), "shard"))
    under = per_source.where("n_drawn < n_slots").select("place", "n_slots", "n_drawn", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((wanted - F.col("n_drawn") - 1) / CHUNK_SLOTS))).alias("chunk"))
    under = run.write("slots_under", under.select("place", F.explode(F.sequence(
        F.col("n_drawn") + F.col("chunk") * CHUNK_SLOTS,
        F.least(F.col("n_drawn") + (F.col("chunk") + 1) * CHUNK_SLOTS, wanted) - 1)).alias("slot")))
    n_over = over.count()  # as many as are missing, since draws and needed slots are equal in number

    def indexed(rows: DataFrame) -> DataFrame:
        one = rows.withColumns({"one": F.lit(1), "all": F.lit(0), "n_rows": F.lit(n_over)})
        return running_start(one, ["all"], ["place", "slot"], "one", "n_rows")

    given = indexed(under).select("place", "slot", "_start").join(indexed(over).select("shard", "_start"), "_start")
    return own.unionByName(given.select("place", "slot", "shard"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """For every row of ``docs``: doc_id, size, source, source_size, target and taken, the words that the mix takes."""
    run = RunFolder(docs.sparkSession)
    sized = run.write("sized", pick(docs, id_column, text_column, source_column).toDF("doc_id", "text", "source").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    sources = source_table(sized, weights, cap, run)
    taken_blocks = block_uses(sources, run)
    placed = run.write("streams", running_start(
        lookup(sized, sources, ["source"], ["place", "n_docs", "source_size", "target"], "n_docs", match_nulls=True),
        ["place"], ["doc_id"], "size", "n_docs"))
    end = F.col("_start") + F.col("size")
    pieces = placed.where("size > 0").select("place", "_start", "size", F.explode(F.sequence(
        F.floor(F.col("_start") / BLOCK), F.floor((end - 1) / BLOCK))).alias("block"))
    low, high = F.greatest(F.col("_start"), F.col("block") * BLOCK), F.least(end, (F.col("block") + 1) * BLOCK)
    cut = F.greatest(F.lit(0), F.least(high, F.col("block") * BLOCK + F.col("part")) - low)
    taken = pieces.join(taken_blocks, ["place", "block"]).groupBy("place", "_start").agg(
        F.sum((high - low) * F.col("times") + cut).alias("taken"))
    # A row of size 0 has the start of its successor.
    mine = F.expr("p.place = t.place AND p._start = t._start AND p.size > 0")
    return placed.alias("p").join(taken.alias("t"), mine, "left").select(
        "p.doc_id", "p.size", "p.source", "p.source_size", "p.target", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"))


def block_uses(sources: DataFrame, run: RunFolder) -> DataFrame:
    """place, block, times (passes that take it whole) and part (its first words that the last pass takes)."""
    own = ["n_blocks", "passes", "rest", "source_size"]
    slots = lookup(drawn_slots(sources, run), run.write("slot_sources", sources.select("place", "n_slots", *own)),
                   ["place"], own, "n_slots").withColumns({
        "turn": F.floor(F.col("slot") / F.col("n_blocks")), "at": F.col("slot") % F.col("n_blocks")})
    key = F.pmod(F.xxhash64("place", "turn"), F.lit(1 << 30))
    slots = run.write("slots", slots.withColumn("block", permuted(F.col("at"), F.col("n_blocks"), key)))
    # A source's last block may be shorter; one row a source tells where the last pass meets it.
    shorter = run.write("shorter", slots.where("turn = passes AND block = n_blocks - 1").select(
        "place", F.col("at").alias("shorter_at"), F.lit(1).alias("n")))
    last = lookup(slots.where("turn = passes"), shorter, ["place"], ["shorter_at"], "n")
    lacking = F.col("n_blocks") * BLOCK - F.col("source_size")
    before = F.col("at") * BLOCK - F.when(F.col("shorter_at") < F.col("at"), lacking).otherwise(0)
    length = F.when(F.col("block") == F.col("n_blocks") - 1, BLOCK - lacking).otherwise(BLOCK)
    part = F.greatest(F.lit(0), F.least(length, F.col("rest") - before))
    whole = slots.where("turn < passes").select("place", "block", F.lit(1).alias("times"), F.lit(0).cast("long").alias("part"))
    return whole.unionByName(last.select("place", "block", F.lit(0).alias("times"), part.cast("long").alias("part"))).groupBy(
        "place", "block").agg(F.sum("times").alias("times"), F.sum("part").alias("part")).where("times > 0 OR part > 0")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Whole passes count in full; the rest of a pass counts as one more with that probability, by a hash of the id.
    Rows that share an id are taken alike.
    """
    own = options.get("id_column", "doc_id")
    ratio = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1.0)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 53)) / float(1 << 53)
    copies = mix(docs, **options).groupBy("doc_id").agg(F.avg(ratio).alias("ratio")).select(
        F.col("doc_id").alias("_id"), F.floor(F.col("ratio") + chance).cast("int").alias("_copies")).where("_copies > 0")
    rows = numbered(docs).alias("d")
    joined = rows.join(copies.alias("c"), F.expr(f"d.{place(docs, own)} <=> c._id"))
    return joined.select("d.*", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).drop("_copy").toDF(*docs.columns)
