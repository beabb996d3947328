"""Mixing of sources to target weights, with DataFrame functions only.

The words of each source form one stream that is cut into blocks of fixed length. The output has
as many slots as the targets need blocks; each slot of an output shard draws its source, so the
counts of a shard are a multinomial draw. A source that got more slots than its target hands the
last ones to sources that got too few. The slots of a source are numbered through all shards, and
a pseudorandom permutation of the block indexes, another one in each pass over the source, says
which block a slot holds. Everything is a hash of the seed and of keys, so reruns agree.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source of
its own, last in order; repeated rows count each on their own; a null id is kept; an empty table
gives an empty table; columns other than id, text and source are not read, so they may have any
name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .text import let, n_words, unused, words

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
SHARDS = 10_000
ROUNDS = 12
BUCKETS = 4096
RANKED_TOGETHER = 4_000


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Per source: `sid`, `source_size`, `target`. Shares follow the weights; none is above `most` times its source.

    With sources in the order of limit by weight, the level at which no further source is above
    its limit follows from sums over the sources before and after. One row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    sources = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(order))
        .withColumn("__weight", weight)
        .withColumn("__limit", (most * F.col("source_size")).cast("double"))
    )
    by_level = W.orderBy(F.col("__limit") / F.col("__weight"), "sid")
    upto = by_level.rowsBetween(W.unboundedPreceding, -1)
    onward = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    levels = sources.withColumn(
        "__level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("__limit").over(upto), F.lit(0.0)))
        / F.sum("__weight").over(onward),
    )
    free = F.when(F.col("__level") <= F.col("__limit") / F.col("__weight"), F.col("__level"))
    final = F.min_by(free, F.when(free.isNotNull(), F.col("__limit") / F.col("__weight"))).over(everything)
    target = F.when(final.isNull() | (F.col("__limit") < final * F.col("__weight")), F.col("__limit")) \
        .otherwise(final * F.col("__weight"))
    return levels.select("source", "sid", "source_size", target.alias("target"))


def permuted(index: Column, size: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """The place of `index` in a pseudorandom permutation of 0 to size - 1, by swap-or-not rounds."""
    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        swap = F.xxhash64(*key, r, F.greatest(x, partner), F.lit("swap")).bitwiseAND(F.lit(1).cast("long")) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, lambda x, r: step(x, r))


def drawn_slots(sources: DataFrame, seed: int, block_words: int) -> DataFrame:
    """All output slots: `shard`, `sid`, `slot` (from 0 within the source), with the source's `blocks`.

    `sources` is a written table.
    """
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    wanted = F.when(F.col("source_size") > 0, F.least(
        F.lit(MOST_PASSES) * blocks, F.round(F.col("target") * blocks / F.col("source_size")).cast("long"))).otherwise(0)
    needs = sources.select("sid", blocks.alias("blocks"), wanted.cast("long").alias("wanted"))
    upto = W.orderBy("sid").rowsBetween(W.unboundedPreceding, -1)
    needs = materialize(needs.withColumn("__from", F.coalesce(F.sum("wanted").over(upto), F.lit(0)).cast("long")))
    total = needs.agg(F.sum("wanted")).first()[0] or 0
    shard_slots = max(SHARD_SLOTS, -(-total // SHARDS))
    width = max(1, -(-total // BUCKETS))

    last = F.col("__from") + F.col("wanted") - 1
    ranges = needs.where("wanted > 0").withColumn("__bucket", F.explode(
        F.sequence(F.floor(F.col("__from") / width).cast("long"), F.floor(last / width).cast("long"))))
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total)))
    draws = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).cast("long").alias("shard"), draw.alias("__draw"),
        F.floor(draw / width).cast("long").alias("__bucket"))
    drawn = (
        draws.groupBy("shard", "__bucket", "__draw").agg(F.count(F.lit(1)).alias("__n"))
        .join(ranges, "__bucket").where((F.col("__draw") >= F.col("__from")) & (F.col("__draw") <= last))
        .groupBy("shard", "sid", "blocks", "wanted").agg(F.sum("__n").alias("drawn"))
    )

    # At most SHARDS rows per source from here on.
    before = W.partitionBy("sid").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("drawn").over(before), F.lit(0))
    counts = materialize(
        drawn.withColumn("first", first)
        .withColumn("kept", F.least(F.greatest(F.col("wanted") - F.col("first"), F.lit(0)), F.col("drawn")))
    )
    # The counts are few bytes, but every row stands for many slots: they are dealt over all tasks.
    dealt = counts.where("kept > 0").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "sid", "shard")
    kept = dealt.select(
        "shard", "sid", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("kept") - 1)).alias("slot"))

    freed = counts.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("kept")).alias("n")).where("n > 0")
    by_shard = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    freed = freed.withColumn("from", F.coalesce(F.sum("n").over(by_shard), F.lit(0)))
    freed = freed.select("shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)).alias("__turn"))
    have = counts.groupBy("sid").agg(F.sum("kept").alias("have"))
    short = needs.join(have, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    short = short.withColumn("n", F.col("wanted") - F.col("have")).where("n > 0")
    short = short.withColumn("from", F.coalesce(F.sum("n").over(W.orderBy("sid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    short = short.withColumn("__turn", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)))
    settled = short.join(freed, "__turn").select(
        "shard", "sid", "blocks", (F.col("have") + F.col("__turn") - F.col("from")).alias("slot"))
    return kept.unionByName(settled)


def stream_places(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Add `sid`, `source_size`, `target` and `place`: the words before each row in the stream of its source.

    Rows of a source are dealt into parts by a hash, so that no source is one window.
    """
    parts = max(1, -(-sized.count() // RANKED_TOGETHER))
    rows = sized.join(sources.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))) \
        .drop("__source").withColumn("__part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(parts)))
    totals = rows.groupBy("sid", "__part").agg(F.sum("size").alias("__size"))
    before = W.partitionBy("sid").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("sid", "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    within = W.partitionBy("sid", "__part").orderBy("doc_id", "digest", "size", "__row")
    inner = F.coalesce(F.sum("size").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("__inner", inner).join(starts, ["sid", "__part"])
    return placed.withColumn("place", F.col("__start") + F.col("__inner")).drop("__part", "__start", "__inner")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: int = 7, block_words: int = BLOCK_WORDS, with_parts: bool = False,
            row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, digest, source, size, source_size, target, taken.

    `taken` counts the words of the document in all output slots. `with_parts` adds `parts`: for
    each block of the document its word range (`from`, `to`) and the passes that take it. `row_col`
    names a column that numbers the rows of a written table; it is returned as `__row`.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text).alias("size"),
        F.xxhash64(text).alias("digest"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("__row")))
    sources = materialize(source_targets(sized))
    slots = drawn_slots(sources, seed, block_words)
    run = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    index = permuted(F.pmod(F.col("slot"), F.col("blocks")), F.col("blocks"), F.lit(seed), F.col("sid"), run)
    held = slots.select("sid", index.alias("__block"), run.cast("int").alias("pass"))
    taken = held.groupBy("sid", "__block").agg(
        F.count(F.lit(1)).alias("__times"), F.sort_array(F.collect_list("pass")).alias("passes"))  # MOST_PASSES at most

    rows = stream_places(sized, sources)
    first = F.floor(F.col("place") / block_words).cast("long")
    last = F.floor((F.col("place") + F.col("size") - 1) / block_words).cast("long")
    spread = rows.withColumn("__block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    low = F.greatest(F.col("__block") * block_words, F.col("place")) - F.col("place")
    high = F.least((F.col("__block") + 1) * block_words, F.col("place") + F.col("size")) - F.col("place")
    spread = spread.withColumns({"from": low, "to": high})
    met = spread.join(taken, ["sid", "__block"], "left")
    sums = [F.coalesce(F.sum((F.col("to") - F.col("from")) * F.col("__times")), F.lit(0)).cast("long").alias("taken")]
    if with_parts:
        sums.append(F.sort_array(F.collect_list(
            F.when(F.col("passes").isNotNull(), F.struct("from", "to", "passes")))).alias("parts"))
    found = met.groupBy("__row", "doc_id", "digest", "source", "size", "source_size", "target").agg(*sums)
    return found if row_col else found.drop("__row")


def mix(docs: DataFrame, seed: int = 7, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: per row of the input and pass, a row with the words that the pass takes.

    A row that a pass takes whole keeps its text as it is; else the taken words are joined by
    blanks. `n_chars` follows the text; all columns of the input are kept.
    """
    columns = docs.columns
    row = unused("__row", columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    found = mixture(rows, seed=seed, block_words=block_words, with_parts=True, row_col=row)
    chosen = (
        found.where("taken > 0").select("__row", "size", F.explode("parts").alias("p"))
        .select("__row", "size", "p.from", "p.to", F.explode("p.passes").alias("__pass"))
    )
    ranges = F.sort_array(F.collect_list(F.struct("from", "to")))
    chosen = chosen.groupBy("__row", "size", "__pass").agg(ranges.alias("__ranges"))
    wide = rows.alias("d").join(chosen.alias("c"), F.col(f"d.{row}") == F.col("c.__row"))
    covered = F.aggregate("c.__ranges", F.lit(0).cast("long"), lambda s, r: s + (r["to"] - r["from"]))
    whole = covered == F.col("c.size")
    some = let(words(F.col("d.text")), lambda w: F.flatten(F.transform("c.__ranges", lambda r: F.slice(
        w, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")))))
    mixed = F.when(whole, F.col("d.text")).otherwise(F.array_join(some, " "))
    out = wide.select(*[F.col(f"d.`{c}`") for c in columns if c not in ("text", "n_chars")], mixed.alias("text"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
