"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Every document's size is its number of words; a source's is the sum.
2. Targets: sources in code point order, null last, weigh `weights` in turn and share
   `share` times all words. A target stops at `repeats` times its source's size; what is
   above is shared again by weight until none is above.
3. Each source is dealt into shards of about `shard_words` words by a seeded hash. The
   words of a shard, in a seeded order of its documents, form a tape cut into blocks of
   `block_words`. Blocks go to shards by the highest quotients target / (2 k + 1), at most
   `repeats` times the blocks a shard has, which makes the shards' integer quotas.
4. A quota q over m blocks takes every block q div m times, and q mod m blocks once more,
   spread evenly along the tape from a seeded place. So what a document gives follows
   from its place on the tape; blocks are never listed.

Null texts and texts without words have size 0 and give nothing; a null source is a source
of its own; without words all targets are 0. Repeated rows count as rows of their own.
Only `doc_id`, `text` and `source` are read; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wickwork.llm.common import staged
from wickwork.operators.numbering import number_names

WORD = r"[^\x20\x09-\x0D]+"
SHARD_WORDS = 4_000_000
BLOCK_WORDS = 8
#: Multipliers tried in one pass when the divisor is searched.
_TRIES = 32


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """(source, source_size, target): shares by weight that stop at `repeats` times the size."""
    sources = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = number_names(sources.where("source IS NOT NULL"), "source", "place")
    last = sources.where("source IS NULL").withColumn("place", F.lit(sources.count()).cast("int"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    weighed = staged(named.unionByName(last).select("source", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size") * repeats
    level, full = 0.0, -1
    while True:  # each pass settles at least one more source
        above = cap <= F.col("weight") * F.lit(level)
        row = weighed.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, cap)).alias("caps"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights"), F.count(F.when(above, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["weights"]:
            break
        full = row["full"]
        level = (row["all"] * share - (row["caps"] or 0)) / row["weights"]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    return weighed.select("source", "source_size", target.alias("target"))


def _quota(multiplier: Column | float) -> Column:
    seats = F.floor(F.col("weight") * multiplier + 0.5).cast("long")
    return F.least(seats, F.col("cap"))


def apportion(shares: DataFrame, seats: int) -> DataFrame:
    """`shares` (weight, cap, key, ...) with `quota`: seats to the highest weight / (2 k + 1).

    The divisor is searched with a few aggregates, then the last seats go one by one to the
    highest quotients, ties to the smaller key. No row takes more than its cap.
    """
    low, high = 0.0, 1.0
    count = lambda xs: shares.agg(*[F.sum(_quota(F.lit(x))) for x in xs]).first()
    most = shares.agg(F.sum(F.when(F.col("weight") > 0, F.col("cap")))).first()[0] or 0
    seats = min(seats, most)
    while (count([high])[0] or 0) < seats:
        low, high = high, high * 1024
    for _ in range(8):
        steps = [low + (high - low) * i / _TRIES for i in range(_TRIES + 1)]
        found = [x or 0 for x in count(steps)]
        at = max(i for i, x in enumerate(found) if x <= seats) if found[0] <= seats else 0
        low, high = steps[at], steps[min(at + 1, _TRIES)]
        if found[at] == seats or low == high:
            break
    left = seats - (count([low])[0] or 0)
    base = shares.withColumn("quota", _quota(F.lit(low)))
    if left <= 0:
        return base
    more = base.where(_quota(F.lit(high)) > F.col("quota")).select(
        "key", "weight", F.explode(F.sequence(F.col("quota"), _quota(F.lit(high)) - 1)).alias("k")
    )
    best = more.select("key", (F.col("weight") / (2 * F.col("k") + 1)).alias("quotient")).orderBy(F.desc("quotient"), "key")
    won = best.limit(int(left)).groupBy("key").agg(F.count(F.lit(1)).alias("won"))
    return base.join(won, "key", "left").withColumn("quota", F.col("quota") + F.coalesce("won", F.lit(0))).drop("won")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 17,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row; see the module."""
    sizes = staged(sized(docs), "sizes")
    targets = staged(source_targets(sizes, weights, share, repeats), "targets")
    drawn = F.xxhash64(F.lit(seed), "doc_id")
    # A source and its number of shards are few next to the documents.
    dealt = sizes.withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    dealt = dealt.withColumn("draw", drawn).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), shards))
    # Rows without words have no place on a tape: a source of them alone would be one shard.
    wordless = dealt.where("size = 0")
    dealt = dealt.where("size > 0")
    by_shard = Window.partitionBy("source", "shard")
    tape = by_shard.orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = staged(dealt.withColumns({"end": F.sum("size").over(tape), "words": F.sum("size").over(by_shard)}), "tape")

    key = F.xxhash64("source", "shard")
    shares = staged(
        placed.groupBy("source", "shard").agg(
            F.max("words").alias("words"), F.max("target").alias("target"), F.max("source_size").alias("source_size")
        ).select(
            key.alias("key"), (F.col("target") * F.col("words") / F.col("source_size") / block_words).alias("weight"),
            (F.ceil(F.col("words") / block_words)).alias("m"),
        ).withColumn("cap", F.col("m") * repeats), "shares",
    )
    seats = shares.agg(F.sum("weight")).first()[0]
    quotas = apportion(shares, round(seats)) if seats else shares.withColumn("quota", F.lit(0).cast("long"))
    quotas = quotas.select(
        "key", "m", F.expr("quota DIV m").alias("whole"), F.expr("quota % m").alias("extra"),
        F.pmod(F.xxhash64(F.lit(seed + 2), "key"), F.col("m")).alias("turn"),
    )
    before = lambda j: f"(({j} + turn) * extra DIV m)"  # noqa: E731  blocks picked before block j, and a constant
    words = lambda x: (  # noqa: E731  words picked before word x of the tape
        f"({block_words} * {before(f'({x} DIV {block_words})')} + "
        f"({before(f'({x} DIV {block_words} + 1)')} - {before(f'({x} DIV {block_words})')}) * ({x} % {block_words}))"
    )
    taken = F.expr(f"whole * size + {words('end')} - {words('(end - size)')}")
    columns = ["doc_id", "source", "size", "source_size", "target"]
    out = placed.withColumn("key", key).join(quotas, "key", "left").select(*columns, F.coalesce(taken, F.lit(0)).cast("long").alias("taken"))
    return out.unionByName(wordless.select(*columns, F.lit(0).cast("long").alias("taken")))
