"""Mixing sources to target weights.

Sizes (words) are added up per source. Sources in code point order, null last,
weigh 3, 1, 2, repeating; they share 150 % of all words by weight, no source
above twice its size, and the excess goes to the others by weight. A source's
rate is target / size: every document is emitted floor(rate) times, plus one
hash-seeded Bernoulli copy whose probability is the fraction: a document gets
it if its hash, turned by its source's seed, lies below the fraction. The seed
is one of ``BUCKETS`` turns of the hash circle, the one at which the words taken
meet the target best; the fraction itself is never changed, so about that share
of a source's documents get the copy. (Sizes differ so much that with a fixed
seed a source of thousands of documents misses its target by up to a tenth. A
source of very few documents, or with one that outweighs all others, gets the
nearest sum that a turn can give.)

Defined results: a null text has size 0 and takes 0 words; a source without
words has target 0; null sources are one source, the last; repeated rows share
their hash and so their copies; equal hashes go together; an empty table gives
no rows. Columns beside doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import WORD, prepare, saved

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BUCKETS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column) -> Column:
    """A document's place on the hash circle, 0 to 1 (exclusive), exact in a double."""
    return F.pmod(F.xxhash64(F.lit("mix"), doc_id.cast("long")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def bucket(at: Column) -> Column:
    return F.floor(at * BUCKETS).cast("int")


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``weight`` by the source's place in code point order, without a sort in one task."""
    dealt = saved(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    sizes = dealt.groupBy("part").agg(F.count("*").alias("rows"))
    # one row per partition
    before = sizes.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    place = F.pmod(F.col("own") + F.col("before"), F.lit(len(WEIGHTS))).cast("int")
    return dealt.withColumn("own", own).join(before, "part").withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), place + 1)
    ).select("source", "source_size", "weight")


def targets(sized: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    The level per unit of weight rises until no source stands above its
    ceiling; each step is one aggregate over the table of sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = saved(_ranked(sources).withColumn("ceiling", F.lit(most) * F.col("source_size")))
    full = F.col("ceiling") / F.col("weight")
    level = -1.0
    while True:
        r = ranked.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(full <= level, F.col("ceiling")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(full > level, F.col("weight")).otherwise(0.0)).alias("weight"),
        ).first()
        if not r.weight:
            break
        now = (share * r.size - r.taken) / r.weight
        if now <= level:
            break
        level = now
    return ranked.select("source", "source_size", F.least("ceiling", F.lit(max(level, 0.0)) * F.col("weight")).alias("target"))


def rates(sized: DataFrame) -> DataFrame:
    """(mix_source, source_size, target, whole, fraction, turn) from (source, size, bucket).

    All documents of a source get ``whole`` copies; those whose place lies in the
    arc of length ``fraction`` that starts at ``turn`` get one more.
    """
    goal = saved(targets(sized)).withColumnRenamed("source", "mix_source")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    goal = goal.withColumn("whole", F.floor(rate).cast("long")).withColumn("fraction", rate - F.floor(rate))
    dealt = sized.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    dealt = dealt.join(goal, F.col("source").eqNullSafe(F.col("mix_source"))).drop("source")
    # arcs begin at a bucket with documents or right behind it; the circle is laid out twice, so none wraps
    starts = F.array(F.col("bucket"), F.col("bucket") + 1)
    ends = F.transform(starts, lambda s: F.struct((s - 0.5).alias("pos"), s.alias("start"), F.lit(-1).alias("sign"), F.lit(0).alias("add")))
    reach = F.transform(
        starts, lambda s: F.struct((s - 0.5 + F.col("fraction") * BUCKETS).alias("pos"), s.alias("start"), F.lit(1).alias("sign"), F.lit(0).alias("add"))
    )
    rows = F.transform(
        F.array(F.col("bucket"), F.col("bucket") + BUCKETS),
        lambda at: F.struct(at.cast("double").alias("pos"), F.lit(None).cast("int").alias("start"), F.lit(0).alias("sign"), F.col("size").alias("add")),
    )
    typed = "array<struct<pos: double, start: int, sign: int, add: bigint>>"
    laid = dealt.select(*goal.columns, F.inline(F.concat(rows.cast(typed), ends.cast(typed), reach.cast(typed))))
    # at most 6 rows per bucket and source, so a window is bounded
    upto = F.sum("add").over(Window.partitionBy("mix_source").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0))
    held = laid.withColumn("upto", upto).where("start is not null").distinct()
    arcs = held.groupBy(*goal.columns, "start").agg(F.sum(F.col("sign") * F.col("upto")).alias("arc"))
    off = F.abs(F.col("arc") - F.col("fraction") * F.col("source_size"))
    best = arcs.groupBy(*goal.columns).agg(F.min(F.struct(off.alias("off"), F.col("start"))).alias("b"))
    return best.select(*goal.columns, (F.pmod(F.col("b.start"), F.lit(BUCKETS)) / float(BUCKETS)).alias("turn"))


def copies(at: Column, whole: Column, fraction: Column, turn: Column) -> Column:
    return whole + (F.pmod(at - turn, F.lit(1.0)) < fraction).cast("long")


def query(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        words(F.col("text")).alias("size"), place(F.col("doc_id")).alias("place"),
    )
    sized = saved(sized.withColumn("bucket", bucket(F.col("place"))))
    found = sized.join(rates(sized), F.col("source").eqNullSafe(F.col("mix_source")))
    found = found.withColumn("copies", copies(F.col("place"), F.col("whole"), F.col("fraction"), F.col("turn")))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, every row as many times as the mix takes it."""
    prepare(docs.sparkSession)
    keyed = docs.withColumns({"__source": F.col("source").cast("string"), "__place": place(F.col("doc_id"))})
    sized = saved(keyed.select(F.col("__source").alias("source"), words(F.col("text")).alias("size"), bucket(F.col("__place")).alias("bucket")))
    rate = rates(sized).select(*[F.col(c).alias(f"__{c}") for c in ("mix_source", "whole", "fraction", "turn")])
    n = copies(F.col("__place"), F.col("__whole"), F.col("__fraction"), F.col("__turn"))
    found = keyed.join(rate, F.col("__source").eqNullSafe(F.col("__mix_source"))).withColumn("__n", n).where("__n > 0")
    return found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
