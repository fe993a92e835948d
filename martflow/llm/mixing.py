"""Operator 10, mixing sources to target weights by systematic sampling.

Sources ordered by code point (null last) weigh 3, 1, 2, 3, 1, 2, ... and share a
budget of so many times all sizes. No target passes ``most`` times its source's size;
what it would get beyond is reshared by weight among the others, which is the same as
one level ``v`` with ``target = min(cap, v * weight)`` for all.

Every document of a source expects ``target / source size`` copies, at most ``most``.
Documents are ordered within their source by size, then by a hash; the expected copies
are summed along that order, one random offset of the source is added, and a document
gets a copy for each whole number its stretch of the sum crosses. Neighbours are of
nearly the same size, so a source's words come out within about one large document of
its target.

The sum is not run through a source in one task. Documents fall into cells (source,
size, hash bucket). Counts of cells are summed along the sizes of a source, then along
the buckets of a size, and a document adds its rank in its own cell; no window is wider
than the distinct sizes of a source, the buckets, or a cell. Expected copies are whole
multiples of 2**-24, so sums are exact in any order and reruns agree.

Defined results: a null text has size 0 and is mixed like any other; a null source is
one source; a null ``doc_id`` is allowed; rows equal in ``doc_id``, source and text
share the copies of their places in any order; an empty table or a source without
words gives target 0 and no copies; clashing column names are kept apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.llm.common import table, word_count
from martflow.plans.staging import stage

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2.0
BUCKETS = 1024
SEED = "mix-1"
_ONE = 1 << 24
# What a document that is taken is in memory on the narrow side of a join, and how much
# of them is sent to all executors; beyond that both sides are shuffled.
_TAKEN_BYTES = 160
_SENT_BYTES = 64 << 20


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST
) -> DataFrame:
    """(source, source_size) with ``target``; a row for each source.

    The windows run over the sources, whose number the corpus's owner fixes.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(
        F.array(*map(F.lit, weights)),
        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
    )
    found = sizes.withColumn("weight", weight.cast("double"))
    found = found.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    # From the source that is full first: the level at which each is the first not full.
    # Levels fall from the true one on, and before it they would overfill their source.
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(
        F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(float(budget)) * F.sum("source_size").over(everything)
    found = found.withColumn("level", (total - before) / open_weight)
    reached = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    found = found.withColumn("level", F.max(reached).over(everything))
    shared = F.least("cap", F.col("level") * F.col("weight"))
    target = F.coalesce(shared, F.col("cap"))
    return found.select("source", "source_size", target.alias("target"))


def copies(
    documents: DataFrame,
    keys: list[str],
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
    buckets: int = BUCKETS,
    seed: str = SEED,
) -> DataFrame:
    """``documents`` (with source, size and a hexadecimal ``mark``) and their copies.

    ``mark`` orders documents of one size; ``keys`` break its ties. Adds source_size,
    target and copies. The rows themselves are shuffled once, to their cells.
    """
    cell = ["source", "size", "bucket"]
    # Buckets follow the order of the marks.
    bucket = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * buckets
    docs = documents.withColumn("bucket", F.shiftright(bucket, 32).cast("int"))
    cells = stage(docs.groupBy(*cell).agg(F.count(F.lit(1)).alias("docs")), "mix-cells")

    size_docs = cells.groupBy("source", "size").agg(F.sum("docs").alias("size_docs"))
    size_docs = stage(size_docs, "mix-sizes")
    totals = size_docs.groupBy("source").agg(
        F.sum(F.col("size") * F.col("size_docs")).alias("source_size")
    )
    targets = source_targets(totals, weights, budget, most)
    share = F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    targets = targets.withColumn("step", F.floor(share * _ONE).cast("long"))
    chance = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit(""))))
    chance = F.conv(F.substring(chance, 1, 6), 16, 10)  # 24 bits
    targets = targets.withColumn("offset", chance.cast("long"))

    along = Window.partitionBy("source").orderBy("size")
    before = Window.unboundedPreceding
    earlier = F.coalesce(F.sum("size_docs").over(along.rowsBetween(before, -1)), F.lit(0))
    by_size = size_docs.select("source", "size", earlier.alias("in_sizes"))
    within = Window.partitionBy("source", "size").orderBy("bucket")
    earlier = F.coalesce(F.sum("docs").over(within.rowsBetween(before, -1)), F.lit(0))
    by_cell = cells.select(*cell, earlier.alias("in_buckets"))

    starts = _join(_join(by_cell, by_size, ["source", "size"]), targets, ["source"])
    first = (F.col("in_sizes") + F.col("in_buckets")).alias("first")
    starts = starts.select(*cell, first, "source_size", "target", "step", "offset")
    placed = _join(docs, stage(starts, "mix-starts"), cell)
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("mark", *keys))
    placed = placed.withColumn("place", F.col("first") + rank)  # from 1 in its source

    def crossed(place):  # 2**24 of them are one copy
        return F.expr(f"(({place}) * step + offset) div {_ONE}")

    made = crossed("place") - crossed("place - 1")
    placed = placed.withColumn("copies", made)
    return placed.drop("bucket", "first", "step", "offset", "place")


def _join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that takes nulls in ``on`` as equal and keeps one of each column."""
    other = {c: f"{c}_right" for c in on}
    right = right.withColumnsRenamed(other)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in other.items()]
    return left.join(right, same).drop(*other.values())


def _placing() -> list:
    """The columns that ``copies`` places documents by."""
    text = F.col("text").cast("string")
    told = F.concat_ws("|", F.lit(SEED), F.col("doc_id").cast("long"), text)
    return [
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        F.md5(told).alias("mark"),
    ]


def mixed(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies; a row for each document."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    found = copies(documents.select(doc_id, *_placing()), ["doc_id"])
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken, "copies")


def take_mix(documents: DataFrame) -> DataFrame:
    """Each document as often as it is taken, with its columns as they are.

    Places are found on narrow rows. What is taken of a document goes back to it by its
    mark: texts are shuffled once, and not at all where the narrow rows are few enough to
    be sent to them. Of rows equal in ``doc_id``, source and text one stands for all.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    found = copies(documents.select(doc_id, *_placing()), ["doc_id"])
    taken = found.groupBy(F.col("mark").alias("of"), F.col("doc_id").alias("of_id"), F.col("source").alias("of_source"))
    taken = taken.agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").cast("int").alias("times"))
    taken = stage(taken.where("times > 0"), "mix-taken")
    if taken.count() * _TAKEN_BYTES <= _SENT_BYTES:
        taken = F.broadcast(taken)

    names = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    own = [F.col(f"`{c}`").alias(n) for c, n in names.items()]
    source, _, mark = _placing()
    marked = documents.select(*own, doc_id, source, mark)
    met = marked.join(
        taken,
        (F.col("mark") == F.col("of"))
        & F.col("doc_id").eqNullSafe(F.col("of_id"))
        & F.col("source").eqNullSafe(F.col("of_source")),
    )
    row = F.struct(*names.values())
    single = met.where("rows = 1").select("times", row.alias("row"))
    several = met.where("rows > 1").groupBy("of", "of_id", "of_source")
    several = several.agg(F.first("times").alias("times"), F.first(row).alias("row"))
    found = single.unionByName(several.select("times", "row"))
    found = found.select("row.*", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("repeat"))
    return found.select([F.col(n).alias(c) for c, n in names.items()])


def op10_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mixed(table(spark, sf_dir, "documents"))


#: The same in SQL, with one running number for each source in place of the cells.
OP10_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws('|', 'mix-1', doc_id, text)) AS mark
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM docs GROUP BY source
), capped AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    1.5::DOUBLE * sum(source_size::DOUBLE) OVER () AS budget FROM sources
), levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM capped
), targets AS (
  SELECT *, coalesce(least(cap, weight * max(CASE WHEN own_level * weight <= cap THEN own_level END)
    OVER ()), cap) AS target
  FROM levels
), steps AS (
  SELECT source, source_size, target,
    floor(coalesce(target / nullif(source_size, 0), 0) * 16777216)::BIGINT AS step,
    ('0x' || md5('mix-1|' || coalesce(source, ''))[1:6])::BIGINT AS start
  FROM targets
), placed AS (
  SELECT d.*, s.source_size, s.target, s.step, s.start,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.mark, d.doc_id) AS place
  FROM docs d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
), counted AS (
  SELECT *, (place * step + start) // 16777216 - ((place - 1) * step + start) // 16777216 AS copies
  FROM placed
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken,
  copies::BIGINT AS copies
FROM counted
"""
