"""Mixing sources to target weights by capped water-filling, DataFrame operations only.

Targets: every uncapped source gets level * weight; sources above their cap (maximum epochs times their size) are
clamped and the excess is shared again by weight until none is above. Each round is one aggregate over the source
table, so only the level (one number) passes through the driver, however many sources there are.

Sampling: a source at ratio r of its size takes every document floor(r) times and a seeded fraction once more.
The fraction is cut on the documents' seeded hashes where the words taken reach the target: a histogram of hash ranges
per source finds the range that holds the cut, and only that range's rows are ordered. There are more ranges for more
rows, so that a range stays small even if one source holds most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, uniform53

WORD = r"[^ \t\n\x0B\f\r]+"
SEED = 2024
#: Hash ranges of a source at least, and the rows that one of them holds about.
LEAST_RANGES, RANGE_ROWS = 4096, 50_000
#: Source tables of at most so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    """Number of maximal runs of characters other than the six white-space characters; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame, name: str) -> DataFrame:
    """sources plus `place` (from 0): their rank by name in code-point order, null last, without one global sort task."""
    slot = Window.partitionBy("part").orderBy(F.col(name).asc_nulls_last())
    spread = sources.repartitionByRange(F.col(name).asc_nulls_last()).withColumn("part", F.spark_partition_id())
    local = staged(spread.withColumn("local", F.row_number().over(slot)), "mix-sources")
    parts = local.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # one row for each partition of the range exchange
    before = parts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    return local.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("local") - 1).drop("part", "local", "before")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """sources (weight, source_size, ...) plus `target`. Weights must be above 0; all caps together below total: all capped."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, seen = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level >= cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("clamped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if row.n == seen or not row.weights:
            break
        seen = row.n
        rest, weights = float(total) - row.clamped, float(row.weights)
        level = F.lit(rest) / F.lit(weights)
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    if not row.weights:
        return sources.withColumn("target", cap)
    share = F.lit(rest) * F.col("weight") / F.lit(weights)
    return sources.withColumn("target", F.when(F.col("weight") * level >= cap, cap).otherwise(share))


def _joined(left: DataFrame, source: str, right: DataFrame, few: bool) -> DataFrame:
    """left with right's row of its source (null is a source too); right is broadcast if it has few rows."""
    return left.join(F.broadcast(right) if few else right, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")


def _planned(docs: DataFrame, text: str, source: str, doc_id: str, weights: tuple[int, ...], epochs: float, max_epochs: float, seed: int) -> tuple[DataFrame, DataFrame, int, bool]:
    """Sizes and draws of all rows; of each source its size, target, whole repetitions and the hash range in which the
    next repetition is cut; the number of ranges; whether the sources are few."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"))
    slim = staged(slim.withColumn("draw", uniform53(seed, F.col("doc_id"))), "mix-sizes")
    n_ranges = max(LEAST_RANGES, 1 << (slim.count() // RANGE_ROWS).bit_length())
    slim = slim.withColumn("bucket", _range(F.col("draw"), n_ranges))
    sums = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sums, "source")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.withColumn("weight", weight).drop("place"), "mix-weights")
    facts = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.count(F.lit(1)).alias("n")).first()
    few = facts.n <= BROADCAST_SOURCES
    filled = water_fill(ranked, epochs * facts.words, max_epochs).drop("weight")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    filled = filled.withColumn("whole", F.floor(ratio)).withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))

    # The first hash range in which the words of a further repetition reach what is left of the target.
    ranges = slim.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket")
    ranges = ranges.withColumn("until", F.sum("words").over(running)).withColumn("before", F.col("until") - F.col("words"))
    ranges = _joined(ranges, "source", filled.select(F.col("source").alias("__source"), "more"), few)
    cut = ranges.filter(F.col("until") > F.col("more")).groupBy("source").agg(F.min(F.struct("bucket", "before")).alias("cut"))
    cut = cut.select(F.col("source").alias("__source"), F.col("cut.bucket").alias("cut"), F.col("cut.before").alias("before"))
    plan = filled.join(cut, filled["source"].eqNullSafe(cut["__source"]), "left").drop("__source")
    return slim, staged(plan.withColumnRenamed("source", "__source"), "mix-plan"), n_ranges, few


def _range(draw: Column, n_ranges: int) -> Column:
    return F.floor(draw / ((1 << 52) // n_ranges))


def _edge(slim: DataFrame, plan: DataFrame, few: bool, may_repeat: Column) -> DataFrame:
    """The rows of each source's cut range, with extra: whether they are taken once more."""
    order = Window.partitionBy("source").orderBy("draw", "doc_id")
    rows = _joined(slim, "source", plan, few).filter("bucket = cut").withColumn("reached", F.col("before") + F.sum("size").over(order))
    # half of the document that crosses the cut must lie below it: the nearest whole number of documents
    return rows.withColumn("extra", F.coalesce(may_repeat & (F.col("reached") - F.col("size") / 2.0 <= F.col("more")), F.lit(False))).drop("reached")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2), epochs: float = 1.5, max_epochs: float = 2.0, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    Sources in code-point order, null last, weigh `weights` in turn and share `epochs` times all words. A null text
    has no words and is taken as often as its source's whole repetitions say. Rows that repeat a doc_id within a
    source share one draw. Sources without words get target 0; an empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    slim, plan, _, few = _planned(docs, text, source, doc_id, weights, epochs, max_epochs, seed)
    may_repeat = (F.col("size") > 0) & (F.col("whole") < max_epochs)
    sure = _joined(slim, "source", plan, few).filter("cut is null or bucket <> cut").withColumn("extra", F.coalesce(may_repeat & (F.col("bucket") < F.col("cut")), F.lit(False)))
    out = sure.unionByName(_edge(slim, plan, few, may_repeat)).withColumn("copies", (F.col("whole") + F.col("extra").cast("int")).cast("int"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2), epochs: float = 1.5, max_epochs: float = 2.0, seed: int = SEED) -> DataFrame:
    """docs with each row as often as mix() takes it (0 to max_epochs times), all columns as they were.

    Nulls, empty texts and empty tables count as in mix(); rows that repeat doc_id and source are taken alike, as often as
    the first of them in the order of draws. Texts stay where they are: only rows of a source's cut range are joined by
    doc_id.
    """
    slim, plan, n_ranges, few = _planned(docs, text, source, doc_id, weights, epochs, max_epochs, seed)
    own = plan.select("__source", F.col("whole").alias("__mix_whole"), F.col("cut").alias("__mix_cut"))
    rows = _joined(docs, source, own, few).withColumn("__mix_bucket", _range(uniform53(seed, F.col(doc_id)), n_ranges))
    inside = F.coalesce(F.col("__mix_bucket") == F.col("__mix_cut"), F.lit(False))
    has_words, below = F.col(text).cast("string").rlike(WORD), F.col("__mix_whole") < max_epochs
    sure = rows.filter(~inside).withColumn("__mix_extra", F.coalesce(has_words & below & (F.col("__mix_bucket") < F.col("__mix_cut")), F.lit(False)))
    edge = _edge(slim, plan, few, (F.col("size") > 0) & (F.col("whole") < max_epochs)).groupBy(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source")).agg(F.max("extra").alias("__mix_extra"))
    met = rows.filter(inside).join(edge, F.col(doc_id).eqNullSafe(F.col("__mix_id")) & F.col(source).eqNullSafe(F.col("__mix_source"))).drop("__mix_id", "__mix_source")
    taken = sure.unionByName(met).withColumn("__mix_copies", (F.col("__mix_whole") + F.col("__mix_extra").cast("int")).cast("int")).filter("__mix_copies > 0")
    repeated = taken.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
    return repeated.select(*docs.columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('2024:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS draw
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([3, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)) AS weight FROM s),
o AS (SELECT *, sum(2.0 * source_size) OVER p AS capped, sum(weight) OVER () - sum(weight) OVER p AS rest_weight
  FROM w WINDOW p AS (ORDER BY 2.0 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, coalesce(lag(capped) OVER q, 0) AS capped_before, coalesce(lag(rest_weight) OVER q, (SELECT sum(weight) FROM w)) AS weight_left,
    (SELECT 1.5 * sum(source_size) FROM w) AS total
  FROM o WINDOW q AS (ORDER BY 2.0 * source_size / weight, source)),
f AS (SELECT *, weight * ((total - capped_before) / weight_left) < 2.0 * source_size AS free FROM k),
level AS (SELECT capped_before, weight_left FROM f WHERE free ORDER BY 2.0 * source_size / weight, source LIMIT 1),
t AS (SELECT f.source, f.source_size,
    CAST(CASE WHEN f.free THEN (f.total - level.capped_before) * f.weight / level.weight_left ELSE 2.0 * f.source_size END AS DOUBLE) AS target
  FROM f LEFT JOIN level ON TRUE),
r AS (SELECT *, floor(target / nullif(source_size, 0)) AS whole, target - floor(target / nullif(source_size, 0)) * source_size AS more FROM t),
b AS (SELECT source, draw // 1099511627776 AS bucket, sum(size) AS words FROM d GROUP BY ALL),
u AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket) AS until FROM b),
c AS (SELECT u.source, min(u.bucket) AS cut, arg_min(u.until - u.words, u.bucket) AS before
  FROM u JOIN r ON u.source IS NOT DISTINCT FROM r.source WHERE u.until > r.more GROUP BY u.source),
x AS (SELECT d.*, r.source_size, r.target, coalesce(r.whole, 0) AS whole, r.more, c.cut, c.before, d.draw // 1099511627776 AS bucket
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source),
y AS (SELECT *, sum(size) OVER (PARTITION BY source, bucket ORDER BY draw, doc_id) AS reached FROM x)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN bucket < cut THEN 1 WHEN bucket = cut AND before + reached - size / 2.0 <= more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM y
"""
