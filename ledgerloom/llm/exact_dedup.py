"""Exact dedup in two passes over a counting Bloom filter.

Pass one counts filter slots: every row's hash names ``HASHES`` slots of one 4 KiB block, the slot counts are
summed map side, and the slots hit twice or more become bitmaps. Pass two tests every row against the broadcast
bitmaps: a row with an unshared slot is certainly unique and passes straight through; only the others shuffle.
The filter grows with the corpus, 16 bits a row. Up to ``BROADCAST_BITS`` its bitmaps are broadcast, and no row that it
clears moves. A larger one is joined block by block: `duplicate_groups` then moves all digests once, and `exact_dedup`,
which returns whole rows, joins the rows with their flags by a shuffle that moves texts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, staged, table

BLOCK_BITS = 32_768
HASHES = 2
#: Least bits of the filter, and how many are broadcast at most (16 MiB).
MIN_BITS, BROADCAST_BITS = 1 << 18, 1 << 27
#: Groups with at least this share of the rows are joined by broadcast: there are at most so many of them.
HOT_GROUPS = 1000


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def filter_bits(rows: int) -> int:
    """16 bits a row, a power of two."""
    return max(MIN_BITS, 1 << max(0, 16 * rows - 1).bit_length())


def _places(digest: Column, bits: int) -> tuple[Column, list[Column]]:
    block = F.pmod(F.xxhash64(digest, F.lit(11)), F.lit(bits // BLOCK_BITS))
    h = F.xxhash64(digest, F.lit(12))
    return block, [F.pmod(F.shiftrightunsigned(h, 20 * i), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def repeat_filter(rows: DataFrame, digest: str, bits: int) -> DataFrame:
    """Bitmaps (block, bitmap) of the slots that two rows or more set. At most bits / 8 bytes."""
    block, places = _places(F.col(digest), bits)
    slots = rows.select(block.alias("block"), F.explode(F.array_distinct(F.array(*places))).alias("place"))
    shared = slots.groupBy("block", "place").count().filter("count > 1")
    return shared.groupBy("block").agg(F.bitmap_construct_agg(F.col("place")).alias("bitmap"))


def possibly_repeated(rows: DataFrame, digest: str, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """rows plus a boolean that is true for every repeated digest and for few others; nothing shuffles up to BROADCAST_BITS."""
    block, places = _places(F.col(digest), bits)
    bm = bitmaps.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap"))
    with_map = rows.join(F.broadcast(bm) if bits <= BROADCAST_BITS else bm, block == F.col("__block"), "left")

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("__bitmap"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (place % 8).cast("int")) == 1

    hit = is_set(places[0])
    for place in places[1:]:
        hit = hit & is_set(place)
    return with_map.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__block", "__bitmap")


def duplicate_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal if their texts are without white space (null: empty text). The row with the longest original
    text stays, then the smallest doc_id (a null doc_id counts as the largest), then any one of the rows that
    repeat the same doc_id: exactly one row of a group is kept. An empty table gives no rows.
    """
    norm = F.sha2(normalised(F.col(text)), 256)
    digests = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            norm.alias("text_sha256"),
            F.coalesce(F.length(F.col(text)), F.lit(0)).alias("n"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "exact-digests",
    )
    total = digests.count()
    bits = filter_bits(total)
    flagged = possibly_repeated(digests, "text_sha256", repeat_filter(digests, "text_sha256", bits), bits, "maybe")
    alone = flagged.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    candidates = flagged.filter("maybe").select("doc_id", "text_sha256", "n", "row_no")
    first = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row_no").alias("row_no"))
    groups = candidates.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first"))
    groups = staged(groups.select("text_sha256", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row_no").alias("keep_row")), "exact-groups")
    hot_size = max(2, total // HOT_GROUPS)
    hot = groups.filter(F.col("group_size") >= hot_size)
    marked = candidates.join(F.broadcast(hot.withColumnRenamed("text_sha256", "hot_sha")), F.col("text_sha256") == F.col("hot_sha"), "left")
    in_hot = marked.filter(F.col("hot_sha").isNotNull()).drop("hot_sha")
    in_cold = marked.filter(F.col("hot_sha").isNull()).select("doc_id", "text_sha256", "row_no").join(groups.filter(F.col("group_size") < hot_size), "text_sha256")
    pick = ["doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "text_sha256"]
    return alone.unionByName(in_hot.select(*pick)).unionByName(in_cold.select(*pick))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each group of equal texts (the row that duplicate_groups keeps), all columns as they were.

    Rows whose hash the filter clears pass straight through. The possibly repeated rows are matched to their
    group's kept doc_id by a join on doc_id, whose keys do not repeat as texts do; rows that repeat both doc_id
    and text collapse to one.
    """
    digest, flag = "__exact_digest", "__exact_maybe"
    columns = docs.columns
    slim = docs.select(
        F.sha2(normalised(F.col(text)), 256).alias(digest), F.coalesce(F.length(F.col(text)), F.lit(0)).alias("n"), F.col(doc_id).alias("doc_id")
    )
    slim = staged(slim, "exact-digests")
    bits = filter_bits(slim.count())
    bitmaps = staged(repeat_filter(slim, digest, bits), "exact-bitmaps")
    maybe = possibly_repeated(slim, digest, bitmaps, bits, flag).filter(flag)
    first = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"))
    keep = maybe.groupBy(digest).agg(F.min(first).alias("first")).select(
        F.col(digest).alias("__keep_digest"), F.col("first.doc_id").alias("__keep_id"), (-F.col("first.n")).alias("__keep_n")
    )
    whole = docs.withColumn(digest, F.sha2(normalised(F.col(text)), 256))
    if bits <= BROADCAST_BITS:
        flagged = possibly_repeated(whole, digest, bitmaps, bits, flag)
    else:  # which rows the filter leaves was found on their digests
        left = maybe.select(F.col("doc_id").alias("__maybe_id"), F.col(digest).alias("__maybe_digest")).distinct()
        met = whole.join(left, F.col(doc_id).eqNullSafe(F.col("__maybe_id")) & (F.col(digest) == F.col("__maybe_digest")), "left")
        flagged = met.withColumn(flag, F.col("__maybe_digest").isNotNull())
    alone = flagged.filter(~F.col(flag)).select(*columns)
    stays = flagged.filter(flag).join(
        keep,
        F.col(doc_id).eqNullSafe(F.col("__keep_id")) & (F.col(digest) == F.col("__keep_digest")) & (F.coalesce(F.length(F.col(text)), F.lit(0)) >= F.col("__keep_n")),
        "left_semi",
    )
    once = stays.dropDuplicates([doc_id, digest])
    return alone.unionByName(once.select(*columns))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
