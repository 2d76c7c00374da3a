"""Target-distribution importance resampling: documents whose word n-grams are as likely as in a target are drawn first.

Texts become lower-case words with one blank between them. An overlapped regex scan then emits the byte span of every run
of 1 to 2 words, bounded by look-arounds, and each span is counted under the crc32 of its bytes. The log ratio of a
bucket's share in the target to its share in all documents is the bucket's gain; a document's weight is its mean gain. A
seeded Gumbel number for each document makes the highest scores a draw without replacement in proportion to exp(weight).

Each text is scanned once: its buckets are written down (two bytes a feature) and read again for the weights. Scores are
whole thousandths of a logarithm, so a table of their counts stays small at any size; it gives the score at which the draw
ends and how many documents lie above each score, and only documents above that score are ordered, inside their score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, trimmed

BUCKETS = 10_000
#: Drawn share of the documents of at least LEAST_WORDS words, in hundredths; the seed of the draw.
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
#: Bytes of text that a task scans before it hands its rows on.
SLICE = 1 << 22
#: A-Z become a-z, and every byte of [\x00-\x2F\x3A-\x60\x7B-\x7F] that is left a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: At every word of a text with single blanks around its words: the word (group 1) and, unless it ends its text, the next.
_RUNS = regex.compile(rb"(?<= )([^ ]++)(?: [^ ]++)?+(?= )")
#: Longer spans are hashed one by one.
_LONG = 64
#: What each byte adds to a crc32 (its polynomial's remainders).
_BYTE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _BYTE = (_BYTE >> 1) ^ np.where(_BYTE & 1, np.uint32(0xEDB88320), np.uint32(0))


def crc_onward(crc: np.ndarray, data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The crc32 of many spans of data, each going on from its crc: byte by byte, all spans at once."""
    raw, size = np.frombuffer(data, np.uint8), end - start
    out = np.empty(len(crc), np.uint32)
    for k in np.flatnonzero(size > _LONG):
        out[k] = zlib.crc32(data[start[k] : end[k]], int(crc[k]))
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -_LONG) :]
    state, at = ~crc[order], start[order]
    active = np.searchsorted(-size[order], -np.arange(1, _LONG + 1), "right")
    for k, n in enumerate(active.tolist()):
        if not n:
            break
        state[:n] = (state[:n] >> np.uint32(8)) ^ _BYTE[(state[:n] ^ raw[at[:n] + k]) & np.uint32(255)]
    out[order] = ~state
    return out


def hashed_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of every run of 1 and 2 words of texts in UTF-8, text after text, and how many each text has.

    Every text becomes its words with one blank between; two blanks part texts, so that no run crosses from one to another.
    """
    folded = [b" ".join(t.translate(_FOLD).split()) for t in texts]
    data = b" " + b"  ".join(folded) + b" "
    spans = np.fromiter((x for m in _RUNS.finditer(data, overlapped=True) for x in (m.start(), m.end(1), m.end())), np.int64).reshape(-1, 3)
    start, word, pair = spans.T
    one = crc_onward(np.zeros(len(spans), np.uint32), data, start, word)
    both = np.stack([one, crc_onward(one, data, word, pair)], axis=1)
    last = word == pair  # ends its text
    ends = np.cumsum([len(t) + 2 for t in folded])
    per_text = np.diff(np.r_[0, np.searchsorted(start, ends)])
    n = 2 * per_text - np.minimum(per_text, 1)
    return both[np.stack([np.ones(len(spans), bool), ~last], axis=1)], n


def features(docs: DataFrame, text: str, *keep: Column, most: int = BUCKETS) -> DataFrame:
    """The columns `keep` of every row, n_features, and own: the buckets of its runs as unsigned 16-bit numbers."""
    if most > 1 << 16:
        raise ValueError("at most 65,536 buckets")
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    kept = [c for c in rows.columns if c != "__text"]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("__text").cast(pa.large_binary()), 0
            while at < len(batch):
                own, size, start = [], 0, at
                while at < len(batch) and size < SLICE:
                    own.append(texts[at].as_py() or b"")
                    size += len(own[-1])
                    at += 1
                crc, n = hashed_runs(own)
                data = (crc % np.uint32(most)).astype("<u2").tobytes()
                ends = 2 * np.r_[0, np.cumsum(n)].astype(np.int32)
                columns = [batch.column(c).slice(start, at - start) for c in kept]
                columns += [pa.array(n, pa.int64()), pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_features", "own"])

    return rows.mapInArrow(trimmed(run), f"{schema + ', ' if kept else ''}n_features long, own binary")


def bucket_counts(scanned: DataFrame, most: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of a scanned table fall into each bucket; every task returns `most` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(most, np.int64)
        for batch in batches:
            for own in batch.column("own"):
                total += np.bincount(np.frombuffer(own.as_buffer(), "<u2"), minlength=most)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    return scanned.select("own").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, most: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket from the (bucket, n) of all documents and of the target: `most` numbers, at any size."""
    spark = source.sparkSession
    both = spark.range(most).withColumnRenamed("id", "bucket").join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    whole = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    s, t, all_s, all_t = (F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t"))
    gain = F.floor(1000 * F.log((t + 1) * (all_s + most) / ((s + 1) * (all_t + most))))
    found = np.zeros(most, np.int64)
    for r in both.crossJoin(whole).select("bucket", gain.alias("gain")).collect():  # one row of totals; `most` rows
        found[r["bucket"]] = r["gain"]
    return found


def weighted(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """A scanned table with weight (the floored mean gain of its features, 0 without any) in place of own."""
    shared = scanned.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket
    kept = [c for c in scanned.columns if c != "own"]
    schema = ", ".join(f"`{c}` {t}" for c, t in scanned.dtypes if c != "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column("own")]
            mean = pa.array([int(shared.value[x].sum()) // len(x) if len(x) else 0 for x in own], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], mean], names=[*kept, "weight"])

    return scanned.mapInArrow(trimmed(run), f"{schema}, weight long")


def drawn(rows: DataFrame, fits: Column, percent: int = PERCENT) -> DataFrame:
    """rows (doc_id, score and others) plus rank: 1, 2, 3... for the `percent` of fitting rows of highest score, else null.

    Equal scores are ordered by doc_id, null ids last. Scores are whole numbers of some ten thousand values, so their
    counts fit one task; documents are ordered inside their score only.
    """
    marked = rows.withColumn("__fits", F.coalesce(fits, F.lit(False)))
    counts = staged(marked.filter("__fits").groupBy("score").agg(F.count(F.lit(1)).alias("n")), "draw-counts")
    wanted = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100)
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    levels = staged(counts.select("score", before.alias("before"), wanted.alias("wanted")).filter("before < wanted"), "draw-levels")
    end = levels.agg(F.min("score")).first()[0]
    if end is None:
        return marked.withColumn("rank", F.lit(None).cast("long")).drop("__fits")
    high = F.col("__fits") & (F.col("score") >= end)
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last())).cast("long")
    level = levels.withColumnRenamed("score", "__score")
    ranked = marked.filter(high).withColumn("__place", place).join(F.broadcast(level), F.col("score") == F.col("__score"))  # a row for each score
    ranked = ranked.withColumn("__rank", F.col("before") + F.col("__place"))
    ranked = ranked.withColumn("rank", F.when(F.col("__rank") <= F.col("wanted"), F.col("__rank")))
    columns = [*rows.columns, "rank"]
    return ranked.select(*columns).unionByName(marked.filter(~high).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, n_features, weight, score and rank (null where not drawn).

    A null text has no words: no features, weight 0, never drawn (so has any text below least_words). A null doc_id is
    hashed as the empty text and comes last among ties; rows that repeat a doc_id share its random number and all take
    part. Other columns of docs are not read. An empty table gives no rows; an empty target has all gains from the
    documents alone.
    """
    own = staged(features(docs, text, F.col(doc_id).cast("long").alias("doc_id")), "draw-features")
    gain = gains(bucket_counts(own), bucket_counts(features(target, target_text)))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    luck = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scores = staged(weighted(own, gain).withColumn("score", F.col("weight") + luck), "draw-scores")
    # runs of 1 and 2 words: w words make 2 w - 1 features
    return drawn(scores, F.col("n_features") >= 2 * least_words - 1, percent)


def op11_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 in SQL: a table of 256 remainders, then one step for each byte of each distinct feature.
OP11_SQL = r"""
WITH bits AS (
  SELECT list(v ORDER BY b) AS remainders FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda acc, i: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b))
), texts AS (
  SELECT 1 AS side, item_id AS id, text FROM benchmark UNION ALL SELECT 0, doc_id, text FROM documents
), cut AS (
  SELECT row_number() OVER () AS row_no, side, id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
), runs AS (
  SELECT row_no, side, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM cut
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(feature)) + 1), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i - 1, 2))::BIGINT)),
    lambda acc, byte: xor(acc >> 8, remainders[(xor(acc, byte) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM runs), bits
), placed AS (
  SELECT row_no, side, bucket FROM runs JOIN hashed USING (feature)
), sums AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM placed GROUP BY bucket
), gained AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
), means AS (
  SELECT row_no, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM placed JOIN gained USING (bucket) WHERE side = 0 GROUP BY row_no
), scored AS (
  SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(words) AS words,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM cut LEFT JOIN means USING (row_no) WHERE side = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY words >= 20) AS fitting FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= fitting * 25 // 100 THEN place END AS rank FROM ranked
"""
