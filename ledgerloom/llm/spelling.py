"""Spelling variants: words one edit apart, found in FM-indexes, and the frequent form that each belongs to.

Two words one inserted, deleted or replaced letter apart share the first half of either or the second half, as one edit
cannot touch both. A search scheme of two searches follows: match the first half exactly and go on to the right, or the
second half exactly and go on to the left, each with one error allowed beyond the half. Both run on suffix-rank intervals
over a vocabulary between delimiters: one index reads words from right to left, the other reversed words, so that a search
never turns round. All words of a task search together in numpy arrays of intervals.

The vocabulary is no single index. A word is listed under the first and last letters that a searching word may have as
its exact half, and asks under its own halves; keys are dealt to shards of bounded size, and a key with more than HOT rows
is split into a grid of blocks, so that each asking word meets each listed word of its key in one block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table, trimmed_group

#: Letters of a word; A-Z are lowered first.
LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run whose hash this number divides loses a letter; least letters and occurrences of a word; a form is so much more frequent.
DAMAGE, SHORTEST, LEAST, FACTOR = 97, 5, 3, 2
#: Rows of a shard on the average; rows of one key beyond which it is split into blocks.
SHARD, HOT = 8192, 65_536
#: Hot keys (at most 4 rows a word / HOT of them) that are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 100_000
#: Words that search together.
TOGETHER = 4096


def counted_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", damage: int = DAMAGE, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): lower-case runs of letters of whole texts, with how often each occurs in all.

    Of a run whose crc32 with its doc_id is divisible by `damage` one letter is deleted first. Null texts have no runs; a
    null doc_id is hashed as the empty text; rows that repeat a doc_id all count.
    """
    found = F.regexp_extract_all(F.col(text).cast("string"), F.lit(LETTERS + "{%d,}" % shortest), F.lit(0))
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h, size = F.crc32(F.concat_ws(":", "id", "run")), F.length("run")
    at = (h % size).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, size))
    words = runs.select(F.when(h % damage == 0, less).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


class WordIndex:
    """FM-index of distinct words between delimiters; patterns are matched from their last symbol to their first."""

    def __init__(self, words: list[str]) -> None:
        sizes = np.array([len(w) for w in words])
        self.starts = np.cumsum(sizes + 1) - sizes - 1  # places of the delimiters
        n = int(sizes.sum()) + len(words)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.alphabet, own = np.unique(letters, return_inverse=True)
        text = np.zeros(n, np.int64)  # a word ends where the next delimiter is, the last one at the first
        text[np.delete(np.arange(n), self.starts)] = own + 1
        # order of all rotations, by doubling their compared length; distinct words make them distinct
        rank, width, place = text, 1, np.arange(n)
        while True:
            key = rank * (n + 1) + rank[(place + width) % n]
            self.order = np.argsort(key, kind="stable")
            key = key[self.order]
            step = np.cumsum(np.r_[0, key[1:] != key[:-1]])
            rank = np.empty(n, np.int64)
            rank[self.order] = step
            if step[-1] == n - 1:
                break
            width *= 2
        self.n, self.before = n, text[self.order - 1]
        self.rows = np.sort(self.before * n + place)  # place among these = first rotations with the symbol + those above the row

    def codes(self, letters: np.ndarray) -> np.ndarray:
        """Symbols (from 1) of letters; -1 for letters of no word."""
        at = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == letters, at + 1, -1)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the rotations that go on to the left with a symbol (empty for -1)."""
        base = symbol * self.n
        first = np.searchsorted(self.rows, base + low)
        return first, np.where(symbol < 0, first, np.searchsorted(self.rows, base + high))

    def onward(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every (interval number, symbol, low, high) that goes on to the left with some letter."""
        size, sigma = high - low, len(self.alphabet)
        wide, narrow = np.flatnonzero(size > sigma), np.flatnonzero(size <= sigma)
        owner = np.repeat(narrow, size[narrow])
        row = np.arange(len(owner)) + np.repeat(low[narrow] - np.cumsum(size[narrow]) + size[narrow], size[narrow])
        seen = np.unique(owner * (sigma + 1) + self.before[row])
        owner = np.r_[seen // (sigma + 1), np.repeat(wide, sigma)]
        symbol = np.r_[seen % (sigma + 1), np.tile(np.arange(1, sigma + 1), len(wide))]
        owner, symbol = owner[symbol > 0], symbol[symbol > 0]
        first, last = self.step(symbol, low[owner], high[owner])
        some = first < last
        return owner[some], symbol[some], first[some], last[some]


def one_edit(index: WordIndex, patterns: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (pattern number, word number) that are one edit apart and equal in the pattern's last exact[i] letters."""
    sizes = np.array([len(p) for p in patterns])
    ends = np.cumsum(sizes)
    codes = index.codes(np.frombuffer("".join(patterns).encode("utf-32-le"), "<u4"))
    q = np.arange(len(patterns))
    low, high = np.zeros(len(q), np.int64), np.full(len(q), len(index.starts))  # rotations that begin with the delimiter
    for k in range(int(exact.max(initial=0))):
        on = np.flatnonzero(exact[q] > k)
        low[on], high[on] = index.step(codes[ends[q[on]] - 1 - k], low[on], high[on])
        alive = low < high
        q, low, high = q[alive], low[alive], high[alive]
    q1 = low1 = high1 = np.empty(0, np.int64)  # states that have spent their error
    found = []
    left = sizes - exact  # letters of each pattern beyond its exact part
    for k in range(int(left.max(initial=0)) + 1):
        # an extra letter of the word
        owner, symbol, first, last = index.onward(low, high)
        q1, low1, high1 = np.r_[q1, q[owner]], np.r_[low1, first], np.r_[high1, last]
        done = left[q1] == k
        first1, last1 = index.step(np.zeros(done.sum(), np.int64), low1[done], high1[done])
        found.append((q1[done][first1 < last1], first1[first1 < last1]))
        # states with letters left take the next one
        go, go1 = left[q] > k, ~done
        replaced = go[owner]
        owner, symbol, first, last = owner[replaced], symbol[replaced], first[replaced], last[replaced]
        letter = codes[np.maximum(ends[q] - 1 - exact[q] - k, 0)]
        other = symbol != letter[owner]
        letter1 = codes[ends[q1[go1]] - 1 - exact[q1[go1]] - k]
        same_low, same_high = index.step(letter1, low1[go1], high1[go1])
        # the same letter after the error; another letter of the word; a letter that the word lacks
        q1 = np.r_[q1[go1], q[owner[other]], q[go]]
        low1, high1 = np.r_[same_low, first[other], low[go]], np.r_[same_high, last[other], high[go]]
        alive = low1 < high1
        q1, low1, high1 = q1[alive], low1[alive], high1[alive]
        low, high = index.step(letter[go], low[go], high[go])
        q = q[go][low < high]
        low, high = low[low < high], high[low < high]
    pattern, row = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    word = np.searchsorted(index.starts, index.order[row])
    pair = np.unique(pattern * (len(index.starts) + 1) + word)
    return pair // (len(index.starts) + 1), pair % (len(index.starts) + 1)


def _near_in_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each asking word of a shard: how many listed words are near by this side's search, and the most frequent."""
    first_half = key[0] == 0
    listed = rows[rows["listed"]].drop_duplicates("word").sort_values("word")
    words, n = listed["word"].tolist(), listed["n"].to_numpy()
    asking = rows.loc[rows["asks"], "word"].unique().tolist()
    out: list[tuple[str, int, int, str]] = []
    index = WordIndex([w[::-1] for w in words] if first_half else words) if words and asking else None
    for i in range(0, len(asking) if index else 0, TOGETHER):
        few = asking[i : i + TOGETHER]
        half = np.array([len(w) // 2 for w in few])
        a, b = one_edit(index, [w[::-1] for w in few], half) if first_half else one_edit(index, few, np.array([len(w) for w in few]) - half)
        if not first_half:  # pairs that share the first half too are the other search's
            own = np.array([few[x][: half[x]] != words[y][: half[x]] for x, y in zip(a.tolist(), b.tolist())], bool)
            a, b = a[own], b[own]
        order = np.lexsort((b, -n[b], a))  # listed words are in code-point order
        a, b = a[order], b[order]
        best = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])[: len(a)]
        out += [(few[a[x]], int(y), int(n[b[x]]), words[b[x]]) for x, y in zip(best, np.diff(np.r_[best, len(a)]))]
    return pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(word, n_near, best_n, best) of the distinct words (word, n, at least 4 letters) that have a near one.

    best is the near word of largest n, of these the first by code point.
    """
    size, word = F.length("word"), F.col("word")
    heads = F.array_distinct(F.transform(F.array(size - 1, size, size + 1), lambda k: F.floor(k / 2).cast("int")))
    tails = F.array_distinct(F.transform(F.array(size - 1, size, size + 1), lambda k: F.ceil(k / 2).cast("int")))
    keys = lambda side, ks: F.transform(ks, lambda k: F.struct(F.lit(side).alias("side"), k.alias("k")))
    rows = words.select("word", "n", F.explode(F.concat(keys(0, heads), keys(1, tails))).alias("x")).select("word", "n", "x.*")
    half = F.when(F.col("side") == 0, F.floor(size / 2)).otherwise(F.ceil(size / 2))
    key = F.when(F.col("side") == 0, F.substring(word, F.lit(1), F.col("k"))).otherwise(F.substring(word, size - F.col("k") + 1, F.col("k")))
    rows = rows.select("side", key.alias("key"), "word", "n", (F.col("k") == half).alias("asks"))
    shards = max(1, -(-4 * words.count() // shard))
    split = staged(rows.groupBy("side", "key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot).select("side", "key", F.ceil(F.col("rows") / hot).cast("int").alias("parts")), "spelling-hot")
    many = split.count()
    rows = rows.join(F.broadcast(split) if many <= BROADCAST_KEYS else split, ["side", "key"], "left") if many else rows.withColumn("parts", F.lit(None).cast("int"))
    own, every = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"), F.sequence(F.lit(0), F.col("parts") - 1)
    block = lambda x, y, listed, asks: F.struct(F.concat_ws("-", "key", x, y).alias("shard"), listed.alias("listed"), asks.alias("asks"))
    yes, no = F.lit(True), F.lit(False)
    whole = F.array(F.struct(F.pmod(F.xxhash64("side", "key"), F.lit(shards)).cast("string").alias("shard"), yes.alias("listed"), F.col("asks").alias("asks")))
    listed = F.transform(every, lambda y: block(own, y, yes, no))
    asking = F.when(F.col("asks"), F.transform(every, lambda x: block(x, own, no, yes))).otherwise(F.array().cast("array<struct<shard:string,listed:boolean,asks:boolean>>"))
    placed = rows.select("side", "word", "n", F.explode(F.when(F.col("parts").isNull(), whole).otherwise(F.concat(listed, asking))).alias("x")).select("side", "word", "n", "x.*")
    schema = "word string, n_near long, best_n long, best string"
    met = placed.groupBy("side", "shard").applyInPandas(trimmed_group(_near_in_shard), schema)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("x")).select("word", "n_near", (-F.col("x.n")).alias("best_n"), F.col("x.word").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each word's chain of forms, by doubling jumps.

    A form is more frequent than its word, so chains have no cycles and at most log2(largest n) steps.
    """
    jumps = forms.select("word", F.col("form").alias("root"))
    while True:
        jumps = staged(jumps, "spelling-jumps")
        onward = jumps.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        if jumps.join(onward, F.col("root") == F.col("__word"), "left_semi").isEmpty():
            return jumps
        jumps = jumps.join(onward, F.col("root") == F.col("__word"), "left").select("word", F.coalesce("__root", "root").alias("root"))


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n for the distinct words (word, n).

    form is the near word of largest n (ties: the first by code point) if its n is at least factor times the word's, else
    null with form_n; root is the last of the chain of forms, the word itself without one; n_near is 0 without near words.
    An empty table gives no rows.
    """
    near = near_words(words)
    full = staged(words.join(near, "word", "left"), "spelling-near")
    is_form = F.col("best_n") >= factor * F.col("n")
    full = full.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    roots = last_forms(full.filter("form is not null"))
    return full.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(staged(counted_words(table(spark, sf_dir, "documents")), "spelling-words"))


#: crc32 in SQL: a table of 256 remainders, then one step for each byte; near words by one left-out or one open letter.
OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT list(v ORDER BY b) AS remainders FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda acc, i: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b))
), found AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{5,}')) AS run FROM documents
), runs AS (
  SELECT id || run AS key, run, count(*) AS n FROM found GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(key)) + 1), lambda i: ('0x' || substr(hex(encode(key)), 2 * i - 1, 2))::BIGINT)),
    lambda acc, byte: xor(acc >> 8, remainders[(xor(acc, byte) & 255) + 1])), 4294967295) AS h
  FROM runs, bits
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), cut AS (
  SELECT word, left(word, i - 1) || substr(word, i + 1) AS less, left(word, i - 1) || '_' || substr(word, i + 1) AS mask FROM places
), near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (mask) WHERE a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.less = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.less = w.word
), best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS form, max(o.n) AS form_n FROM near JOIN words o ON o.word = other GROUP BY 1
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.form_n >= 2 * w.n THEN form END AS form, CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), walk AS (
  SELECT word, coalesce(form, word) AS root FROM forms
  UNION SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NOT NULL
), ends AS (
  SELECT walk.word, walk.root FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
