"""Importance resampling, spelling variants and the quality classifier on small tables, against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality, resampling, spelling
from ledgerloom.llm.common import held_out, labelled_sample

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def test_runs_are_hashed_as_by_plain_splitting():
    r = random.Random(1)
    texts = ["", "  ", "a", "a b", "A-b_C", "é" * 100 + " x " + "z" * 70, "x" * 64 + " " + "y" * 64, "a\x00b\x7fc퟿", "日本 語"]
    texts += ["".join(r.choice("aB9 .\n\té日") for _ in range(r.randrange(200))) for _ in range(300)]
    crc, n = resampling.hashed_runs([t.encode() for t in texts])
    at = np.r_[0, np.cumsum(n)]
    for k, t in enumerate(texts):
        assert sorted(crc[at[k] : at[k + 1]].tolist()) == sorted(zlib.crc32(f.encode()) for f in features(t)[0])
    assert [len(x) for x in resampling.hashed_runs([])] == [0, 0]


def drawn_by_hand(docs, target, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (collections.Counter(bucket(f) for x in texts for f in features(x)[0]) for texts in ([x for _, x in docs], target))
    rows = []
    for d, text in docs:
        own, words = features(text)
        gain = [math.floor(1000 * math.log((t[bucket(f)] + 1) * (s.total() + 10000) / ((s[bucket(f)] + 1) * (t.total() + 10000)))) for f in own]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(order[: len(order) * percent // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=str)


def test_draw_against_brute_force(spark, rows):
    r = random.Random(2)
    words = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta9"]
    docs = [(d, " ".join(r.choice(words) + r.choice(["", "", "x", "!"]) for _ in range(r.choice([0, 5, 30, 60])))) for d in range(200)]
    docs += [(500, None), (501, ""), (502, "a " * 30000), (None, "alpha " * 25)]
    target = ["alpha beta alpha beta " * 9, None, "", "épsilon"]
    df = spark.createDataFrame([(d, t, None, None, 7) for d, t in docs], DOCS).selectExpr("*", "1 AS weight", "2 AS score", "3 AS rank", "4 AS own", "5 AS __fits")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, least in ((25, 20), (100, 1), (0, 20)):
        got = resampling.resampled(df, goal, percent=percent, least_words=least)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert rows(got) == drawn_by_hand(docs, target, percent, least)
    assert resampling.resampled(df.filter("false"), goal).count() == 0
    assert resampling.resampled(df, goal.filter("false")).count() == len(docs)
    repeated = df.unionByName(df)
    ranks = sorted(x["rank"] for x in resampling.resampled(repeated, goal).filter("rank is not null").collect())
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == 2 * sum(features(t)[1] >= 20 for _, t in docs) // 4


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_by_hand(docs):
    count = collections.Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def variants_by_hand(n):
    form, n_near = {}, {}
    for w in n:
        own = [x for x in n if near(w, x)]
        n_near[w] = len(own)
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], n_near[w], n[form[w]] if form[w] else None))
    return sorted(out, key=str)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("letters,count", [("abé", 300), ("abcdefghijkl", 500)])
def test_variants_against_brute_force(spark, rows, monkeypatch, letters, count):
    r = random.Random(count)
    n = {"".join(r.choice(letters) for _ in range(r.randrange(5, 9))): r.choice([3, 4, 6, 13, 40, 99]) for _ in range(count)}
    n |= {"x" * 3000: 5, "x" * 2999: 12, "straße": 3, "strasse": 4, "naïve": 3, "naive": 8, "ÿÿÿÿÿ": 3}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    want = variants_by_hand(n)
    assert rows(spelling.variants(words), *COLUMNS) == want
    # many shards, and keys split into blocks of asking and listed words
    monkeypatch.setattr(spelling, "TOGETHER", 7)
    monkeypatch.setattr(spelling, "near_words", lambda w, f=spelling.near_words: f(w, shard=200, hot=30))
    assert rows(spelling.variants(words), *COLUMNS) == want


def test_counted_words_and_odd_rows(spark, rows):
    r = random.Random(4)
    docs = [(d, " ".join(r.choice(["Wörter", "wörter", "House", "houses", "hous3", "ÀÈÌÒÙ", "tiny", "o'clock"]) for _ in range(40))) for d in range(60)]
    docs += [(None, "House " * 50), (7, None), (8, ""), (9, "!!!"), (3, docs[3][1]), (11, "y" * 100_000 + " " + "y" * 100_000 + "\n" + "y" * 100_000)]
    df = spark.createDataFrame([(d, t, None, None, 7) for d, t in docs], DOCS).selectExpr("*", "1 AS word", "2 AS n", "3 AS run", "4 AS id", "5 AS h")
    want = words_by_hand(docs)
    words = spelling.counted_words(df)
    assert dict(rows(words, "word", "n")) == want
    assert rows(spelling.variants(words), *COLUMNS) == variants_by_hand(want)
    assert spelling.variants(spelling.counted_words(df.filter("false"))).count() == 0
    one = spark.createDataFrame([("alone", 3)], "word string, n long")
    assert rows(spelling.variants(one), *COLUMNS) == [("alone", None, "alone", 3, 0, None)]


def test_chains_of_forms_are_followed_by_doubling(spark, rows):
    """A chain of 40 forms takes few rounds; all words end at its last form."""
    chain = [(f"w{k:02}", f"w{k + 1:02}") for k in range(40)]
    got = rows(spelling.last_forms(spark.createDataFrame(chain, "word string, form string")), "word", "root")
    assert got == [(w, "w40") for w, _ in chain]


def spam(i):
    return " ".join(f"{w.upper()}!!" for w in ["buy", "cheap", "now", f"deal{i % 7}", "win"] * 6)


def prose(i):
    r = random.Random(i)
    return ". ".join(" ".join(r.choice(["the", "river", "runs", "over", "stone", "and", "moss", f"w{r.randrange(500)}"]) for _ in range(9)).capitalize() for _ in range(6)) + "."


def test_quality_learns(spark):
    data = [(i, spam(i) if i % 5 == 0 else prose(i), "en", "s", 1) for i in range(300)]
    docs = spark.createDataFrame(data, DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(300)] + [(None, 1, 1), (3, None, 1), (4, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(docs, labels)
    out = {x["doc_id"]: x["score"] for x in quality.scored(docs, model).collect()}
    assert all((out[i] >= 0.7) == (i % 5 != 0) for i in out)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0), (None, "a " * 50000, "en", "x", 3), (2, "", None, None, 0), (3, "x" * 200_000, None, None, 1), (4, "퟿\x00\n", None, None, 1)], DOCS).selectExpr("*", "9 AS x", "'a' AS score")
    got = quality.scored(odd, model)
    assert got.columns == odd.columns and got.filter("score between 0 and 1").count() == 6
    assert len({r["score"] for r in got.filter("doc_id in (1, 2)").collect()}) == 1  # null texts count as empty ones
    assert quality.scored(odd.filter("false"), model).count() == 0
    assert quality.learn(docs.filter("false"), labels).score(np.array([quality.measures("x")]))[0] == pytest.approx(0.8, abs=0.05)
    assert quality.learn(docs, labels.filter("quality = 1")).score(np.array([quality.measures("x")]))[0] > 0.9
    assert quality.learn(docs, labels.filter("false")).score(np.array([quality.measures("x")]))[0] == pytest.approx(0.5)


def test_quality_scores_are_sums_of_table_entries():
    """A score against plain look-ups, one measure and pair at a time; the loss falls with every further round of training."""
    r = np.random.default_rng(3)
    x = r.normal(size=(800, 5)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)  # an interaction that no single measure shows
    plain, _, _ = quality.boosted(x, y, 60, 0)
    model, losses, pair_losses = quality.boosted(x, y, 20, 60, (x, y))
    assert losses == sorted(losses, reverse=True) and pair_losses == sorted(pair_losses, reverse=True)
    assert (1, 0) in model.pairs and ((model.score(x) >= 0.5) == y).mean() > 0.95 > ((plain.score(x) >= 0.5) == y).mean()
    for row, score in zip(x[:50], model.score(x[:50])):
        place = lambda edges, k: sum(e <= row[k] for e in edges[k])
        z = model.bias + sum(t[place(model.edges, k)] for k, t in enumerate(model.tables))
        z += sum(t[place(model.pair_edges, i), place(model.pair_edges, j)] for (i, j), t in model.pairs.items())
        assert score == pytest.approx(1 / (1 + math.exp(-z)))


def test_trees_against_all_cuts():
    """The first cut of a tree is the best of all places; cells of a pair's tree hold their leaf's step."""
    r = np.random.default_rng(4)
    g, h = r.normal(size=9), r.uniform(1, 2, 9)
    value = lambda a, b: a.sum() ** 2 / (b.sum() + quality.RIDGE)
    gains = [value(g[:k], h[:k]) + value(g[k:], h[k:]) - value(g, h) for k in range(1, 9)]
    gain, at = quality._cut(g, h)
    assert gain == pytest.approx(max(gains)) and at == int(np.argmax(gains)) + 1
    steps = quality._leaves(g, h)
    for s in set(steps.tolist()):
        own = steps == s
        assert s == pytest.approx(g[own].sum() / (h[own].sum() + quality.RIDGE))
    grid, weight = r.normal(size=(4, 5)), r.uniform(1, 2, (4, 5))
    _, cells = quality._pair_leaves(grid, weight)
    for s in set(cells.ravel().tolist()):
        assert s == pytest.approx(grid[cells == s].sum() / (weight[cells == s].sum() + quality.RIDGE))
    assert len(set(cells.ravel().tolist())) <= 4


def test_quality_held_out(spark):
    """op13 on larger tables: held-out labels are found, and teach nothing."""
    where = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in quality.op13_quality(spark, where).filter("held_out").collect()}
    known = [(got[r["doc_id"]], r["quality"]) for r in spark.read.parquet(f"{where}/labels.parquet").collect() if r["doc_id"] in got and r["quality"] in (0, 1)]
    for label in (0, 1):
        right = [r["predicted"] == label for r, q in known if q == label]
        assert sum(right) >= 0.95 * len(right)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    samples = [sorted(map(tuple, labelled_sample(docs, x, "quality", 100)[0].collect())) for x in (labels, turned)]
    assert samples[0] == samples[1]
    twice = [sorted(map(tuple, labelled_sample(d, x, "quality", 100)[0].collect())) for d, x in ((docs, labels), (docs.unionByName(docs), labels.unionByName(labels)))]
    assert twice[0] == twice[1]


def test_near_pairs_of_one_shard_are_found_once():
    """Both searches together name each pair once, whatever letters repeat around the middle."""
    words = sorted({"aaaaa", "aaaaaa", "aaaaaaa", "aabaa", "aabbaa", "ababab", "babab", "bababa"})
    rows = pd.DataFrame({"word": words, "n": 3, "listed": True, "asks": True})
    total = collections.Counter()
    for side in (0, 1):
        for r in spelling._near_in_shard((side, "0"), rows).itertuples():
            total[r.word] += r.n_near
    assert total == {w: n for w in words if (n := sum(near(w, x) for x in words))}
