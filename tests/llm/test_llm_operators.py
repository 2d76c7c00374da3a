"""Every operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out, labelled_sample
from ledgerloom.llm import exact_dedup, html_text, knn, language, licences, line_dedup, minhash, mixing, pieces, toxicity

DIR = "/root/testdata/sf0.001"
WORDS = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "green", "seven", "light", "paper", "horse", "table", "music", "water"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators might use inside.
CLASH = "size int, rank int, score int, n int, row_no int, class int, bucket int, line int, key int, band int, target int, flag int"


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty texts, one long text, copies, a repeated row."""
    base = prose(1)
    data = [
        (0, base, "en", "a", 1), (1, base + " \n", "en", "a", 1), (2, base.replace(" ", "  "), "en", None, 1), (3, None, None, None, None), (4, "", "en", "b", 0),
        (5, " \t\n", None, "b", 3), (6, prose(2, 20000), "en", "b", None), (7, prose(3), "en", "a", 9), (7, prose(3), "en", "a", 9), (None, prose(4), "en", "a", 9),
        (None, None, None, None, None), (9, "!!! 123 ...", "en", "c", 2), (10, prose(1, 59) + " other", "en", "c", 2),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    for c in CLASH.split(", "):
        df = df.selectExpr("*", f"7 AS {c.split()[0]}")
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_groups(odd, empty):
    got = exact_dedup.duplicate_groups(odd).collect()
    data = [(r["doc_id"], r["text"]) for r in odd.collect()]
    groups = collections.defaultdict(list)
    for d, t in data:
        groups[strip(t)].append((-len(t or ""), d is None, d or 0))
    assert len(got) == len(data)
    for r in got:
        own = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        first = min(own)
        assert (r["group_size"], r["keep_id"]) == (len(own), None if first[1] else first[2])
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_dedup.duplicate_groups(empty).count() == 0


def test_exact_dedup_rows(odd, empty):
    out = exact_dedup.exact_dedup(odd)
    assert out.columns == odd.columns
    assert len({strip(r["text"]) for r in odd.collect()}) == out.count() == len({strip(r["text"]) for r in out.collect()})
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_filter_is_safe(spark):
    """Every repeated digest is flagged, however full the filter is."""
    df = spark.range(4000).selectExpr("sha2(cast(id % 3000 as string), 256) AS h", "id")
    for bits in (1 << 15, 1 << 18):
        flagged = exact_dedup.possibly_repeated(df, "h", exact_dedup.repeat_filter(df, "h", bits), bits, "maybe")
        assert flagged.filter("id % 3000 < 1000 and not maybe").count() == 0
    assert flagged.filter("not maybe").count() > 1500


def test_exact_dedup_with_a_filter_beyond_broadcast(spark, odd, monkeypatch):
    """The same rows whether the filter is broadcast or joined block by block."""
    groups, rows = (sorted(map(str, f(odd).collect())) for f in (exact_dedup.duplicate_groups, exact_dedup.exact_dedup))
    monkeypatch.setattr(exact_dedup, "BROADCAST_BITS", 1 << 10)
    assert (groups, rows) == tuple(sorted(map(str, f(odd).collect())) for f in (exact_dedup.duplicate_groups, exact_dedup.exact_dedup))
    assert exact_dedup.filter_bits(1 << 30) == 1 << 34


@pytest.mark.parametrize("block, size", [(512, 1 << 23), (50, 1 << 23), (512, 20_000)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block, size):
    """Classes and numbers of links, with the crowded class in one task and dealt over blocks by rows or by bytes."""
    monkeypatch.setattr(minhash, "LINK_BLOCK", block)
    monkeypatch.setattr(minhash, "LINK_BYTES", size)
    r = random.Random(5)
    data, base = [], [w for w in prose(10, 150).split()]
    for k in range(160):  # one crowded group whose copies differ from each other more than from the original
        own = list(base)
        for _ in range(r.randrange(9)):
            own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
        data.append((k, " ".join(own)))
    data += [(1000 + k, prose(k + 50, r.choice([1, 3, 5, 40]))) for k in range(40)]
    data += [(2000 + k, data[k][1].upper()) for k in range(0, 160, 7)] + [(3000, None), (3001, ""), (3002, "")]
    got = {x["doc_id"]: (x["class_id"], x["class_size"], x["n_links"]) for x in minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()}
    bags = {}
    for d, t in data:
        w = (t or "").lower().split()
        bags[d] = collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    root = {d: d for d in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    same = {d: min((e for e in bags if bags[e] == bags[d]), default=d) if bags[d] else d for d in bags}
    linked = collections.defaultdict(set)
    for a, b in itertools.combinations(bags, 2):
        if bags[a] and bags[b] and 5 * sum((bags[a] & bags[b]).values()) >= 4 * sum((bags[a] | bags[b]).values()):
            x, y = sorted((find(a), find(b)))
            root[y] = x
            if same[a] != same[b]:
                linked[a].add(same[b])
                linked[b].add(same[a])
    sizes = collections.Counter(map(find, bags))
    assert sum(map(len, linked.values())) > 1000  # the fixture has many links, not all of a class
    assert got == {d: (find(d), sizes[find(d)], len(linked[d])) for d in bags}


def test_links_of_by_hand():
    own = [np.array(x, np.uint32) for x in ([1, 2, 3, 4, 5], [1, 2, 3, 4], [1, 1, 2, 3, 4], [7], [1, 2, 3, 4, 5], [7, 7])]
    side = np.array([0, 0, 1, 1, 0, 0])
    assert minhash.links_of(own, np.zeros(6, int), False, 0.8).tolist() == [2, 3, 1, 0, 2, 0]
    assert minhash.links_of(own, side, True, 0.8).tolist() == [0, 1, 1, 0, 0, 0]
    assert minhash.links_of(own, side, False, 0.8).tolist() == [2, 2, 0, 0, 2, 0]


def test_near_dedup_rows(odd, empty):
    out = minhash.near_dedup(odd)
    assert out.columns == odd.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 0 in ids and not {1, 2} & set(ids) and ids.count(None) == 2 and {3, 4, 5, 6} <= set(ids)
    assert minhash.near_dedup(empty).count() == 0


def test_near_dedup_of_repeated_ids(spark):
    """Rows that repeat a doc_id with different texts stay or go together."""
    a, b = prose(1, 80), prose(2, 80)
    df = spark.createDataFrame([(1, a), (2, a + " more"), (2, b), (3, prose(3, 80)), (3, prose(4, 80)), (None, a)], "doc_id long, text string")
    assert sorted((r["doc_id"] for r in minhash.near_dedup(df).collect()), key=str) == [1, 3, 3, None]


def test_dart_signatures_estimate_similarity():
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 400, dtype=np.uint64)
    base = np.r_[base, base[:100]]
    for share in (0.05, 0.2, 0.5):
        diffs = []
        for _ in range(20):
            other = base.copy()
            k = int(len(base) * share)
            other[r.choice(len(base), k, replace=False)] = r.integers(0, 2**63, k, dtype=np.uint64)
            a, b = minhash.signatures([base, other])
            diffs.append((a == b).mean() - minhash.similarity(np.sort(base), np.sort(other)))
        assert abs(np.mean(diffs)) < 0.03
    assert (minhash.signatures([np.empty(0, np.uint64)]) == np.iinfo(np.uint64).max).all()


def _vectors(spark, n, dim, seed, copies=0):
    r = np.random.default_rng(seed)
    data = [(i, [float(x) for x in r.normal(size=dim)]) for i in range(n)] + [(n + i, [0.5] * dim) for i in range(copies)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>"), data


def test_knn_against_brute_force(spark):
    df, data = _vectors(spark, 300, 8, 1, copies=40)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn.top_k(df, df.filter("vec_id % 50 = 0")).collect()}
    v = {i: np.floor(np.array(x) * 256).astype(int) for i, x in data}
    want = {}
    for q in [i for i in v if i % 50 == 0]:
        best = sorted((-int(v[q] @ v[i]), i) for i in v if i != q)[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want


@pytest.mark.parametrize("rows, spread, share", [(3000, 0.02, 0.3), (600, 5.0, 1.0)])
def test_knn_of_clusters_sends_little(spark, monkeypatch, rows, spread, share):
    """Clusters of unequal norms: result by brute force; clustered data go to few blocks, scattered data wherever needed."""
    monkeypatch.setattr(knn, "QUERY_BLOCK", 8)
    monkeypatch.setattr(knn, "DATA_BLOCK", 500)
    monkeypatch.setattr(knn, "SCORES", 4000)
    seen = []
    monkeypatch.setattr(knn, "_sent", lambda *a, f=knn._sent: seen.append(f(*a)) or seen[-1])
    r = np.random.default_rng(7)
    centres = r.normal(size=(12, 6)) * r.uniform(1, 6, (12, 1))
    data = [(i, [float(x) for x in centres[i % 12] + spread * r.normal(size=6)]) for i in range(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in knn.top_k(df, df.filter("vec_id % 50 = 0")).collect()}
    v = np.array([np.floor(np.array(x) * 256) for _, x in data]).astype(int)
    want = {}
    for q in range(0, rows, 50):
        score = v @ v[q]
        best = sorted((-int(score[i]), i) for i in range(rows) if i != q)[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    blocks = len({x["block"] for x in seen[0].select("block").distinct().collect()})
    assert blocks > 1 and seen[0].count() <= share * rows * blocks


def test_knn_odd_rows(spark):
    bad = [(0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0]), (None, [1.0, 1.0]), (3, [])]
    df = spark.createDataFrame(bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS cell", "3 AS d")
    assert [tuple(r) for r in knn.top_k(df, df.filter("vec_id % 50 = 0")).collect()] == [(0, 1, 1, 256 * 768 + 512 * 256)]
    none = df.filter("vec_id < 0")
    assert knn.top_k(none, none).count() == 0


def test_language_profiles(spark, odd, empty):
    de = "der die und ist nicht das ein auf mit sich des dem zu den von wird werden einen schule strasse freund"
    en = "the and is not that a on with itself of to from will become one school street friend this have"
    r = random.Random(1)
    data = [(i, " ".join(r.choice(x.split()) for _ in range(40)), n, "s", 1) for i in range(80) for n, x in (("de", de), ("en", en))]
    profiles = language.learn_profiles(spark.createDataFrame(data, SCHEMA))
    out = language.identified(spark.createDataFrame(data, SCHEMA), profiles)
    assert out.filter("lang <> lang_pred").count() == 0 and out.filter("score < 0 or score > 1").count() == 0
    odd_out = {(x["doc_id"], x["text"]): x["lang_pred"] for x in language.identified(odd.withColumn("lang_pred", F.lit("x")), profiles).collect()}
    assert odd_out[(3, None)] == odd_out[(4, "")] == odd_out[(9, "!!! 123 ...")] == "und"
    replaced = language.identified(odd, profiles)
    assert set(replaced.columns) == {*odd.columns, "lang_pred"} and dict(replaced.dtypes)["score"] == "double"
    nothing = language.learn_profiles(empty)
    assert nothing.languages == [] and nothing.predict("words") == ("und", 0.0)
    assert language.identified(empty, profiles).count() == 0


def _plain_grams(text):
    """n-grams of one to three characters of the words (runs of letters and marks) with a blank at both ends, by a plain loop."""
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split()
    count = collections.Counter()
    if not any(unicodedata.category(c)[0] == "L" for w in words for c in w):
        return []
    joined = f" {' '.join(words)} "
    for i in range(len(joined)):
        for n in (1, 2, 3):
            g = joined[i : i + n]
            if len(g) == n and g != " " and not (n == 3 and g[1] == " "):
                count[g] += 1
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    return [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], code(x[0])))]


def test_language_against_brute_force(spark):
    """op4 on the smallest tables: profiles, distances and scores by plain loops; held-out rows teach nothing."""
    docs = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "lang").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in docs}
    count = collections.defaultdict(collections.Counter)
    for d, t, name in docs:
        if t is not None and name is not None and not held[d]:
            words = collections.Counter()
            joined = f" {' '.join(''.join(c if unicodedata.category(c)[0] in 'LM' else ' ' for c in t.lower()).split())} "
            for i in range(len(joined)):
                for n in (1, 2, 3):
                    g = joined[i : i + n]
                    if len(g) == n and g != " " and not (n == 3 and g[1] == " "):
                        words[g] += 1
            count[name].update(words)
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    rank = {name: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:400])} for name, c in count.items()}
    got = {r["doc_id"]: r for r in language.op4_language_id(spark, DIR).collect()}
    assert len(got) == len(docs)
    right = []
    for d, t, name in docs:
        own = _plain_grams(t or "")[:400]
        off = {x: sum(abs(k - ranks[g]) if g in ranks else 400 for k, g in enumerate(own)) for x, ranks in rank.items()}
        best = min(sorted(off), key=off.get)
        assert (got[d]["lang_pred"], got[d]["held_out"]) == (best if own else "und", held[d])
        assert got[d]["score"] == pytest.approx(1 - off[best] / (400 * len(own)) if own else 0.0)
        if held[d]:
            right.append(best == name)
    assert sum(right) / len(right) > 0.95


def test_language_held_out_rows_teach_nothing(spark):
    """Wrong labels of held-out rows change no prediction."""
    r = random.Random(3)
    data = [(i, " ".join(r.choice(("der die das und ist", "the and of that is")[i % 2].split()) for _ in range(30)), ("de", "en")[i % 2]) for i in range(200)]
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    shown = []
    for changed in (False, True):
        rows = [(d, t, "xx" if changed and held(d) else name, "s", 1) for d, t, name in data]
        profiles = language.learn_profiles(spark.createDataFrame(rows, SCHEMA).filter(~held_out(F.col("doc_id"))))
        shown.append((profiles.languages, profiles.gram.tolist(), profiles.rank.tolist()))
    assert shown[0] == shown[1]


def test_language_letters():
    """Numbers that are no digits are no letters; marks belong to their words."""
    assert all(len(language.gram_counts(t)[0]) == 0 for t in ("½ ² ٣ Ⅷ", "_ 12 !", "\u0301", ""))
    words = {"".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0) if g >> s & 0x1FFFFF) for g in language.gram_counts("हिन्दी")[0].tolist()}
    assert "हिन" in words and " हि" in words and "दी " in words


def test_language_grams_by_hand():
    grams, counts = language.gram_counts("Ab, ab!")
    text = {"".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0) if g >> s & 0x1FFFFF): n for g, n in zip(grams.tolist(), counts.tolist())}
    assert text == {"a": 2, "b": 2, " a": 2, "ab": 2, "b ": 2, " ab": 2, "ab ": 2}


def _brute_licences(text):
    """{line: {template: score}} of lines, whole text and all passages, by plain sets; passages by anchor are among all."""
    lines = (text or "").split("\n")
    units = [(i, x) for i, x in enumerate(lines)] + ([(-1, text)] if len(lines) > 1 else [])
    found = collections.defaultdict(dict)
    for line, unit in units:
        own = set(licences.template_bigrams(unit))
        for k, (_, t) in enumerate(licences.TEMPLATES):
            theirs = set(licences.template_bigrams(t))
            score = 2 * len(own & theirs) / (len(own) + len(theirs)) if own else 0
            if score >= 0.8:
                found[line][k] = score
    placed = [(w, i) for i, x in enumerate(lines) for w in licences.template_words(x)]
    for k, (_, t) in enumerate(licences.TEMPLATES):
        n, theirs = len(licences.template_words(t)), set(licences.template_bigrams(t))
        for gram, template, at, _ in licences.anchors(0.8, licences.TEMPLATES):
            for pos in range(len(placed) - 1):
                if template == k and f"{placed[pos][0]} {placed[pos + 1][0]}" == gram:
                    first = max(0, pos - at)
                    run = placed[first : pos - at + n]
                    own = {f"{a[0]} {b[0]}" for a, b in zip(run, run[1:])}
                    score = 2 * len(own & theirs) / (len(own) + len(theirs))
                    if score >= 0.8:
                        found[run[0][1]][k] = max(score, found[run[0][1]].get(k, 0))
    return found


def test_licences_against_brute_force(spark, odd, empty):
    texts = ["Released under the MIT License.", "x\nLicensed under the Apache License, Version 2.0!\ny", "all RIGHTS reserved", "All rights", None, "", "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3."]
    full = next(t for name, t in licences.TEMPLATES if name == "BSD-3-Clause" and len(t) > 1000).split()
    wrapped = "\n".join("# " + " ".join(full[i : i + 11]) for i in range(0, len(full), 11))
    texts += ["def f():\n" + wrapped + "\n" + prose(3, 500).replace("1", "\n"), "(c) 2023 Acme. All rights reserved.", prose(1, 80) + " " + texts[0] + " " + prose(2, 80), " ".join(full[30:])]
    mit = next(t for name, t in licences.TEMPLATES if name == "MIT" and len(t) > 1000).replace("Permission is hereby granted", "Permission is kindly granted")
    texts.append("MIT License\nCopyright (c) 2020 Someone\n\n" + mit.replace(". ", ".\n") + "\nimport os\n" * 80)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS licence", "1 AS line", "2 AS template", "3 AS grams", "4 AS own")
    got = {r["doc_id"]: (r["licence"], r["line"], r["n_matches"]) for r in licences.scanned(df).collect()}
    assert {k: got[k] for k in range(7)} == {0: ("MIT", 0, 1), 1: ("Apache-2.0", 1, 2), 2: ("LicenseRef-proprietary", 0, 1), 3: (None, None, 0), 4: (None, None, 0), 5: (None, None, 0), 6: ("GPL-3.0", 1, 2)}
    assert got[7][:2] == ("BSD-3-Clause", 1) and got[8][0] == "LicenseRef-proprietary" and got[9][0] == "MIT" and got[11][:2] == ("MIT", 3)
    matches = collections.defaultdict(lambda: collections.defaultdict(dict))
    for r in licences.licence_matches(df).collect():
        matches[r["doc_id"]][r["line"]][r["template"]] = r["score"]
    for k, t in enumerate(texts):
        want = _brute_licences(t)
        assert {line: {x: pytest.approx(v) for x, v in own.items()} for line, own in want.items()} == matches[k], k
    assert licences.scanned(odd).count() == odd.count() and licences.scanned(empty).count() == 0
    units = [t for t in texts if t] + [" ".join(licences.TEMPLATES[3][1].split()[:5] + ["now"])]
    for t in units:
        for line in t.split("\n"):
            own = set(licences.template_bigrams(line))
            for _, template in licences.TEMPLATES:
                theirs = set(licences.template_bigrams(template))
                if own and 2 * len(own & theirs) >= 0.8 * (len(own) + len(theirs)):
                    low, high = licences.bounds(len(theirs), 0.8)
                    assert low <= len(own) <= high


PAGE = """<!DOCTYPE html><html><head><title>Not text</title><script>var a = "<p>no</p>";</script><style>p{}</style></head><body><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy things now, they are good.</div><article><h1>The &amp; title</h1><p>First   paragraph with <b>bold</b>
and <a href="x">linked</a> words, long enough to be prose.</p><p>Second one &#8212; also with words.</p></article><footer>&copy; someone</footer></body></html>"""


def test_html_blocks():
    found = html_text.blocks(PAGE)
    assert [t for _, t, _ in found] == ["One", "Two", "Buy things now, they are good.", "The & title", "First paragraph with bold and linked words, long enough to be prose.", "Second one — also with words.", "© someone"]
    assert html_text.blocks(None) == html_text.blocks("") == html_text.blocks("<script>x") == []
    assert [p[-1] for p, _, _ in html_text.blocks("<p><b>a<br><p>b<li>c<li>d")] == ["p", "p", "li", "li"]


def test_html_inline_surroundings_are_blocks():
    """An advert inside a paragraph is a block of its own, the paragraph stays whole; styled words stay inside."""
    texts = lambda page: [(t, p[-1]) for p, t, _ in html_text.blocks(page)]
    assert texts("<p>One <span class='ad'>buy <span>now</span> here</span> two <b class='x'>three</b>.</p><p>Four</p>") == [("buy now here", "span ad"), ("One two three.", "p"), ("Four", "p")]
    assert texts("<div><p>One <ins class=adsbygoogle>no</ins></p><p>a <em id=ad>left open</p><p>b</p></div>") == [("One no", "p"), ("left open", "em ad"), ("a", "p"), ("b", "p")]


def test_html_training_pages_do_not_depend_on_order(spark):
    data = [(i % 40, "u", f"<p>page {i}</p>") for i in range(400)] + [(1, "u", "<p>page 1</p>"), (None, "u", "<p>x</p>"), (2, "u", None), (3, "u", "")]
    schema = "page_id long, url string, html string"
    one = html_text.training_pages(spark.createDataFrame(data, schema))
    two = html_text.training_pages(spark.createDataFrame(data[::-1], schema).repartition(7))
    assert one == two and len(one) == html_text.TRAIN_PAGES


def test_html_labels_against_plain_loops():
    """main_text against an LSTM of plain loops over single numbers, and blocks of several pages together or alone."""
    model = html_text.fit([PAGE] * 3)
    found = html_text.blocks(PAGE)
    x = html_text.Vectors().page(found).astype(float)
    out = {}
    for way, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        w, bias, n = model.p[f"W{way}"].astype(float), model.p[f"b{way}"].astype(float), html_text.HIDDEN
        h, c = [0.0] * n, [0.0] * n
        for t in order:
            z = [bias[k] + sum(v * w[i, k] for i, v in enumerate([*x[t], *h])) for k in range(4 * n)]
            gate = [1 / (1 + math.exp(-v)) for v in z[: 3 * n]]
            c = [gate[n + k] * c[k] + gate[k] * math.tanh(z[3 * n + k]) for k in range(n)]
            h = [gate[2 * n + k] * math.tanh(c[k]) for k in range(n)]
            out[way, t] = h
    score = [sum(v * model.p["V"][k, 0] for k, v in enumerate(out["f", t] + out["b", t])) + model.p["c"][0] for t in range(len(x))]
    want = "\n".join(found[t][1] for t in range(len(x)) if score[t] > 0)
    pages = [PAGE, "<p>a</p>", None, PAGE.replace("First", "Other")]
    assert html_text.main_text(pages, model, html_text.Vectors())[0] == want == html_text.main_text([PAGE], model, html_text.Vectors())[0]


def test_html_query_on_unseen_pages(spark):
    """op6 on the smallest tables: texts of the article's own tags, and repeats of the whole query are equal."""
    got = {r["page_id"]: r["text"] for r in html_text.op6_html_text(spark, DIR).collect()}
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    assert got.keys() == pages.keys()
    right = total = 0
    for p, t in got.items():
        for path, text, _ in html_text.blocks(pages[p]):
            label = html_text.tag_label(path)
            if label is not None:
                right += (text in t.split("\n")) == (label == 1)
                total += 1
    assert total > 200 and right / total > 0.98


def test_html_extraction(spark):
    model = html_text.fit([PAGE] * 3)
    data = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (3, "u", ""), (4, "u", "<p>" + prose(1, 30000) + ".")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "1 AS path", "2 AS z")
    got = html_text.extracted(df, model).collect()
    one = next(r for r in got if r["page_id"] == 1)
    assert one["text"] == "The & title\nFirst paragraph with bold and linked words, long enough to be prose.\nSecond one — also with words." and one["n_chars"] == len(one["text"])
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] in (2, 3)] == [("", 0)] * 3
    assert html_text.extracted(df.filter("page_id > 9"), model).count() == 0


def test_html_labeller_learns_other_layouts():
    model = html_text.fit([PAGE] * 3)
    r, right, total = random.Random(123), 0, 0
    for _ in range(120):
        page, label = html_text._layouts([prose(k) for k in range(10)], r)
        x, mask = html_text.padded([html_text.Vectors().page(page)])
        right += int(((model.scores(x, mask)[:, 0] > 0) == (np.array(label) == 1)).sum())
        total += len(label)
    assert right / total > 0.95


def test_lstm_gradients():
    r = np.random.default_rng(0)
    model = html_text.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = r.normal(size=(5, 2, html_text.WIDTH)), np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], float)
    weight = r.normal(size=(5, 2, html_text.HIDDEN))

    def loss():
        return float((model._pass(x, mask, "b", None).astype(np.float64) * weight).sum())

    kept, grad = [], {}
    model._pass(x, mask, "b", kept)
    model._back(x, weight, "b", kept, grad)
    for at in ((0, 3), (html_text.WIDTH + 1, 30), (5, 65)):
        model.p["Wb"][at] += 1e-3
        up = loss()
        model.p["Wb"][at] -= 2e-3
        down = loss()
        model.p["Wb"][at] += 1e-3
        assert abs((up - down) / 2e-3 - grad["Wb"][at]) < 0.02 * max(1.0, abs(grad["Wb"][at]))


@pytest.mark.parametrize("group, block, hot", [(1, 2, 20), (2, 512, 5), (line_dedup.SMALL_GROUP, line_dedup.LINK_BLOCK, line_dedup.HOT_TOKEN)])
def test_line_matches_against_brute_force(spark, monkeypatch, group, block, hot):
    """Small limits send everything through the searched groups, pairs of blocks and dealt tokens."""
    for name, value in (("SMALL_GROUP", group), ("LINK_BLOCK", block), ("HOT_TOKEN", hot)):
        monkeypatch.setattr(line_dedup, name, value)
    r = random.Random(8)
    pool = [prose(k, r.choice([1, 2, 4, 8, 20, 60])) for k in range(40)]
    data = []
    for d in range(120):
        lines = []
        for _ in range(r.randrange(6)):
            words = r.choice(pool).split()
            for _ in range(r.choice([0, 0, 1, 3])):
                words[r.randrange(len(words))] = f"y{r.randrange(50)}"
            lines.append(" ".join(words) if r.random() < 0.9 else "")
        data.append((d, "\n".join(lines)))
    data += [(500, None), (501, ""), (502, "The same\nthe  SAME\r\n\nother")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS line")
    got = {x["doc_id"]: (x["n_lines"], list(x["removed"]), list(x["earliest"]), x["n_links"]) for x in line_dedup.line_matches(df).collect()}
    lines = {(d, i): frozenset(re.findall(r"[^ \t\n\x0b\x0c\r]+", line.lower())) for d, t in data for i, line in enumerate((t or "").split("\n"))}
    sets = {s for s in lines.values() if s}
    like = {s: {o for o in sets if 5 * len(s & o) >= 4 * len(s | o)} for s in sets}
    first = {}
    for at in sorted(lines):
        first.setdefault(lines[at], at)
    want = {}
    for d, t in data:
        own = [(i, lines[(d, i)]) for i in range(len((t or "").split("\n")))]
        gone = [(i, min(first[o] for o in like[s])[0]) for i, s in own if s and min(first[o] for o in like[s]) < (d, i)]
        want[d] = (len(own), [i for i, _ in gone], [e for _, e in gone], sum(len(like[s]) - 1 for _, s in own if s))
    assert got == want


def test_line_groups_do_not_grow_by_chance(spark, monkeypatch):
    """Unlike lines that share a rare word are no candidates, however long they are; beside them the links are found."""
    r = np.random.default_rng(3)
    unlike = [(d, " ".join([f"rare{n}", *(f"w{x}" for x in r.choice(4000, n - 1, replace=False))])) for n, docs in ((96, range(400)), (300, range(400, 600))) for d in docs]
    alike = [(1000 + d, " ".join([f"own{d}", *(f"v{x}" for x in range(200))])) for d in range(3)]
    seen = []
    links = line_dedup._links
    monkeypatch.setattr(line_dedup, "_links", lambda nodes, *more: (seen.append(nodes.count()), links(nodes, *more))[1])
    got = {x["doc_id"]: x["n_links"] for x in line_dedup.line_matches(spark.createDataFrame(unlike + alike, "doc_id long, text string")).collect()}
    assert got == {d: 0 for d, _ in unlike} | {d: 2 for d, _ in alike}
    assert seen[0] <= 3 + 6


def test_line_groups_are_copied_a_bounded_number_of_times(spark, monkeypatch):
    """However many blocks' worth of sets a group has, a set goes to MOST_BLOCKS tasks; all links are counted."""
    monkeypatch.setattr(line_dedup, "LINK_BLOCK", 1)
    seen = []
    links = line_dedup._links

    def caught(*all_):
        found = links(*all_)
        seen.append(found.groupBy("key").count().agg({"count": "max"}).first()[0])
        return found

    monkeypatch.setattr(line_dedup, "_links", caught)
    data = [(d, " ".join([f"own{d}", *(f"v{x}" for x in range(20))])) for d in range(60)]
    got = line_dedup.line_matches(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert [x["n_links"] for x in got] == [59] * 60
    assert seen[0] <= 16


def test_line_sets_are_read_where_texts_are(spark, monkeypatch):
    """Texts take part in no join or shuffle, however many lines are read again."""
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0, raising=False)
    docs = spark.createDataFrame([(1, 5, "a b c\n\nd e f"), (2, 6, None), (3, 7, "x y\nd e f g")], "doc_id long, mark long, text string")
    nodes = spark.createDataFrame([(1, 5, 2), (3, 7, 1)], "doc_id long, mark long, line int")
    sets = line_dedup._sets(nodes, docs)
    assert "Join" not in sets._jdf.queryExecution().executedPlan().toString()
    assert {len(x["tokens"]) // 8 for x in sets.collect()} >= {3, 4}


def test_line_dedup_rows(odd, empty):
    out = line_dedup.line_dedup(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = {(r["doc_id"], r["source"]): r["text"] for r in out.collect()}
    assert text[(1, "a")] == "" and text[(3, None)] is None and text[(0, "a")] == prose(1)
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_dedup_of_repeated_ids_with_different_texts(spark):
    """Each text loses its own lines only; line numbers of one never reach the other."""
    data = [(1, "a b c\nonly here"), (2, "x\ny\nz\na b c"), (2, "first of two\nx"), (2, "first of two\nx"), (3, "first of two"), (None, "a b c")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS mark", "2 AS a", "3 AS lines")
    out = line_dedup.line_dedup(df)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(got) == 6 and (1, data[0][1]) in got and (None, "a b c") in got and (3, "") in got
    twos = [t for d, t in got if d == 2]
    assert sum("x" in t.split("\n") for t in twos) in (1, 2) and all("a b c" not in t.split("\n") for t in twos)
    assert len(line_dedup.line_matches(df).collect()) == 4


def test_line_sets_tell_unlike_lines_apart():
    """Sets are told apart by 64 bits: a million lines of one token each have as many keys."""
    n = 1_000_000
    counts = np.ones(1 << line_dedup.TABLE_BITS, np.int64)
    keys = np.concatenate([line_dedup.line_sets(j, counts)[2] for _, _, j in line_dedup.pieces(["\n".join(f"t{i}" for i in range(n))])])
    assert len(np.unique(keys)) == n


def test_line_pieces_split_long_texts(monkeypatch):
    monkeypatch.setattr(line_dedup, "PIECE", 50)
    texts = [prose(1, 100).replace(" ", "\n"), None, "", "a\n" * 200, prose(2, 30)]
    seen = collections.Counter()
    joined = []
    for own, sizes, text in line_dedup.pieces(texts):
        assert text.count("\n") + 1 == sum(sizes)
        seen.update(dict(zip(own, [0] * len(own))))
        for i, n in zip(own, sizes):
            seen[i] += n
        joined.append(text)
    assert [seen[i] for i in range(5)] == [len((t or "").split("\n")) for t in texts]


def test_mixing_meets_targets(spark, monkeypatch):
    r = random.Random(4)
    data = [(i, " ".join(["w"] * r.randrange(1, 60)), "en", f"s{min(i % 9, 4)}" if i % 11 else None, 1) for i in range(3000)]
    plan = mixing.mix(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    by = collections.defaultdict(list)
    for x in plan:
        by[x["source"]].append(x)
    total = sum(x["size"] for x in plan)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weights = dict(zip(names, itertools.cycle((3, 1, 2))))
    sizes = {s: sum(x["size"] for x in by[s]) for s in names}
    target, clamped = {}, set()
    while True:
        rest = 1.5 * total - sum(2 * sizes[s] for s in clamped)
        share = {s: rest * weights[s] / sum(weights[t] for t in names if t not in clamped) for s in names if s not in clamped}
        more = {s for s, v in share.items() if v > 2 * sizes[s]}
        if not more:
            break
        clamped |= more
    target = share | {s: 2.0 * sizes[s] for s in clamped}
    for s in names:
        assert by[s][0]["source_size"] == sizes[s] and by[s][0]["target"] == pytest.approx(target[s])
        assert abs(sum(x["taken"] for x in by[s]) - target[s]) <= 60
    assert all(x["taken"] <= 2 * x["size"] for x in plan)
    again = mixing.mix(spark.createDataFrame(data[::-1], SCHEMA)).collect()
    assert sorted((x["doc_id"], x["taken"]) for x in again) == sorted((x["doc_id"], x["taken"]) for x in plan)
    whole = collections.Counter(r["doc_id"] for r in mixing.mixed_documents(spark.createDataFrame(data, SCHEMA)).collect())
    assert {x["doc_id"]: x["copies"] for x in plan if x["copies"]} == whole
    monkeypatch.setattr(mixing, "LEAST_RANGES", 4)  # ranges change the work, not the rows
    again = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted((x["doc_id"], x["taken"]) for x in again) == sorted((x["doc_id"], x["taken"]) for x in plan)


def test_mixing_odd_rows(odd, empty):
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(empty).count() == 0
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and out.count() > 0 and mixing.mixed_documents(empty).count() == 0
    taken = collections.Counter((r["doc_id"], r["source"], r["text"]) for r in out.collect())
    plan = {(r["doc_id"], r["source"]): r["copies"] for r in mixing.mix(odd).collect()}
    rows = collections.Counter((r["doc_id"], r["source"], r["text"]) for r in odd.collect())
    assert all(taken[k] == n * plan[k[:2]] for k, n in rows.items() if k[0] not in (7, None)) and sum(taken.values()) == out.count()


def test_pieces_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    library, own, r = sentencepiece.SentencePieceProcessor(model_file=path), pieces.piece_model(path), random.Random(2)
    texts = ["", " ", "  ", "▁▁a▁", "\n\n x\t\x00", "日本語 𝒳 é", "a" * 3000, " " * 1500, "<s> <0x41>", "ab" * 700, prose(1, 500)]
    texts += ["".join(r.choice(["th", "e", "er", " ", "in", "  ", "    ", "0", "12", "\n", "é", "▁", "日", "ion"]) for _ in range(r.randint(1, 50))) for _ in range(1500)]
    texts += ["".join(r.choice("etaoinshrdlu") for _ in range(5000)), "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(4000)), "".join(r.choice("ab—é日本語ไทย0") for _ in range(3000)), "0123456789abcdef" * 300, "the" * 1500 + "." * 2500]
    for text, ids in zip(texts, own.encode_batch(texts)):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert own.decode(ids) == library.decode(ids.tolist())
    for _ in range(1500):
        ids = [r.randrange(400) for _ in range(r.randrange(12))]
        assert own.decode(np.array(ids, "<u4")) == library.decode(ids)


def test_pieces_of_long_words_by_either_way(monkeypatch):
    """Rounds over all words of a batch and rounds of one word give the same ids."""
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    r = random.Random(5)
    texts = ["".join(r.choice("etaoin shrdlu日本éa") for _ in range(400)) for _ in range(60)] + ["a" * 999, "ab" * 300]
    one = pieces.PieceModel(path).encode_batch(texts)
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    assert pieces.PieceModel(path).encode_batch(texts) == one


def test_pieces_odd_rows(spark, odd, empty):
    pytest.importorskip("public_tokenizers")
    got = {r["doc_id"]: r for r in pieces.encoded(odd, keep_ids=True).collect()}
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == 2 and list(got[3]["ids"]) == [1, 2]
    assert got[0]["decoded_sha256"] == hashlib.sha256(prose(1).encode()).hexdigest()
    assert pieces.encoded(empty).count() == 0


def test_toxicity_learns(spark, odd, empty):
    r = random.Random(6)
    data = [(i, prose(i, 30) + (" you horrid fool " + prose(i + 1, 5) if i % 5 == 0 else ""), "en", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(data, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    sample, counts = labelled_sample(docs, labels, "toxic", 3000)
    model = toxicity.fit(sample, counts)
    out = {x["doc_id"]: x["score"] for x in toxicity.scored(docs, model).collect()}
    assert all((out[i] >= 0.3) == (i % 5 == 0) for i in out)
    assert toxicity.scored(odd, model).filter("score >= 0 and score <= 1").count() == odd.count()
    assert toxicity.scored(empty, model).count() == 0
    sample, counts = labelled_sample(empty, labels.filter("doc_id < 0"), "toxic", 3000)
    assert toxicity.fit(sample, counts).score("anything") == pytest.approx(0.5)
    del r


def test_toxicity_held_out_recall(spark):
    """op7 on larger tables: held-out labels, and that held-out labels teach nothing."""
    where = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in toxicity.op7_toxicity(spark, where).filter("held_out").collect()}
    toxic = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{where}/labels.parquet").collect() if r["doc_id"] in got and r["toxic"] in (0, 1)]
    hit = sum(got[d]["predicted"] for d, t in toxic if t == 1)
    assert hit >= 0.9 * sum(t for _, t in toxic) and hit >= 0.9 * sum(got[d]["predicted"] for d, _ in toxic)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    samples = [sorted(map(tuple, labelled_sample(docs.select("doc_id", "text"), x, "toxic", 3000)[0].collect())) for x in (labels, turned)]
    assert samples[0] == samples[1] and not any(zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in samples[0])


def place_of(gram):
    """The feature of one n-gram, by whole numbers of 64 bits."""
    h, most = 0, 1 << 64
    for c in gram:
        h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % most
        h ^= h >> 29
    return (h * 0xC2B2AE3D27D4EB4F % most) >> (64 - toxicity.BITS)


def test_toxicity_ratios_by_hand(spark):
    """Weights are regression weights times log-count ratios that plain counting gives; a score is their plain sum."""
    data = [(i, ("bad words" if i % 3 == 0 else "good words") + (" here" if i % 2 else ""), int(i % 3 == 0)) for i in range(60)]
    model = toxicity.fit(spark.createDataFrame(data, "doc_id long, text string, label int"), {1: 20, 0: 40})
    assert all((model.score(t) >= 0.3) == bool(y) for _, t, y in data)
    for text in ("bad", "some good words", "", None):
        clean = f" {' '.join((text or '').lower().split())} "
        own = {clean[i : i + n] for n in (3, 4, 5) for i in range(len(clean) - n + 1)}
        z = model.bias + sum(float(model.weights[place_of(g)]) for g in own)
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)
    with_bad = sum(y for _, t, y in data if " bad " in f" {t} ")
    assert math.log((with_bad + 1) / 22) - math.log(1 / 42) > 0 and model.weights[place_of(" bad ")] > 0 > model.weights[place_of(" good")]


def test_line_links_are_all_counted(spark):
    """Variants of one line: each is linked to every other, whatever their number; classes follow links and equal lines."""
    base = [f"w{i}" for i in range(18)]
    data = [(d, " ".join(base + [f"own{d}"]) + (f"\nshared by {d // 2} two" if d > 7 else "")) for d in range(12)]
    data += [(50, "nothing like it"), (51, "far away\nshared by 5 two"), (60, "Nothing  LIKE it"), (61, None), (62, "")]
    got = {x["doc_id"]: (x["class_id"], x["n_links"], list(x["removed"])) for x in line_dedup.line_matches(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {d: got[d][:2] for d in range(12)} == {d: (0, 11) for d in range(12)}
    assert got[0][2] == [] and all(0 in got[d][2] for d in range(1, 12))
    assert got[51] == (0, 0, [1]) and got[50] == (50, 0, []) and got[60] == (50, 0, [0])
    assert got[61] == (61, 0, []) and got[62] == (62, 0, [])


def test_html_custom_elements_and_math_lose_no_text():
    """Tags that only begin like a tag without text, self-closed svg, and MathML."""
    texts = lambda page: [t for _, t, _ in html_text.blocks(page)]
    for tag in ("video-player", "svg-icon", "title-bar", "object-list", "script-x", "math-view"):
        assert texts(f"<p>Before.</p><{tag} a='1'>own</{tag}><p>After.</p>") == ["Before.", "own", "After."]
    assert texts('<p>Before <svg viewBox="0 0 1 1"/> after.</p><p>More <svg/>text.</p><p>End.</p>') == ["Before after.", "More text.", "End."]
    assert texts("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, <math/> always.</p>") == ["So x=2 holds, always."]
    assert texts("<p>a</p><svg\nwidth='1'><text>no</text></svg><VIDEO>no</VIDEO><title >no</title ><p>b</p>") == ["a", "b"]


def test_pieces_of_long_runs_end():
    """Runs of one symbol are merged in linear time, alone, side by side and many in a batch, and equal the library's ids."""
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)
    own = pieces.PieceModel(path)
    r = random.Random(9)
    units = ["a", "-", "=", "ab", " ", "\n", "*", "é", "0", "- ", "=-", "日"]
    texts = [u * n for u in units for n in (*range(1, 40), 999, 1001, 3000)]
    texts += ["".join(r.choice(units) * r.choice([1, 2, 5, 17, 64, 700]) for _ in range(r.randrange(1, 9))) for _ in range(200)]
    texts += [" " * (20_000 + k) for k in range(300)] + [" " * 1_000_000, "=" * 1_000_000]
    for text, ids in zip(texts, own.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True), text[:30]


def test_components_never_grow_on_chains(spark, monkeypatch):
    """A path, a hub, a comb and a cycle: classes by the smallest id, and no table of edges has more than there were."""
    path = [(k, k + 1) for k in range(2000)]
    random.Random(1).shuffle(path)
    hub = [(5000, 5000 + k) for k in range(1, 400)] + [(5399 + k, 5000 + k) for k in range(1, 400)]
    cycle = [(9000 + k, 9000 + (k + 1) % 50) for k in range(50)]
    sizes, write = [], minhash.staged

    def counted(df, name):
        out = write(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(minhash, "staged", counted)
    edges = path + hub + cycle
    got = dict(map(tuple, minhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {k: 0 for k in range(2001)} | {k: 5000 for k in range(5000, 5799)} | {k: 9000 for k in range(9000, 9050)}
    assert got == want
    assert max(sizes) <= len(edges) and len(sizes) < 40
    assert minhash.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing_never_exceeds_the_cap(spark):
    """A clamped source with empty documents: copies stay at most max_epochs, whole rows too."""
    docs = [(k, "" if k % 10 == 0 else "one two three", None, "small", 1) for k in range(400)] + [(1000 + k, "word " * 40, None, "z", 1) for k in range(400)]
    df = spark.createDataFrame(docs, SCHEMA)
    for most in (2.0, 1.0):
        got = mixing.mix(df, epochs=1.5 if most == 2 else 0.9, max_epochs=most).collect()
        assert max(r["copies"] for r in got) <= most
        out = collections.Counter(r["doc_id"] for r in mixing.mixed_documents(df, epochs=1.5 if most == 2 else 0.9, max_epochs=most).collect())
        assert out == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_html_odd_quotes_leave_no_markup():
    texts = lambda page: [t for _, t, _ in html_text.blocks(page)]
    assert texts("<p class=it's>Hello world</p><p>Next.</p>") == ["Hello world", "Next."]
    assert texts('<p title="unclosed>x</p><p>y</p>') == ["x", "y"]
    assert texts("<p data-a=\"1 > 0\" b='>'>x</p><p c = \"a>b\">y</p>") == ["x", "y"]
    assert texts("<script data-x=it's>var a = '<p>no</p>'</script><p>yes</p><style a=\"b>p{}</style><p>end</p><p class=\"open") == ["yes", "end"]
    assert texts("<p>a < b and 3<4</p>") == ["a < b and 3<4"]


def test_line_tokens_collide_by_no_structure():
    """The Thue-Morse word and its complement have different hashes; places of long tokens count."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    texts = [word, word.translate(str.maketrans("ab", "ba")), word[:60], word[60:120], "x" * 64 + "ab", "x" * 64 + "ba", "ab", "ba", "é", "e"]
    hashes = line_dedup.tokenised(" ".join(texts))[1]
    assert len(set(hashes.tolist())) == len(texts)
    assert line_dedup.tokenised("a\n" + word)[1][1] == hashes[0]
