"""The pipeline's stages against brute force on the smallest tables."""

import collections
import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import language, minhash, pieces, registry
from ledgerloom.llm.common import held_out

DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@needs_data
def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    source = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = dict(corpus_pipeline.STAGES)
    one = kept["language_id"](spark, docs, DIR).persist()
    assert one.columns == docs.columns
    profiles = language.learn_profiles(docs.filter(~held_out(F.col("doc_id"))))
    nearest = {d: profiles.predict(t) for d, t in source.items()}
    assert {r["doc_id"]: r["lang"] for r in one.collect()} == {d: name for d, (name, score) in nearest.items() if name != "und" and score >= corpus_pipeline.LANGUAGE_SCORE}
    assert one.count() == docs.count()  # these documents are clean
    two = kept["exact_dedup"](spark, one, DIR).persist()
    texts = [strip(r["text"]) for r in two.collect()]
    assert len(set(texts)) == len(texts) and set(texts) == {strip(r["text"]) for r in one.collect()}
    three = kept["near_dedup"](spark, two, DIR).persist()
    words = minhash.Words()
    bags = {r["doc_id"]: sorted(minhash.shingles(r["text"], words).tolist()) for r in two.collect()}
    left = {r["doc_id"] for r in three.collect()}
    count = {d: collections.Counter(b) for d, b in bags.items()}
    for a in left:
        for b in left:
            if a < b:
                assert 5 * sum((count[a] & count[b]).values()) < 4 * sum((count[a] | count[b]).values())
    four = kept["mixing"](spark, three, DIR).persist()
    taken = collections.Counter(r["doc_id"] for r in four.collect())
    assert four.columns == docs.columns and set(taken) <= left and max(taken.values()) <= 2
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in three.collect()}
    by = collections.defaultdict(list)
    for r in three.collect():
        by[r["source"]].append(r["doc_id"])
    total, weight = sum(size.values()), {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(by, key=lambda s: (s is None, s or "")))}
    cap, open_ = {s: 2 * sum(size[d] for d in own) for s, own in by.items()}, set(by)
    while True:
        rest = 1.5 * total - sum(cap[s] for s in by if s not in open_)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        if not (over := {s for s in open_ if share[s] >= cap[s]}):
            break
        open_ -= over
    for s, own in by.items():
        assert abs(sum(size[d] * taken[d] for d in own) - share.get(s, cap[s])) <= max(size[d] for d in own)
    five = kept["pieces"](spark, four, DIR)
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.default_model())
    want = collections.Counter()
    for r in four.collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want[r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), tuple(ids)] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"])) for r in five.collect()) == want


@needs_data
def test_language_stage_rejects_foreign_texts(spark):
    """Texts in a script or of signs that no profile knows go, and so do null texts; repeated rows and other columns stay."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").filter("text is not null")
    odd = [(900001, "Ελληνικά κείμενα χωρίς καμία σχέση με τις άλλες γλώσσες", None, "s", 1), (900002, "123 ½ !!", "en", "s", 1), (900003, None, "en", "s", 1), (900004, "", None, None, None)]
    some = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")).unionByName(docs.filter("doc_id < 3"))
    some = some.selectExpr("*", "1 AS score", "'x' AS lang_pred", "2 AS row")
    out = corpus_pipeline.language_id(spark, some, DIR)
    assert out.columns == some.columns
    ids = collections.Counter(r["doc_id"] for r in out.collect())
    assert ids == collections.Counter(r["doc_id"] for r in docs.unionByName(docs.filter("doc_id < 3")).collect())


@needs_data
def test_run_and_registry(spark):
    assert corpus_pipeline.run(spark, DIR).count() > 0
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
