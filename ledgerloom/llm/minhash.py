"""Near-duplicate documents: DartMinHash signatures, banded joins, exact verification, connected classes.

Documents are multisets of five-word shingles (lower case). DartMinHash throws hashed darts at the region that each
shingle spans (its count by a rank axis): one hash per region says how many darts land there, further hashes place
them, and every signature coordinate keeps its earliest dart. Coordinates of two documents agree with the probability
of their weighted Jaccard similarity, at a cost that does not grow with coordinates times shingles.

Equal token sequences collapse first. Distinct ones meet in the buckets of BANDS bands. A bucket does not emit all
its pairs: its most connected document leads it and every other member is paired with the leader. After exact
verification the links of all buckets together give classes, and only members outside their leader's class meet the
others: inside tasks, in blocks of BLOCK documents, which return no more links than they connect.

Then the links inside every class are counted exactly: the shingles of its different texts go to tasks in blocks of
LINK_BLOCK texts, small classes share tasks, and what leaves a task is one number a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged, table, trimmed, trimmed_group

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
SIZE = BANDS * ROWS
#: Signature agreement below which a pair is not verified: four standard deviations under SIMILARITY.
ESTIMATE = 0.685
#: Darts wanted for a signature: with so many an empty coordinate is rare (and then more are thrown).
DARTS = SIZE * (np.log(SIZE) + 3)
#: Rank shells: the first ends at 2^FIRST_SHELL, each further one at twice the rank before.
FIRST_SHELL = -6
BROADCAST_IDS = 1_000_000
#: Members of a bucket that one task compares with as many others.
BLOCK = 128
#: Texts of a class whose links one task counts with as many others, and the bytes of their shingles.
LINK_BLOCK, LINK_BYTES = 1024, 1 << 23
#: Shingles of one matrix product.
WIDTH = 4096
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of words, kept for the words that a worker has seen."""

    def __init__(self, most: int = 100_000) -> None:
        self.known: dict[str, int] = {}
        self.most = most

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, words: Words) -> np.ndarray:
    """The hashed shingles of the whole text in order; a text of fewer words is one shingle, one without words none."""
    tokens = words.hashes((text or "").lower().split())
    if not len(tokens):
        return tokens
    n = max(1, len(tokens) - SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(tokens))):
        h = mixed(h ^ tokens[k : k + n])
    return h


def counted(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and how often each occurs."""
    own = np.sort(own)
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])[: len(own)]
    return own[starts], np.diff(np.r_[starts, len(own)])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted shingle arrays (with repeats)."""
    if not len(a) or not len(b):
        return 0.0
    (x, m), (y, n) = counted(a), counted(b)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int(np.minimum(m, n[at])[y[at] == x].sum())
    return common / (len(a) + len(b) - common)


def signatures(documents: list[np.ndarray]) -> np.ndarray:
    """A row of SIZE darts for each document: rank in the high bits, the dart's own hash in the low bits."""
    earliest = np.full((len(documents), SIZE), np.iinfo(np.uint64).max, np.uint64)
    flat = earliest.reshape(-1)
    distinct = [counted(d) for d in documents]
    sizes = np.array([len(d) for d in documents], float)
    # one element for each unit of weight: the k-th occurrence of a shingle spans the weights from k to k + 1
    units = [mixed(np.repeat(x, n) ^ (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64) * _C) for x, n in distinct]
    open_ = np.flatnonzero(sizes > 0)
    # the shell in which the wanted number of darts is reached
    last = np.full(len(documents), FIRST_SHELL)
    last[open_] = np.maximum(FIRST_SHELL, np.ceil(np.log2(DARTS / sizes[open_]))).astype(int)
    shell = FIRST_SHELL
    while len(open_):
        low, high = (0.0 if shell == FIRST_SHELL else 2.0 ** (shell - 1)), 2.0**shell
        element = np.concatenate([units[d] for d in open_])
        owner = np.repeat(open_, [len(units[d]) for d in open_])
        pieces = max(1, round(high - low))  # regions of at most one unit of rank
        span = (high - low) / pieces
        salts = mixed(np.arange(pieces, dtype=np.uint64) | np.uint64((shell + 64) << 32))
        region = mixed((element[:, None] ^ salts[None, :]).reshape(-1))
        chance = (region >> np.uint64(11)).astype(np.float64) * 2.0**-53
        # Poisson(span) darts by inversion
        count, term = np.zeros(len(region), np.int64), float(np.exp(-span))
        total, k, left = term, 0, np.flatnonzero(chance > term)
        while len(left) and k < 24:
            count[left] += 1
            k += 1
            term *= span / k
            total += term
            left = left[chance[left] > total]
        hit = np.flatnonzero(count)
        row = np.repeat(hit, count[hit])
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
        dart = mixed(region[row] + (nth.astype(np.uint64) + np.uint64(1)) * _B)
        rank = low + (row % pieces) * span + span * (dart >> np.uint64(32)).astype(np.float64) * 2.0**-32
        place = (mixed(dart) % np.uint64(SIZE)).astype(np.int64)
        # ranks lie below 2^16: 48 bits of fixed point hold them in order
        packed = (rank * 2.0**28).astype(np.uint64) << np.uint64(16) | (dart & np.uint64(0xFFFF))
        np.minimum.at(flat, owner[row // pieces] * SIZE + place, packed)
        done = (last[open_] <= shell) & (earliest[open_] != np.iinfo(np.uint64).max).all(axis=1)
        open_ = open_[~done]
        shell += 1
    return earliest


def _features(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, seq (hash of the token sequence; null without words), bands, sig (four bytes a coordinate)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            own = [shingles(t, words) for t in batch["text"]]
            darts = signatures(own)
            h = np.zeros((len(own), BANDS), np.uint64)
            for k in range(ROWS):
                h = mixed(h ^ darts[:, k::ROWS])
            h = mixed(h ^ np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
            sig = mixed(darts).astype(np.uint32)
            full = [len(x) > 0 for x in own]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "seq": [xxhash.xxh3_128_digest(x.tobytes()) if ok else None for x, ok in zip(own, full)],
                    "bands": [x if ok else None for x, ok in zip(h, full)],
                    "sig": [x.tobytes() if ok else None for x, ok in zip(sig, full)],
                }
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(trimmed(run), "doc_id long, seq binary, bands array<long>, sig binary")


def _alike(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Share of equal signature coordinates."""
    if not len(a):
        return np.empty(0)
    x, y = (np.frombuffer(b"".join(s), np.uint32).reshape(len(s), SIZE) for s in (a, b))
    return (x == y).mean(axis=1)


def _plausible(pairs: DataFrame) -> DataFrame:
    """Pairs (a, sig_a, b, sig_b) whose signatures agree in ESTIMATE of the coordinates or more, as (a, b)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[_alike(batch["sig_a"], batch["sig_b"]) >= ESTIMATE, ["a", "b"]]

    return pairs.mapInPandas(trimmed(run), "a long, b long")


def _named(pairs: DataFrame) -> DataFrame:
    """The distinct ids (id) in pairs (a, b), written down."""
    return staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")


def _only(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """rows whose column is among ids (id): by broadcast up to BROADCAST_IDS ids (8 bytes each), else by a shuffle."""
    wanted = ids.select(F.col("id").alias("__id"))
    return rows.join(F.broadcast(wanted) if ids.count() <= BROADCAST_IDS else wanted, F.col(column) == F.col("__id"), "left_semi")


def _bags(docs: DataFrame, ids: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(id, own): the sorted shingles (32 bits each) of the documents of ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "own": [np.sort((shingles(t, words) >> np.uint64(32)).astype(np.uint32)).tobytes() for t in batch["text"]]})

    named = _only(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")), "id", ids)
    return staged(named.mapInPandas(trimmed(cut), "id long, own binary").dropDuplicates(["id"]), "near-bags")


def _verified(pairs: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity reaches `similar`; a bag travels once a pair."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            as_array = lambda x: np.frombuffer(x, np.uint32)
            ok = [similarity(as_array(x), as_array(y)) >= similar for x, y in zip(batch["own_a"], batch["own_b"])]
            yield batch.loc[ok, ["a", "b"]]

    with_a = pairs.join(bags.select(F.col("id").alias("a"), F.col("own").alias("own_a")), "a")
    both = with_a.join(bags.select(F.col("id").alias("b"), F.col("own").alias("own_b")), "b")
    return both.mapInPandas(trimmed(check), "a long, b long")


def connected(links: DataFrame, name: str = "near") -> DataFrame:
    """(id, class): the smallest id of every id's component, by alternating large-star and small-star steps.

    A large star links every larger neighbour of an id to the smallest of its neighbourhood, a small star the id and its
    smaller neighbours to the smallest of them. Neither ever has more edges than before, on chains and hubs alike.
    """
    edges = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), f"{name}-edges")
    while True:
        # done if every id is linked to one smaller id at most, and that one to none
        smaller = edges.groupBy(F.col("b").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        roots = edges.select(F.col("a").alias("id")).distinct().withColumn("root", F.lit(True))
        if smaller.join(roots, "id", "left").filter("n > 1 or root").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = staged(edges.join(low, "a").select(F.col("low").alias("a"), "b").distinct(), f"{name}-large")
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        pair = F.inline(F.array(F.struct(F.col("low").alias("a"), F.col("a").alias("b")), F.struct(F.col("low").alias("a"), F.col("b").alias("b"))))
        edges = staged(large.join(low, "b").select(pair).filter("a < b").distinct(), f"{name}-edges")
    return edges.select(F.col("b").alias("id"), F.col("a").alias("class")).unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("class")).distinct())


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similar: float = SIMILARITY) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, class_id (smallest doc_id of its class), class_size (its rows), n_links.

    Classes are the components of links between documents of similarity `similar` or more; n_links is the number of
    other token sequences that the document's own is linked to, all of its class compared (equal sequences are one, as
    are sequences whose smallest doc_id is the same). Texts without words, null ones too, are classes of their own; rows
    with a null doc_id take no part; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    return _classes(docs, text, doc_id, similar, True)


def _classes(docs: DataFrame, text: str, doc_id: str, similar: float, counting: bool) -> DataFrame:
    """What near_duplicates returns; without the work for n_links, which is null then, unless counting."""
    small_batches(docs.sparkSession)
    features = staged(_features(docs.filter(F.col(doc_id).isNotNull()), text, doc_id), "near-features")
    groups = staged(features.filter("seq is not null").groupBy("seq").agg(F.min("doc_id").alias("rep")), "near-groups")
    one = groups.select(F.col("rep").alias("__rep"), F.col("seq").alias("__seq"))
    reps = features.select("doc_id", "seq", "bands").join(one, (F.col("doc_id") == F.col("__rep")) & (F.col("seq") == F.col("__seq")), "left_semi")
    bands = staged(reps.select("doc_id", F.posexplode("bands").alias("slot", "band")).distinct(), "near-bands")
    shared = staged(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-buckets")
    members = staged(bands.join(shared, "band"), "near-members")
    weight = staged(members.groupBy("doc_id").agg(F.sum("n").alias("weight")), "near-weights")
    lead = members.join(weight, "doc_id").groupBy("band").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("doc_id").alias("lead"))).alias("first"))
    lead = staged(lead.select("band", F.col("first.lead").alias("lead")), "near-leads")
    rays = members.join(lead, "band").filter("doc_id <> lead").select(F.least("doc_id", "lead").alias("a"), F.greatest("doc_id", "lead").alias("b")).distinct()
    links, bags = _linked(staged(rays, "near-rays"), features, docs, text, doc_id, similar)
    links, bags = _completed(members, lead, links, bags, features, docs, text, doc_id, similar)
    classes = connected(links)
    of_rep = groups.join(classes.withColumnRenamed("id", "rep"), "rep", "left").select("seq", "rep", F.coalesce("class", "rep").alias("class_rep"))
    if counting:
        counts = _link_counts(staged(classes, "near-components"), bags, similar).withColumnRenamed("id", "rep")
        of_rep = of_rep.join(counts, "rep", "left").select("seq", "class_rep", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    else:
        of_rep = of_rep.select("seq", "class_rep", F.lit(None).cast("long").alias("n_links"))
    return _members(features.select("doc_id", "seq").distinct(), staged(of_rep, "near-classes"))


def _signatures_of(features: DataFrame, ids: DataFrame) -> DataFrame:
    return staged(_only(features.select("doc_id", "sig"), "doc_id", ids).dropDuplicates(["doc_id"]), "near-sigs")


def _linked(pairs: DataFrame, features: DataFrame, docs: DataFrame, text: str, doc_id: str, similar: float) -> tuple[DataFrame, DataFrame]:
    """Those of the pairs (a, b) that are similar: signatures first, then exactly; and the bags read for it."""
    sig = _signatures_of(features, _named(pairs))
    a = sig.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a"))
    b = sig.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b"))
    plausible = staged(_plausible(pairs.join(a, "a").join(b, "b").select("a", "sig_a", "b", "sig_b")), "near-pairs")
    bags = _bags(docs, _named(plausible), text, doc_id)
    return staged(_verified(plausible, bags, similar), "near-links"), bags


def _completed(
    members: DataFrame, lead: DataFrame, links: DataFrame, bags: DataFrame, features: DataFrame, docs: DataFrame, text: str, doc_id: str, similar: float
) -> tuple[DataFrame, DataFrame]:
    """Links that connect what links connect and what links between members of one bucket in different classes connect;
    and bags with those of all documents that these links name.

    A class is a component of links. A member outside its leader's class meets the bucket's members of other classes;
    members inside need not meet each other, as they are connected already. Two documents meet in the first bucket that
    they share only: if both are inside there, they are of one class.
    """
    classes = staged(connected(links, "near-first").withColumnRenamed("id", "doc_id"), "near-first-classes")
    known = classes.filter("doc_id <> class").select(F.col("class").alias("a"), F.col("doc_id").alias("b"))
    tagged = members.join(classes, "doc_id", "left").select("band", "slot", "doc_id", F.coalesce("class", "doc_id").alias("class"))
    lead_class = lead.join(classes.withColumnRenamed("doc_id", "lead"), "lead", "left").select("band", F.coalesce("class", "lead").alias("lead_class"))
    tagged = staged(tagged.join(staged(lead_class, "near-lead-classes"), "band").withColumn("outside", F.col("class") != F.col("lead_class")), "near-tagged")
    sizes = tagged.groupBy("band").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("outside").alias("n_outside")).filter("n_outside > 0")
    sizes = staged(sizes, "near-open")
    if sizes.isEmpty():
        return known, bags
    crowd = staged(tagged.join(sizes, "band").select("band", "slot", "doc_id", "class", "outside", "n_all", "n_outside"), "near-crowds")
    ids = staged(crowd.select(F.col("doc_id").alias("id")).distinct(), "near-ids")
    unread = staged(ids.join(bags.select("id"), "id", "left_anti"), "near-unread")
    bags = bags.unionByName(_bags(docs, unread, text, doc_id))
    return known.unionByName(_met_in_blocks(crowd, _signatures_of(features, ids), bags, similar)), bags


def _unrepeated(own: np.ndarray) -> np.ndarray:
    """Sorted shingles with the number of their occurrence, so that repeats are told apart; ascending."""
    starts = np.maximum.accumulate(np.where(np.r_[True, own[1:] != own[:-1]], np.arange(len(own)), 0))
    return own.astype(np.uint64) << np.uint64(32) | (np.arange(len(own)) - starts).astype(np.uint64)


def _met_in_blocks(crowd: DataFrame, sig: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """Links between the outside members and all members of each bucket that connect different classes.

    A task compares one block of outside members with one block of members: signatures first, then shingles exactly.
    Classes that it has connected are not compared again, so it returns fewer links than its blocks have members.
    """
    full = crowd.join(sig, "doc_id").join(bags.withColumnRenamed("id", "doc_id"), "doc_id")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("long")
    spread = lambda n: F.pmod(F.xxhash64("doc_id"), blocks(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), blocks(n) - 1))
    columns = ["band", "xb", "yb", "side", "slot", "doc_id", "class", "sig", "own"]
    xs = full.filter("outside").withColumns({"side": F.lit(0), "xb": spread("n_outside")}).withColumn("yb", every("n_all"))
    ys = full.withColumns({"side": F.lit(1), "yb": spread("n_all")}).withColumn("xb", every("n_outside"))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                root[c] = c = root.get(root[c], root[c])
            return c

        x, y = rows[rows["side"] == 0], rows[rows["side"] == 1]
        out: list[tuple[int, int]] = []
        if len(x) and len(y):
            theirs = np.frombuffer(b"".join(y["sig"]), np.uint32).reshape(len(y), SIZE)
            y_ids, y_class = y["doc_id"].tolist(), y["class"].tolist()
            y_own = [_unrepeated(np.frombuffer(b, np.uint32)) for b in y["own"]]
            slot = int(rows["slot"].iloc[0])
            for i, c, sig_i, own_i in zip(x["doc_id"], x["class"], x["sig"], x["own"]):
                equal = theirs == np.frombuffer(sig_i, np.uint32)
                first = equal.reshape(len(y), BANDS, ROWS).all(axis=2).argmax(axis=1) == slot
                near = [j for j in np.flatnonzero(first & (equal.mean(axis=1) >= ESTIMATE)).tolist() if find(c) != find(y_class[j])]
                if not near:
                    continue
                mine = _unrepeated(np.frombuffer(own_i, np.uint32))
                sizes = np.array([len(y_own[j]) for j in near])
                flat = np.concatenate([y_own[j] for j in near])
                hits = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
                common = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes) - sizes)
                for j, k, n in zip(near, common.tolist(), sizes.tolist()):
                    if k >= similar * (len(mine) + n - k) - 1e-9 and find(c) != find(y_class[j]):
                        root[find(c)] = find(y_class[j])
                        out.append((min(i, y_ids[j]), max(i, y_ids[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    met = xs.select(*columns).unionByName(ys.select(*columns)).groupBy("band", "xb", "yb").applyInPandas(meet, "a long, b long")
    return staged(met.distinct(), "near-met")


def links_of(bags: list[np.ndarray], side: np.ndarray, cross: bool, similar: float) -> np.ndarray:
    """How many of the other bags each one is similar to: those of its own side, or, if cross, those of the other.

    bags: sorted shingles with repeats. What two of them have in common is counted by products of 0/1 matrices over the
    shingles that several bags hold, WIDTH shingles at a time.
    """
    n, links = np.array([len(b) for b in bags]), np.zeros(len(bags), np.int64)
    _, column, times = np.unique(np.concatenate([_unrepeated(b) for b in bags]), return_inverse=True, return_counts=True)
    several = times > 1
    held = several[column]
    row, column = np.repeat(np.arange(len(n)), n)[held], (np.cumsum(several) - 1)[column[held]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left = np.flatnonzero(side == side.min()) if cross else np.arange(len(n))
    right = np.flatnonzero(side != side.min()) if cross else left
    common = np.zeros((len(left), len(right)))
    for low in range(0, int(several.sum()), WIDTH):
        start, end = np.searchsorted(column, [low, low + WIDTH])
        dense = np.zeros((len(n), min(WIDTH, int(several.sum()) - low)), np.float32)
        dense[row[start:end], column[start:end] - low] = 1
        common += dense[left] @ dense[right].T if cross else dense @ dense.T
    near = common >= similar * (n[left][:, None] + n[right] - common) - 1e-9
    if cross:
        links[right] = near.sum(axis=0)
    else:
        near &= side[:, None] == side
        np.fill_diagonal(near, False)
    links[left] = near.sum(axis=1)
    return links


def _link_counts(classes: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """(id, n_links) of the documents of classes (id, class) that are similar to others of their class.

    A class is dealt over pairs of blocks, so that a large one is spread over as many tasks as it has pairs.
    """
    own = staged(classes.join(bags, "id").select("id", "class", F.length("own").alias("bytes")), "near-sizes")
    sizes = own.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    sizes = staged(sizes.select("class", F.ceil(F.greatest(F.col("n") / LINK_BLOCK, F.col("bytes") / LINK_BYTES)).alias("blocks")), "near-class-blocks")
    total = own.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    packs = 1 + max(total[0] // (4 * LINK_BLOCK), (total[1] or 0) // LINK_BYTES)
    full = own.drop("bytes").join(sizes, "class").join(bags, "id").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("class"), F.lit(packs))).otherwise(F.xxhash64("class"))
    full = full.select(pack.alias("pack"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "block", "id", "own")

    def count(at: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, members in rows.groupby("class", sort=False):
            own = [np.frombuffer(b, np.uint32) for b in members["own"]]
            out.append(pd.DataFrame({"id": members["id"], "links": links_of(own, members["block"].to_numpy(), at[1] != at[2], similar)}))
        found = pd.concat(out)
        return found[found["links"] > 0]

    counted_ = full.groupBy("pack", "low", "high").applyInPandas(trimmed_group(count), "id long, links long")
    return staged(counted_.groupBy("id").agg(F.sum("links").alias("n_links")), "near-link-counts")


def _members(ids: DataFrame, of_rep: DataFrame) -> DataFrame:
    """Every document with its class and links; the documents of hot token sequences get theirs by broadcast."""
    ids = staged(ids, "near-docs")
    total = ids.count()
    sizes = staged(ids.filter("seq is not null").groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "near-sizes")
    full = of_rep.join(sizes, "seq")
    size = staged(full.groupBy("class_rep").agg(F.sum("n").alias("class_size")), "near-class-sizes")
    full = staged(full.join(size, "class_rep"), "near-full").select(F.col("seq").alias("__seq"), F.col("class_rep").alias("class_id"), "class_size", "n_links", "n")
    hot_size = max(2, total // 1000)
    hot, cold = full.filter(F.col("n") >= hot_size), full.filter(F.col("n") < hot_size)  # at most 1000 hot rows
    pick = ["doc_id", "class_id", "class_size", "n_links"]
    marked = ids.join(F.broadcast(hot), F.col("seq") == F.col("__seq"), "left")
    rest = marked.filter("class_id is null").select("doc_id", "seq")
    joined = rest.filter("seq is not null").join(cold, F.col("seq") == F.col("__seq")).select(*pick)
    alone = rest.filter("seq is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"))
    return marked.filter("class_id is not null").select(*pick).unionByName(joined).unionByName(alone)


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similar: float = SIMILARITY) -> DataFrame:
    """docs with one document of each class (the smallest doc_id), all columns as they were.

    Rows with a null doc_id pass; of rows that repeat a doc_id all stay or all go.
    """
    gone = _classes(docs, text, doc_id, similar, False).filter("doc_id <> class_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
