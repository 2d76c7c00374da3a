"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch's distinct words lie end to end in flat numpy symbol arrays. Each round ranks all neighbouring pairs, takes
the smallest rank of every word (segmented minimum), merges that pair's leftmost non-overlapping occurrences in all
words at once, compacts, and retires words in which no pair remains. The ids equal the library's: begin id, pieces
(characters without a piece become byte pieces), end id.

A merge may be applied to all its occurrences at once only if no pair that the merged piece can form has the same or
a better rank. For the few pieces where one has, the leftmost occurrence is merged in a round; words with many such
occurrences (runs of blanks or of one mark) are merged from the left in one pass a rank, linear in their length.

Words may be very long (scripts without blanks, encoded data). They are cut where two characters meet that no piece holds
side by side, as no merge can cross such a place. What is still longer than LONG_WORD symbols is merged in rounds of its
own that touch only the places of the smallest rank, so that their cost grows with the merges and not with rounds times
length.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, trimmed

SPACE = "▁"
#: Words kept in a worker's cache before it starts anew.
CACHE_WORDS = 100_000
#: Words of more symbols are cut, and merged in rounds of their own where they cannot be cut.
LONG_WORD = 1000
#: Places of one rank in a word that are still merged one a round where they must be merged from the left.
CROWD = 4
_NONE = np.iinfo(np.int32).max


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("ledgerloom.one_byte", _one_byte)


class PieceModel:
    """The pieces of a SentencePiece BPE model file and the pairs that make them."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        if any(library.is_unused(i) for i in range(n)) or library.encode("a  b", out_type=str) == library.encode("a b", out_type=str):
            raise ValueError("models with unused pieces or white-space folding are not supported")
        self.bos, self.eos, self.unk = library.bos_id(), library.eos_id(), library.unk_id()
        self.byte_ids = np.zeros(256, np.uint32)
        self.surface: list[bytes] = [b""] * n
        self.is_byte = np.zeros(n, bool)
        symbol: dict[str, int] = {}
        for i, name in enumerate(names):
            if library.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_ids[value], self.surface[i], self.is_byte[i] = i, bytes([value]), True
            elif library.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not library.is_control(i):
                self.surface[i] = name.replace(SPACE, " ").encode()
                symbol[name] = i
        self.n = n
        self.width = np.array([len(x) for x in self.surface], np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        rank_of = {s: r for r, s in enumerate(sorted({-library.get_score(i) for i in symbol.values()}))}
        chars = sorted({c for name in symbol for c in name if c not in symbol})
        symbol |= {c: n + k for k, c in enumerate(chars)}  # characters inside pieces that are no piece themselves
        self.char = np.full(0x110000, -1, np.int32)
        for name, i in symbol.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        pairs = [(symbol[p[:k]] << 32 | symbol[p[k:]], i, rank_of[-library.get_score(i)]) for p, i in symbol.items() if len(p) > 1 for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        pairs.sort()
        self.keys = np.array([p[0] for p in pairs], np.int64)
        self.made = np.array([p[1] for p in pairs], np.int32)
        self.rank = np.array([p[2] for p in pairs], np.int32)
        own = {p[1]: p[2] for p in pairs}
        self.alone = np.zeros(n + len(chars), bool)  # merge one occurrence at a time
        for key, _, rank in pairs:
            for part in (key >> 32, key & 0xFFFFFFFF):
                if part in own and rank <= own[part]:
                    self.alone[part] = True
        self.joined = np.unique(np.array([ord(a) << 21 | ord(b) for name in symbol for a, b in zip(name, name[1:])], np.int64))
        inner = any(SPACE in name.lstrip(SPACE) for name in symbol) or self.char[10] >= 0
        self.words = re.compile(r"(?s).+" if inner else r" *[^ \n]+| +|\n")
        self.cache: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}

    def _ranked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; _NONE where they make no piece."""
        keys = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (a >= 0) & (b >= 0)
        return np.where(hit, self.rank[at], _NONE), self.made[at]

    def _long(self, symbols: np.ndarray) -> np.ndarray:
        """One long word in rounds: the places of the smallest rank are merged from the left, then their neighbours ranked."""
        n = len(symbols)
        after, before, live = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at < n)]
            at = at[after[at] < n]
            rank, _ = self._ranked(symbols[at], symbols[after[at]])
            at, rank = at[rank != _NONE], rank[rank != _NONE]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]][: len(rank)])
            for r, places in zip(rank[starts].tolist(), np.split(at, starts[1:])):
                if r not in waiting:
                    heapq.heappush(ranks, r)
                waiting.setdefault(r, []).append(places)

        wait(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[live[at] & (after[at] < n)]
            rank, made = self._ranked(symbols[at], symbols[after[at]])
            at, made = at[rank == r], made[rank == r]
            if not len(at):
                continue
            index = np.arange(len(at))
            touches = np.r_[False, after[at[:-1]] == at[1:]]  # shares a symbol with the place before
            run = np.maximum.accumulate(np.where(touches, 0, index))
            take = (index - run) % 2 == 0
            if self.alone[made].any():
                wait(self._from_left(r, at, symbols, after, before, live))
                continue
            at, made = at[take], made[take]
            gone = after[at]
            symbols[at], live[gone], after[at] = made, False, after[gone]
            inside = after[at] < n
            before[after[at][inside]] = at[inside]
            wait(np.unique(np.concatenate([before[at], at])))
        return symbols[live]

    def _pair(self, a: int, b: int) -> tuple[int, int]:
        """Rank and product of one pair, kept for the pairs seen; a rank of _NONE if they make no piece."""
        found = self.pairs.get((a, b))
        if found is None:
            rank, made = self._ranked(np.array([a]), np.array([b]))
            found = self.pairs[a, b] = (int(rank[0]), int(made[0]))
        return found

    def _from_left(self, r: int, places: np.ndarray, symbols: np.ndarray, after: np.ndarray, before: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Merge the places of rank r one after another, each with the pairs of rank r or better that it brings about.

        These touch the newest symbol, as no other pair is better than r. Returns the places whose pairs are new.
        """
        n = len(symbols)
        s, following, preceding, alive = (memoryview(x) for x in (symbols, after, before, live))
        pair, touched = self._pair, []
        for i in places.tolist():
            j = following[i] if alive[i] else n
            if j >= n or pair(s[i], s[j])[0] != r:
                continue
            made = pair(s[i], s[j])[1]
            while True:
                # i and j become one symbol
                s[i], alive[j] = made, False
                j = following[i] = following[j]
                if j < n:
                    preceding[j] = i
                h = preceding[i]
                right, right_made = pair(made, s[j]) if j < n else (_NONE, 0)
                left, left_made = pair(s[h], made) if h >= 0 else (_NONE, 0)
                if min(left, right) > r:
                    break
                if left <= right:
                    i, j, made = h, i, left_made
                else:
                    made = right_made
            touched.append(i)
            if h >= 0:
                touched.append(h)
        return np.unique(np.array(touched, np.int64))

    def _cut(self, words: list[str]) -> tuple[list[str], list[int]]:
        """Parts of the words and how many each has: long ones end where no piece holds two characters side by side."""
        parts, counts = [], []
        for w in words:
            if len(w) <= LONG_WORD:
                parts.append(w)
                counts.append(1)
                continue
            c = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            pair = c[:-1] << 21 | c[1:]
            known = self.joined[np.minimum(np.searchsorted(self.joined, pair), len(self.joined) - 1)] == pair if len(self.joined) else np.zeros(len(pair), bool)
            ends = [0, *(np.flatnonzero(~known) + 1).tolist(), len(w)]
            parts += [w[a:b] for a, b in zip(ends, ends[1:])]
            counts.append(len(ends) - 1)
        return parts, counts

    def _merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit integers."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.char[points]
        symbols = np.where(symbols < 0, -1 - points, symbols)  # below 0: a character that no piece has
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        offsets = np.cumsum(lengths) - lengths
        for w in np.flatnonzero(lengths > LONG_WORD).tolist():
            merged = self._long(symbols[offsets[w] : offsets[w] + lengths[w]])
            done.append((np.full(len(merged), w), merged))
        live = lengths[word] <= LONG_WORD
        word, symbols = word[live], symbols[live]
        rank, made = np.full(len(word), _NONE, np.int32), np.zeros(len(word), np.int32)
        dirty = np.arange(len(word))  # places whose pair with the next symbol is to be ranked anew
        while len(word):
            last = dirty[(dirty + 1 == len(word)) | (word[np.minimum(dirty + 1, len(word) - 1)] != word[dirty])]
            rank[last] = _NONE
            inside = np.setdiff1d(dirty, last, assume_unique=True)
            rank[inside], made[inside] = self._ranked(symbols[inside], symbols[inside + 1])
            opens = np.r_[True, word[1:] != word[:-1]]
            starts, segment = np.flatnonzero(opens), np.cumsum(opens) - 1
            best = np.minimum.reduceat(rank, starts)
            if (best == _NONE).any():
                going = (best != _NONE)[segment]
                done.append((word[~going], symbols[~going]))
                word, symbols, rank, made = word[going], symbols[going], rank[going], made[going]
                if not len(word):
                    break
                best = best[best != _NONE]
                opens = opens[going]
                starts, segment = np.flatnonzero(opens), np.cumsum(opens) - 1
            at = np.arange(len(word))
            chosen = rank == best[segment]
            run = np.maximum.accumulate(np.where(chosen & ~np.r_[False, chosen[:-1]], at, 0))
            take = chosen & ((at - run) % 2 == 0)
            single = np.logical_or.reduceat(chosen & self.alone[made], starts)
            if single.any():
                crowded = np.flatnonzero(single & (np.add.reduceat(chosen.astype(np.int64), starts) > CROWD))
                if len(crowded):  # words with many of them are merged from the left on their own
                    ends = np.r_[starts[1:], len(word)]
                    for k in crowded.tolist():
                        merged = self._long(symbols[starts[k] : ends[k]])
                        done.append((np.full(len(merged), word[starts[k]]), merged))
                    going = ~np.isin(segment, crowded)
                    word, symbols, rank, made = word[going], symbols[going], rank[going], made[going]
                    dirty = np.empty(0, np.int64)
                    continue
                first = np.minimum.reduceat(np.where(chosen, at, len(at)), starts)
                take &= ~single[segment] | (at == first[segment])
            symbols = np.where(take, made, symbols)
            stay = ~np.r_[False, take[:-1]]
            dirty = np.flatnonzero((take | np.r_[take[1:], False])[stay])
            word, symbols, rank, made = word[stay], symbols[stay], rank[stay], made[stay]
        if not done:
            return [b""] * len(words)
        word, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, symbols = word[order], symbols[order]
        bounds = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        plain = (symbols >= 0) & (symbols < self.n)
        ids = np.where(plain, symbols, 0).astype("<u4")
        odd = np.flatnonzero(np.r_[0, np.cumsum(~plain)][bounds[1:]] > np.r_[0, np.cumsum(~plain)][bounds[:-1]])
        flat = ids.tobytes()
        out = [flat[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:])]
        extra = {v: k for k, v in enumerate(self.char.tolist()) if v >= self.n} if len(odd) and (symbols >= self.n).any() else {}
        for w in odd.tolist():  # byte pieces for characters without a piece
            parts = []
            for s in symbols[bounds[w] : bounds[w + 1]].tolist():
                raw = b"" if 0 <= s < self.n else chr(-1 - s if s < 0 else extra[s]).encode("utf-8", "surrogatepass")
                parts.append(self.byte_ids[np.frombuffer(raw, np.uint8)].astype("<u4").tobytes() if raw else int(s).to_bytes(4, "little"))
            out[w] = b"".join(parts)
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids with begin and end ids, as little-endian unsigned 32-bit integers."""
        split = [self.words.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = [w for w in {w for words in split for w in words} if w not in self.cache]
        if new:
            parts, counts = self._cut([w.replace(" ", SPACE) for w in new])
            merged = iter(self._merge(parts))
            self.cache.update((w, b"".join(islice(merged, n))) for w, n in zip(new, counts))
        head, tail = (int(i).to_bytes(4, "little") for i in (self.bos, self.eos))
        return [head + b"".join(map(self.cache.__getitem__, words)) + tail for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, the space that encoding puts in front removed, bad bytes as U+FFFD."""
        control = (ids == self.bos) | (ids == self.eos)
        size = self.width[ids]
        ends = np.cumsum(size)
        raw = self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        cuts = ends[np.flatnonzero(control[:-1])].tolist()  # a control id ends a run of byte pieces
        text = "".join(raw[i:j].decode("utf-8", "ledgerloom.one_byte") for i, j in zip([0, *cuts], [*cuts, len(raw)]))
        lead = ids[~control][:1]
        own_space = len(lead) and text[:1] == " " and not self.is_byte[lead[0]] and int(lead[0]) != self.unk
        return text[1:] if own_space else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids if keep_ids).

    A null text counts as empty and has the begin and end ids only. Nothing shuffles; an empty table gives no rows.
    """
    path = model or default_model()
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = piece_model(path)
        for batch in batches:
            ids = pieces.encode_batch(["" if t is None else t for t in batch["text"]])
            arrays = [np.frombuffer(x, "<u4") for x in ids]
            decoded = [pieces.decode(x) for x in arrays]
            out = {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(x) for x in arrays],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in decoded],
            }
            if keep_ids:
                out["ids"] = [x.astype(np.int32) for x in arrays]
            yield pd.DataFrame(out)
        pieces.cache.clear()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(trimmed(run), schema)


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
