"""Main text of web pages: a recurrent network labels every block of a page as text or surroundings.

A page becomes its sequence of leaf blocks (text between block-level tags). Each block is read as a vector of its tag
path (hashed tags, classes and ids), a vector of its words (hashed), and a few measures. A bidirectional LSTM in numpy
passes over the whole sequence both ways, so that every block is judged in the context of the document. The network is
trained here: on a bounded sample of the pages, labelled by their own semantic tags, and on rearrangements of the same
blocks under other layouts, so that it does not depend on one template.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, trimmed

PATH_SIZE, WORD_SIZE, MEASURES = 48, 24, 8
WIDTH = PATH_SIZE + WORD_SIZE + MEASURES
HIDDEN = 20
#: Pages that the training reads at most, and the longest page (characters) it takes.
TRAIN_PAGES, TRAIN_CHARS = 150, 100_000
ROUNDS = 14
_NO_TEXT = "script|style|noscript|template|title|textarea|select|svg|iframe|object|canvas|audio|video"
#: Attributes up to the end of a tag. Quotes hold a value only behind an equals sign; where one is not closed, the tag ends
#: at the next `>`, or with the page.
_VALUES = r"(?>[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=(?!\s*[\"']))*+"
_REST = rf"(?:{_VALUES}>|[^>]*(?:>|\Z))"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>"
    rf"|<svg(?=[\s/]){_VALUES}(?<=/)>"
    rf"|<(?P<skip>{_NO_TEXT})(?=[\s/>]){_REST}.*?(?:</(?P=skip)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>{_REST})|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MATH = frozenset("math maction annotation annotation-xml menclose merror mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()) | _MATH
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PARAGRAPH_ENDS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "option": ("option", ("select",))}
Block = tuple[tuple[str, ...], str, float]


def blocks(page: str | None) -> list[Block]:
    """(tag path with class names, text, share of the text inside links) of every block that has text, in order.

    An inline element whose class names it as surroundings (an advert inside a paragraph) is a block of its own, in front
    of the one it stands in, which goes on behind it.
    """
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    found: list[Block] = []
    linked = total = depth = 0
    #: Open inline blocks: tag, open tags of that name, height of the stack, and what was read of the block around.
    inner: list[list] = []

    def flush() -> None:
        nonlocal linked, total
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            found.append((tuple(x[1] for x in stack), text, linked / max(1, total)))
        parts.clear()
        linked = total = 0

    def leave(height: int) -> None:
        """End the inline blocks that began at this height of the stack or above."""
        nonlocal linked, total
        while inner and inner[-1][2] >= height:
            flush()
            _, _, at, kept, linked, total = inner.pop()
            del stack[at:]
            parts[:] = kept

    def close(names: tuple[str, ...], until: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                leave(k)
                flush()
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    for m in _TOKEN.finditer(page or ""):
        text = m["text"]
        if text is None:
            text = m["cdata"]
        if text is not None:
            parts.append(text)
            size = len(text.strip())
            total += size
            linked += size * (depth > 0)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            depth = max(0, depth - 1) if m["close"] else depth + 1
        if tag == "br":
            parts.append(" ")
        rest = m["rest"].removesuffix(">")
        names = "" if m["close"] or tag in _VOID or rest.endswith("/") else " ".join(x for g in _NAMES.findall(rest) for x in g if x).lower()
        if tag in _INLINE:
            if inner and inner[-1][0] == tag and tag not in _VOID and not rest.endswith("/"):
                inner[-1][1] += -1 if m["close"] else 1
                if not inner[-1][1]:
                    leave(inner[-1][2])
            elif names and _OTHER_NAMES.search(names.replace("_", "-")):
                inner.append([tag, 1, len(stack), list(parts), linked, total])
                parts.clear()
                linked = total = 0
                stack.append((tag, f"{tag} {names}"))
            continue
        flush()
        if m["close"]:
            close((tag,))
            depth = 0
        else:
            if tag in _PARAGRAPH_ENDS:
                close(("p",), ("td", "th", "div", "article", "section", "main", "body", "li", "blockquote"))
            if tag in _SIBLINGS:
                close((_SIBLINGS[tag][0],), _SIBLINGS[tag][1])
            if tag not in _VOID and not rest.endswith("/"):
                stack.append((tag, f"{tag} {names}" if names else tag))
    leave(0)
    flush()
    return found


class Vectors:
    """Block vectors; hashes of words and path elements are kept for those a worker has seen."""

    def __init__(self) -> None:
        self.word: dict[str, int] = {}
        self.path: dict[tuple[str, ...], np.ndarray] = {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        found = self.path.get(path)
        if found is None:
            found = np.zeros(PATH_SIZE, np.float32)
            for up, element in enumerate(reversed(path)):
                for name in {*element.split(), *re.split(r"[\s_-]+", element)}:
                    h = zlib.crc32(name.encode("utf-8", "surrogatepass"))
                    found[h % PATH_SIZE] += (1 if h >> 16 & 1 else -1) / (1 + 0.2 * up)
            if len(self.path) > 20_000:
                self.path.clear()
            self.path[path] = found
        return found

    def page(self, found: list[Block]) -> np.ndarray:
        out = np.zeros((len(found), WIDTH), np.float32)
        if len(self.word) > 200_000:
            self.word.clear()
        for k, (path, text, links) in enumerate(found):
            words = text.lower().split()
            codes = []
            for w in words:
                c = self.word.get(w)
                if c is None:
                    c = self.word[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % (2 * WORD_SIZE)
                codes.append(c)
            bag = np.bincount(codes, minlength=2 * WORD_SIZE)
            out[k, :PATH_SIZE] = self._path(path)
            out[k, PATH_SIZE : PATH_SIZE + WORD_SIZE] = (bag[::2] - bag[1::2]) / (1 + np.sqrt((bag * bag).sum()))
            ends = text.count(".") + text.count("!") + text.count("?")
            out[k, PATH_SIZE + WORD_SIZE :] = (np.log1p(len(words)) / 4, links, min(1.0, ends / (1 + len(words) / 10)), len(text) / (8 * (1 + len(words))), text[-1] in ".!?\"", "©" in text or "@" in text, len(path) / 10, 1.0)
        return out


class Labeller:
    """A bidirectional LSTM with a logistic output for every step."""

    def __init__(self, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        self.p = {}
        for way in "fb":
            self.p[f"W{way}"] = (r.standard_normal((WIDTH + HIDDEN, 4 * HIDDEN)) / np.sqrt(WIDTH + HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.p[f"b{way}"] = bias
        self.p["V"] = (r.standard_normal((2 * HIDDEN, 1)) / np.sqrt(2 * HIDDEN)).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """Hidden states over time; padded steps (mask 0) leave the state as it was."""
        steps, n, _ = x.shape
        W, b = self.p[f"W{way}"], self.p[f"b{way}"]
        inner = x @ W[:WIDTH] + b
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inner[t] + h @ W[WIDTH:]
            gate = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c2 = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(c2)
            h2 = m * (o * tc) + (1 - m) * h
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            h, c = h2, c2
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass(x, mask, w, None) for w in "fb"], axis=2)
        return (both @ self.p["V"])[:, :, 0] + self.p["c"]

    def _back(self, x: np.ndarray, dh_out: np.ndarray, way: str, kept: list, grad: dict) -> None:
        W = self.p[f"W{way}"]
        dW, db = np.zeros_like(W), np.zeros_like(self.p[f"b{way}"])
        dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        for t, h, c, i, f, o, g, tc, m in reversed(kept):
            dh = dh + dh_out[t]
            do, dct = m * dh * tc, m * dh * o * (1 - tc * tc) + dc
            di, df, dg = m * dct * g, m * dct * c, m * dct * i
            dz = np.concatenate([di * i * (1 - i), df * f * (1 - f), do * o * (1 - o), dg * (1 - g * g)], axis=1)
            dW[:WIDTH] += x[t].T @ dz
            dW[WIDTH:] += h.T @ dz
            db += dz.sum(axis=0)
            dh = dz @ W[WIDTH:].T + (1 - m) * dh
            dc = m * dct * f + (1 - m) * dct
        grad[f"W{way}"], grad[f"b{way}"] = dW, db

    def train(self, pages: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int = ROUNDS, seed: int = 6) -> None:
        """pages: block vectors, labels, and which labels are known."""
        r = np.random.default_rng(seed)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(rounds):
            order = sorted(r.permutation(len(pages)).tolist(), key=lambda k: len(pages[k][0]) // 12)
            batches = [order[k : k + 24] for k in range(0, len(order), 24)]
            for at in r.permutation(len(batches)):
                own = [pages[k] for k in batches[at]]
                x, mask = padded([p[0] for p in own])
                y, known = np.zeros(mask.shape, np.float32), np.zeros(mask.shape, np.float32)
                for k, p in enumerate(own):
                    y[: len(p[1]), k], known[: len(p[2]), k] = p[1], p[2]
                kept = {w: [] for w in "fb"}
                both = np.concatenate([self._pass(x, mask, w, kept[w]) for w in "fb"], axis=2)
                z = (both @ self.p["V"])[:, :, 0] + self.p["c"]
                d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * known / max(1.0, known.sum()))[:, :, None].astype(np.float32)
                grad = {"V": np.tensordot(both, d, axes=([0, 1], [0, 1])), "c": d.sum(axis=(0, 1))}
                dh = d @ self.p["V"].T
                self._back(x, dh[:, :, :HIDDEN], "f", kept["f"], grad)
                self._back(x, dh[:, :, HIDDEN:], "b", kept["b"], grad)
                step += 1
                for k, g in grad.items():
                    a, v = moment[k]
                    a += 0.1 * (g - a)
                    v += 0.01 * (g * g - v)
                    self.p[k] -= 0.012 * (a / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, WIDTH) and the mask of real steps."""
    steps = max(map(len, pages), default=0)
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


_TEXT_PLACES = ("article", "main")
_OTHER_PLACES = frozenset("nav footer header aside form button menu dialog fieldset".split())
_OTHER_NAMES = re.compile(r"\b(ads?|advert\w*|sponsor\w*|promo\w*|side-?bar|comments?|respond|cookies?|consent|notice|banner|alert|menu|navigation|breadcrumbs?|share|social|related|newsletter|subscribe|pagination|copyright|popup|modal)\b")


def tag_label(path: tuple[str, ...]) -> int | None:
    """What a block's own tags say: 1 in an article, 0 in surroundings, None if they say nothing."""
    inside = False
    for element in path:
        tag, _, names = element.partition(" ")
        if tag in _OTHER_PLACES and not (tag == "header" and inside) or _OTHER_NAMES.search(names.replace("_", "-")):
            return 0
        inside |= tag in _TEXT_PLACES
    return 1 if inside else None


def _layouts(texts: list[str], r: random.Random) -> tuple[list[Block], list[int]]:
    """One page of the texts' words under a layout drawn at random, with its labels."""
    pool = [w for t in r.sample(texts, min(8, len(texts))) for w in t.split()] or ["text"]

    def some(low: int, high: int) -> str:
        n, at = r.randint(low, high), r.randrange(len(pool))
        return " ".join((pool + pool)[at : at + n])

    def prose() -> str:
        return some(6, 90).rstrip(".,") + "."

    if r.random() < 0.12:  # text that stands alone
        path = r.choice([(), ("p",), ("body",), ("html", "body"), ("html", "body", "p"), ("div",), ("body", "div", "p")])
        bare = [(path, prose(), 0.0) for _ in range(r.choice([1, 1, 2, 4, 9]))]
        return bare, [1] * len(bare)
    root = ("html", "body")
    wrap = r.choice([(), ("div",), ("div page",), ("div wrapper", "div container"), ("table", "tr", "td")])
    out: list[tuple[Block, int]] = []

    def add(path: tuple[str, ...], text: str, links: float, label: int) -> None:
        out.append(((root + path, text, links), label))

    def menu(path: tuple[str, ...]) -> None:
        for _ in range(r.randint(3, 9)):
            add((*path, "ul", "li") if r.random() < 0.8 else path, some(1, 3), 1.0, 0)

    def aside() -> None:
        kind = r.randrange(9)
        if kind == 0:
            menu((*wrap, r.choice(["aside", "div sidebar", "div side-bar widget", "aside sidebar", "div related", "section related-posts"])))
        elif kind == 1:
            add((*wrap, r.choice(["div ad", "div advert", "div ads banner", "aside ad", "div sponsored", "ins adsbygoogle"])), prose(), 0.0, 0)
        elif kind == 2:
            box = (*wrap, r.choice(["div cookie-notice", "div notice", "div cookie-banner", "div alert", "section notice", "div consent"]))
            add((*box, "p"), prose(), r.choice([0.0, 0.1]), 0)
        elif kind == 3:
            box = (*wrap, r.choice(["form", "form search", "form newsletter", "div subscribe"]))
            for _ in range(r.randint(1, 3)):
                add((*box, r.choice(["div", "p", "button", "fieldset"])), some(1, 6), 0.0, 0)
        elif kind == 4:
            box = (*wrap, r.choice(["div comments", "section comments", "div comment-list", "ol commentlist", "div disqus comments"]))
            add((*box, r.choice(["h2", "h3"])), some(1, 3), 0.0, 0)
            for _ in range(r.randint(1, 5)):
                add((*box, r.choice(["div comment", "li comment"]), "p"), prose(), 0.0, 0)
        elif kind == 5:
            add((*wrap, r.choice(["div share", "div social", "ul pagination", "div breadcrumbs"])), some(1, 5), 1.0, 0)
        elif kind == 6:
            add((*wrap, r.choice(["div promo", "div newsletter", "aside promo"]), "p"), prose(), 0.2, 0)
        else:
            menu((*wrap, r.choice(["nav", "div menu", "nav navbar", "div"])))

    if r.random() < 0.5:
        box = r.choice(["header", "div header", "header site-header", "div masthead"])
        add((box, r.choice(["h1", "p", "div", "h2"])), some(1, 8), r.choice([0.0, 1.0]), 0)
    menu((r.choice(["nav", "nav", "div nav", "div menu", "header"]),))
    for _ in range(r.randint(0, 3)):
        aside()
    text = (*wrap, r.choice(["article", "article", "main", "main article", "div content", "div post", "div entry-content", "section story", "div main", "div article-body", "div"]))
    if " article" in text[-1] and text[-1].startswith("main"):
        text = (*wrap, "main", "article")
    add((*text, "h1"), some(2, 12), 0.0, 1)
    for _ in range(r.choice([1, 2, 3, 5, 8, 12, 20])):
        kind = r.random()
        if kind < 0.75:
            add((*text, "p"), prose() if r.random() < 0.9 else some(1, 5), r.choice([0.0, 0.0, 0.0, 0.1, 0.3]), 1)
        elif kind < 0.82:
            add((*text, r.choice(["h2", "h3"])), some(1, 8), 0.0, 1)
        elif kind < 0.9:
            for _ in range(r.randint(2, 5)):
                add((*text, r.choice(["ul", "ol"]), "li"), some(2, 25), 0.0, 1)
        elif kind < 0.95:
            add((*text, r.choice(["blockquote", "pre", "blockquote p"])), prose(), 0.0, 1)
        elif r.random() < 0.5:
            add((*text, r.choice(["div ad", "aside", "div related", "div share"])), prose(), r.choice([0.0, 0.9]), 0)
        else:
            add(text, prose(), 0.0, 1)
    for _ in range(r.randint(0, 3)):
        aside()
    box = r.choice(["footer", "div footer", "footer site-footer", "div bottom"])
    for _ in range(r.randint(1, 3)):
        add((box, "p") if r.random() < 0.4 else (box,), r.choice(["© ", "Copyright ", ""]) + some(2, 14), r.choice([0.0, 0.5]), 0)
    return [b for b, _ in out], [y for _, y in out]


def fit(pages: list[str]) -> Labeller:
    """A labeller trained on a bounded sample of pages (html) and on rearrangements of their blocks."""
    vectors, r, data = Vectors(), random.Random(9), []
    found = [blocks(p) for p in pages]
    texts = [t for page in found for _, t, _ in page if len(t) > 20]
    for page in found:
        label = [tag_label(path) for path, _, _ in page]
        if page and any(y is not None for y in label):
            data.append((vectors.page(page), np.array([y or 0 for y in label], np.float32), np.array([y is not None for y in label], np.float32)))
    for _ in range(max(300, 2 * len(data))):
        page, label = _layouts(texts or ["some words of plain text that stand for a page"], r)
        data.append((vectors.page(page), np.array(label, np.float32), np.ones(len(label), np.float32)))
    model = Labeller()
    model.train(data)
    return model


def main_text(pages: list[str | None], model: Labeller, vectors: Vectors) -> list[str]:
    """The main text of each page: its blocks labelled as text, in order, joined by line feeds."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if found[k]), key=lambda k: len(found[k]))
    for at in range(0, len(order), 32):
        own = order[at : at + 32]
        x, mask = padded([vectors.page(found[k]) for k in own])
        z = model.scores(x, mask)
        for i, k in enumerate(own):
            out[k] = "\n".join(b[1] for b, s in zip(found[k], z[:, i]) if s > 0)
    return out


def extracted(pages: DataFrame, model: Labeller, page: str = "html") -> DataFrame:
    """pages plus text and n_chars (code points). Null or empty html gives empty text; nothing shuffles.

    Columns of pages that are named text or n_chars are replaced; all others, repeated rows too, stay. An empty table
    gives no rows.
    """
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # some 100 KB

    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors = Vectors()
        for column in batches:
            yield pd.Series(main_text(column.tolist(), shared.value, vectors), dtype=object)

    found = pages.withColumn("text", F.pandas_udf(trimmed(extract), "string", F.PandasUDFType.SCALAR_ITER)(F.col(page).cast("string")))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def training_pages(pages: DataFrame, page: str = "html", page_id: str = "page_id") -> list[str]:
    """At most TRAIN_PAGES distinct pages of at most TRAIN_CHARS characters, those of the smallest hashes of their ids.

    Pages that repeat an id are ordered by a hash of their html, so that any order of the rows gives the same pages. Null
    ids and null or empty pages are not read.
    """
    own, mark = F.col(page_id).cast("string"), F.xxhash64(F.col(page).cast("string"))
    fine = pages.filter(F.length(page).between(1, TRAIN_CHARS) & own.isNotNull())
    # ids and hashes are ranked first, so that the ranking moves no pages
    ranked = fine.select(own.alias("id"), F.xxhash64(own).alias("h"), mark.alias("mark")).distinct()
    wanted = [(r["id"], r["mark"]) for r in ranked.orderBy("h", "id", "mark").limit(TRAIN_PAGES).collect()]
    some = fine.filter(own.isin([w[0] for w in wanted]) & mark.isin([w[1] for w in wanted])).select(own.alias("id"), mark.alias("mark"), F.col(page).alias("p")).dropDuplicates(["id", "mark"])
    return sorted(r["p"] for r in some.collect() if (r["id"], r["mark"]) in set(wanted))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages, fit(training_pages(pages))).select("page_id", "url", "text", "n_chars")
