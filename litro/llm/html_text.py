"""Main text of web pages: a bidirectional LSTM in numpy labels every block with the whole page in view.

A page becomes its sequence of leaf blocks. Each is read as a vector of its tag path (tags, class and
id words, hashed to fixed signs), a histogram of its hashed words, its length and its share of link
text. The network is fitted on a bounded sample of pages, whose blocks are labelled by what their
tags and class words say, or, where these name no main text, by where the most text lies.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import table

#: Pages the network is fitted on, those of least url hash; longer ones in windows of so many blocks.
SAMPLE_PAGES, SAMPLE_BLOCKS = 256, 200
PATH, WORDS, HIDDEN, ROUNDS = 48, 16, 16, 150
#: Blocks of a batch that run through the network together.
BATCH_BLOCKS = 20_000

# HTML's elements by their role, and usual class words.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN_TEXT = "script|style|noscript|template|textarea|select|svg|iframe|object"
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
MAIN = frozenset("article main articlebody content post entry story".split())
ASIDE = frozenset("head title nav header footer aside form button menu sidebar notice notices banner cookie consent ad ads advert advertisement sponsored promo comment comments reply breadcrumb breadcrumbs share social related widget newsletter subscribe login search copyright popup modal".split())

_START = re.compile(r"<(?:(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)|(?P<other>[!?/]))")
#: From a tag's name to its end. A quote counts only where a value begins, as in HTML; nothing is read twice.
_END = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+>")
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in HIDDEN_TEXT.split("|")}


class Place:
    """An open element as the path to it: what hangs on the whole path is added up as it grows, so that no block repeats its path."""

    __slots__ = ("tag", "parts", "up", "main", "aside", "linked", "below", "_sum")

    def __init__(self, parts: tuple[str, ...], up: Place | None):
        words = {p.lstrip(".") for p in parts}
        self.tag, self.parts, self.up = parts[0] if parts else "", parts, up
        self.main = bool(words & MAIN) or (up is not None and up.main)
        self.aside = bool(words & ASIDE) or (up is not None and up.aside)
        self.linked = self.tag == "a" or (up is not None and up.linked)
        self.below: dict[tuple[str, ...], Place] = {}
        self._sum: np.ndarray | None = None if up else np.zeros(PATH)

    def child(self, parts: tuple[str, ...]) -> Place:
        found = self.below.get(parts)
        if found is None:
            found = self.below[parts] = Place(parts, self)
        return found

    def sum(self) -> np.ndarray:
        """The sum of the path's vectors."""
        chain, at = [], self
        while at._sum is None:
            chain.append(at)
            at = at.up
        for node in reversed(chain):
            node._sum = sum((_PATHS[p] for p in node.parts), node.up._sum)
        return self._sum


@dataclass
class Block:
    place: Place
    text: str
    links: int

    @property
    def path(self) -> tuple[str, ...]:
        steps, at = [], self.place
        while at is not None:
            steps.append(at.parts)
            at = at.up
        return tuple(p for parts in reversed(steps) for p in parts)


def _parts(tag: str, rest: str) -> tuple[str, ...]:
    names = [w for m in _NAMES.finditer(rest) for w in re.split(r"[^a-z0-9]+", "".join(x or "" for x in m.groups()).lower()) if w] if "=" in rest else []
    return (tag, *("." + w for w in names))


def tokens(page: str):
    """(text, tag, closes, rest) in order: text with no tag, or a tag with no text. Linear in the page.

    Comments, declarations and the content of HIDDEN_TEXT are left out. A tag ends as HTML says; from
    the first one on that never does, tags end at the next `>`. A tag cut off by the page's end is left out.
    """
    at = look = 0
    quoted, data_end = True, page.rfind("]]>")
    while m := _START.search(page, look):
        start, look = m.start(), m.end()
        if start > at:
            yield page[at:start], "", False, ""
        if m["other"]:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 2)
                at = len(page) if end < 0 else end + 3
            elif page[start : start + 9].upper() == "<![CDATA[" and start + 9 <= data_end:
                end = page.find("]]>", start + 9)
                yield page[start + 9 : end], "", False, ""
                at = end + 3
            else:
                end = page.find(">", look)
                at = len(page) if end < 0 else end + 1
        else:
            done = _END.match(page, look) if quoted else None
            quoted = done is not None
            end = done.end() - 1 if done else page.find(">", look)
            if end < 0:
                return
            at = end + 1
            tag, closes, rest = m["tag"].lower(), bool(m["close"]), page[look:end]
            if tag not in _CLOSING:
                yield "", tag, closes, rest
            elif not closes and not (tag == "svg" and rest.endswith("/")):
                hidden = _CLOSING[tag].search(page, at)
                end = page.find(">", hidden.end()) if hidden else -1
                at = len(page) if end < 0 else end + 1
        look = at
    if at < len(page):
        yield page[at:], "", False, ""


def _decoded(text: str) -> str:
    """Character references as characters; numbers too long for an int are beyond every character."""
    if "&#" in text:
        text = re.sub(r"&#[0-9]{1000,}+;?", "\ufffd", re.sub(r"&#0{8,}+", "&#0", text))
    return html.unescape(text)


def blocks(page: str | None, root: Place | None = None) -> list[Block]:
    """The leaf blocks of a page in order; markup that is not closed is closed where the next block or the page ends.
    Elements of equal paths share a place, also those of other pages, where a root is given; else each has its own."""
    found: list[Block] = []
    at = root or Place((), None)
    stack: list[Place] = [at]
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    links = 0

    def end() -> None:
        nonlocal links
        text = " ".join(_decoded("".join(pieces)).split()) if pieces else ""
        if text:
            found.append(Block(at, text, links))
        pieces.clear()
        links = 0

    def drop(k: int) -> None:
        opened.subtract(x.tag for x in stack[k:])
        del stack[k:]

    for text, tag, closes, rest in tokens(page or ""):
        if not tag:
            if pieces or not text.isspace():
                if not pieces:
                    at = stack[-1]
                pieces.append(text)
                if stack[-1].linked:
                    links += len(text)
            continue
        if tag == "br" and pieces:
            pieces.append(" ")
        if tag not in INLINE:
            end()
        if closes:
            if opened[tag] > 0:
                drop(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
        elif tag not in VOID and not rest.endswith("/"):
            if tag in CLOSES:
                for k in range(len(stack) - 1, max(0, len(stack) - 6), -1):
                    if stack[k].tag in CLOSES[tag]:
                        drop(k)
                        break
                    if stack[k].tag not in INLINE:
                        break
            parts = _parts(tag, rest)
            stack.append(stack[-1].child(parts) if root else Place(parts, stack[-1]))
            opened[tag] += 1
    end()
    return found


def weak_label(block: Block) -> int:
    """1 within an article or what is named like one, and not within what is named as something beside it."""
    return int(block.place.main and not block.place.aside)


def weak_labels(page: list[Block]) -> np.ndarray:
    """Labels of a page's blocks by names; where these name no main text, 1 for what lies in the element whose
    own blocks hold the most text that is neither beside the point nor linked (of equal ones the first).
    Elements of equal paths must not share a place here."""
    named = np.array([weak_label(b) for b in page], int)
    free = [b for b in page if not b.place.aside]
    if named.any() or not free:
        return named
    held: dict[Place, int] = {}
    for b in free:
        home = b.place.up or b.place
        held[home] = held.get(home, 0) + max(0, len(b.text) - b.links)
    within = {max(held, key=held.__getitem__): True}

    def inside(place: Place) -> bool:
        chain = []
        while place is not None and place not in within:
            chain.append(place)
            place = place.up
        value = place is not None and within[place]
        within.update(dict.fromkeys(chain, value))
        return value

    return np.array([int(not b.place.aside and inside(b.place)) for b in page], int)


class _Vectors(dict):
    """Fixed signs for a tag or class word, or the bucket of a word."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str):
        if len(self) > 1 << 18:
            self.clear()
        seed = xxhash.xxh3_64_intdigest(word.encode())
        self[word] = value = np.random.default_rng(seed).choice([-1.0, 1.0], PATH) / np.sqrt(8) if self.size == PATH else seed % WORDS
        return value


_PATHS, _WORDS = _Vectors(PATH), _Vectors(WORDS)


def vectors(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), PATH + WORDS + 2), np.float32)
    words = [b.text.split() for b in page]
    n = np.array([len(w) for w in words])
    bucket = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(words)), np.int64, n.sum())
    counts = np.bincount(np.repeat(np.arange(len(page)), n) * WORDS + bucket, minlength=len(page) * WORDS)
    x[:, PATH : PATH + WORDS] = counts.reshape(-1, WORDS) / n[:, None]
    for k, b in enumerate(page):
        x[k, :PATH] = b.place.sum()
        x[k, -2:] = np.log1p(len(b.text)) / 8, min(1.0, b.links / len(b.text))
    return x


@dataclass
class Network:
    """Weights of both directions, (inputs + hidden + 1, 4 * hidden), and of the output."""

    forward: np.ndarray
    backward: np.ndarray
    out: np.ndarray


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _run(w: np.ndarray, x: np.ndarray, length: np.ndarray, keep: bool = False):
    """Hidden states of one direction over x (pages, blocks, inputs); longer pages come first, and only those not yet at their end take part in a step."""
    n, t, d = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    states, trace = np.zeros((n, t, HIDDEN)), []
    inputs = x @ w[:d] + w[-1]
    for k in range(t):
        m = int(np.count_nonzero(length > k))
        h, c = h[:m], c[:m]
        z = inputs[:m, k] + h @ w[d:-1]
        gates = np.concatenate([_sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])], 1)
        i, f, o, g = np.split(gates, 4, 1)
        new_c = f * c + i * g
        tanh = np.tanh(new_c)
        if keep:
            trace.append((h, c, gates, tanh))
        h, c = o * tanh, new_c
        states[:m, k] = h
    return states, trace


def _back(w: np.ndarray, x: np.ndarray, trace: list, grad: np.ndarray) -> np.ndarray:
    n, t, d = x.shape
    dh, dc, down_z = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), []
    for k in range(t - 1, -1, -1):
        h, c, gates, tanh = trace[k]
        m = len(h)
        i, f, o, g = np.split(gates, 4, 1)
        out = dh[:m] + grad[:m, k]
        down = dc[:m] + out * o * (1 - tanh**2)
        dz = np.concatenate([down * g * i * (1 - i), down * c * f * (1 - f), out * tanh * o * (1 - o), down * i * (1 - g**2)], 1)
        down_z.append(dz)
        dc[:m] = down * f
        dh[:m] = dz @ w[d:-1].T
    # One product over all steps, last step first.
    dz = np.concatenate(down_z)
    read = np.concatenate([x[: len(trace[k][0]), k] for k in range(t - 1, -1, -1)])
    held = np.concatenate([trace[k][0] for k in range(t - 1, -1, -1)])
    return np.concatenate([read.T @ dz, held.T @ dz, dz.sum(0, keepdims=True)])


def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pages, longest first, read ahead and behind, and their lengths."""
    length = np.array([len(p) for p in pages])
    ahead = np.zeros((len(pages), length.max(), PATH + WORDS + 2), np.float32)
    behind = np.zeros_like(ahead)
    for k, p in enumerate(pages):
        ahead[k, : len(p)], behind[k, : len(p)] = p, p[::-1]
    return ahead, behind, length


def _turned(states: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each page's blocks in the other direction; what lies after its end stays."""
    place = np.arange(states.shape[1])
    place = np.where(place < length[:, None], length[:, None] - 1 - place, place)
    return np.take_along_axis(states, place[:, :, None], 1)


def probabilities(net: Network, pages: list[np.ndarray]) -> list[np.ndarray]:
    """For each page, how likely each block is main text."""
    if not pages:
        return []
    order = sorted(range(len(pages)), key=lambda k: -len(pages[k]))
    ahead, behind, length = _pad([pages[k] for k in order])
    states = [_run(net.forward, ahead, length)[0], _turned(_run(net.backward, behind, length)[0], length)]
    p = _sigmoid(np.concatenate(states, 2) @ net.out[:-1] + net.out[-1])
    row = {k: r for r, k in enumerate(order)}
    return [p[row[k], : len(page)] for k, page in enumerate(pages)]


def _batches(pages: list[np.ndarray], labels: list[np.ndarray]) -> list[tuple]:
    """Pages of like length together, padded to BATCH_BLOCKS blocks at most: read ahead and behind, lengths, live places, labels."""
    order, found = sorted(range(len(pages)), key=lambda k: -len(pages[k])), []
    while order:
        many = max(1, BATCH_BLOCKS // len(pages[order[0]]))
        some, order = order[:many], order[many:]
        ahead, behind, length = _pad([pages[k] for k in some])
        live = np.arange(ahead.shape[1]) < length[:, None]
        y = np.zeros(live.shape)
        for row, k in enumerate(some):
            y[row, : len(labels[k])] = labels[k]
        found.append((ahead.astype(np.float64), behind.astype(np.float64), length, live, y))  # once, and not in each round
    return found


def train(pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = ROUNDS) -> Network:
    """Back-propagation through time with Adam; each step follows the gradient over all pages."""
    r = np.random.default_rng(11)
    d = PATH + WORDS + 2
    weights = [r.normal(0, 0.15, (d + HIDDEN + 1, 4 * HIDDEN)), r.normal(0, 0.15, (d + HIDDEN + 1, 4 * HIDDEN)), r.normal(0, 0.15, 2 * HIDDEN + 1)]
    batches, total = _batches(pages, labels), sum(map(len, pages))
    m, s = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, rounds + 1):
        steps = [np.zeros_like(w) for w in weights]
        for ahead, behind, length, live, y in batches:
            states_a, trace_a = _run(weights[0], ahead, length, True)
            states_b, trace_b = _run(weights[1], behind, length, True)
            states = np.concatenate([states_a, _turned(states_b, length)], 2)
            error = np.where(live, _sigmoid(states @ weights[2][:-1] + weights[2][-1]) - y, 0) / total
            grad = error[:, :, None] * weights[2][:-1]
            steps[0] += _back(weights[0], ahead, trace_a, grad[:, :, :HIDDEN])
            steps[1] += _back(weights[1], behind, trace_b, _turned(grad[:, :, HIDDEN:], length))
            steps[2] += np.r_[np.einsum("nt,nth->h", error, states), error.sum()]
        for k, step in enumerate(steps):
            m[k], s[k] = 0.9 * m[k] + 0.1 * step, 0.999 * s[k] + 0.001 * step**2
            weights[k] -= 0.03 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Network(*weights)


def _windows(values: np.ndarray) -> list[np.ndarray]:
    """A page's blocks in stretches of like length, SAMPLE_BLOCKS at most; none is left out."""
    return np.array_split(values, -(-len(values) // SAMPLE_BLOCKS))


def _firsts(batches):
    """Of the rows of each hash in a partition the first."""
    seen: set[int] = set()
    for batch in batches:
        new = [k for k, h in enumerate(batch["hash"].to_pylist()) if not (h in seen or seen.add(h))]
        if new:
            yield batch.take(new)


def _sample(pages: DataFrame, most: int) -> list:
    """The `most` different pages of least hash. Only hashes are sorted; then those pages are fetched, copies once."""
    hashed = pages.select(F.xxhash64("url", "html").alias("hash"), "html").where("html IS NOT NULL")
    least = [r.hash for r in hashed.select("hash").distinct().orderBy("hash").limit(most).collect()]
    if not least:
        return []
    found = hashed.where(F.col("hash") <= least[-1]).mapInArrow(_firsts, hashed.schema)
    return sorted(found.dropDuplicates(["hash"]).collect(), key=lambda r: r.hash)


def fit(pages: DataFrame, most: int = SAMPLE_PAGES) -> Network | None:
    """From all blocks of at most `most` different pages. None if no block of them is labelled as main text."""
    sample = _sample(pages.select("url", "html"), most)
    parsed = [p for p in (blocks(r.html) for r in sample) if p]
    labels = [weak_labels(p) for p in parsed]
    if not any(v.any() for v in labels):
        return None
    return train([w for p in parsed for w in _windows(vectors(p))], [w for v in labels for w in _windows(v)])


def main_text(pages: DataFrame, net: Network | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of pages; the blocks labelled as main text, blank lines between.

    Nulls: a missing html is empty, its text empty; a missing url or page_id stays null. Without a
    network, and where the sample shows none to learn from, blocks go by what their tags say; pages
    without markup are one block, which is then main text. Repeated rows get equal texts. An empty table gives no rows.
    Other columns are ignored. Characters are decoded, white space in a block is one space.
    """
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    net = net or fit(pages)

    @F.pandas_udf("string")
    def extract(column):
        out = []
        batch: list[list[Block]] = []

        def label() -> None:
            # Pages of like length run together, so that little of a batch is padding.
            order = sorted((k for k in range(len(batch)) if batch[k]), key=lambda k: len(batch[k]))
            kept: list[list[str]] = [[] for _ in batch]
            for i in range(0, len(order), 64):
                some = order[i : i + 64]
                if net is None:
                    scores = [weak_labels(batch[k]) for k in some]
                else:
                    scores = probabilities(net, [vectors(batch[k]) for k in some])
                for k, p in zip(some, scores, strict=True):
                    kept[k] = [b.text for b, v in zip(batch[k], p, strict=True) if v >= 0.5]
            out.extend("\n\n".join(x) for x in kept)
            batch.clear()

        size, root = 0, net and Place((), None)
        for page in column:
            batch.append(blocks(page, root))
            size += len(batch[-1])
            if size > BATCH_BLOCKS:
                label()
                size, root = 0, net and Place((), None)
        label()
        return column.__class__(out, dtype=object)

    done = pages.select("page_id", "url", extract(F.coalesce("html", F.lit(""))).alias("text"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
