"""Secrets in texts: fixed patterns, and automata learnt from what the patterns label.

A credential's format is a word over kinds of characters: each run of letters and digits repeats one
symbol for the least alphabet that holds it, marks stand for themselves. The formats of labelled
credentials make a prefix tree; states whose continuations are statistically compatible (Hoeffding's
bound) are merged into a probabilistic automaton, one for each kind of credential. Every other run of
credential characters in the corpus is a candidate; it is a secret where an automaton makes its format
likelier than the corpus's own candidates do, counted over all texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import id_and_text, table

#: The patterns of the base kinds, in the order in which they are listed, and least lengths.
LEAST_HEX = 32
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex")
#: What ASSIGN cannot match without, in lower case.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: The kind of spans that the automata add.
LEARNT = "format"
#: A candidate is a whole run of so many characters or more.
LEAST = 8
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}+")

#: The fit reads the formats that most labelled credentials of a kind have, so many of them, and none longer than this.
MOST_FORMATS, LONGEST = 2_000, 256
#: Probability that compatible states are held to be different, in each comparison.
ALPHA = 0.01
#: Counts of a symbol that is never seen after a state.
SMOOTHING = 0.01
SYMBOLS = "0xXaAyYmz+/_.=-"
END = "$"

_RUN = re.compile("[A-Za-z0-9]+|[^A-Za-z0-9]")


def _symbol(run: str) -> str:
    """The least alphabet: digits 0, lower or upper hexadecimal x X, letters a A or both m, with digits y Y z."""
    if run.isdigit():
        return "0"
    if run.isalpha():
        return "a" if run.islower() else "A" if run.isupper() else "m"
    if run.islower():
        return "x" if not run.strip("0123456789abcdef") else "y"
    if run.isupper():
        return "X" if not run.strip("0123456789ABCDEF") else "Y"
    return "z"


def format_of(value: str) -> str:
    return "".join(_symbol(r) * len(r) if r[0].isalnum() else r for r in _RUN.findall(value))


def base_spans(text: str, long_words: bool = True) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the fixed patterns, by start, then kind. long_words: whether a word may hold a long run."""
    found = []
    small = text.lower()
    if any(n in small for n in NAMES):
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if long_words:
        found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return [(start, end, KINDS[k], value) for start, end, k, value in sorted(found)]


def candidates(text: str, base: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str]]:
    """Runs of credential characters that touch no base span, by start."""
    at, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= start:
            yield start, end, m[0]


@dataclass
class State:
    """Of a prefix tree or automaton: words that pass it, words that end in it, and continuations."""

    count: int = 0
    ends: int = 0
    next: dict[str, int] = field(default_factory=dict)
    seen: dict[str, int] = field(default_factory=dict)


def prefix_tree(formats: dict[str, int]) -> list[State]:
    states = [State()]
    for word, n in sorted(formats.items()):
        at = states[0]
        at.count += n
        for symbol in word:
            at.seen[symbol] = at.seen.get(symbol, 0) + n
            if symbol not in at.next:
                at.next[symbol] = len(states)
                states.append(State())
            at = states[at.next[symbol]]
            at.count += n
        at.ends += n
    return states


def _differ(f: int, n: int, g: int, m: int, alpha: float) -> bool:
    """Whether f of n and g of m are too far apart for one probability."""
    return abs(f / n - g / m) > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def _compatible(states: list[State], a: int, b: int, alpha: float) -> bool:
    """Whether all that follows b, still a tree, is as likely after a."""
    pairs = [(a, b)]
    while pairs:
        i, j = pairs.pop()
        s, t = states[i], states[j]
        if _differ(s.ends, s.count, t.ends, t.count, alpha):
            return False
        if any(_differ(s.seen.get(c, 0), s.count, t.seen.get(c, 0), t.count, alpha) for c in s.seen.keys() | t.seen.keys()):
            return False
        pairs += [(s.next[c], t.next[c]) for c in s.next.keys() & t.next.keys()]
    return True


def _fold(states: list[State], a: int, b: int) -> None:
    """Adds the tree below b to what follows a."""
    pairs = [(a, b)]
    while pairs:
        i, j = pairs.pop()
        s, t = states[i], states[j]
        s.count, s.ends = s.count + t.count, s.ends + t.ends
        for c, n in t.seen.items():
            s.seen[c] = s.seen.get(c, 0) + n
            if c in s.next:
                pairs.append((s.next[c], t.next[c]))
            else:
                s.next[c] = t.next[c]


def infer(formats: dict[str, int], alpha: float = ALPHA) -> list[State]:
    """The automaton: states of the prefix tree, breadth first, are merged into the first compatible one that is kept."""
    states = prefix_tree(formats)
    kept, waiting = [0], deque((0, c) for c in sorted(states[0].next))
    while waiting:
        parent, symbol = waiting.popleft()
        b = states[parent].next[symbol]
        if b in kept:
            continue
        into = next((a for a in kept if _compatible(states, a, b, alpha)), None)
        if into is None:
            kept.append(b)
            waiting += [(b, c) for c in sorted(states[b].next)]
            continue
        states[parent].next[symbol] = into
        _fold(states, into, b)
        # Kept states may have got new continuations.
        queued = set(waiting)
        for a in kept:
            waiting += [(a, c) for c in sorted(states[a].next) if states[a].next[c] not in kept and (a, c) not in queued]
    place = {s: k for k, s in enumerate(kept)}
    return [State(states[s].count, states[s].ends, {c: place[t] for c, t in states[s].next.items()}, dict(states[s].seen)) for s in kept]


def likelihood(automaton: list[State], word: str) -> float:
    """Log probability of a format; a symbol never seen leads to a state of even probabilities."""
    choices = len(SYMBOLS) + 1
    total, at = 0.0, 0
    for symbol in word + END:
        if at is None:
            total -= math.log(choices)
            continue
        s = automaton[at]
        n = s.ends if symbol == END else s.seen.get(symbol, 0)
        total += math.log((n + SMOOTHING) / (s.count + SMOOTHING * choices))
        at = s.next.get(symbol)
    return total


@dataclass
class Model:
    """Automata and log priors by kind, and the corpus's log probabilities of a symbol after another."""

    automata: dict[str, list[State]]
    priors: dict[str, float]
    corpus: dict[str, float]
    rest: float

    def __post_init__(self):
        self.known: dict[str, bool] = {}

    def secret(self, word: str) -> bool:
        """Whether a format is a credential's."""
        if word not in self.known:
            if len(self.known) > 1 << 18:
                self.known.clear()
            self.known[word] = self.score(word) > 0
        return self.known[word]

    def score(self, word: str) -> float:
        """Log odds that a format is a credential's."""
        marked = END + word + END
        plain = self.rest + sum(self.corpus[marked[i : i + 2]] for i in range(len(marked) - 1))
        return max((self.priors[k] + likelihood(a, word) for k, a in self.automata.items()), default=-math.inf) - plain


#: Marks around a word that no candidate holds.
MARKS = ".,;:!?\"'()[]{}<>"


class Words(dict):
    """What `value` makes of the formats of a word's candidates. No candidate holds white space, so a word is judged once for all texts."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, word: str):
        found = self.value([format_of(m[0]) for m in CANDIDATE.finditer(word)])
        if len(word) <= LONGEST:
            if len(self) > 1 << 18:
                self.clear()
            self[word] = found
        return found


def spread(text: str) -> tuple[Counter, list[str], int]:
    """Formats of a text's candidates that are plain ASCII letters, the other words with a candidate, and the longest word's length."""
    plain: Counter = Counter()
    others, longest = [], 0
    for word in text.split():
        if len(word) < LEAST:
            continue
        longest = max(longest, len(word))
        word = word.strip(MARKS)
        if word.isascii() and word.isalpha():
            if len(word) >= LEAST:
                plain["a" if word.islower() else "A" if word.isupper() else "m", len(word)] += 1
        else:
            others.append(word)
    return plain, others, longest


COUNTED = "kind string, item string, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formats of labelled credentials by kind; pairs of neighbouring symbols of all candidates."""
    counts: Counter = Counter()
    shapes: Counter = Counter()
    formats = Words(lambda found: found)

    def flush() -> Iterator[pa.RecordBatch]:
        for shape, n in shapes.items():
            marked = END + shape + END
            for i in range(len(marked) - 1):
                counts["pair", marked[i : i + 2]] += n
        if counts:
            kinds, items = zip(*counts, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(items, pa.string()), pa.array(counts.values(), pa.int64())], ["kind", "item", "n"])
        counts.clear()
        shapes.clear()

    for batch in batches:
        for text in batch["text"]:
            text = text.as_py()
            plain, others, longest = spread(text)
            base = base_spans(text, longest >= LEAST_HEX)
            if base:
                for _, _, kind, value in base:
                    counts[kind, format_of(value) if len(value) <= LONGEST else ""] += 1
                shapes.update(format_of(value) for _, _, value in candidates(text, base))
            else:
                for (symbol, size), n in plain.items():
                    shapes[symbol * size] += n
                for word in others:
                    shapes.update(formats[word])
            if len(shapes) + len(counts) > 1 << 16:
                yield from flush()
    yield from flush()


def fit(docs: DataFrame) -> Model:
    """Learns from all texts; what reaches the driver are the pairs of symbols and MOST_FORMATS formats a kind."""
    docs = id_and_text(docs).select("text")
    counts = docs.mapInArrow(_count, COUNTED).groupBy("kind", "item").agg(F.sum("n").alias("n")).persist()
    try:
        pairs = Counter({r.item: r.n for r in counts.where("kind = 'pair'").collect()})
        labelled = {r.kind: r.n for r in counts.where("kind <> 'pair'").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
        chosen = {
            k: {r.item: r.n for r in counts.where((F.col("kind") == k) & (F.col("item") != "")).orderBy(F.desc("n"), "item").limit(MOST_FORMATS).collect()}
            for k in labelled
        }
    finally:
        counts.unpersist()
    others = sum(n for pair, n in pairs.items() if pair[0] == END)
    total = others + sum(labelled.values())
    choices = len(SYMBOLS) + 1
    after = Counter()
    for pair, n in pairs.items():
        after[pair[0]] += n
    corpus = {a + b: math.log((pairs[a + b] + 1) / (after[a] + choices)) for a in SYMBOLS + END for b in SYMBOLS + END}
    priors = {k: math.log(n / total) for k, n in labelled.items()}
    return Model({k: infer(f) for k, f in chosen.items() if f}, priors, corpus, math.log((others + 1) / (total + 1)))


FOUND = "doc_id long, text string, spans array<struct<kind: string, start: long, end: long>>"


def _spans(model: Model):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspect = Words(lambda found: any(map(model.secret, found)))
        for batch in batches:
            spans = []
            for text in batch["text"]:
                text = text.as_py()
                plain, others, longest = spread(text)
                base = base_spans(text, longest >= LEAST_HEX)
                found = [(start, KINDS.index(k), end) for start, end, k, _ in base]
                if any(model.secret(symbol * size) for symbol, size in plain) or any(suspect[w] for w in others):
                    found += [(start, len(KINDS), end) for start, end, value in candidates(text, base) if model.secret(format_of(value))]
                spans.append([{"kind": (*KINDS, LEARNT)[k], "start": start, "end": end} for start, k, end in sorted(found)])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], pa.array(spans, kind)], ["doc_id", "text", "spans"])

    return run


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, text, spans array of (kind, start, end)), a row for each row of docs; spans by start, then kind.

    Spans are in code points, end exclusive; the base kinds are those of KINDS, learnt spans have the kind
    `format` and touch no base span. Nulls: a missing text is empty; a missing doc_id stays null. Repeated rows
    each get the same spans. An empty table gives no rows, and texts without labelled credentials give no learnt
    spans. Texts are read whole, whatever their length. Other columns are ignored.
    """
    model = model or fit(docs)
    return id_and_text(docs).mapInArrow(_spans(model), FOUND)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents")).drop("text")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda spans: F.array_join(F.transform(spans, line), ",")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != LEARNT)), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
