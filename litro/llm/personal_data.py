"""Personal data: validated patterns, and secrets found by weak supervision. Native functions only.

Patterns find e-mail and IP addresses, card and phone numbers. For secrets (keys, tokens, passwords)
every long run of key characters is a candidate on which three labelers vote: a regular expression
on its shape, a gazetteer of words before it, and the marks of an assignment before it.
Expectation-maximisation estimates how reliable each labeler is from the counts of vote patterns,
and its posteriors train a naive Bayes classifier on the candidates' own features, which decides.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import cut, id_and_text, table

#: A match of e-mail starts at the start of a run of its characters, or where the last match ended; so
#: does one of IP with digits. Possessive groups find the same matches without a deep stack or new tries.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_KEY = "A-Za-z0-9+/_-"
#: A candidate for a secret: a whole run of 12 key characters or more, not the name of an address.
CANDIDATE = rf"(?<![{_KEY}])[{_KEY}]{{12,}}+(?!@)"
#: Words that announce a secret.
GAZETTEER = ("token", "password", "passwd", "secret", "api_key", "apikey", "api-key", "access_key", "private_key", "auth")
LABELERS = ("shape", "gazetteer", "context")
#: Code points before a candidate that the gazetteer and the context labeler read.
BEFORE = 32
ROUNDS = 50
#: Entries of an array, or code points of a text, that are handled at once.
BLOCK = 256


def _luhn(digits: Column) -> Column:
    """Whether the digits' check sum is right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, add) -> Column:
    """Running totals of an array of longs under `add`. Arrays grow within blocks only, so that no long array is copied for each entry."""

    def within(block: Column) -> Column:
        grown = lambda done, x: F.concat(done, F.array(F.coalesce(add(F.try_element_at(done, F.lit(-1)), x), x)))
        return F.aggregate(block, F.array().cast("array<bigint>"), grown)

    def of_blocks(blocks: Column) -> Column:
        ends = within(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return _let(ends, lambda e: F.flatten(F.transform(blocks, lambda b, k: F.when(k == 0, b).otherwise(F.transform(b, lambda x: add(F.get(e, k - 1), x))))))

    def of_values(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v), F.lit(BLOCK))
        several = _let(F.transform(starts, lambda s: within(F.slice(v, s, BLOCK))), of_blocks)
        return F.when(F.size(v) <= BLOCK, within(v)).otherwise(several)

    return _let(values, of_values)


def _located(text: str, pattern: str) -> Column:
    """array of (start, end, match, before) of the pattern's matches, in code points; before is what stands before a match,
    back to the match before the last at most."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string,before:string>>")

    def found(pairs: Column) -> Column:
        ends = _running(F.transform(pairs, lambda p: (F.length(p["piece"]) + F.length(p["match"])).cast("long")), lambda a, b: a + b)

        def one(end: Column, k: Column) -> Column:
            pair, last = F.get(pairs, k), F.coalesce(F.get(pairs, k - 1)["match"], F.lit(""))
            before = F.right(F.concat(last, pair["piece"]), F.lit(BEFORE))
            return F.struct((end - F.length(pair["match"])).alias("start"), end.alias("end"), pair["match"].alias("match"), before.alias("before"))

        return F.transform(ends, one)

    def paired(m: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), 1, F.size(m))
        return F.zip_with(pieces, m, lambda p, x: F.struct(p.alias("piece"), x.alias("match")))

    return _let(matches, lambda m: F.when(F.size(m) == 0, none).otherwise(_let(paired(m), found)))


def _votes(candidate: Column) -> dict[str, Column]:
    """1 for, 0 against."""
    match, before = candidate["match"], F.lower(candidate["before"])
    shape = match.rlike("[0-9]") & match.rlike("[A-Za-z]") & match.rlike("^[A-Za-z0-9+/_-]{16,}$")
    named = before.rlike("(?:" + "|".join(GAZETTEER) + ")[\"']?\\s*[:=]?\\s*[\"']?$")
    assigned = before.rlike("[=:]\\s*[\"']?$")
    return {"shape": shape.cast("int"), "gazetteer": named.cast("int"), "context": assigned.cast("int")}


def _features(match: Column) -> dict[str, Column]:
    """What the final classifier reads of a candidate, in a few values each."""
    n = F.length(match)
    digits = n - F.length(F.translate(match, "0123456789", ""))
    return {
        "digits": F.least(F.floor(10 * digits / n), F.lit(9)).cast("int"),
        "length": F.least(F.floor(n / 8), F.lit(8)).cast("int"),
        "hex": match.rlike("^[0-9a-f]+$").cast("int"),
        "cases": F.when(match.rlike("[a-z]"), 1).otherwise(0) + F.when(match.rlike("[A-Z]"), 2).otherwise(0),
    }


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]], dict]:
    """Share of secrets, each labeler's rate of votes for (on secrets, on others), and each vote pattern's posterior.

    Expectation-maximisation over independent labelers; the start takes the majority for true.
    """
    total = sum(patterns.values())
    post = {p: 0.9 if 2 * sum(p) > len(p) else 0.1 for p in patterns}
    share, rates = 0.5, [(0.5, 0.5)] * len(LABELERS)
    for _ in range(rounds if total else 0):
        yes = sum(n * post[p] for p, n in patterns.items())
        share = min(1 - 1e-6, max(1e-6, yes / total))
        rates = [
            (
                (sum(n * post[p] * p[k] for p, n in patterns.items()) + 0.5) / (yes + 1),
                (sum(n * (1 - post[p]) * p[k] for p, n in patterns.items()) + 0.5) / (total - yes + 1),
            )
            for k in range(len(LABELERS))
        ]
        for p in patterns:
            odds = math.log(share / (1 - share))
            for v, (a, b) in zip(p, rates, strict=True):
                odds += math.log(a / b) if v else math.log((1 - a) / (1 - b))
            post[p] = 1 / (1 + math.exp(-odds))
    return share, rates, post


def classifier(found: DataFrame) -> dict[tuple[str, int], float]:
    """Log odds by (feature, value), and by ("prior", 0). Only counts by votes and by feature values reach the driver."""
    one = F.explode("candidates").alias("c")
    rows = found.where(F.size("candidates") > 0).select(one)
    votes, features = _votes(F.col("c")), _features(F.col("c.match"))
    rows = rows.select(F.array(*votes.values()).alias("votes"), *[c.alias(k) for k, c in features.items()])
    counts = rows.groupBy("votes", *features).count().collect()  # 8 votes, 720 feature values at most
    patterns: dict[tuple[int, ...], int] = defaultdict(int)
    for r in counts:
        patterns[tuple(r.votes)] += r["count"]
    share, _, post = reliabilities(patterns)
    yes: dict[tuple[str, int], float] = defaultdict(float)
    no: dict[tuple[str, int], float] = defaultdict(float)
    for r in counts:
        p = post[tuple(r.votes)]
        for values in [(k, r[k]) for k in features] + list(zip(LABELERS, r.votes, strict=True)):
            yes[values] += r["count"] * p
            no[values] += r["count"] * (1 - p)
    total = sum(patterns.values())
    t, f = sum(n * post[p] for p, n in patterns.items()) + 1, sum(n * (1 - post[p]) for p, n in patterns.items()) + 1
    odds = {v: math.log((yes[v] + 0.5) / t) - math.log((no[v] + 0.5) / f) for v in yes}
    return odds | {("prior", 0): math.log(share / (1 - share)) if total else -10.0}


def _decide(candidate: Column, odds: dict[tuple[str, int], float]) -> Column:
    total = F.lit(odds["prior", 0])
    for name, value in (_features(candidate["match"]) | _votes(candidate)).items():
        known = {v: w for (k, v), w in odds.items() if k == name}
        weight = F.lit(0.0)
        for v, w in known.items():
            weight = F.when(value == v, w).otherwise(weight)
        total = total + weight
    return total > 0


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans array of (kind, start, end)): base kinds as listed in PATTERNS, then secret, by start.

    Spans are in code points, end exclusive. Spans of different kinds may overlap; each is reported
    whole. Nulls: a missing text is empty; a missing doc_id stays null. Repeated rows each get the same
    spans. An empty table gives no rows. Other columns are ignored.
    """
    docs = id_and_text(docs)
    kept = [_located("text", pattern).alias(kind) for kind, pattern in PATTERNS.items()]
    found = cut(docs.select("doc_id", "text", *kept, _located("text", CANDIDATE).alias("candidates")))
    odds = classifier(found)

    def spans(column: str, kind: str, test) -> Column:
        return F.transform(F.filter(column, test), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def checked(kind: str) -> Column:
        return spans(kind, kind, lambda s: _valid(kind, s["match"]))

    base = found.select("doc_id", "text", "candidates", F.concat(*[checked(k) for k in PATTERNS]).alias("base"))
    secret = spans("candidates", "secret", lambda s: _decide(s, odds))
    return base.select("doc_id", "text", F.concat("base", secret).alias("spans"))


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text that is given in blocks of BLOCK code points."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    block = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    inside = lambda place: (place % BLOCK).cast("int")
    one = F.substring(block(first), inside(start) + 1, (end - start).cast("int"))
    several = F.concat(F.substring(block(first), inside(start) + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, first + 2, last - first - 1), ""), F.substring(block(last), F.lit(1), inside(end)))
    return F.when(start >= end, "").when(first == last, one).otherwise(several)


def redact(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans, redacted): each span replaced by its kind in angle brackets; overlapping spans as one, by the
    kind of the first, the longer one. Nulls, repeated rows and empty tables as in `find`; a missing text becomes an empty one."""
    found = find(docs)
    order = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))

    def joined(spans: Column, reach: Column) -> Column:
        """Spans that no earlier one reaches, each with the end of the union it opens and that of the one before."""
        opens = F.filter(F.transform(spans, lambda s, k: F.when((k == 0) | (s["start"] >= F.get(reach, k - 1)), k)), lambda k: k.isNotNull())

        def union(o: Column) -> Column:
            end = lambda j: F.coalesce(F.get(reach, F.get(o, j + 1) - 1), F.element_at(reach, -1))
            at = lambda k, j: F.struct(F.get(spans, k)["start"].alias("start"), F.get(spans, k)["kind"].alias("kind"), end(j).alias("end"), F.when(j == 0, F.lit(0).cast("long")).otherwise(end(j - 1)).alias("last"))
            return F.transform(o, at)

        return _let(opens, union)

    def replaced(spans: Column, blocks: Column) -> Column:
        unions = _let(_running(F.transform(spans, lambda s: -s["back"]), F.greatest), lambda reach: joined(spans, reach))
        piece = lambda u: F.concat(_between(blocks, u["last"], u["start"]), F.lit("<"), F.upper(u["kind"]), F.lit(">"))
        rest = lambda u: _between(blocks, F.element_at(u, -1)["end"], F.length("text").cast("long"))
        return _let(unions, lambda u: F.concat(F.array_join(F.transform(u, piece), ""), rest(u)))

    cut_up = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    clean = _let(order, lambda spans: _let(cut_up, lambda blocks: replaced(spans, blocks)))
    return found.select("doc_id", "text", "spans", F.when(F.size("spans") == 0, F.col("text")).otherwise(clean).alias("redacted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda spans: F.array_join(F.transform(spans, line), ",")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "secret")), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
