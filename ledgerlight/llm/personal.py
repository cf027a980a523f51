"""Personal data by weak supervision: labelers vote on spans, their reliabilities are estimated, a classifier decides.

Spans come from fixed patterns and from looser ones.  Four labelers vote on each (pattern check,
gazetteer, context words, shape) or abstain.  Votes form at most a few hundred patterns, whatever the
corpus, so expectation-maximisation and the final classifier work on counts of patterns; texts meet
only built-in functions.  Spans of the fixed patterns always stay; of the others the classifier
keeps those it holds likelier than not.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.texts import beside, own_names
from ledgerlight.session import materialise

KINDS = ("email", "ip", "card", "phone")
#: The fixed patterns, written so that each start is tried once: possessive runs cannot backtrack, and a
#: run is entered only at its beginning or where the last match ended.  A card's run has 13 to 19 digits.
FIXED = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What must occur in a text for the pattern to be tried.
NEEDED = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]",
}
#: Looser patterns, for the classifier to decide upon.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}\x20?[\[({]\x20?at\x20?[\])}]\x20?[a-z0-9-]{2,63}(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?[a-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?[\[(]\x20?\.?(?:dot)?\x20?[\])]\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9.-])(?:[0-9]{4}[.\x20_-]){3}[0-9]{1,4}(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\(0?[0-9]{2,4}\)[\x20-]?|0[0-9]{1,4}[\x20/-])[0-9]{3,4}[\x20-]?[0-9]{3,5}(?![0-9])",
}
LOOSE_NEEDED = {
    "email": r"(?i)[\[({]\x20?at\x20?[\])}]", "ip": r"[0-9]\x20?[\[(]\x20?(?:\.|dot)", "card": r"[0-9]{4}[.\x20_-][0-9]{4}[.\x20_-]",
    "phone": r"\([0-9]{2,4}\)|0[0-9]{1,4}[\x20/-][0-9]{3}",
}
#: Gazetteers: name endings of the net, country codes, first digits of card issuers, reserved addresses.  Fixed values.
ENDINGS = (
    "com", "org", "net", "edu", "gov", "info", "biz", "io", "dev", "app", "eu", "de", "fr", "es", "it", "nl", "uk", "us", "ch", "at", "be", "pt", "ma", "ca", "mx", "br", "ar",
)
COUNTRY = r"^\+\s?(?:1|7|20|27|3[0-69]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|212|213|216|33|351|352|353|358)"
ISSUER = r"^(?:3[47]|4|5[1-5]|2[2-7]|6(?:011|5|4[4-9]))"
RESERVED = r"^(?:0|127|255|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
#: Words beside a span that speak for or against it.  Fixed values.
FOR = {
    "email": r"(?i)mail|contact|write|address|kontakt|courriel|correo",
    "ip": r"(?i)\bip\b|address|host|server|login|adresse|client",
    "card": r"(?i)card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": r"(?i)phone|tel|call|mobile|fax|cell|contact|ruf|appel|llam",
}
AGAINST = r"(?i)version|isbn|issn|order|invoice|serial|build|license|figure|table|chapter|page|§"
BESIDE = 40
BLOCK = 256         # matches whose places are counted together
CHUNK = 512         # code points of a chunk that spans are seen in, more than BESIDE
#: Fixed votes of the reliabilities before the first step: how often a labeler is thought to be right.
PRIOR, ROUNDS, PRIOR_COUNT = 0.8, 50, 4.0
VOTES = ("check", "gazetteer", "context", "shape")
MADE = (*(f"n_{k}" for k in KINDS), "base_sha256", "spans")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where the value is worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(text: Column, pattern: str, needed: str) -> Column:
    """(start, end, match) of each match, code points.  Lengths of the pieces between matches give the places.

    An array that grows by one is copied each time, so places are counted in blocks, then blocks are put
    after each other: the cost of a text is linear in its matches.
    """
    possible = F.contains(text, F.lit(needed)) if needed == "@" else text.rlike(needed)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    lengths = F.transform(F.arrays_zip(pieces.alias("p"), matches.alias("m")), lambda z: F.struct(
        F.length(z["p"]).alias("p"), F.coalesce(F.length(z["m"]), F.lit(0)).alias("l"), z["m"].alias("m")))
    empty = F.expr("struct(0 as at, cast(array() as array<struct<start:int,end:int,match:string>>) as out)")
    nowhere = F.expr("struct(0 as at, cast(array() as array<struct<at:int,out:array<struct<start:int,end:int,match:string>>>>) as out)")

    def step(state, z):
        start = state["at"] + z["p"]
        end = start + z["l"]
        return F.struct(end.alias("at"), F.when(z["l"] >= 5, F.concat(state["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), z["m"].alias("match"))))).otherwise(state["out"]).alias("out"))

    def after(state, block):
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(F.struct(
            state["at"].alias("at"), block["out"].alias("out")))).alias("out"))

    def moved(block):
        return F.transform(block["out"], lambda s: F.struct(
            (s["start"] + block["at"]).alias("start"), (s["end"] + block["at"]).alias("end"), s["match"].alias("match")))

    def places(z):
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(z) - 1) / BLOCK).cast("int")),
            lambda k: F.aggregate(F.slice(z, k * BLOCK + 1, F.lit(BLOCK)), empty, step),
        )
        return F.flatten(F.transform(F.aggregate(blocks, nowhere, after)["out"], moved))

    return F.when(possible, _with(lengths, places))


def _around(chunks: Column, span: Column) -> Column:
    """The text beside a span, from chunks of the text: a place far inside is not reached from the beginning."""
    def cut(start, length):
        chunk = F.floor(start / CHUNK).cast("int")
        near = F.concat(F.get(chunks, chunk), F.coalesce(F.get(chunks, chunk + 1), F.lit("")))
        return F.coalesce(F.substring(near, start - chunk * CHUNK + 1, length), F.lit(""))
    start = F.greatest(F.lit(0), span["start"] - BESIDE)
    return F.concat_ws(" ", cut(start, span["start"] - start), cut(span["end"], F.lit(BESIDE)))


def _meets(span: Column, others: Column) -> Column:
    """Whether a span meets one of the others, which are disjoint and in order."""
    def half(at, _):
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        going, below = at["low"] < at["high"], F.get(others, middle)["start"] < span["end"]
        return F.struct(F.when(going & below, middle + 1).otherwise(at["low"]).alias("low"),
                        F.when(going & ~below, middle).otherwise(at["high"]).alias("high"))
    # The first that starts at or after the end of the span, by halving.
    bounds = F.struct(F.lit(0).alias("low"), F.size(others).alias("high"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(31)), bounds, half)["low"]
    few = F.exists(others, lambda f: (f["start"] < span["end"]) & (span["start"] < f["end"]))
    return F.when(F.size(others) <= 32, few).otherwise(F.coalesce(F.get(others, first - 1)["end"] > span["start"], F.lit(False)))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    turned = F.reverse(_digits(match))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(turned)))

    def worth(i):
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(places, F.lit(0), lambda total, i: total + F.coalesce(worth(i), F.lit(0))) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    """The check that a span of the fixed pattern has to pass."""
    count = F.length(_digits(match))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def small(part):
            bare = F.regexp_replace(part, "^0+", "")
            return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.when((count >= 13) & (count <= 19), _luhn(match)).otherwise(F.lit(False))
    return (count >= 9) & (count <= 15)


def _vote(up: Column, down: Column) -> Column:
    return F.when(up, 1).when(down, 0).otherwise(-1)


def _votes(kind: str, chunks: Column, span: Column) -> dict[str, Column]:
    """1 for, 0 against, -1 no opinion."""
    match, digits, around = span["match"], _digits(span["match"]), _around(chunks, span)
    if kind == "email":
        ending = F.lower(F.regexp_extract(match, r"([A-Za-z]+)$", 1)).isin(*ENDINGS)
        known, shape = _vote(ending, ~ending), _vote(F.length(match) <= 80, F.length(match) > 120)
        check = _vote(match.rlike(r"^[A-Za-z0-9][^@]*@"), match.rlike(r"^[._%+-]|\.\."))
    elif kind == "ip":
        plain = F.regexp_replace(match, r"[^0-9]+", ".")
        known, check = _vote(~plain.rlike(RESERVED), plain.rlike(RESERVED)), _vote(_passes("ip", plain), ~_passes("ip", plain))
        shape = _vote(~match.rlike(r"^0+\.0|^1\.[0-9]\.[0-9]\.[0-9]$"), match.rlike(r"^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))
    elif kind == "card":
        known, check = _vote(digits.rlike(ISSUER), ~digits.rlike(ISSUER)), _vote(_passes("card", match), ~_passes("card", match))
        shape = _vote(match.rlike(r"^[0-9]{13,19}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1"), digits.rlike(r"^([0-9])\1+$"))
    else:
        known, check = _vote(match.rlike(COUNTRY), match.startswith("+") & ~match.rlike(COUNTRY)), _vote(_passes("phone", match), ~_passes("phone", match))
        shape = _vote(match.rlike(r"[ ()-]"), digits.rlike(r"([0-9])\1{6}"))
    return {"check": check, "gazetteer": known, "context": _vote(around.rlike(FOR[kind]), around.rlike(AGAINST)), "shape": shape}


def _candidates(text: Column, kind: str) -> tuple[Column, Column]:
    """Spans of the fixed and of the looser pattern, with votes; looser ones that meet a fixed one are left out later."""
    def told(span, fixed, chunks):
        votes = _votes(kind, chunks, span)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), F.lit(fixed).alias("fixed"),
            F.least(F.floor(F.length(span["match"]) / 8), F.lit(7)).cast("int").alias("size"), *[votes[v].alias(v) for v in VOTES],
        )
    nothing = F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)")
    fixed = F.filter(F.coalesce(_found(text, FIXED[kind], NEEDED[kind]), nothing), lambda s: _passes(kind, s["match"]))
    loose = F.coalesce(_found(text, LOOSE[kind], LOOSE_NEEDED[kind]), nothing)
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def voted(spans, is_fixed):
        # Only a text with spans is cut into chunks.
        return _with(spans, lambda found: _with(
            F.when(F.size(found) > 0, chunks), lambda c: F.transform(found, lambda s: told(s, is_fixed, c))))

    return voted(fixed, True), voted(loose, False)


def reliabilities(patterns: Sequence[tuple[tuple[int, ...], float]], rounds: int = ROUNDS) -> list[float]:
    """Posterior of each vote pattern (votes, count): expectation-maximisation over labelers that err independently."""
    n = len(patterns[0][0]) if patterns else 0
    right = [[PRIOR, PRIOR] for _ in range(n)]          # of a span that is (1) or isn't (0) personal
    share, posterior = 0.5, []
    for _ in range(rounds):
        posterior = []
        for votes, _ in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for (no_right, yes_right), v in zip(right, votes, strict=True):
                if v >= 0:
                    yes += math.log(yes_right if v else 1 - yes_right)
                    no += math.log(1 - no_right if v else no_right)
            posterior.append(1 / (1 + math.exp(min(50, max(-50, no - yes)))))
        total = sum(c for _, c in patterns)
        share = (sum(p * c for p, (_, c) in zip(posterior, patterns, strict=True)) + 1) / (total + 2)
        for k in range(n):
            for side in (0, 1):
                own = [(c * (p if side else 1 - p), v[k]) for p, (v, c) in zip(posterior, patterns, strict=True) if v[k] >= 0]
                agree = sum(w for w, v in own if v == side)
                right[k][side] = (agree + PRIOR * PRIOR_COUNT) / (sum(w for w, _ in own) + PRIOR_COUNT)
    return posterior


def classifier(rows: Sequence[tuple[list[float], float, float]], rounds: int = 400, keep: float = 0.01) -> list[float]:
    """Logistic regression on (features, target, count) by gradient steps, counts damped by their logarithm."""
    width = len(rows[0][0]) if rows else 0
    w = [0.0] * width
    weights = [math.log1p(c) for _, _, c in rows]
    whole = sum(weights) or 1.0
    for _ in range(rounds):
        slope = [keep * x for x in w]
        for (x, y, _), c in zip(rows, weights, strict=True):
            p = 1 / (1 + math.exp(-max(-40, min(40, sum(a * b for a, b in zip(w, x, strict=True))))))
            for k, a in enumerate(x):
                if a:
                    slope[k] += c / whole * (p - y) * a
        w = [a - 1.0 * s for a, s in zip(w, slope, strict=True)]
    return w


def _features(votes: Sequence[int], size: int) -> list[float]:
    return [1.0, *[float(v == 1) for v in votes], *[float(v == 0) for v in votes], size / 8]


@own_names("text")
def personal_spans(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns, counts of the fixed kinds, their digest, and all spans as kind:start:end.

    Kinds in the order of KINDS, then starts; code points, ends exclusive.  Null and empty texts have
    no spans.  The classifier is trained on all spans of the table, by kind.  Rows that repeat an id, or
    have none, are rows of their own; a carried column with the name of a result column is replaced.
    The work of a text grows with its length and its matches, not with their square.
    """
    kept = beside(docs, MADE, carry)
    body = F.col("_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))
    both = [_candidates(body, k) for k in KINDS]
    by_kind = [f"_fixed_{k}" for k in KINDS]
    rows = rows.select(
        *[F.col(f"`{c}`") for c in kept], *[b[0].alias(c) for b, c in zip(both, by_kind, strict=True)],
        F.concat(*[b[1] for b in both]).alias("_loose"),
    )
    free = F.filter("_loose", lambda s: ~functools.reduce(operator.or_, [_meets(s, F.col(c)) for c in by_kind]))
    # One row per text with its few spans: read by the counts and by the result.
    rows = materialise(rows.select(*[F.col(f"`{c}`") for c in kept], F.concat(*by_kind).alias("_fixed"), free.alias("_loose")))

    patterns = rows.select(F.explode(F.concat("_fixed", "_loose")).alias("s")).select("s.*").groupBy("kind", "size", *VOTES).count().collect()
    weights: dict[int, list[float]] = {}
    for kind in range(len(KINDS)):
        own = [r for r in patterns if r["kind"] == kind]
        by_votes: dict[tuple[int, ...], float] = {}
        for r in own:
            votes = tuple(r[v] for v in VOTES)
            by_votes[votes] = by_votes.get(votes, 0) + r["count"]
        ordered = sorted(by_votes.items())
        posterior = dict(zip([v for v, _ in ordered], reliabilities(ordered), strict=True))
        weights[kind] = classifier(sorted(
            (_features(v := tuple(r[x] for x in VOTES), r["size"]), posterior[v], float(r["count"])) for r in own
        ))

    def likely(s):
        total = F.lit(-1.0)
        for kind, w in weights.items():
            if w:
                up, down, size = w[1 : 1 + len(VOTES)], w[1 + len(VOTES) : -1], w[-1]
                value = F.lit(w[0]) + s["size"] / 8 * size
                for name, u, d in zip(VOTES, up, down, strict=True):
                    value = value + F.when(s[name] == 1, u).when(s[name] == 0, d).otherwise(0.0)
                total = F.when(s["kind"] == kind, value).otherwise(total)
        return total > 0

    name = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda spans: F.array_join(F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))),
        lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("_fixed", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(len(KINDS))]
    return rows.select(
        *[F.col(f"`{c}`") for c in kept], *counts, F.sha2(listed(F.col("_fixed")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("_fixed", F.filter("_loose", likely))).alias("spans"),
    )
