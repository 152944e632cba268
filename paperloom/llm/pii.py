"""Personal data by candidate gradient boosting, on DataFrame functions alone.

Base rules find emails, IPv4 addresses, payment cards (Luhn) and international phone numbers; what they accept stays.
Generators of high recall propose further, overlapping spans of the same kinds: spelled-out or bracketed addresses,
IPv6, other separators, national numbers. Every proposal gets features of its format and of the words around it, and
boosted trees score it. The trees are trained in numpy on the driver from generated sentences of fixed number
(``SENTENCES``), which pass through the very same generators and features; half of them set, per kind, the threshold
at which accepted proposals are right with ``PRECISION``. The trees become one SQL expression. Accepted proposals that
overlap no base span and no better proposal join the spans.

Everything is computed within a document's row: there is no shuffle. Patterns use possessive repeats, so that long
runs of one character class take linear time and no stack.

Nulls and odd rows: a null text is an empty one. Rows are independent; null or repeated ids pass through. An empty
table gives no rows. Extra columns pass through ``find`` unless they carry its output's names. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns. A run that fails at its first character fails at every later one, so that only run starts are
#: tried; \G lets a match begin where the last one ended.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:@|\(at\)|\[at\]|\{at\}|(?<= )at(?= ))"
_DOT = r"(?:\.|\(dot\)|\[dot\]|\{dot\}|(?<= )dot(?= ))"
PROPOSED = {
    "email": rf"(?i)(?<!{LOCAL}){LOCAL}{{1,64}}+ ?{_AT} ?[A-Za-z0-9-]{{1,63}}+(?: ?{_DOT} ?[A-Za-z0-9-]{{1,63}}+){{1,6}}+",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}+)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ ./_-]{0,2}+[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+])\(?[0-9](?:[ ()./-]{0,2}+[0-9]){6,14}+(?![0-9A-Za-z])",
}
#: What a text must hold for a pattern to match at all.
NEEDS = {"email": "contains(text, '@')", "ip": "text rlike '[0-9]'", "card": "text rlike '[0-9]'", "phone": "contains(text, '+')"}
PROPOSAL_NEEDS = {"email": "(contains(text, '@') OR text rlike '(?i)[ \\\\[({]at[ \\\\])}]')", "ip": "text rlike '[0-9]'", "card": "text rlike '[0-9]'", "phone": "text rlike '[0-9]'"}
#: Code points of context on either side, as far as the neighbouring matches.
CONTEXT = 32
WORDS = {
    "ctx_mail": "mail|contact|correo|courriel|kontakt|write to|schreib",
    "ctx_phone": "phone|tel|call|mobile|fax|ruf|appel|llam|handy",
    "ctx_net": "ip|host|server|addr|ping|client|login",
    "ctx_card": "card|visa|master|amex|credit|karte|carte|tarjeta|pay",
    "ctx_other": "version|section|order|invoice|isbn|token|ref|serial|build|page|chapter|release|no\\\\.|#|date|total",
}
FEATURES = ["kind", "length", "digits", "letters", "runs", "longest_run", "luhn", "octets", "dots", "colons", "spaces", "parens", "dashes", "brackets", "at_word", "ending", *WORDS]
SENTENCES = 2400
TREES = 40
DEPTH = 3
RATE = 0.3
PRECISION = 0.98
SEED = 11


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Matches whose places are summed up in one go; arrays grow by appending within a block only.
BLOCK = 256


def _matches(pattern: str) -> str:
    """SQL: array of (s, e, m, before, after) of the pattern's leftmost, non-overlapping matches in ``text``.

    A match begins where the gaps and matches before it end. Gaps and matches are taken in blocks, whose lengths give
    where each block begins, so that a text with very many matches takes about linear time. ``before`` and ``after``
    are the nearest CONTEXT code points of the gaps around a match.
    """
    p = _quoted(pattern)
    none = "CAST(array() AS array<struct<s:int,e:int,m:string,before:string,after:string>>)"
    zipped = f"transform(array(split(text, {p}, -1)), g -> arrays_zip(transform(g, y -> y), regexp_extract_all(text, {p}, 0), slice(g, 2, size(g))))[0]"
    own = f"slice(z, n * {BLOCK} + 1, {BLOCK})"
    numbers = f"sequence(0, CAST((size(z) - 1) div {BLOCK} AS int))"
    starts = f"aggregate(transform({numbers}, n -> aggregate({own}, 0, (a, x) -> a + length(x['0']) + coalesce(length(x['1']), 0))), array(0), (a, v) -> concat(a, array(element_at(a, -1) + v)))"
    match = f"named_struct('s', a.at + length(x['0']), 'e', a.at + length(x['0']) + length(x['1']), 'm', x['1'], 'before', substring(x['0'], -{CONTEXT}, {CONTEXT}), 'after', substring(x['2'], 1, {CONTEXT}))"
    found = f"aggregate({own}, named_struct('at', firsts[n], 'out', {none}), (a, x) -> IF(x['1'] IS NULL, a, named_struct('at', a.at + length(x['0']) + length(x['1']), 'out', concat(a.out, array({match})))), a -> a.out)"
    return f"transform(array({zipped}), z -> transform(array({starts}), firsts -> flatten(transform({numbers}, n -> {found})))[0])[0]"


def _count_before(spans: str, condition: str) -> str:
    """SQL: how many of the sorted spans fulfil a condition on ``x`` that holds up to some place, by halving."""
    mid = "shiftright(a.lo + a.hi, 1)"
    return (
        f"aggregate(sequence(1, length(bin(size({spans})))), named_struct('lo', 0, 'hi', size({spans})), (a, i) -> IF(a.lo >= a.hi, a, "
        f"IF({condition.replace('x.', f'{spans}[{mid}].')}, named_struct('lo', {mid} + 1, 'hi', a.hi), named_struct('lo', a.lo, 'hi', {mid}))), a -> a.lo)"
    )


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    return f"aggregate(transform(split(reverse({digits}), ''), (d, i) -> CAST(d AS int) * (1 + i % 2)), 0, (a, v) -> a + v - IF(v > 9, 9, 0)) % 10 = 0"


_OCTET = "rlike '^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$'"
#: What a base match must be, for the match ``x.m``.
ACCEPT = {
    "email": "true",
    "ip": f"forall(split(x.m, '\\\\.'), o -> o {_OCTET})",
    "card": f"IF(length({_digits('x.m')}) BETWEEN 14 AND 19, {_luhn(_digits('x.m'))}, false)",
    "phone": f"length({_digits('x.m')}) BETWEEN 10 AND 15",
}


def base_spans(kind: str) -> Column:
    """Array of (s, k, e): the base spans of a kind in ``text``, ``k`` the kind's number."""
    k = KINDS.index(kind)
    none = "CAST(array() AS array<struct<s:int,k:int,e:int>>)"
    found = f"transform(filter({_matches(BASE[kind])}, x -> {ACCEPT[kind]}), x -> named_struct('s', x.s, 'k', {k}, 'e', x.e))"
    return F.expr(f"CASE WHEN {NEEDS[kind]} THEN {found} ELSE {none} END")


def proposals() -> Column:
    """Array of (s, k, e, f): what the generators propose in ``text``, with features."""
    each = []
    for k, kind in enumerate(KINDS):
        around = "lower(concat(x.before, ' ', x.after))"
        count = lambda pattern: f"size(regexp_extract_all(x.m, {_quoted(pattern)}, 0))"
        digits = _digits("x.m")
        values = {
            "kind": str(k), "length": "length(x.m)", "digits": f"length({digits})", "letters": count("[A-Za-z]"), "runs": count("[0-9]+"),
            "longest_run": "coalesce(array_max(transform(regexp_extract_all(x.m, '[0-9]+', 0), r -> length(r))), 0)",
            "luhn": f"IF(length({digits}) BETWEEN 12 AND 19, IF({_luhn(digits)}, 1, 0), 0)",
            "octets": f"size(filter(regexp_extract_all(x.m, '[0-9]+', 0), o -> o {_OCTET}))",
            "dots": count("[.]"), "colons": count(":"), "spaces": count(" "), "parens": count("[()]"), "dashes": count("-"), "brackets": count("[\\[\\]{}]"),
            "at_word": "IF(x.m rlike '(?i)(^|[^a-z])at([^a-z]|$)', 1, 0)", "ending": "IF(x.m rlike '[A-Za-z]{2,6}$', 1, 0)",
            **{name: f"IF({{around}} rlike '{words}', 1, 0)".replace("{around}", around) for name, words in WORDS.items()},
        }
        features = ", ".join(f"CAST({values[n]} AS double)" for n in FEATURES)
        found = f"transform({_matches(PROPOSED[kind])}, x -> named_struct('s', x.s, 'k', {k}, 'e', x.e, 'f', array({features})))"
        none = "CAST(array() AS array<struct<s:int,k:int,e:int,f:array<double>>>)"
        each.append(f"CASE WHEN {PROPOSAL_NEEDS[kind]} THEN {found} ELSE {none} END")
    return F.expr(f"concat({', '.join(each)})")


def sentences(n: int = SENTENCES, seed: int = SEED) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated texts with their personal data as (kind number, start, end); half of them hold look-alikes only."""
    rng = random.Random(seed)
    syllables = ["an", "er", "ti", "on", "re", "le", "de", "sch", "ment", "ar", "os", "ue", "ing", "ver", "pa", "to"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def luhn_number(k: int, right: bool) -> str:
        body = rng.choice("3456") + digits(k - 2)
        total = sum(d - 9 if d > 9 else d for d in (int(c) * (2 - i % 2) for i, c in enumerate(reversed(body))))
        last = (10 - total % 10) % 10
        return body + str(last if right else (last + rng.randint(1, 9)) % 10)

    def grouped(number: str, sep: str) -> str:
        return sep.join(number[i : i + 4] for i in range(0, len(number), 4))

    def email() -> str:
        at = rng.choice(["@", " at ", " [at] ", "(at)", "{at}", " @ "])
        dot = rng.choice([".", " dot ", "[dot]", "(dot)"]) if at != "@" or rng.random() < 0.5 else "."
        return f"{word()}{rng.choice(['', '.', '_'])}{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'fr', 'de', 'es', 'info'])}"

    def ip() -> str:
        if rng.random() < 0.4:
            return ":".join(f"{rng.getrandbits(16):x}" for _ in range(8))
        return rng.choice(["[.]", "(.)", "[dot]"]).join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        return grouped(luhn_number(rng.choice([15, 16, 16, 16]), True), rng.choice([".", "/", "_", "  "]))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{digits(2)} {digits(3)} {digits(4)}", f"00{digits(2)} {digits(3)} {digits(6)}", f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}"])

    look_alikes = [
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", lambda: ".".join(str(rng.randint(0, 40)) for _ in range(rng.choice([3, 5, 6]))),
        lambda: luhn_number(rng.choice([13, 15, 16, 18]), False), lambda: grouped(luhn_number(16, False), rng.choice([" ", "-", "."])), lambda: digits(rng.randint(7, 15)), lambda: f"{rng.randint(1, 23):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}",
        lambda: f"{rng.randint(1, 999)},{digits(3)}.{digits(2)}", lambda: f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)), lambda: f"{digits(4)}-{digits(4)}-{digits(2)}",
        lambda: f"{rng.randint(1900, 2030)}/{rng.randint(1900, 2030)} {digits(4)}", lambda: f"{word()} at {word()} {word()}", lambda: f"{word()} at {word()}. {word().capitalize()}", lambda: f"look at the dot {word()}", lambda: f"{word()} @ {word()}", lambda: f"{word()}: {word()}.{word()}",
        lambda: f"{word()} at the dot of {word()}", lambda: ".".join(str(rng.randint(256, 999)) for _ in range(4)), lambda: f"{digits(2)} {digits(2)} {digits(3)} {digits(3)}", lambda: f"::{word()}", lambda: f"{digits(3)} {digits(3)} {digits(3)} {digits(3)}",
    ]
    before = [["mail", "contact", "correo", "courriel", "write to"], ["ip", "host", "server", "client addr"], ["card", "visa", "credit card", "tarjeta", "carte", "pay with"], ["phone", "tel", "call", "mobile", "fax"]]
    other = ["version", "section", "order", "invoice", "isbn", "token", "ref", "serial", "build", "page", "total", "date", "see", "the", "and", "de"]
    out = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(rng.randint(2, 9))) + " ", []
        if rng.random() < 0.5:
            k = rng.randrange(4)
            if rng.random() < 0.7:
                text += rng.choice(before[k]) + rng.choice([" ", ": "])
            value = (email, ip, card, phone)[k]()
            spans.append((k, len(text), len(text) + len(value)))
        else:
            if rng.random() < 0.6:
                text += rng.choice(other) + rng.choice([" ", ": ", " no. "])
            value = rng.choice(look_alikes)()
        text += value + rng.choice([" ", ", ", ". ", "\n"]) + " ".join(word() for _ in range(rng.randint(2, 9)))
        out.append((text, spans))
    return out


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int):
    """A tree as nested (feature, threshold, left, right); leaves are numbers."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    leaf, best, split = -total_g / (total_h + 1) * RATE, 1e-6, None
    if depth and len(rows) > 10:
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            if len(values) > 1:
                cuts = (values[1:] + values[:-1]) / 2
                for t in cuts if len(cuts) <= 32 else np.unique(np.quantile(cuts, np.linspace(0, 1, 32), method="nearest")):
                    left = x[rows, f] <= t
                    gl, hl = g[rows][left].sum(), h[rows][left].sum()
                    gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
                    if gain > best and min(hl, total_h - hl) > 0.5:
                        best, split = gain, (f, float(t), left)
    if split is None:
        return float(leaf)
    f, t, left = split
    return f, t, _grow(x, g, h, rows[left], depth - 1), _grow(x, g, h, rows[~left], depth - 1)


def _predict(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, t, a, b = tree
    return np.where(x[:, f] <= t, _predict(a, x), _predict(b, x))


def boost(x: np.ndarray, wanted: np.ndarray) -> list:
    """Boosted trees for the logistic loss."""
    score, trees = np.zeros(len(x)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(x, p - wanted, p * (1 - p), np.arange(len(x)), DEPTH))
        score += _predict(trees[-1], x)
    return trees


def threshold(scores: np.ndarray, wanted: np.ndarray) -> float:
    """The lowest score from which proposals are right with PRECISION; never below even odds."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(wanted[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(right >= PRECISION)
    return max(0.0, float(scores[order][good[-1]])) if len(good) else float("inf")


def tree_sql(tree, features: str) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    f, t, a, b = tree
    return f"IF({features}[{f}] <= {t!r}D, {tree_sql(a, features)}, {tree_sql(b, features)})"


def train(spark: SparkSession) -> tuple[list, list[float]]:
    """(trees, thresholds by kind) from the generated sentences; the same on every run."""
    made = sentences()
    rows = spark.range(1).select(F.posexplode(F.array(*[F.lit(t) for t, _ in made])).alias("i", "text")).select("i", F.explode(proposals()).alias("c")).select("i", "c.s", "c.k", "c.e", "c.f")
    x, wanted, half = [], [], []
    for r in rows.collect():
        true = [(s, e) for k, s, e in made[r.i][1] if k == r.k]
        overlap = max([(min(r.e, e) - max(r.s, s)) / (max(r.e, e) - min(r.s, s)) for s, e in true], default=0)
        x.append(r.f)
        wanted.append(overlap >= 0.8)
        half.append(r.i % 2)
    x, wanted, half = np.array(x), np.array(wanted, float), np.array(half)
    trees = boost(x[half == 0], wanted[half == 0])
    scores = sum(_predict(t, x) for t in trees)
    back = half == 1
    return trees, [threshold(scores[back & (x[:, 0] == k)], wanted[back & (x[:, 0] == k)]) for k in range(len(KINDS))]


@lru_cache(maxsize=1)
def _model_sql() -> tuple[str, str]:
    trees, limits = train(SparkSession.active())
    score = " + ".join(tree_sql(t, "c.f") for t in trees)
    limit = f"element_at(array({', '.join('1e300D' if v == float('inf') else f'{v!r}D' for v in limits)}), c.k + 1)"
    return score, limit


def _spans(docs: DataFrame) -> DataFrame:
    """(own, text, base, added) of every row, ``own`` its columns.

    Matches of one kind never overlap each other, so that those of a kind which overlap a span lie side by side, from
    the first that ends after its start to the last that begins before its end; both are found by halving.
    """
    score, limit = _model_sql()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), storage.text_or_empty().alias("text"))
    row = row.select("own", "text", *[base_spans(k).alias(f"base{i}") for i, k in enumerate(KINDS)], proposals().alias("proposed"))
    taken = [f"element_at(base{k}, nullif({_count_before(f'base{k}', 'x.s < c.e')}, 0)).e > c.s" for k in range(len(KINDS))]
    free = F.when(F.size("proposed") > 0, F.expr(f"filter(proposed, c -> NOT ({' OR '.join(f'coalesce({t}, false)' for t in taken)}))"))
    row = row.select("own", "text", F.array_sort(F.concat(*[F.col(f"base{k}") for k in range(len(KINDS))])).alias("base"), free.alias("free"))
    scored = F.expr(f"filter(transform(free, c -> named_struct('s', c.s, 'k', c.k, 'e', c.e, 'margin', ({score}) - {limit})), c -> c.margin >= 0)")
    row = row.select("own", "text", "base", F.when(F.size("free") > 0, scored).alias("scored"))
    row = row.select("own", "text", "base", "scored", *[F.expr(f"filter(scored, x -> x.k = {k})").alias(f"kind{k}") for k in range(len(KINDS))])
    ahead = "(d.margin > c.margin OR (d.margin = c.margin AND (d.s < c.s OR (d.s = c.s AND d.k < c.k))))"
    better = []
    for k in range(len(KINDS)):
        first, last = _count_before(f"kind{k}", "x.e <= c.s"), _count_before(f"kind{k}", "x.s < c.e")
        better.append(f"exists(slice(kind{k}, {first} + 1, greatest({last} - {first}, 0)), d -> {ahead})")
    best = F.expr(f"transform(filter(scored, c -> NOT ({' OR '.join(better)})), c -> named_struct('s', c.s, 'k', c.k, 'e', c.e))")
    added = F.coalesce(F.when(F.size("scored") > 0, F.array_sort(best)), F.expr("CAST(array() AS array<struct<s:int,k:int,e:int>>)"))
    return row.select("own", "text", "base", added.alias("added"))


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``added`` spans, arrays of (s, k, e) in order of start, then kind; columns of those
    names are replaced."""
    kept = [c for c in docs.columns if c not in ("base", "added")]
    return _spans(docs.select(*[F.col(f"`{c}`") for c in kept])).select(*[F.col(f"own.`{c}`").alias(c) for c in kept], "base", "added")


def spans_text(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform(array_sort({spans}), x -> concat_ws(':', element_at(array({names}), x.k + 1), x.s, x.e)), ',')")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans by the first one's."""
    names = ", ".join(f"'[{k}]'" for k in KINDS)
    found = _spans(docs)
    pieces = F.expr(
        f"aggregate(array_sort(concat(base, added)), named_struct('at', 0, 'out', CAST(array() AS array<string>)), (a, x) -> IF(x.s < a.at, named_struct('at', greatest(a.at, x.e), 'out', a.out), "
        f"named_struct('at', x.e, 'out', concat(a.out, array(substring(text, a.at + 1, x.s - a.at), element_at(array({names}), x.k + 1))))), a -> concat(array_join(a.out, ''), substring(text, a.at + 1)))"
    )
    return found.select(*[F.when(F.size("base") + F.size("added") > 0, pieces).otherwise(F.col("own.text")).alias("text") if c == "text" else F.col(f"own.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the personal data of every document."""
    found = find(storage.documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.expr(f"CAST(size(filter(base, x -> x.k = {i})) AS long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("concat(base, added)").alias("spans"))
