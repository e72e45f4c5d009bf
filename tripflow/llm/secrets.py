"""Secret scans: rule matches, and a sliding-window entropy search for what no rule knows. DataFrame operations only, one map-only pass.

Rules. ``RULES`` match leftmost and without overlap; matches that are too short are dropped after matching, as dropping them during
matching would let others start inside them. Positions come from the texts between matches, which ``split`` returns.

Entropy. Candidates are runs of ``CANDIDATE``; a candidate belongs to one character class, which sets its threshold. A window of ``WINDOW``
characters moves over it. Entering and leaving characters change counts and the sum of c*log2(c), kept in whole numbers, so that the sum is exact
however long the run. The span reaches from the first window above the threshold to the end of the last. Candidates that match
``FORMS`` and spans with one of ``SAMPLES`` inside are not reported; rule matches always are.

Defined results: a null or empty text has no spans. A null doc_id and repeated rows are carried through. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, a cheap condition that every text with a match meets, pattern, the group whose length counts, the least length. In this order.
RULES = (
    (
        "assign", r"(?i)passw|secret|token|api_?key",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12,
    ),
    ("access", "AKIA", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16}", r"[0-9a-f]{16,}", 0, 16),  # maximal runs, so short ones can be left out of the pattern
)
ENTROPY = "entropy"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character classes with their least entropy in bits per character; the first that fits counts. Letters of one case are prose or paths.
CLASSES = (
    (r"\A[0-9]+\z", 3.1),
    (r"\A[0-9a-f]+\z|\A[0-9A-F]+\z", 3.2),
    (r"\A(?=.*[0-9])(?=.*[A-Za-z]).*\z", 3.8),
    (r"\A(?=.*[a-z])(?=.*[A-Z])[^0-9]*\z", 4.0),
)
#: Words of samples, which excuse a span that they are in.
SAMPLES = r"(?i)example|sample|placeholder|changeme|dummy|0123456789|abcdefgh"
#: Whole candidates that look random and are no secrets.
FORMS = (
    r"(?i)x{6}"
    r"|\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
    r"|\Asha(?:1|256|384|512)[-_=]"
)
ALLOWED = f"{SAMPLES}|{FORMS.removeprefix('(?i)')}"
#: c*log2(c) in units of 2**-20 bit.
SCALE = 1 << 20
WEIGHTS = [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WINDOW + 2)]
LOWEST, HIGHEST = ord("+"), ord("z")
#: Counts reach WINDOW at most, so that 12 of them fit in a long: a step rewrites 7 numbers and not 80.
COUNT_BITS, PACKED = 5, 12
#: Matches whose positions are summed up in one go; see ``positions``.
BLOCK = 512


def most_weight(bits: float) -> int:
    """The largest sum of weights of a window whose entropy is at least ``bits``."""
    return WEIGHTS[WINDOW] - math.ceil(bits * WINDOW * SCALE)


def _let(name: str, value: str, body: str) -> str:
    """``body`` of a value that is computed once: a lambda variable, not an expression that is copied."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_ONE = "struct<start:bigint,end:bigint,body:string,size:bigint>"
_MATCH = f"array<{_ONE}>"


def _state(at: str, found: str, kind: str) -> str:
    return f"CAST(struct({at}, {found}) AS struct<at:bigint,found:{kind}>)"


def matches(text: Column, guard: str, pattern: str, group: int) -> Column:
    """array<struct<gap, body, part>>: the matches, each with the text before it and one of its groups. Null where the guard fails."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("body"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    # The last piece is the text after the last match.
    return F.when(text.rlike(guard), F.filter(pieces, lambda p: p["body"].isNotNull()))


def positions(found: str) -> str:
    """array<struct<start, end, body, size>> of ``matches`` in code points; ``size`` is the length of the group.

    A growing array is copied at each step, so it grows within a block only, and the work stays linear in the matches.
    """
    start = "s.at + length(p.gap)"
    end = f"{start} + length(p.body)"
    step = _state(end, f"concat(s.found, array(CAST(struct({start}, {end}, p.body, length(p.part)) AS {_ONE})))", _MATCH)
    first = _state("o.at", f"CAST(array() AS {_MATCH})", _MATCH)
    block = f"aggregate(slice(m, b * {BLOCK} + 1, {BLOCK}), {first}, (s, p) -> {step})"
    joined = _let("n", block, _state("n.at", "concat(o.found, array(n.found))", f"array<{_MATCH}>"))
    empty = _state("0", f"CAST(array() AS array<{_MATCH}>)", f"array<{_MATCH}>")
    whole = f"aggregate(sequence(0, size(m) div {BLOCK}), {empty}, (o, b) -> {joined})"
    return f"flatten({_let('m', found, whole)}.found)"


def hot_range(body: str, bits: float) -> str:
    """struct<first, last>: where windows of at least ``bits`` begin and end in the candidate; nulls without one."""
    weights = "array(" + ",".join(f"{w}L" for w in WEIGHTS) + ")"
    state = "struct<counts:array<bigint>,sum:bigint,first:int,last:int>"
    zero = f"CAST(struct(array_repeat(0L, {(HIGHEST - LOWEST) // PACKED + 1}), 0, NULL, NULL) AS {state})"

    def weight(count: str) -> str:
        return f"get({weights}, cast({count} AS int))"

    def count(code: str) -> str:
        return f"(shiftright(get(s.counts, cast({code} div {PACKED} AS int)), {code} % {PACKED} * {COUNT_BITS}) & {(1 << COUNT_BITS) - 1}L)"

    def one(code: str) -> str:
        return f"IF(k = {code} div {PACKED}, shiftleft(1L, {code} % {PACKED} * {COUNT_BITS}), 0L)"

    # x: the code that enters; y: the code that leaves, or -1.
    entering, leaving = f"{count('x')} - IF(x = y, 1, 0)", count("y")
    total = (
        f"s.sum + IF(y < 0, 0L, {weight(f'{leaving} - 1')} - {weight(leaving)}) "
        f"+ {weight(f'{entering} + 1')} - {weight(entering)}"
    )
    counts = f"transform(s.counts, (c, k) -> c + {one('x')} - IF(y < 0, 0L, {one('y')}))"
    hot = f"i >= {WINDOW - 1} AND t <= {most_weight(bits)}"
    moved = _let("t", total, (
        f"CAST(struct({counts}, t, IF({hot}, coalesce(s.first, i - {WINDOW - 1}), s.first), IF({hot}, i + 1, s.last)) AS {state})"
    ))
    step = _let("x", "get(codes, i)", _let("y", f"IF(i >= {WINDOW}, get(codes, i - {WINDOW}), -1)", moved))
    codes = f"transform(regexp_extract_all({body}, '(?s).', 0), c -> ascii(c) - {LOWEST})"
    return _let("codes", codes, f"aggregate(sequence(0, size(codes) - 1), {zero}, (s, i) -> {step})")


def _class_range(body: str) -> str:
    cases = " ".join(f"WHEN {body} RLIKE r'{pattern}' THEN {hot_range(body, bits)}" for pattern, bits in CLASSES)
    return f"CASE {cases} END"


def _ranked(found: str, rank: int, kind: str) -> str:
    return f"transform({found}, p -> named_struct('start', p.start, 'rank', {rank}, 'end', p.end, 'kind', '{kind}'))"


def _written(spans: str) -> str:
    """kind:start:end by start, then by the order of the kinds."""
    return f"array_join(transform(array_sort({spans}), p -> concat_ws(':', p.kind, p.start, p.end)), ',')"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) for every row."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = {f"{kind}_found": matches(text, guard, pattern, group) for kind, guard, pattern, group, _ in RULES}
    rows = rows.select("doc_id", *(c.alias(n) for n, c in found.items()), matches(text, CANDIDATE, CANDIDATE, 0).alias("candidates"))
    none = f"CAST(array() AS {_MATCH})"
    for kind, _, _, _, least in RULES:
        spans = f"filter(coalesce({positions(f'{kind}_found')}, {none}), p -> p.size >= {least})"
        rows = rows.withColumn(kind, F.expr(spans))
    looked = f"filter(coalesce({positions('candidates')}, {none}), p -> NOT p.body RLIKE r'{FORMS}')"
    ranged = f"transform({looked}, p -> struct(p.start AS at, p.body AS body, {_class_range('p.body')} AS range))"
    meant = f"p.range.first IS NOT NULL AND NOT substring(p.body, p.range.first + 1, p.range.last - p.range.first) RLIKE r'{SAMPLES}'"
    hot = f"transform(filter({ranged}, p -> {meant}), p -> struct(p.at + p.range.first AS start, p.at + p.range.last AS end))"
    rows = rows.withColumn(ENTROPY, F.expr(hot))
    base = "concat(" + ", ".join(_ranked(kind, rank, kind) for rank, (kind, *_) in enumerate(RULES)) + ")"
    rows = rows.select("doc_id", *(kind for kind, *_ in RULES), ENTROPY, F.expr(base).alias("base"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in (*(k for k, *_ in RULES), ENTROPY)]
    return rows.select(
        "doc_id", *counts, F.sha2(F.expr(_written("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(_written(f"concat(base, {_ranked(ENTROPY, len(RULES), ENTROPY)})")).alias("spans"),
    )
