"""Personal data in texts: patterns first, then what a span classifier adds to them.

Spans of fixed patterns (emails, IP addresses, cards, phone numbers) are always kept. Looser
patterns give further candidates. Five labelers vote on each candidate: the strict pattern, a
gazetteer, the words before it, its borders and its inner form. Expectation-maximisation over
the counts of vote patterns estimates how reliable each labeler is and how likely a candidate
with given votes is personal data; a logistic classifier of the span's features is trained on
these and decides on the candidates that the strict patterns do not hold. All of it is DataFrame
and SQL functions; the driver sees only counts of vote and feature patterns, at most
4 kinds x 32 x 8 of them.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import free_name
from recurra.session import stage

# The patterns, in linear-time form (possessive, and only from where the leftmost
# match can begin), and the lists that labelers use.
KINDS = ("email", "ip", "card", "phone")
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9](?:[ ().-]++[0-9]|[0-9][ ().-]*+[0-9])(?:[ ().-]*+[0-9])*+",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64} ?(?:\(at\)|\[at\]) ?"
             r"[A-Za-z0-9-]{2,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9+().-])[0-9](?:[ -]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: A text without a match of these has none of the kind.
MAY_HAVE = {
    "email": "@|[(\\[]at[)\\]]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]",
    "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]|[0-9][ .-][0-9]{4}",
}
GAZETTEER = {
    "email": r"(?i)[. \])](?:com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|us|ca)$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.|^(?:2[0-9a-fA-F]{3}|f[cde])",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}",
}
CONTEXT = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|address|correo|courriel)\W{0,12}$",
    "ip": r"(?i)(?:\bip|address|host|server|from|client)\W{0,12}$",
    "card": r"(?i)(?:card|visa|amex|mastercard|credit|payment|tarjeta|carte|karte)\W{0,16}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|telefon|\btel\.)\W{0,12}$",
}
_SPAN = "struct<kind: string, start: int, end: int, hit: string, before: string, after: string>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(kind: str, pattern: str, text: str) -> str:
    """SQL: the leftmost non-overlapping matches as spans, in code points.

    The gaps between the matches and the matches themselves add up to the positions.
    """
    regex = _quoted(pattern)
    return f"""
        if({text} rlike {_quoted(MAY_HAVE[kind])}, transform(
            array(struct(split({text}, {regex}, -1) AS gaps,
                         regexp_extract_all({text}, {regex}, 0) AS hits)),
            m -> if(size(m.hits) = 0, CAST(array() AS array<{_SPAN}>), aggregate(
                sequence(0, size(m.hits) - 1),
                struct(0 AS at, CAST(array() AS array<{_SPAN}>) AS out),
                (acc, i) -> struct(
                    acc.at + length(m.gaps[i]) + length(m.hits[i]) AS at,
                    array_append(acc.out, struct(
                        '{kind}' AS kind, acc.at + length(m.gaps[i]) AS start,
                        acc.at + length(m.gaps[i]) + length(m.hits[i]) AS end, m.hits[i] AS hit,
                        right(m.gaps[i], 40) AS before, left(m.gaps[i + 1], 1) AS after
                    )) AS out)
            ).out))[0], CAST(array() AS array<{_SPAN}>))"""


_DIGITS = "regexp_replace(s.hit, '[^0-9]', '')"
_LUHN = f"""transform(array({_DIGITS}), d -> aggregate(sequence(1, length(d)), 0, (sum, i) ->
    sum + transform(array(CAST(substr(d, -i, 1) AS int) * if(i % 2 = 0, 2, 1)),
                    x -> if(x > 9, x - 9, x))[0]) % 10 = 0)[0]"""
_VALID = f"""CASE s.kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN forall(
        transform(split(s.hit, '[.]'), p -> regexp_replace(p, '^0+', '')),
        p -> length(p) < 3 OR length(p) = 3 AND p <= '255')
    WHEN 'card' THEN length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}
    ELSE length({_DIGITS}) BETWEEN 8 AND 15 END"""
_FORM = f"""CASE s.kind
    WHEN 'email' THEN s.hit rlike '^[A-Za-z0-9]' AND s.hit rlike '[A-Za-z]'
    WHEN 'ip' THEN NOT s.hit rlike '(?:^|[.])0[0-9]' AND NOT s.hit rlike '[0-9]{{4}}[.]'
    WHEN 'card' THEN {_LUHN}
    ELSE length({_DIGITS}) BETWEEN 10 AND 15 END"""


def _per_kind(patterns: dict[str, str], value: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {value} rlike {_quoted(p)}" for k, p in patterns.items())
    return f"CASE s.kind {cases} END"


#: The labelers, as SQL conditions on a span; bit i of the votes is the i-th.
LABELERS = (
    "s.strict",
    _per_kind(GAZETTEER, "s.hit"),
    _per_kind(CONTEXT, "s.before"),
    r"s.before rlike '(?:^|[\\s(<\\[:;,\"=])$' AND s.after rlike '^(?:$|[\\s)>\\]:;,.\"!?])'",
    _FORM,
)
#: Further features of the classifier, by the form of the span alone.
FEATURES = (
    "length(s.hit) >= 14", "s.hit rlike '[ ()-]'", f"length({_DIGITS}) * 2 >= length(s.hit)",
)


def _bits(conditions) -> str:
    return " + ".join(f"if({c}, {1 << i}, 0)" for i, c in enumerate(conditions))


def candidates(text: str) -> Column:
    """Spans (kind, start, end, strict, votes, features) of a text, by kind and start.

    Strict spans, and candidates that overlap none of them; none for a null text.
    """
    whole = f"coalesce({text}, '')"
    empty = f"CAST(array() AS array<{_SPAN}>)"
    strict = [f"filter({_matches(k, STRICT[k], whole)}, s -> {_VALID})" for k in KINDS]
    loose = [_matches(k, LOOSE[k], whole) for k in KINDS]
    plain = "s.kind AS kind, s.start AS start, s.end AS end, s.hit AS hit, " \
            "s.before AS before, s.after AS after"
    return F.expr(f"""
        transform(
            array(struct(concat({empty}, {", ".join(strict)}) AS held,
                         concat({empty}, {", ".join(loose)}) AS more)),
            f -> transform(
                concat(
                    transform(f.held, s -> struct({plain}, true AS strict)),
                    transform(
                        filter(f.more, c -> NOT exists(
                            f.held, h -> c.start < h.end AND h.start < c.end)),
                        s -> struct({plain}, false AS strict))),
                s -> struct(s.kind AS kind, s.start AS start, s.end AS end, s.strict AS strict,
                            {_bits(LABELERS)} AS votes, {_bits(FEATURES)} AS features))
        )[0]""")


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities and a prior per kind, and the classifier's bias and weights per kind."""

    reliability: dict[str, list[tuple[float, float]]]
    weights: dict[str, list[float]]

    def keeps(self, votes: str, features: str, kind: str) -> str:
        """SQL: whether the classifier takes a candidate."""
        cases = []
        for name, (bias, *rest) in sorted(self.weights.items()):
            bits = [f"{w!r} * ({votes} >> {i} & 1)" for i, w in enumerate(rest[: len(LABELERS)])]
            bits += [
                f"{w!r} * ({features} >> {i} & 1)" for i, w in enumerate(rest[len(LABELERS) :])
            ]
            cases.append(f"WHEN '{name}' THEN {bias!r} + {' + '.join(bits)} >= 0")
        return f"CASE {kind} {' '.join(cases)} ELSE false END" if cases else "false"


def _marks(votes: int, features: int = 0) -> list[int]:
    return [votes >> i & 1 for i in range(len(LABELERS))] + [
        features >> i & 1 for i in range(len(FEATURES))
    ]


def expectation_maximisation(
    counts: dict[int, int], rounds: int = 50
) -> tuple[dict[int, float], list[tuple[float, float]]]:
    """From counts of vote patterns: how likely each is personal data, and per labeler how often
    it votes for personal data and for anything else."""
    n = len(LABELERS)
    likely = {v: (0.5 + sum(_marks(v)[:n])) / (n + 1) for v in counts}
    rates: list[tuple[float, float]] = []
    for _ in range(rounds):
        yes = sum(counts[v] * p for v, p in likely.items())
        no = sum(counts.values()) - yes
        rates = [
            (
                (sum(c * likely[v] for v, c in counts.items() if v >> i & 1) + 4) / (yes + 5),
                (sum(c * (1 - likely[v]) for v, c in counts.items() if v >> i & 1) + 1) / (no + 5),
            )
            for i in range(n)
        ]
        prior = math.log((yes + 1) / (no + 1))
        for v in counts:
            odds = prior + sum(
                math.log(t / f) if v >> i & 1 else math.log((1 - t) / (1 - f))
                for i, (t, f) in enumerate(rates)
            )
            likely[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return likely, rates


def logistic(rows: list[tuple[list[int], float, int]], rounds: int = 400) -> list[float]:
    """Bias and weights for rows (marks, how likely, count), by gradient steps with a penalty."""
    size = len(LABELERS) + len(FEATURES)
    weights, total = [0.0] * (size + 1), sum(c for _, _, c in rows)
    for _ in range(rounds):
        slope = [0.01 * w for w in weights]
        for marks, likely, count in rows:
            x = [1, *marks]
            odds = sum(w * v for w, v in zip(weights, x))
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))) - likely) * count / total
            slope = [s + error * v for s, v in zip(slope, x)]
        weights = [w - 1.0 * s for w, s in zip(weights, slope)]
    return weights


def fit_spans(found: DataFrame, spans: str = "spans") -> SpanModel:
    """Fit on all candidates of a table; kinds without a candidate get no classifier."""
    rows = (
        found.select(F.explode(spans).alias("s")).groupBy("s.kind", "s.votes", "s.features")
        .count().collect()
    )
    by_kind = defaultdict(list)
    for r in rows:
        by_kind[r["kind"]].append(r)
    reliability, weights = {}, {}
    for kind, own in by_kind.items():
        counts: dict[int, int] = defaultdict(int)
        for r in own:
            counts[r["votes"]] += r["count"]
        likely, reliability[kind] = expectation_maximisation(dict(counts))
        weights[kind] = logistic(
            [(_marks(r["votes"], r["features"]), likely[r["votes"]], r["count"]) for r in own]
        )
    return SpanModel(reliability, weights)


def kept(model: SpanModel, spans: str) -> Column:
    """The strict spans and those that the classifier adds, by kind and start."""
    order = "CASE {0}.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    a, b = order.format("a"), order.format("b")
    return F.expr(f"""array_sort(
        filter({spans}, s -> s.strict OR {model.keeps("s.votes", "s.features", "s.kind")}),
        (a, b) -> CASE WHEN {a} != {b} THEN {a} - {b} ELSE a.start - b.start END)""")


def _written(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def find_personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key and spans, an array of structs (kind, start, end, strict, votes, features).

    Starts and ends are in code points, ends exclusive. A null or empty text has no span.
    Repeated rows and null keys give a row each; other columns are left out, so none can clash;
    an empty table gives none.
    """
    found = stage(docs.select(key, candidates(text).alias("spans")), "personal-data")
    return found.select(key, kept(fit_spans(found), "spans").alias("spans"))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: counts and SHA-256 of the strict spans by kind, and all spans as text."""
    base = "filter(spans, s -> s.strict)"
    return found.select(
        key,
        *[
            F.expr(f"CAST(size(filter({base}, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}")
            for k in KINDS
        ],
        F.sha2(F.expr(_written(base)), 256).alias("base_sha256"),
        F.expr(_written("spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of the text replaced by its kind, as in [EMAIL].

    Overlapping spans become one, named after the first. Null texts stay null.
    """
    name = free_name(docs, "_spans")
    # Written, as the candidates are dear to find and read twice: to fit and to replace.
    found = stage(docs.withColumn(name, candidates(text)), "redacted")
    found = found.withColumn(name, kept(fit_spans(found.select(name), name), name))
    merged = f"""aggregate(
        array_sort({name}, (a, b) -> CASE WHEN a.start != b.start THEN a.start - b.start
                                          ELSE b.end - a.end END),
        CAST(array() AS array<struct<kind: string, start: int, end: int>>),
        (out, s) -> CASE
            WHEN size(out) > 0 AND s.start < element_at(out, -1).end THEN concat(
                slice(out, 1, size(out) - 1),
                array(struct(element_at(out, -1).kind AS kind, element_at(out, -1).start AS start,
                             greatest(element_at(out, -1).end, s.end) AS end)))
            ELSE array_append(out, struct(s.kind AS kind, s.start AS start, s.end AS end)) END)"""
    masked = F.expr(f"""transform(array({merged}), m -> concat(
        array_join(transform(m, (s, i) -> concat(
            substring({text}, if(i = 0, 0, m[greatest(i - 1, 0)].end) + 1,
                      s.start - if(i = 0, 0, m[greatest(i - 1, 0)].end)),
            '[', upper(s.kind), ']')), ''),
        substring({text}, element_at(m, -1).end + 1)))[0]""")
    return found.withColumn(
        text, F.when(F.size(name) > 0, masked).otherwise(F.col(text))
    ).select(docs.columns)
