"""Personal data by aggregating weak labels.

Candidates for each kind (email, ip, card, phone) come from a wide pattern. Labelers vote on each: the
strict pattern of the kind, checks on the candidate's form, gazetteers of words that go with the kind, and
its context. Expectation-maximisation over the patterns of votes, counted over all documents, estimates how
reliable each labeler is in each kind and how likely a candidate with given votes is real. Those posteriors
train a logistic span classifier on the votes, and candidates that it accepts are spans. Matches of the
strict pattern are always spans; added ones never overlap a span of their kind.

All work on documents is SQL expressions. Vote patterns are at most kinds x 3 ^ labelers rows, so their
counts are fitted as plain numbers on the driver. Patterns use possessive loops that start at the first
character of a run, so a text of one long run is read once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import write_scratch
from .common import query, table, text_of

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: Strict patterns, equal to the plain ones but linear in the length of a run.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wide patterns of candidates that the strict ones do not take.
WIDE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?(?:\(at\)|\[at\]|\{{at\}}|\x20at\x20)\x20?[A-Za-z0-9-]++(?:(?:\x20?(?:\(dot\)|\[dot\]|\{{dot\}})\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: Words that go with a kind.
GAZETTEER = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|account|iban)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|contact)\b",
}
AROUND = 24
ROUNDS = 50
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match): the matches, leftmost first, with code point positions.

    Matches and the gaps between them, both by the same pattern, take turns along the text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,m:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    # Gap i and match i in turn: positions add up.
    both = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("m"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["g"])
        end = begin + F.char_length(x["m"])
        one = F.struct(begin.cast("int").alias("start"), end.cast("int").alias("end"), x["m"].alias("m"))
        return F.struct(end.cast("int").alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(both, start, add, lambda acc: acc["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _holds(kind: str, m: Column) -> Column:
    """What a match of the strict pattern must fulfil besides."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(_OCTETS)
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & F.coalesce(F.call_function("luhn_check", _digits(m)), F.lit(False))
    return F.length(_digits(m)).between(9, 15)


def _may_hold(kind: str, text: Column) -> Column:
    """Cheap test that a text without any match fails."""
    if kind == "email":
        return F.contains(text, F.lit("@")) | text.rlike(r"(?:\(at\)|\[at\]|\{at\}|\x20at\x20)")
    if kind == "phone":
        return F.contains(text, F.lit("+")) | text.rlike(r"[0-9]{3}[.-][0-9]{4}")
    return text.rlike("[0-9]{2}|[0-9][.:\\x20-][0-9]")


def _tag(number: int, strict: bool):
    return lambda s: F.struct(
        F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m"), F.lit(strict).alias("strict")
    )


def _is_kind(number: int):
    return lambda v: v["kind"] == number


def _candidates(docs: DataFrame) -> DataFrame:
    """The rows with _c, an array of all their candidates."""
    text = F.col("_text")
    parts = []
    for number, kind in enumerate(KINDS):
        for strict, pattern in ((True, BASE[kind]), (False, WIDE[kind])):
            spans = F.when(_may_hold(kind, text), _spans(text, pattern))
            none = F.array().cast("array<struct<start:int,end:int,m:string>>")
            tagged = F.transform(F.coalesce(spans, none), _tag(number, strict))
            parts.append(tagged)
    return docs.withColumn("_c", F.concat(*parts))


def _votes(number: int, c: Column, text: Column) -> Column:
    """Votes of the labelers on one candidate: 1 yes, 0 no, -1 abstains."""
    kind = KINDS[number]
    before = F.substring(text, F.greatest(c["start"] - AROUND + 1, F.lit(1)), F.least(c["start"], F.lit(AROUND)))
    after = F.substring(text, c["end"] + 1, F.lit(AROUND))
    digits = _digits(c["m"])
    form = {
        "email": F.when(c["m"].rlike(r"(?i)(?:\.|dot\W*\s?)(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$"), 1).otherwise(0),
        "ip": F.when(c["m"].rlike(r"^(?:0|10|127|192|255)\."), 0).otherwise(1),
        "card": F.when(F.length(digits).between(12, 19), 1).otherwise(0),
        "phone": F.when(F.length(digits).between(9, 15), 1).otherwise(0),
    }[kind]
    check = {
        "email": F.when(c["m"].rlike(r"\x20(?:at|dot)\x20"), 0).otherwise(1),
        "ip": F.when(F.size(F.split(c["m"], r"[.:]")).isin(4, 8), 1).otherwise(0),
        "card": F.when(F.coalesce(F.call_function("luhn_check", digits), F.lit(False)), 1).otherwise(0),
        "phone": F.when(c["m"].rlike(r"^[+(]"), 1).otherwise(-1),
    }[kind]
    gazetteer = F.when(before.rlike(GAZETTEER[kind]) | after.rlike(GAZETTEER[kind]), 1).otherwise(-1)
    alone = F.when(before.rlike(r"[0-9A-Za-z_.:/=-]$") | after.rlike(r"^[0-9A-Za-z_:/=-]"), 0).otherwise(1)
    base = F.when(c["strict"] & _holds(kind, c["m"]), 1).otherwise(0)
    return F.array(base, form, check, gazetteer, alone)


def aggregate_votes(patterns: Sequence[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Posterior of each vote pattern, by expectation-maximisation over patterns and their counts.

    Labelers err independently given the truth; the start is the share of yes votes. Priors of one count
    keep all rates inside (0, 1).
    """
    if not patterns:
        return {}
    width = len(patterns[0][0])
    given = [[v for v in votes if v >= 0] for votes, _ in patterns]
    post = [(sum(g) + 0.5) / (len(g) + 1) for g in given]
    for _ in range(ROUNDS):
        yes = sum(p * n for p, (_, n) in zip(post, patterns))
        total = sum(n for _, n in patterns)
        prior = (yes + 1) / (total + 2)
        rates = []
        for j in range(width):
            seen = [(p, n, votes[j]) for p, (votes, n) in zip(post, patterns) if votes[j] >= 0]
            hit = (sum(p * n for p, n, v in seen if v) + 2) / (sum(p * n for p, n, _ in seen) + 3)
            false = (sum((1 - p) * n for p, n, v in seen if v) + 1) / (sum((1 - p) * n for p, n, _ in seen) + 3)
            rates.append((hit, false))
        new = []
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (hit, false) in zip(votes, rates):
                if v >= 0:
                    odds += math.log(hit / false) if v else math.log((1 - hit) / (1 - false))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        moved = max(abs(a - b) for a, b in zip(new, post))
        post = new
        if moved < 1e-9:
            break
    return {votes: p for (votes, _), p in zip(patterns, post)}


def fit_classifier(patterns: Sequence[tuple[tuple[int, ...], int]]) -> tuple[float, ...]:
    """Weights of a logistic classifier on votes (yes 1, no -1, abstained 0), bias first."""
    post = aggregate_votes(patterns)
    width = len(patterns[0][0]) + 1 if patterns else 1
    w = [0.0] * width
    total = sum(n for _, n in patterns) or 1
    rows = [([1.0, *[{1: 1.0, 0: -1.0}.get(v, 0.0) for v in votes]], post[votes], n / total) for votes, n in patterns]
    for _ in range(2_000):
        grad = [1e-3 * x for x in w]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for j, a in enumerate(x):
                grad[j] += n * (p - y) * a
        w = [a - 1.0 * g for a, g in zip(w, grad)]
    return tuple(w)


def find_personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with the counts and digest of base spans and the list of all spans.

    Null or empty text has no span. One result row per row, so repeated rows repeat; without candidates
    anywhere nothing is learnt and nothing added. Positions are code points, ends exclusive.
    """
    rows = docs.select(*keep, text_of(text).alias("_text"))
    found = _candidates(rows).filter(F.size("_c") > 0)
    every = F.transform(
        F.col("_c"),
        lambda c: F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
            F.element_at(F.array(*[_votes(i, c, F.col("_text")) for i in range(len(KINDS))]), c["kind"] + 1).alias("votes"),
        ),
    )
    voted = write_scratch(
        found.select(*keep, F.xxhash64("_text").alias("_h"), every.alias("_v")), "votes"
    )
    counted = voted.select(F.explode("_v").alias("v")).groupBy("v.kind", "v.votes").agg(F.count(F.lit(1)).alias("n"))
    learnt: dict[int, list] = {}
    for r in counted.collect():  # at most kinds x 3 ^ labelers rows
        learnt.setdefault(r["kind"], []).append((tuple(r["votes"]), r["n"]))
    weights = {k: fit_classifier(sorted(p)) for k, p in learnt.items()}
    none = tuple([-1.0] + [0.0] * 5)
    rates = F.array(*[F.array(*[F.lit(float(x)) for x in weights.get(i, none)]) for i in range(len(KINDS))])

    def accepted(v: Column) -> Column:
        w = F.element_at(rates, v["kind"] + 1)
        score = F.get(w, F.lit(0))
        for j in range(5):
            vote = F.get(v["votes"], F.lit(j))
            score = score + F.get(w, F.lit(j + 1)) * F.when(vote == 1, 1.0).when(vote == 0, -1.0).otherwise(0.0)
        return score > 0

    by_place = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1).otherwise(0)
    slim = lambda v: F.struct(v["start"].alias("start"), v["kind"].alias("kind"), v["end"].alias("end"))
    base = F.transform(F.filter("_v", lambda v: F.get(v["votes"], F.lit(0)) == 1), slim)
    marked = voted.select(*keep, "_h", "_v", base.alias("_base"))
    extra = F.transform(
        F.filter(
            "_v",
            lambda v: (F.get(v["votes"], F.lit(0)) != 1)
            & accepted(v)
            & ~F.exists("_base", lambda b: (b["kind"] == v["kind"]) & (b["start"] < v["end"]) & (v["start"] < b["end"])),
        ),
        slim,
    )
    marked = marked.select(*keep, "_h", "_base", F.array_distinct(extra).alias("_more"))
    # Of overlapping additions of one kind the first stays.
    marked = marked.withColumn(
        "_more",
        F.filter("_more", lambda v: ~F.exists("_more", lambda o: (o["kind"] == v["kind"]) & (o["start"] < v["end"]) & (v["start"] < o["end"]) & (F.struct(o["start"], o["end"]) < F.struct(v["start"], v["end"])))),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda v: F.concat_ws(":", F.element_at(names, v["kind"] + 1), v["start"].cast("string"), v["end"].cast("string"))

    def text_list(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans, by_place), line), ",")

    result = marked.select(
        *keep, "_h",
        *[F.size(F.filter("_base", _is_kind(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(text_list(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        text_list(F.concat("_base", "_more")).alias("spans"),
    )
    nothing = _candidates(rows).filter(F.size("_c") == 0).select(
        *keep, F.lit(0).cast("bigint").alias("_h"),
        *[F.lit(0).cast("bigint").alias(f"n_{k}") for k in KINDS], F.sha2(F.lit("").cast("binary"), 256).alias("base_sha256"), F.lit("").alias("spans"),
    )
    return result.unionByName(nothing).drop("_h")


@query("op9_weak_supervision")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
