"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of one expression for each family (e-mail and IP addresses, card and phone
numbers, phone numbers without a country code, names after a title or a known given name). Five labellers
vote yes, no or not at all on each candidate: the strict form (parts of an IP address, a card's length and
Luhn sum, a phone number's digits), a gazetteer (top-level domains, card issuers, country codes, given
names), the words before it, its shape, and what encloses it. Expectation-maximisation over the counts of
vote patterns estimates each labeller's reliability for each kind, from stated beliefs on; the posteriors
train a logistic classifier over votes, kind and length, which accepts candidates at 0.5 or more. Those
that have the strict form are always kept.

Spans are code points, end exclusive. All matches of a family are found from the left and do not overlap;
expressions take possessive steps and anchor at the start of a run, so that very long runs cost no more
than linear time and no stack. Texts without a family's signal character skip its expressions.

Cases: a null text is the empty text and has no spans; repeated rows are judged row by row; with no
candidates at all no classifier is needed; an empty table gives an empty result; other input columns are
not read, and are returned unchanged by ``masked``.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored

KINDS = ("email", "ip", "card", "phone", "name")
BASE_KINDS = ("email", "ip", "card", "phone")
LABELLERS = ("form", "gazetteer", "context", "shape", "enclosed")
#: labeller -> how often it is believed to be right, and how many votes for each candidate that belief weighs
BELIEF = {"form": (0.98, 1.0), "gazetteer": (0.75, 0.1), "context": (0.8, 0.1), "shape": (0.7, 0.1), "enclosed": (0.7, 0.1)}
ACCEPT = 0.5
PRIOR = 0.5

# fixed values: short lists of public knowledge
TOP_LEVEL = "com|org|net|edu|gov|info|io|eu|uk|us|de|fr|es|it|nl|at|ch|be|pt|mx|ar|br|ca|au"
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra"
GIVEN_NAMES = ("James|Mary|John|Patricia|Robert|Jennifer|Michael|Linda|William|Elizabeth|David|Susan|Thomas|Karen|"
               "Hans|Klaus|Jürgen|Wolfgang|Ursula|Monika|Petra|Sabine|Pierre|Jean|Michel|Philippe|Nathalie|Isabelle|"
               "Sylvie|Catherine|José|Carlos|Javier|Miguel|Carmen|Pilar|Dolores|Lucía")
CUES = {
    "email": "mail|contact|write|schreib|correo|courriel", "ip": r"\bip\b|host|server|address|adresse|dirección",
    "card": "card|karte|carte|tarjeta|visa|credit|kredit", "phone": "tel|phone|call|fax|mobil|appel|llam|anruf",
    "name": r"name\b|nom\b|nombre\b|by\b|signed|dear|lieber?\b|cher\b|querid",
}
COUNTER_CUES = r"version|\bv\.?$|isbn|issn|order|invoice|rechnung|facture|pedido|serial|\bid\b|\bref\b"


def _yes_no(test: Column) -> Column:
    return F.when(test, "y").otherwise("n")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn sum divisible by ten: every second digit from the right is doubled."""
    reverse = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0),
                        lambda s, i: s + F.substring(F.when(i % 2 == 0, F.translate(reverse, "0123456789", "0246813579")).otherwise(reverse), i, F.lit(1)).cast("int"))
    return total % 10 == 0


def _valid_card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


@dataclass(frozen=True)
class Family:
    kind: str
    expression: str
    signal: str  # what a text must match to be searched
    form: object  # value -> vote
    gazetteer: object
    shape: object


#: matches of a text that are placed together
MATCH_BLOCK = 256
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
FAMILIES = (
    Family("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
           lambda v: F.lit("y"), lambda v: F.when(v.rlike(rf"(?i)\.(?:{TOP_LEVEL})$"), "y").otherwise("-"),
           lambda v: _yes_no(v.rlike(r"^[A-Za-z0-9][^@]{0,63}@[^@]{1,255}$"))),
    Family("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
           lambda v: _yes_no(v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
           lambda v: F.when(v.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."), "y").otherwise("-"),
           lambda v: _yes_no(~v.rlike(r"(?:^|\.)0[0-9]") & (F.length(v) >= 7) & (F.length(v) <= 15))),
    Family("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9][ -]?[0-9]",
           lambda v: _yes_no(_valid_card(v)),
           lambda v: _yes_no(v.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))")),
           lambda v: _yes_no(v.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"))),
    Family("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]",
           lambda v: _yes_no(F.length(_digits(v)).between(9, 15)),
           lambda v: _yes_no(v.rlike(r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")),
           lambda v: _yes_no(v.rlike(r"^[^()]*(?:\([0-9]+\)[^()]*)?$") & ~v.rlike(r"[ .-]{3}"))),
    Family("phone", r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])", r"\+[0-9]{1,3} ?\(",
           lambda v: F.lit("-"), lambda v: F.lit("y"), lambda v: F.lit("y")),
    Family("phone", r"(?<![0-9+(])(?<!\+[0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}[ -])[0-9]{3}[ -][0-9]{4}(?![0-9])", r"[0-9]{3}[ -][0-9]{4}",
           lambda v: F.lit("-"), lambda v: F.lit("-"), lambda v: _yes_no(v.rlike(r"^\([0-9]{3}\) [0-9]{3}-[0-9]{4}$|-[0-9]{3}-"))),
    Family("name", rf"(?<![\p{{L}}\p{{N}}])(?:(?:{TITLES})\.? \p{{Lu}}\p{{Ll}}++(?: \p{{Lu}}\p{{Ll}}++)?+|(?:{GIVEN_NAMES}) \p{{Lu}}\p{{Ll}}++)(?!\p{{L}})",
           rf"(?:{TITLES}|{GIVEN_NAMES})\.? \p{{Lu}}\p{{Ll}}",
           lambda v: F.lit("-"), lambda v: _yes_no(v.rlike(rf"(?:^| )(?:{GIVEN_NAMES}) ")),
           lambda v: _yes_no(v.rlike(rf"^(?:{TITLES})\.? "))),
)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _matches(text: Column, family: Family) -> Column:
    """``before, value, after`` of each match: the text since the match before it, the match, and the text up to the next."""
    paired = F.zip_with(F.split(text, family.expression, -1), F.regexp_extract_all(text, F.lit(family.expression), F.lit(0)),
                        lambda before, value: F.struct(before.alias("before"), value.alias("value")))  # the last has no value

    def with_after(pairs: Column) -> Column:
        return F.filter(F.transform(pairs, lambda p, i: F.struct(p["before"].alias("before"), p["value"].alias("value"), F.get(pairs, i + 1)["before"].alias("after"))),
                        lambda m: m["value"].isNotNull())

    return F.when(text.rlike(family.signal), _let(paired, with_after)).otherwise(F.array().cast("array<struct<before:string,value:string,after:string>>"))


def _votes(match: Column, family: Family) -> Column:
    value, before = match["value"], F.right(match["before"], F.lit(32))
    context = (F.when(before.rlike(f"(?i)(?:{CUES[family.kind]})"), "y").when(before.rlike(f"(?i)(?:{COUNTER_CUES})"), "n").otherwise("-"))
    enclosed = _yes_no(~F.right(match["before"], F.lit(1)).rlike(r"[\p{L}\p{N}]") & ~F.left(match["after"], F.lit(1)).rlike(r"[\p{L}\p{N}]"))
    return F.concat(family.form(value), family.gazetteer(value), context, family.shape(value), enclosed)


def _pattern(match: Column, family: Family) -> Column:
    """Kind, votes, and length in steps of four up to 32: all that the label model and the classifier see."""
    return F.concat_ws(":", F.lit(family.kind), _votes(match, family), F.least(F.floor(F.length(match["value"]) / 4), F.lit(8)).cast("string"))


def _is_candidate(match: Column, family: Family) -> Column:
    """Runs with too few or too many digits for their kind are no candidates."""
    if family.kind == "card":
        return F.length(_digits(match["value"])).between(13, 19)
    if family.kind == "phone":
        return F.length(_digits(match["value"])).between(9, 15)
    return F.lit(True)


def candidates(text: Column) -> Column:
    """``kind, start, end, pattern`` of all candidates of a text."""
    kind = "array<struct<kind:string,start:int,end:int,pattern:string>>"

    def of(family: Family) -> Column:
        def length(match: Column) -> Column:
            return F.length(match["before"]) + F.length(match["value"])

        def placed(done: Column, match: Column) -> Column:
            start = done["at"] + F.length(match["before"])
            end = done["at"] + length(match)
            one = F.struct(F.lit(family.kind).alias("kind"), start.alias("start"), end.alias("end"),
                           F.when(_is_candidate(match, family), _pattern(match, family)).otherwise("").alias("pattern"))
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

        def in_block(block: Column, at: Column) -> Column:
            return F.aggregate(block, F.struct(at.alias("at"), F.array().cast(kind).alias("out")), placed)["out"]

        def in_blocks(blocks: Column) -> Column:
            # a growing array is copied for each element: only those of one block, and that of the blocks' first places, grow
            totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, m: total + length(m)))
            firsts = F.aggregate(totals, F.array(F.lit(0)), lambda done, total: F.concat(done, F.array(F.element_at(done, -1) + total)))
            return F.flatten(F.zip_with(blocks, F.slice(firsts, F.lit(1), F.size(blocks)), in_block))

        def cut(matches: Column) -> Column:
            number = F.ceil(F.size(matches) / F.lit(MATCH_BLOCK)).cast("int")
            return F.transform(F.filter(F.sequence(F.lit(0), number), lambda k: k < number),
                               lambda k: F.slice(matches, k * MATCH_BLOCK + 1, F.lit(MATCH_BLOCK)))

        return F.filter(_let(_let(_matches(text, family), cut), in_blocks), lambda c: c["pattern"] != "")

    return F.concat(*(of(f) for f in FAMILIES))


# ---- label model and classifier: small tables on the driver ----

def _split(patterns: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [p.split(":") for p in patterns]
    return (np.array([KINDS.index(k) for k, _, _ in parts]), np.array([["-ny".index(c) for c in v] for _, v, _ in parts]),
            np.array([int(s) for _, _, s in parts]))


def posteriors(patterns: list[str], counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Probability that candidates of each pattern are personal data; every kind has its own model."""
    kinds, votes, _ = _split(patterns)
    counts = np.asarray(counts, dtype=np.float64)
    out = np.zeros(len(patterns))
    for kind in np.unique(kinds):
        rows = kinds == kind
        v, n = votes[rows], counts[rows]
        belief = np.array([BELIEF[l] for l in LABELLERS])
        weight = belief[:, 1] * n.sum() + 2
        right, prior = np.tile(belief[:, 0], (2, 1)), PRIOR  # of labellers on no and on yes, when they vote
        for _ in range(rounds):
            log = np.log([1 - prior, prior])[:, None] + np.zeros((2, len(n)))
            for c in (0, 1):
                agrees = v == c + 1
                log[c] += np.where(v > 0, np.log(np.where(agrees, right[c], 1 - right[c])), 0).sum(axis=1)
            yes = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
            for c, w in ((0, (1 - yes) * n), (1, yes * n)):
                voted = ((v > 0) * w[:, None]).sum(axis=0)
                agreed = ((v == c + 1) * w[:, None]).sum(axis=0)
                right[c] = np.clip((agreed + belief[:, 0] * weight) / (voted + weight), 1e-3, 1 - 1e-3)
            prior = float(np.clip(((yes * n).sum() + 1) / (n.sum() + 2), 1e-3, 1 - 1e-3))
        out[rows] = yes
    return out


def _features(pattern: str) -> list[str]:
    kind, votes, size = pattern.split(":")
    return [f"kind={kind}", f"size={kind}:{size}", *(f"{l}={kind}:{v}" for l, v in zip(LABELLERS, votes)), *(f"{l}={v}" for l, v in zip(LABELLERS, votes))]


def classifier(patterns: list[str], counts: np.ndarray, steps: int = 400) -> dict[str, float]:
    """Probability of each pattern by a logistic classifier trained on the posteriors, each pattern weighing as its
    count does."""
    if not patterns:
        return {}
    soft = posteriors(patterns, counts)
    names = sorted({f for p in patterns for f in _features(p)})
    place = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(patterns), len(names)))
    for row, p in enumerate(patterns):
        x[row, [place[f] for f in _features(p)]] = 1
    weight, w, squares = np.sqrt(counts) / np.sqrt(counts).sum(), np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(steps):
        gradient = x.T @ (weight * (1 / (1 + np.exp(-x @ w)) - soft)) + 1e-5 * w
        squares += gradient ** 2
        w -= 0.5 * gradient / np.sqrt(squares)
    return dict(zip(patterns, (1 / (1 + np.exp(-x @ w))).tolist()))


def pattern_counts(found: DataFrame) -> DataFrame:
    """``pattern, n`` over all candidates; the patterns are bounded by kinds, votes and length steps."""
    return found.select(F.explode("candidates.pattern").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


def train(found: DataFrame) -> dict[str, float]:
    rows = pattern_counts(found).orderBy("pattern").collect()
    return classifier([r.pattern for r in rows], np.array([r.n for r in rows], dtype=np.float64))


def _accepted(patterns: dict[str, float]) -> Column:
    return F.array(*(F.lit(p) for p, score in patterns.items() if score >= ACCEPT)).cast("array<string>")


def _base(pattern: Column) -> Column:
    """Whether a candidate has one of the base forms."""
    return pattern.rlike(rf"^(?:{'|'.join(BASE_KINDS)}):y")


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` (``kind, start, end, base``) for every row, by kind as listed and then by start; the candidates
    are written once, and both the training and the decisions read them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = stored(docs.select(F.col(id_col), candidates(text).alias("candidates")), "pii-candidates")
    accepted = _accepted(train(found))
    ranks = F.array(*(F.lit(k) for k in KINDS))
    base = F.filter("candidates", lambda c: _base(c["pattern"]))
    more = F.filter("candidates", lambda c: ~_base(c["pattern"]) & F.array_contains(accepted, c["pattern"])
                    & ~F.exists(base, lambda b: (b["kind"] == c["kind"]) & (b["start"] < c["end"]) & (c["start"] < b["end"])))

    def ranked(array: Column, is_base: bool) -> Column:
        return F.transform(array, lambda c: F.struct(F.array_position(ranks, c["kind"]).alias("rank"), c["start"].alias("start"),
                                                     c["end"].alias("end"), c["kind"].alias("kind"), F.lit(is_base).alias("base")))

    return found.select(id_col, F.array_sort(F.concat(ranked(base, True), ranked(more, False))).alias("spans"))


def masked(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with every accepted span replaced by its kind in brackets, in all their columns; a null text stays.

    Families are masked one after the other, each in the text that the one before it has left."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    accepted = _accepted(train(docs.select(candidates(text).alias("candidates"))))
    for family in FAMILIES:
        docs = docs.withColumn(text_col, _masked_family(F.col(text_col), family, accepted))
    return docs


def _masked_family(text: Column, family: Family, accepted: Column) -> Column:
    def replaced(match: Column) -> Column:
        pattern = _pattern(match, family)
        taken = _is_candidate(match, family) & (_base(pattern) | F.array_contains(accepted, pattern))
        return F.concat(match["before"], F.when(taken, f"[{family.kind.upper()}]").otherwise(match["value"]))

    found = _matches(text, family)
    rest = F.try_element_at(found, F.lit(-1))["after"]
    return F.when(text.rlike(family.signal), F.coalesce(F.concat(F.array_join(F.transform(found, replaced), ""), rest), text)).otherwise(text)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(read_table(spark, sf_dir, "documents"))

    def listed(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
