"""Personal data by weak supervision.

Base kinds (email, ip, card, phone) come from fixed patterns and checks and are
always kept. Further candidates (written-out emails, local phone numbers,
numbers like cards that fail their check, identity numbers, bank accounts) are
voted on by labelers: a shape rule, a check digit, a gazetteer of known
prefixes and endings, words before the span for and against, and its
borders. Labelers say yes, no or nothing. Expectation-maximisation estimates
each labeler's reliability from the votes alone, over all candidates of the
corpus; its posteriors are the soft labels that train the final classifier (a
naive Bayes over votes and span features), and a candidate is a span when that
gives at least 0.5.

Votes and features take few values, so candidates are grouped by them before
anything leaves the executors: at most ``kinds * 3^6 * 24`` rows, whatever the
input. Native expressions only.

Edge cases: null and empty texts have no spans (the digest is that of the empty
string); every input row gives one row, null ids and repeated ids included; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .spans import digits, joined, labelled, luhn, matches, overlaps

BASE = ("email", "ip", "card", "phone")
ADDED = ("email_words", "phone_local", "card_like", "identity_number", "bank_account")
VOTES = ("shape", "check", "gazetteer", "words_for", "words_against", "borders")

#: Patterns. Quantifiers are possessive where the plain ones give the same matches.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?+[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
EMAIL_WORDS = r"[A-Za-z0-9._%+-]++\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]++\x20?[\[(](?i:dot)[\])]\x20?[A-Za-z]{2,}+"
PHONE_LOCAL = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
BANK = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Gazetteers.
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us)$", "ip": r"^(10|127|172|192|[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(4|5[1-5]|3[47]|6011|65|35|2[2-7])", "phone": r"^\+(1|7|20|27|3[0-4]|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "email_words": r"(?i)(com|org|net|edu|de|fr|es)$", "phone_local": r"^\(?[2-9][0-9]{2}", "card_like": r"^(4|5[1-5]|3[47]|6011|65|35|2[2-7])",
    "identity_number": r"^(?!000|666|9)[0-9]{3}", "bank_account": r"^(AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"}
#: Words before a span.
WORDS_FOR = (r"(?i)\b(e-?mail|mail|contact|write|reach|call|phone|tel|telephone|mobile|fax|card|visa|mastercard|credit|payment|ip|address|host|"
             r"login|ssn|social|security|identity|passport|iban|account|kontakt|telefon|karte|adresse|courriel|carte|correo|tarjeta)\b[^\n]*$")
WORDS_AGAINST = r"(?i)\b(version|release|isbn|issn|doi|order|invoice|serial|sku|part|ticket|total|sum|page|figure|table|hash|checksum|timestamp|id)\b[^\n]*$"


def base_spans(text: Column) -> dict[str, Column]:
    """The base kinds' spans of a text that is not null."""
    email = matches(text, EMAIL, text.contains("@"))
    ip = F.filter(matches(text, IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
                  lambda s: F.forall(F.split(s["value"], "\\."), lambda p: F.coalesce(p.try_cast("decimal(38,0)"), F.lit(256)) <= 255))
    phone = F.filter(matches(text, PHONE, text.contains("+")), lambda s: F.length(digits(s["value"])).between(9, 15))
    return {"email": email, "ip": ip, "phone": phone, "numbers": matches(text, CARD, text.rlike(r"[0-9][0-9\x20-]{11}"))}


def _card_size(s: Column) -> Column:
    return F.length(digits(s["value"])).between(13, 19)


def _candidates(kind: str, rank: int, spans: Column) -> Column:
    """Votes (1 yes, 0 no, -1 nothing) and features of each span of a kind."""
    strict = {"email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[^-].*\.[A-Za-z]{2,}$", "ip": r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){3}$",
              "card": r"^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$", "phone": r"^\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ .-]?[0-9]",
              "email_words": "^[A-Za-z0-9]", "phone_local": r"^\([0-9]{3}\) |^[0-9]{3}([ .-])[0-9]{3}\1",
              "card_like": r"^([0-9]{15,16}|[0-9]{4}([ -][0-9]{4}){3})$", "identity_number": r"^(?!.*-00-)", "bank_account": r"^[A-Z]{2}[0-9]{2}( [A-Z0-9]{4})+"}[kind]

    def row(s: Column) -> Column:
        v, number = s["value"], digits(s["value"])
        yes = lambda c: F.when(c, 1).otherwise(0)
        check = (yes(luhn(number)) if kind in ("card", "card_like") else
                 yes(~v.rlike(r"([0-9])\1{4}")) if kind in ("phone", "phone_local", "identity_number") else F.lit(-1))
        return F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            yes(v.rlike(strict)).alias("shape"), check.alias("check"),
            F.when(v.rlike(GAZETTEER[kind]), 1).otherwise(F.lit(0) if kind != "email" else F.lit(-1)).alias("gazetteer"),
            F.when(s["before"].rlike(WORDS_FOR), 1).otherwise(-1).alias("words_for"),
            F.when(s["before"].rlike(WORDS_AGAINST), 0).otherwise(-1).alias("words_against"),
            yes((F.right(s["before"], F.lit(1)).rlike(r"^[\s(\[<\"':;,]?$")) & s["after"].rlike(r"^[\s)\]>\"':;,.!?]?$")).alias("borders"),
            F.least(F.floor(F.length(number) / 4), F.lit(5)).cast("int").alias("size"),
            (yes(v.rlike("[ -]")) + 2 * yes(v.rlike("[().]"))).alias("marks"))

    return F.transform(spans, row)


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: every base span and further candidate of the text,
    with its votes and features. Kinds with a rank below 4 are base spans."""
    text = F.col("text")
    spans = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base_spans(text)
    spans = spans.select(
        "doc_id", *(c.alias(k) for k, c in base.items()),
        matches(text, EMAIL_WORDS, text.rlike(r"[\[(](?i:at)[\])]")).alias("email_words"),
        matches(text, PHONE_LOCAL, text.rlike(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}")).alias("phone_local"),
        matches(text, IDENTITY, text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}")).alias("identity_number"),
        matches(text, BANK, text.rlike("[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}")).alias("bank_account"))
    spans = spans.select(
        "doc_id", "email", "ip", "phone", F.filter("numbers", lambda s: _card_size(s) & luhn(digits(s["value"]))).alias("card"),
        F.filter("numbers", lambda s: _card_size(s) & ~luhn(digits(s["value"]))).alias("card_like"),
        "email_words", "phone_local", "identity_number", "bank_account")
    taken = lambda s, kinds: F.lit(False) if not kinds else overlaps(s, F.col(kinds[0])) | taken(s, kinds[1:])
    spans = spans.select("doc_id", *BASE, *(F.filter(k, lambda s: ~taken(s, BASE + ADDED[:i])).alias(k) for i, k in enumerate(ADDED)))
    return spans.select("doc_id", F.concat(*(_candidates(k, i, F.col(k)) for i, k in enumerate(BASE + ADDED))).alias("found"))


def estimate(patterns: list[tuple[tuple, tuple, int]], rounds: int = 200, tolerance: float = 1e-9):
    """Expectation-maximisation over (votes, features, count) rows, votes and
    features being tuples; features[0] is the kind. Returns the posterior of
    every row and each labeler's rates P(vote | personal), P(vote | not). The
    latent class is tied to the labelers by a start at the share of yes votes;
    every rate has a Dirichlet prior that expects labelers to be better than
    chance."""
    posterior = []
    for votes, _, _ in patterns:
        said = [v for v in votes if v >= 0]
        posterior.append((1 + sum(said)) / (2 + len(said)))
    total = sum(n for _, _, n in patterns)
    rates: list[dict] = []
    for _ in range(rounds):
        rates = []
        for k in range(len(VOTES)):
            seen = {(v, y): 1.0 + (v >= 0 and v == y) for v in (-1, 0, 1) for y in (0, 1)}
            for (votes, _, n), p in zip(patterns, posterior, strict=True):
                seen[votes[k], 1] += n * p
                seen[votes[k], 0] += n * (1 - p)
            rates.append({(v, y): c / sum(seen[u, y] for u in (-1, 0, 1)) for (v, y), c in seen.items()})
        share = (1 + sum(n * p for (_, _, n), p in zip(patterns, posterior, strict=True))) / (2 + total)
        moved = 0.0
        for i, (votes, _, n) in enumerate(patterns):
            odds = math.log(share / (1 - share)) + sum(math.log(rates[k][v, 1] / rates[k][v, 0]) for k, v in enumerate(votes) if v >= 0)
            p = 1 / (1 + math.exp(-max(min(odds, 30.0), -30.0)))
            moved += n * abs(p - posterior[i])
            posterior[i] = p
        if moved <= tolerance * max(total, 1):
            break
    return posterior, rates


def train(patterns: list[tuple[tuple, tuple, int]]) -> tuple[float, list[dict]]:
    """The span classifier: intercept and, for every vote and feature, the
    weight of each value, from the posteriors as soft labels."""
    posterior, _ = estimate(patterns)
    both = [(votes + features, n, p) for (votes, features, n), p in zip(patterns, posterior, strict=True)]
    yes, no = 1 + sum(n * p for _, n, p in both), 1 + sum(n * (1 - p) for _, n, p in both)
    weights = []
    for k in range(len(VOTES) + 3):
        seen: dict = defaultdict(lambda: [1.0, 1.0])
        for values, n, p in both:
            seen[values[k]][0] += n * p
            seen[values[k]][1] += n * (1 - p)
        a, b = sum(c[0] for c in seen.values()), sum(c[1] for c in seen.values())
        weights.append({v: math.log(c[0] / a) - math.log(c[1] / b) for v, c in seen.items()})
    return math.log(yes / no), weights


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``added``: arrays of (rank, kind, start, end)."""
    found = written(find_candidates(docs), "personal-candidates")
    columns = [*VOTES, "kind", "size", "marks"]
    rows = (found.select(F.explode("found").alias("s")).groupBy(*(F.col(f"s.{c}").alias(c) for c in columns))
            .agg(F.count("*").alias("n")).orderBy(*columns).collect())  # bounded by the values' combinations
    intercept, weights = train([(tuple(r[c] for c in VOTES), tuple(r[c] for c in columns[len(VOTES):]), r.n) for r in rows])

    def odds(s: Column) -> Column:
        score = F.lit(intercept)
        for name, table in zip(columns, weights, strict=True):
            pick = F.lit(0.0)
            for value, w in sorted(table.items()):
                pick = F.when(s[name] == F.lit(value), F.lit(w)).otherwise(pick)
            score = score + pick
        return score

    narrow = lambda spans: F.transform(spans, lambda s: F.struct(s["rank"], s["kind"], s["start"], s["end"]))
    return found.select("doc_id", narrow(F.filter("found", lambda s: s["rank"] < len(BASE))).alias("base"),
                        narrow(F.filter("found", lambda s: (s["rank"] >= len(BASE)) & (odds(s) >= 0))).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the base kinds' counts, base_sha256 and spans of ``find_personal``."""
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(F.col("base"), by_kind=True), 256).alias("base_sha256"),
        joined(F.concat("base", "added"), by_kind=True).alias("spans"))
