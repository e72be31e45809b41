"""Secret scan: base patterns, and strings of high entropy.

Base kinds are ``assign``, ``access`` and ``hex``. Beyond them, every run of 20
or more token characters is a candidate: a window of 20 characters slides over
it with incremental counts per character, and the highest Shannon entropy of
any window is held against the threshold of the run's narrowest character
class. An allow-list suppresses well-known harmless shapes. Candidates that
overlap a base span are left to it.

Native expressions only. Edge cases: null and empty texts have no spans (the
digest is that of the empty string); every input row gives one row, null ids
and repeated ids included; an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import joined, labelled, matches, overlaps

WINDOW = 20
#: Bits per character that a window must reach, by class.
THRESHOLDS = {"hexadecimal": 3.0, "alphanumeric": 3.7, "base64": 3.8}
#: Shapes that are no secrets.
ALLOWED = (
    "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
    "^[A-Za-z]+$", "^[0-9]+$", "^[-_=/+]+$",
    "^[A-Za-z]+([-_/+=][A-Za-z]+)*[-_/+=]*$",  # joined words and paths
    "^[0-9]+([-_/][0-9]+)*$",  # dates and numbers
    "(?i)(example|sample|placeholder|changeme|your[-_]?(api|key|token)|xxxx|0123456789|abcdefghij)",
)
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits per character, of any ``window``
    consecutive characters of an ASCII string of '+' to 'z'. One pass: the
    state holds a count per character and the sum of c log2 c, and each step
    changes both for the character that enters and the one that leaves."""
    chars = F.split(value, "")
    n = F.size(chars)
    code = lambda i: F.ascii(F.element_at(chars, i)) - 42  # noqa: E731  '+' is 1
    part = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))
    start = F.struct(F.array_repeat(F.lit(0), 80).alias("count"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(s: Column, i: Column) -> Column:
        enters = code(i)
        leaves = F.when(i > window, code(F.greatest(i - window, F.lit(1)))).otherwise(F.lit(0))
        a = F.element_at(s["count"], enters)
        b = F.when(leaves > 0, F.element_at(s["count"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(1))
        total = F.when(enters == leaves, s["sum"]).otherwise(
            s["sum"] + part(a + 1) - part(a) - F.when(leaves > 0, part(b) - part(b - 1)).otherwise(F.lit(0.0)))
        return F.struct(
            F.transform(s["count"], lambda c, j: c + (j + 1 == enters).cast("int") - (j + 1 == leaves).cast("int")).alias("count"),
            total.alias("sum"),
            F.when(i >= window, F.greatest(s["best"], F.log2(F.lit(float(window))) - total / window)).otherwise(s["best"]).alias("best"))

    return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["best"])


def character_class(value: Column) -> Column:
    return (F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hexadecimal")
            .when(value.rlike("^[A-Za-z0-9]+$"), "alphanumeric").otherwise("base64"))


def is_secret(value: Column) -> Column:
    """Whether a run of token characters holds a window of high entropy and no
    entry of the allow-list fits it."""
    name = character_class(value)
    limit = F.when(name == "hexadecimal", THRESHOLDS["hexadecimal"]).when(
        name == "alphanumeric", THRESHOLDS["alphanumeric"]).otherwise(THRESHOLDS["base64"])
    allowed = F.lit(False)
    for shape in ALLOWED:
        allowed = allowed | value.rlike(shape)
    return F.when(allowed, F.lit(False)).otherwise(window_entropy(value) >= limit)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and per kind the array of (start, end, value, ...) of its spans:
    ``assign``, ``access``, ``hex`` and ``entropy``."""
    text = F.col("text")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text",
        F.filter(matches(text, ASSIGN, text.rlike(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*+[:=]"""), 1),
                 lambda s: F.length(s["part"]) >= 8).alias("assign"),
        matches(text, "AKIA[A-Z0-9]{12,}+", text.contains("AKIA")).alias("access"),
        matches(text, "(?<![0-9a-f])[0-9a-f]{32,}+", text.rlike("[0-9a-f]{32}")).alias("hex"),
        matches(text, "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+", text.rlike("[A-Za-z0-9+/_=-]{20}")).alias("runs"))
    return base.select("doc_id", "assign", "access", "hex", F.filter(
        "runs", lambda r: ~overlaps(r, F.col("assign")) & ~overlaps(r, F.col("access")) & ~overlaps(r, F.col("hex")) & is_secret(r["value"])
    ).alias("entropy"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the base kinds' counts, base_sha256 and spans of ``find_secrets``."""
    base = F.concat(*(labelled(F.col(k), k, i) for i, k in enumerate(("assign", "access", "hex"))))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(base, by_kind=False), 256).alias("base_sha256"),
        joined(F.concat(base, labelled(F.col("entropy"), "entropy", 3)), by_kind=False).alias("spans"))
