"""Response classes by a cascade of patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SPACE, is_blank, let, strip

# The pattern groups, in priority order.
REFUSAL_PATTERNS: dict[str, list[str]] = {
    "insufficient_context": [
        r"no\s+(?:sufficient|enough)\s+(?:information|evidence|context)",
        r"(?:the\s+)?context\s+(?:does\s+not|doesn't|has\s+no)\s+(?:contain|provide|include)",
        r"not\s+(?:mentioned|specified|provided|included)\s+in\s+(?:the\s+)?(?:context|document)",
        r"(?:the\s+)?(?:provided|given)\s+context\s+(?:does\s+not|doesn't)",
        r"insufficient\s+(?:information|context|data)",
        r"(?:the\s+)?context\s+(?:is\s+)?(?:unclear|incomplete|lacks)",
        r"no\s+relevant\s+(?:information|context|data)",
        r"based\s+on\s+(?:the\s+)?(?:provided|given)\s+context,?\s+(?:i\s+)?(?:cannot|can't)",
        r"(?:the\s+)?document\s+(?:does\s+not|doesn't)\s+(?:mention|specify|provide)",
        r"not\s+enough\s+(?:information|context|evidence)",
    ],
    "ambiguous_question": [
        r"(?:your\s+)?question\s+(?:is\s+)?(?:unclear|ambiguous|vague)",
        r"(?:could\s+you|please)\s+(?:clarify|rephrase|be\s+more\s+specific)",
        r"(?:i\s+)?(?:need|require)\s+(?:more\s+)?(?:clarification|details)",
        r"what\s+(?:do\s+you\s+mean|are\s+you\s+asking)",
        r"(?:not\s+)?(?:sure|certain)\s+(?:what\s+you're|what\s+you\s+are)\s+asking",
    ],
    "out_of_scope": [
        r"(?:that's|that\s+is)\s+(?:outside|beyond)\s+(?:my\s+)?(?:scope|expertise|knowledge)",
        r"(?:i\s+)?(?:cannot|can't)\s+(?:help|assist)\s+with\s+(?:that|this)",
        r"(?:i'm|i\s+am)\s+(?:only|specifically)\s+(?:designed|trained)\s+(?:for|to)",
        r"(?:not\s+)?(?:related\s+to|about)\s+(?:GDPR|data\s+protection)",
        r"(?:outside|beyond)\s+(?:the\s+)?(?:scope\s+of|domain\s+of)",
    ],
    "capability_limitation": [
        r"(?:i\s+)?(?:cannot|can't|unable\s+to)\s+(?:access|retrieve|search)",
        r"(?:i\s+)?(?:don't|do\s+not)\s+have\s+(?:access|permission|ability)",
        r"(?:that\s+)?(?:requires|needs)\s+(?:external|real-time)\s+(?:access|data)",
        r"(?:i\s+)?(?:cannot|can't)\s+(?:browse|fetch|query)\s+(?:external|live)",
    ],
}
# Short answers without content.
VAGUE_PATTERNS: list[str] = [
    r"^(?:yes|no|maybe|unclear|unknown)\.?$",
    r"^(?:i\s+)?(?:don't|do\s+not)\s+know\.?$",
    r"^not\s+(?:sure|certain|available)\.?$",
]
MIN_ANSWER_LENGTH = 20


def _regex(patterns: list[str]) -> str:
    """Letters match in any case and blanks are those of Unicode, as in Python's re."""
    return "(?iUd)" + "|".join(patterns).replace(r"\s", SPACE)


def classify(text: Column, min_length: int = MIN_ANSWER_LENGTH) -> Column:
    """Struct of response_classification, refusal_type and classification_reason.

    Steps are bound by let, so the whole stays one expression that computes
    each of them once, also where the optimizer copies it into a filter.
    """

    def result(kind: str, refusal: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("response_classification"),
            refusal.cast("string").alias("refusal_type"),
            reason.cast("string").alias("classification_reason"),
        )

    def hit(name: str) -> Column:
        """(name, match) or NULL; no pattern can match the empty string."""
        found = F.regexp_extract(text, _regex(REFUSAL_PATTERNS[name]), 0)
        return let(found, lambda m: F.when(m != "", F.struct(F.lit(name).alias("name"), m.alias("match"))))

    none = F.lit(None)

    def judged(clean: Column, refusal: Column) -> Column:
        size = F.length(clean)
        label = F.replace(refusal["name"], F.lit("_"), F.lit(" "))
        matched = F.concat(F.lit("Contains "), label, F.lit(" pattern: '"), refusal["match"], F.lit("'"))
        short = F.when(
            text.rlike(_regex(VAGUE_PATTERNS)), F.concat(F.lit("Too short and vague: '"), clean, F.lit("'"))
        ).otherwise(F.concat(F.lit("Response too short ("), size.cast("string"), F.lit(" chars)")))
        return (
            F.when(refusal.isNotNull(), result("refusal", refusal["name"], matched))
            .when(size < min_length, result("vague", none, short))
            .otherwise(result("answer", none, none))
        )

    first = F.coalesce(*[hit(name) for name in REFUSAL_PATTERNS])
    checked = let(strip(text), lambda clean: let(first, lambda h: judged(clean, h)))
    blank = result("empty", none, F.lit("Response is empty or whitespace"))
    return F.when(is_blank(text), blank).otherwise(checked)


def classify_response(
    df: DataFrame, answer: str = "answer", min_length: int = MIN_ANSWER_LENGTH, only: Column | None = None
) -> DataFrame:
    """Add response_classification, refusal_type and classification_reason.

    Rows for which `only` is not true keep NULL in all three.
    """
    found = classify(F.col(answer), min_length)
    if only is not None:
        found = F.when(only, found)
    names = ["response_classification", "refusal_type", "classification_reason"]
    return df.withColumn("_class", found).withColumns({n: F.col(f"_class.{n}") for n in names}).drop("_class")
