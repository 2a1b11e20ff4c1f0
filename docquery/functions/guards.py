"""Screening of questions and answers: regex predicates and masking as built-in columns."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt-injection phrasings, matched case-insensitively anywhere.
INJECTION_PATTERNS = [
    r"ignore\s+(?:all\s+|the\s+|any\s+)?(?:previous|above|prior|earlier)\s+"
    r"(?:instructions?|prompts?|context|messages?)",
    r"disregard\s+(?:all\s+|the\s+)?(?:previous|above|prior)\b",
    r"forget\s+(?:everything|all|your)\b",
    r"(?:reveal|show|print|repeat|tell\s+me|expose)\s+(?:me\s+)?(?:your\s+|the\s+)?"
    r"(?:system\s+)?(?:prompt|instructions?|rules)",
    r"you\s+are\s+now\b",
    r"\bact\s+as\s+(?:if|a|an|though)\b",
    r"\bpretend\s+(?:to\s+be|you\s+are)\b",
    r"developer\s+mode",
    r"\bjailbreak\b",
    r"\bdo\s+anything\s+now\b|\bDAN\b",
    r"override\s+(?:your\s+|the\s+)?(?:rules|instructions|safety|guardrails)",
    r"new\s+instructions?\s*:",
]

# Toxic terms, matched as whole words, case-insensitively.
TOXIC_TERMS = [
    "idiot", "moron", "stupid", "shut up", "hate you", "kill yourself",
    "worthless", "scum", "loser",
]

# Personal-data patterns in the order they are masked.
PII_PATTERNS = [
    ("EMAIL", r"[\w.+-]+@[\w-]+\.[\w.-]+"),
    ("SSN", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("CREDIT_CARD", r"\b(?:\d[ -]?){13,16}\b"),
    ("IP", r"\b(?:\d{1,3}\.){3}\d{1,3}\b"),
    ("PHONE", r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"),
]

# The messages users see.
INJECTION_REASON = "prompt-injection pattern detected"
INJECTION_JUDGED = "prompt-injection flagged by LLM judge"
TOXICITY_REASON = "toxic language detected"
TOXICITY_JUDGED = "toxicity flagged by LLM judge"
BLOCKED_TEXT = "I can't help with that request."


def is_injection(text: Column) -> Column:
    return text.rlike("(?iU)" + "|".join(INJECTION_PATTERNS))


def is_toxic(text: Column) -> Column:
    return text.rlike(r"(?iU)\b(?:" + "|".join(TOXIC_TERMS) + r")\b")


def mask_one(text: Column, entity: str) -> Column:
    """Replace every match of one entity with its tag.

    An address needs an "@", so texts without one skip that pattern's
    backtracking over long unbroken runs.
    """
    masked = F.regexp_replace(text, "(?U)" + dict(PII_PATTERNS)[entity], f"[{entity}]")
    if entity == "EMAIL":
        return F.when(text.contains("@"), masked).otherwise(text)
    return masked


def reasons(*flags: tuple[Column, str]) -> Column:
    """The messages of the flags that are set, in the order given."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(message)) for flag, message in flags]))
