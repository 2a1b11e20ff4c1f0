"""Input screening and output masking over tables of questions and answers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.functions import guards
from docquery.hooks import Hook
from docquery.operators.gating import decide
from docquery.settings import DEFAULTS, Settings


def mask_pii(
    rows: DataFrame, column: str = "text", entities: tuple[str, ...] | None = None
) -> DataFrame:
    """Mask `column` in place and add `pii_found`, the entities replaced, in masking order.

    Each pattern sees the text as masked so far. A replacement always changes the
    text, so comparing before and after tells what was found without a second scan.
    """
    entities = DEFAULTS.pii_entities if entities is None else entities
    steps = [name for name, _ in guards.PII_PATTERNS if name in entities]
    before = column
    flags = []
    for n, entity in enumerate(steps):
        after = f"_masked_{n}"
        rows = rows.withColumn(after, guards.mask_one(F.col(before), entity))
        flags.append((F.col(after) != F.col(before), entity))
        before = after
    found = guards.reasons(*flags) if flags else F.expr("cast(array() as array<string>)")
    rows = rows.withColumn("pii_found", found)
    return rows.withColumn(column, F.col(before)).drop(*[f"_masked_{n}" for n in range(len(steps))])


def _detect(rows: DataFrame, column: str, hit: Column, messages: tuple[str, str], judge: Hook | None, out: str):
    """Add array `out`: the heuristic's message, else the judge's where one is configured."""
    first, second = messages
    if judge is None:
        return rows.withColumn(out, guards.reasons((hit, first)))
    flagged = rows.withColumn("_hit", hit)
    judged = decide(
        flagged, F.col("_hit"), F.lit(False), judge, [F.col(column)], "_judged"
    )
    return judged.withColumn(
        out, guards.reasons((F.col("_hit"), first), (F.col("_judged"), second))
    ).drop("_hit", "_judged")


def detect_injection(rows: DataFrame, column: str = "text", judge: Hook | None = None, out: str = "injection"):
    return _detect(
        rows, column, guards.is_injection(F.col(column)),
        (guards.INJECTION_REASON, guards.INJECTION_JUDGED), judge, out,
    )


def detect_toxicity(rows: DataFrame, column: str = "text", judge: Hook | None = None, out: str = "toxicity"):
    return _detect(
        rows, column, guards.is_toxic(F.col(column)),
        (guards.TOXICITY_REASON, guards.TOXICITY_JUDGED), judge, out,
    )


def input_firewall(
    rows: DataFrame,
    column: str = "question",
    settings: Settings = DEFAULTS,
    injection_judge: Hook | None = None,
    toxicity_judge: Hook | None = None,
) -> DataFrame:
    """Add `reasons` (injection before toxicity) and `allowed`."""
    parts = []
    if settings.guardrails_enabled and settings.guard_injection:
        rows = detect_injection(rows, column, injection_judge, "_injection")
        parts.append("_injection")
    if settings.guardrails_enabled and settings.guard_toxicity:
        rows = detect_toxicity(rows, column, toxicity_judge, "_toxicity")
        parts.append("_toxicity")
    found = F.concat(*parts) if parts else F.expr("cast(array() as array<string>)")
    rows = rows.withColumn("reasons", found).drop(*parts)
    return rows.withColumn("allowed", F.size("reasons") == 0)


def output_firewall(
    rows: DataFrame,
    column: str = "text",
    settings: Settings = DEFAULTS,
    toxicity_judge: Hook | None = None,
) -> DataFrame:
    """Mask `column`, flag toxicity on the masked text; add `pii_masked`, `toxic`, `findings`."""
    none = F.expr("cast(array() as array<string>)")
    if not settings.guardrails_enabled:
        return rows.withColumns(
            {"pii_masked": F.lit(False), "toxic": F.lit(False), "findings": none}
        )
    rows = mask_pii(rows, column, settings.pii_entities)
    if settings.guard_toxicity:
        rows = detect_toxicity(rows, column, toxicity_judge, "_toxicity")
    else:
        rows = rows.withColumn("_toxicity", none)
    masked = F.transform("pii_found", lambda e: F.concat(F.lit("masked "), e))
    return rows.withColumns(
        {
            "pii_masked": F.size("pii_found") > 0,
            "toxic": F.size("_toxicity") > 0,
            "findings": F.concat(masked, F.col("_toxicity")),
        }
    ).drop("pii_found", "_toxicity")
