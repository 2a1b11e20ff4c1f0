"""Audit of SQL text held in a column: cleaning, validation and risk flags."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.guards import reasons
from docquery.functions.text import strip

# Word-bounded, case-insensitive markers.
WRITE_WORDS = "insert|update|delete|drop|alter|create|replace|truncate|attach|pragma"
AGGREGATE_WORDS = r"count|sum|avg|min|max|group\s+by"
ROUTE_WORDS = (
    "how many|count|number of|average|avg|mean|median|sum|total|"
    "highest|lowest|most|least|per department|by department|"
    "salary|salaries|headcount|employees in"
)

# Messages in the order the checks are made.
EMPTY = "empty SQL"
STACKED = "only a single statement is allowed"
NOT_SELECT = "only SELECT queries are allowed"
WRITES = "query contains a write/DDL keyword"
STACKED_AT_RUN = "multiple statements are not allowed"
BROAD_SCAN = "unbounded scan (no WHERE/LIMIT) could return whole rows"
NO_RISK = "no risk flags"
DENIED = "query was denied by an administrator"


def has_word(text: Column, alternatives: str) -> Column:
    return text.rlike(rf"(?iU)\b({alternatives})\b")


def wants_data(question: Column) -> Column:
    """True where a question names a count, a total or another figure over rows."""
    return has_word(question, ROUTE_WORDS)


def strip_fences(sql: Column) -> Column:
    fence = r"(?isU)^```(?:sql)?\s*(.*?)\s*```\z"
    text = strip(sql)
    inner = F.when(text.rlike(fence), F.regexp_extract(text, fence, 1)).otherwise(text)
    return F.btrim(inner, F.lit("` \n"))


def _unterminated(sql: Column) -> Column:
    return strip(F.rtrim(strip(sql), F.lit(";")))


def cleaned_sql(sql: Column) -> Column:
    return _unterminated(strip_fences(sql))


def validation_error(cleaned: Column) -> Column:
    """The first rule a cleaned statement breaks, or null."""
    head = F.lower(cleaned)
    return (
        F.when(cleaned == "", EMPTY)
        .when(cleaned.contains(";"), STACKED)
        .when(~(head.startswith("select") | head.startswith("with")), NOT_SELECT)
        .when(has_word(cleaned, WRITE_WORDS), WRITES)
    )


def execution_error(sql: Column) -> Column:
    """The stricter check made right before a statement runs, or null."""
    text = _unterminated(sql)
    return F.when(text.contains(";"), STACKED_AT_RUN).when(
        ~F.lower(text).startswith("select"), NOT_SELECT
    )


def risk_reasons(sql: Column, sensitive_columns: tuple[str, ...], flag_broad_scans: bool) -> Column:
    lowered = F.lower(sql)
    flags = [
        (
            lowered.rlike(rf"(?U)\b\Q{name.lower()}\E\b"),
            f"reads sensitive column '{name.lower()}'",
        )
        for name in sensitive_columns
    ]
    if flag_broad_scans:
        bounded = has_word(sql, f"{AGGREGATE_WORDS}|where|limit")
        flags.append((~bounded, BROAD_SCAN))
    if not flags:
        return F.expr("cast(array() as array<string>)")
    return reasons(*flags)


def risk_summary(found: Column) -> Column:
    return F.when(F.size(found) == 0, NO_RISK).otherwise(F.array_join(found, "; "))
