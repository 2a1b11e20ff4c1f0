"""Tuning knobs, passed explicitly to the operators that use them."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Defaults a user of the service relies on.
    embed_provider: str = "offline"
    embed_model: str = "hashed-terms"
    embed_dim: int = 768
    chunk_size: int = 800
    chunk_overlap: int = 120
    child_size: int = 350
    top_k: int = 5
    retrieve_k: int = 20
    rerank_enabled: bool = True
    correction_enabled: bool = True
    grade_gate: float = 0.6
    max_rewrites: int = 1
    sql_enabled: bool = True
    sql_max_rows: int = 50
    approval_enabled: bool = True
    sensitive_columns: tuple[str, ...] = ("salary",)
    flag_broad_scans: bool = True
    guardrails_enabled: bool = True
    guard_injection: bool = True
    guard_toxicity: bool = True
    pii_entities: tuple[str, ...] = ("EMAIL", "PHONE", "SSN", "CREDIT_CARD", "IP")

    # Statements that run side by side, and how long one may take.
    sql_at_once: int = 8
    sql_seconds: float = 600.0

    # Scale limit of this engine: what may be sent to every executor.
    broadcast_bytes: int = 64 << 20

    def fingerprint(self) -> dict:
        return {"provider": self.embed_provider, "model": self.embed_model, "dim": self.embed_dim}


DEFAULTS = Settings()
