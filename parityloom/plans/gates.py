"""Gates and decisions over a handful of metrics, in plain Python."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from ..functions.math import JS_BASE

# Thresholds by profile, gate codes with the hard ones, fields by weight.
THRESHOLDS = {
    "ANALYSIS_ONLY": {"max_mean_l1_error": 0.10, "max_category_error": 0.25, "max_fallback_ratio_critical": 0.70, "max_fallback_ratio_super_critical": 1.0, "max_mock_ratio": 1.0, "min_ess_ratio": 0.50, "max_cache_age_days": 60, "min_schema_valid_ratio_attempted": 0.50},
    "NARRATIVE_REQUIRED": {"max_mean_l1_error": 0.10, "max_category_error": 0.25, "max_fallback_ratio_critical": 0.70, "max_fallback_ratio_super_critical": 0.50, "max_mock_ratio": 0.20, "min_ess_ratio": 0.70, "max_cache_age_days": 30, "min_schema_valid_ratio_attempted": 0.90},
    "HIGH_STAKES": {"max_mean_l1_error": 0.06, "max_category_error": 0.15, "max_fallback_ratio_critical": 0.40, "max_fallback_ratio_super_critical": 0.50, "max_mock_ratio": 0.05, "min_ess_ratio": 0.85, "max_cache_age_days": 7, "min_schema_valid_ratio_attempted": 0.95},
}
HARD = {"MARGINAL_ERROR_CRITICAL", "FALLBACK_SUPERCRITICAL_FIELD", "TARGET_FALLBACK_SUPERCRITICAL", "ESS_TOO_LOW", "IPF_DIVERGENCE", "NARRATIVE_SCHEMA_INVALID", "NARRATIVE_PRONOUN_MISMATCH", "NARRATIVE_MOCK_RATIO_HIGH", "SYSTEM_MEMORY_EXCEEDED", "SYSTEM_TIMEOUT"}
SUPER_CRITICAL = {"ethnicity", "education_level", "employment_status", "region"}
CRITICAL = SUPER_CRITICAL | {"sex", "age_group", "residence_type", "marital_status"}
PASS = {"PASS", "PASS_WITH_WARNINGS"}


def is_hard(code: str) -> bool:
    return code in HARD


def is_warning(code: str) -> bool:
    return code not in HARD and code not in PASS


def sort_codes(codes: Sequence[str]) -> list[str]:
    """Different codes, hard ones first, then by name."""
    return sorted(set(codes), key=lambda c: (not is_hard(c), not is_warning(c), c))


def first_code(codes: Sequence[str]) -> str:
    return next(iter(sort_codes(codes)), "PASS")


@dataclass
class Metrics:
    """What the gates look at; by_field has js, p_value and n of each field."""

    mean_l1: float = 0.0
    max_error: float = 0.0
    fallback_critical: float = 0.0
    fallback_super: float = 0.0
    all_fallback: bool = False
    ess_ratio: float | None = None
    converged: bool | None = None
    mock_ratio: float = 0.0
    failed_ratio: float = 0.0
    schema_valid: float = 1.0
    cache_age_days: int | None = None
    estimated: Sequence[str] = ()
    by_field: Mapping[str, Mapping[str, float]] = field(default_factory=dict)


@dataclass
class Decision:
    verdict: str
    codes: list[str]
    reasons: list[str]
    structured_tier: str
    narrative_tier: str
    overall_tier: str
    confidence: str

    def as_dict(self) -> dict:
        return asdict(self)


def structured_tier(m: Metrics) -> str:
    more = 0.05 if m.all_fallback else 0.0
    mean, top = m.mean_l1 + more, m.max_error + more
    if mean > 0.20 or top > 0.30:
        return "REJECT"
    if mean < 0.05 and top < 0.15 and m.fallback_critical < 0.30:
        return "A"
    return "B" if mean < 0.10 and top < 0.25 else "C"


def narrative_tier(m: Metrics) -> str:
    if m.failed_ratio > 0.50 or m.schema_valid < 0.70:
        return "REJECT"
    for name, mock, failed, valid in (("A", 0.05, 0.01, 0.95), ("B", 0.20, 0.05, 0.90), ("C", 0.50, 2.0, 0.80)):
        if m.mock_ratio < mock and m.failed_ratio < failed and m.schema_valid >= valid:
            return name
    return "REJECT"


def overall_tier(profile: str, structured: str, narrative: str) -> str:
    return structured if profile == "ANALYSIS_ONLY" else max(structured, narrative, key=("A", "B", "C", "REJECT").index)


def js_limit(name: str, n: float, profile: str, estimated: bool) -> float:
    base = JS_BASE[profile] * (0.8 if name in SUPER_CRITICAL else 0.9 if name in CRITICAL else 1.0) * (1.5 if estimated else 1.0)
    return min(1.0, max(base, 2 * 1.96 * 0.5 / max(n, 1) ** 0.5))


def decide(m: Metrics, profile: str = "HIGH_STAKES", strict: bool = False) -> Decision:
    """PASS, PASS_WITH_WARNINGS or REJECT, with codes and reasons; strict turns warnings into a rejection."""
    limits, found = THRESHOLDS[profile], []

    def gate(bad: bool, code: str, reason: str, hard: bool | None = None) -> None:
        if bad:
            found.append((code, reason, is_hard(code) if hard is None else hard))

    gate(m.mean_l1 > limits["max_mean_l1_error"], "MARGINAL_ERROR_HIGH", f"mean L1 error {m.mean_l1:.2%}")
    gate(m.max_error > limits["max_category_error"], "MARGINAL_ERROR_CRITICAL", f"largest category error {m.max_error:.2%}", False)
    for name, x in sorted(m.by_field.items()):
        limit = js_limit(name, x["n"], profile, name in m.estimated)
        far, unlikely = x["js"] > limit, x["p_value"] < 0.001
        hard = far and unlikely and (name in CRITICAL or profile == "HIGH_STAKES")
        gate(far or unlikely, "MARGINAL_ERROR_CRITICAL" if hard else "MARGINAL_ERROR_HIGH", f"{name}: JS {x['js']:.4f} against {limit:.4f}, p {x['p_value']:.4f}", hard)
    gate(m.fallback_critical > limits["max_fallback_ratio_critical"], "FALLBACK_CRITICAL_FIELD", f"critical fallbacks {m.fallback_critical:.0%}", True)
    gate(m.fallback_super > limits["max_fallback_ratio_super_critical"], "FALLBACK_SUPERCRITICAL_FIELD", f"super-critical fallbacks {m.fallback_super:.0%}")
    gate(m.ess_ratio is not None and m.ess_ratio < limits["min_ess_ratio"], "ESS_TOO_LOW", f"effective sample {m.ess_ratio or 0:.0%}")
    gate(m.converged is False, "IPF_DIVERGENCE", "raking did not converge", False)
    gate(m.mock_ratio > limits["max_mock_ratio"], "NARRATIVE_MOCK_RATIO_HIGH", f"mock texts {m.mock_ratio:.0%}")
    gate(m.schema_valid < limits["min_schema_valid_ratio_attempted"], "NARRATIVE_SCHEMA_INVALID", f"valid texts {m.schema_valid:.0%}")
    gate(m.cache_age_days is not None and m.cache_age_days > limits["max_cache_age_days"], "PXWEB_CACHE_STALE", f"targets are {m.cache_age_days} days old", False)
    gate(bool(m.estimated), "ESTIMATED_FIELD_USED", f"estimated: {', '.join(sorted(m.estimated))}", False)
    structured, narrative = structured_tier(m), narrative_tier(m)
    rejected = any(h for _, _, h in found) or structured == "REJECT"
    codes = [c for c, _, _ in found]
    if strict and found and not rejected:
        rejected, codes = True, [*codes, "CONFIG_INCOMPLETE"]
    verdict = "REJECT" if rejected else "PASS_WITH_WARNINGS" if found else "PASS"
    confidence = "high" if not found else "medium" if len(found) <= 2 else "low"
    return Decision(verdict, sort_codes(codes) or ["PASS"], [r for _, r, _ in found], structured, narrative, overall_tier(profile, structured, narrative), confidence)


def capped_confidence(d: Decision, profile: str, targets_source: str) -> str:
    """The confidence others may rely on: low if rejected; medium at most where high stakes rest on fallback targets."""
    if d.verdict == "REJECT":
        return "low"
    return "medium" if profile == "HIGH_STAKES" and targets_source == "hardcoded_fallback" else d.confidence


def payload(d: Decision, profile: str = "ANALYSIS_ONLY", targets_source: str = "") -> dict:
    """What another system is told."""
    confidence = capped_confidence(d, profile, targets_source)
    return {"decision": d.verdict, "gate_codes": d.codes, "quality_tier": d.overall_tier, "confidence": confidence, "base_confidence": d.confidence, "monotonicity_applied": confidence != d.confidence}


def can_publish(found: Sequence[Mapping]) -> bool:
    """No violation is critical."""
    return all(v["severity"] != "critical" for v in found)


def repairs(checks: Mapping[str, bool]) -> tuple[bool, list[str]]:
    """Whether all checks passed, and what has to be mended."""
    return all(checks.values()), [k for k, ok in checks.items() if not ok]


def place_policy(profile: str, candidates: int, fits: bool) -> tuple[str, str]:
    """What to do where no place fits: strict profiles leave it empty."""
    if candidates and fits:
        return "use", "VERIFIED"
    if profile == "HIGH_STAKES":
        return "empty", "MISSING"
    return ("use", "FALLBACK_REGION") if candidates else ("empty", "MISSING")
