"""Lookups and decision rules as SQL expression text."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from greenwave.functions import constants as C


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def lookup(key: str, table: Mapping, default) -> str:
    """``table[key]`` with a default for unknown and NULL keys."""
    cases = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in table.items())
    return f"(CASE {key} {cases} ELSE {literal(default)} END)"


def or_default(value: str, empty, default) -> str:
    """``default`` where ``value`` is NULL or equals its empty value (0 or '')."""
    return f"coalesce(nullif({value}, {literal(empty)}), {literal(default)})"


def severity_rank(severity: str) -> str:
    return lookup(severity, C.SEVERITY_RANK, 0)


def mode_label(mode: str) -> str:
    return lookup(mode, C.MODE_LABEL, "?")


def mode_symbol(mode: str, default: str = "") -> str:
    return lookup(mode, C.MODE_SYMBOL, default)


def severity_symbol(severity: str, default: str = "") -> str:
    return lookup(severity, C.SEVERITY_SYMBOL, default)


@dataclass(frozen=True)
class SignalRules:
    """Weights and thresholds of the signal plan; the defaults are fixed values.

    ``volume_scores`` maps "more vehicles than" to a score, highest first;
    ``base_score`` applies below all of them. A severity of ``override`` decides alone.
    """

    volume_scores: tuple = ((20, 80), (10, 50))
    base_score: int = 20
    severity_malus: Mapping[str, int] = field(
        default_factory=lambda: {"CRITICAL": 40, "HIGH": 20, "MEDIUM": 10}
    )
    override: str = "CRITICAL"
    slow_kmh: float = 15.0
    dense_score: int = 80
    moderate_score: int = 50
    green_seconds: Mapping[str, int] = field(
        default_factory=lambda: {
            "EMERGENCY": 5,
            "CONGESTION": 60,
            "DENSE": 60,
            "MODERATE": 40,
            "FLUID": 20,
        }
    )
    cycle_seconds: int = C.CYCLE_SECONDS


def traffic_mode(total: str, speed: str, severity: str, rules: SignalRules = SignalRules()) -> str:
    """Traffic mode of a window; the first matching rule wins.

    ``speed`` is the average already rounded to two decimals. A missing total
    counts as 0 and a missing speed as 0, which makes the window CONGESTION.
    """
    volume = " ".join(
        f"WHEN coalesce({total}, 0) > {above} THEN {score}" for above, score in rules.volume_scores
    )
    score = (
        f"((CASE {volume} ELSE {rules.base_score} END) + "
        f"{lookup(severity, rules.severity_malus, 0)})"
    )
    return (
        f"(CASE WHEN {severity} = {literal(rules.override)} THEN 'EMERGENCY' "
        f"WHEN coalesce({speed}, 0D) < {literal(float(rules.slow_kmh))} THEN 'CONGESTION' "
        f"WHEN {score} >= {rules.dense_score} THEN 'DENSE' "
        f"WHEN {score} >= {rules.moderate_score} THEN 'MODERATE' "
        "ELSE 'FLUID' END)"
    )


def green_seconds(mode: str, rules: SignalRules = SignalRules()) -> str:
    return lookup(mode, rules.green_seconds, None)


def density_class(count: str) -> str:
    """HIGH above 20 vehicles, MEDIUM above 10, else LOW; NULL stays NULL."""
    return (
        f"(CASE WHEN {count} > 20 THEN 'HIGH' WHEN {count} > 10 THEN 'MEDIUM' "
        f"WHEN {count} IS NOT NULL THEN 'LOW' END)"
    )


# Hour bands in order of precedence, with inclusive hour ranges and
# the range of the density factor.
HOUR_BANDS = [
    ("PEAK", [(7, 9), (17, 19)], (1.5, 2.5)),
    ("MIDDAY", [(12, 14)], (1.0, 1.5)),
    ("NIGHT", [(0, 5)], (0.1, 0.3)),
    ("NORMAL", [(0, 23)], (0.5, 1.0)),
]


def hour_band(time: str) -> str:
    """Name of the density band at the hour of ``time``."""
    cases = " ".join(
        "WHEN " + " OR ".join(f"hour({time}) BETWEEN {a} AND {b}" for a, b in hours) + f" THEN '{name}'"
        for name, hours, _ in HOUR_BANDS
    )
    return f"(CASE {cases} END)"


def hour_factor(band: str, which: int) -> str:
    """Lowest (``which=0``) or highest (1) density factor expected in a band."""
    return lookup(band, {name: factors[which] for name, _, factors in HOUR_BANDS}, None)
