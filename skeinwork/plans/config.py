"""Checks of a run's settings, a nested dict as YAML gives it."""

from __future__ import annotations

#: Sections that must be there.
SECTIONS = ["model", "qlora", "training", "aws", "distillation"]
#: Ranges, ends included, of values that may be set.
RANGES = {
    ("distillation", "quality_threshold"): (0.0, 10.0),
    ("distillation", "convergence_threshold"): (0.0, 10.0),
    ("distillation", "convergence_patience"): (1, 1000),
    ("distillation", "max_corrections_per_epoch"): (1, 10**9),
    ("training", "num_epochs"): (1, 10**6),
    ("training", "learning_rate"): (1e-9, 1.0),
}


def problems(config: dict) -> list[str]:
    """What is missing or out of range; an empty list if nothing is."""
    found = [f"section {s} is missing" for s in SECTIONS if s not in config]
    if not (config.get("model") or {}).get("name"):
        found.append("model.name is missing")
    for (section, key), (low, high) in RANGES.items():
        value = (config.get(section) or {}).get(key)
        if value is not None and not (isinstance(value, (int, float)) and low <= value <= high):
            found.append(f"{section}.{key} = {value!r} is not within {low} to {high}")
    return found
