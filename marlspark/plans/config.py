"""The configuration of a data set, and what must hold for it."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from marlspark.kernels.cases import CASES
from marlspark.operators.assign import checked_quotas
from marlspark.sources.store import read_json


def load_config(path: str | Path) -> dict[str, Any]:
    """S6."""
    return read_json(Path(path).read_bytes())


def checked_config(config: dict[str, Any]) -> dict[str, Any]:
    """The configuration, if it is one; ValueError with the first thing that is not."""
    # What these keys may hold.
    for key, usual, allowed in (("rng_algorithm", "PCG64", ("PCG64",)), ("conveyor_axis", "horizontal", ("horizontal", "vertical")), ("forward_direction", "positive", ("positive", "negative"))):
        if str(config.get(key, usual)).casefold() not in {a.casefold() for a in allowed}:
            raise ValueError(f"{key} must be {' or '.join(allowed)}")
    for modality, known in CASES.items():
        own = lambda name, usual=None, m=modality.lower(): int(config[f"{m}_{name}"] if usual is None else config.get(f"{m}_{name}", usual))
        quotas = config[f"{modality.lower()}_failure_case_quotas"]
        unknown = sorted(set(quotas) - set(known))
        if unknown:
            raise ValueError(f"{modality} unknown failure cases: {unknown}")
        target, fail, test, test_fail = own("target"), own("augmented_target"), own("test_target", 0), own("test_fail_target", 0)
        if sum(map(int, quotas.values())) != fail:
            raise ValueError(f"{modality} failure case quotas do not sum to {fail}")
        checked_quotas([(k, int(v)) for k, v in quotas.items()], list(known), fail)
        if not (0 <= test_fail <= fail and 0 <= test - test_fail <= target - fail):
            raise ValueError(f"{modality} test PASS/FAIL targets are impossible")
    return config


def case_set(value: str) -> set[str]:
    """The cases of a list with commas; ValueError for names that are none."""
    named = {x.strip() for x in value.split(",")} - {""}
    unknown = sorted(named - {c for cases in CASES.values() for c in cases})
    if unknown:
        raise ValueError(f"Unknown failure case: {', '.join(unknown)}")
    return named
