"""The stages of a run one after the other, with a status file; publishing in waves; progress lines."""

from __future__ import annotations

import json
import logging
import shutil
import time
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from marlspark.cli import format_duration
from marlspark.plans.generate import generate
from marlspark.plans.planning import write_plan
from marlspark.plans.verify import raise_first, verify_rows
from marlspark.sources.store import atomic_write, local, pretty_json

STAGES = ("plan", "smoke", "generate", "resume", "verify", "upload")


@dataclass
class Progress:
    """A line for every so many items or seconds, at the end, and when forced; with rate and time left."""

    log: logging.Logger
    label: str
    total: int
    done: int = 0
    every: int = 100
    seconds: float = 30.0
    began: float = field(default_factory=time.monotonic)
    start: int = field(init=False)
    told: int = field(init=False)
    at: float = field(init=False)

    def __post_init__(self) -> None:
        self.start = self.told = self.done
        self.at = self.began

    def update(self, done: int, force: bool = False, now: float | None = None) -> bool:
        """Whether a line was written."""
        now = time.monotonic() if now is None else now
        if not (force or done >= self.total or done - self.told >= self.every or now - self.at >= self.seconds):
            return False
        rate = max(done - self.start, 0) / max(now - self.began, 1e-9)
        left = format_duration(max(self.total - done, 0) / rate if rate else None)
        share = 100.0 * done / self.total if self.total else 100.0
        self.log.info("%s | %s/%s (%.2f%%) | %.2f/s | %s", self.label, f"{done:,}", f"{self.total:,}", share, rate, left)
        self.told, self.at = done, now
        return True


def measured_config(config: dict[str, Any], summary: dict[str, Any]) -> dict[str, Any]:
    """The configuration with the memory that a worker of the smoke run took at most; ValueError without a measurement."""
    peak = int(summary.get("worker_peak_rss_bytes_observed") or 0)
    if peak <= 0:
        raise ValueError("smoke run measured no worker memory")
    return {**config, "worker_peak_rss_bytes": peak}


def waves(output: Path) -> list[list[Path]]:
    """Files in the order in which they go out: manifests, summaries and logs, then archives, then the trees of the modalities."""
    files = sorted(p for p in output.rglob("*") if p.is_file())
    tree = [p for p in files if p.relative_to(output).parts[0] in ("CT", "RGB")]
    archives = [p for p in files if p.suffix == ".zip" and p not in tree]
    gone = {*tree, *archives}
    return [[p for p in files if p not in gone], archives, tree]


def publish(output: str | Path, target: str | Path) -> int:
    """The files copied below target, wave by wave; the number of files."""
    out, to, n = local(output), local(target), 0
    for wave in waves(out):
        for path in wave:
            place = to / path.relative_to(out)
            place.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(path, place)
            n += 1
    return n


def run_stage(spark: SparkSession, stage: str, root: str, config: dict[str, Any], folder: str | Path, target: str | Path | None = None, smoke: int = 100) -> dict[str, Any]:
    """One stage in a folder of its run; status.json there tells the last one and how it ended."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    base = local(folder)
    plan = base / "plan" / "manifests" / "generation_plan.csv"
    status = lambda state, **more: atomic_write(base / "status.json", pretty_json({"stage": stage, "state": state, **more}))
    status("running")
    try:
        if stage == "plan":
            result = write_plan(spark, root, config, base / "plan")
        elif stage == "smoke":
            shutil.rmtree(base / "smoke", ignore_errors=True)
            result = generate(spark, root, config, plan, base / "smoke", limit=smoke, trust=True)
            atomic_write(base / "measured.json", pretty_json(measured_config(config, result)))
        elif stage in ("generate", "resume"):
            result = generate(spark, root, config, plan, base / "output", resume=stage == "resume", trust=stage == "resume")
        elif stage == "verify":
            raise_first(verify_rows(spark, str(base / "output")))
            result = {"verified": True}
        else:
            result = {"files": publish(base / "output", target or base / "published")}
    except Exception as fault:
        status("failed", error=f"{type(fault).__name__}: {fault}")
        raise
    status("done", result=json.loads(json.dumps(result, default=str)))
    return result
