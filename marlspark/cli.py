"""audit-raw, plan, generate and verify from the command line."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from pathlib import Path

from marlspark.plans.config import case_set, load_config


def format_duration(seconds: float | None) -> str:
    """minutes and seconds, with hours from one hour on."""
    if seconds is None or seconds < 0:
        return "계산 중"
    minutes, rest = divmod(int(round(seconds)), 60)
    hours, minutes = divmod(minutes, 60)
    return f"{hours:02d}:{minutes:02d}:{rest:02d}" if hours else f"{minutes:02d}:{rest:02d}"


class ClosingFileHandler(logging.FileHandler):
    """A log file that is open for one record at a time."""

    def __init__(self, path: Path):
        super().__init__(path, mode="a", encoding="utf-8", delay=True)

    def emit(self, record: logging.LogRecord) -> None:
        super().emit(record)
        self.close()


def logger_of(name: str, path: Path) -> logging.Logger:
    """To the console and to a file; asked for again, the old handlers go."""
    path.parent.mkdir(parents=True, exist_ok=True)
    log = logging.getLogger(name)
    log.setLevel(logging.INFO)
    log.propagate = False
    while log.handlers:
        log.handlers[0].close()
        log.removeHandler(log.handlers[0])
    for handler in (logging.StreamHandler(sys.stdout), ClosingFileHandler(path)):
        handler.setFormatter(logging.Formatter("%(asctime)s | %(levelname)s | %(message)s", "%Y-%m-%d %H:%M:%S"))
        log.addHandler(handler)
    return log


def _cases(value: str) -> set[str]:
    try:
        return case_set(value)
    except ValueError as fault:
        raise argparse.ArgumentTypeError(str(fault)) from None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marlspark")
    commands = top.add_subparsers(dest="command", required=True)
    for name, text in (("audit-raw", "look at a raw tree, read-only"), ("plan", "scan a raw tree and freeze a plan"), ("generate", "make the data set of a plan")):
        sub = commands.add_parser(name, help=text)
        for option in ("--raw-root", "--config", "--output", *(["--plan"] if name == "generate" else [])):
            sub.add_argument(option, type=Path, required=True)
        if name != "generate":
            sub.add_argument("--reuse-scan", type=Path, help="a scan cache, or a folder that holds one")
        else:
            sub.add_argument("--limit-per-modality", type=int)
            sub.add_argument("--resume", action="store_true")
            sub.add_argument("--trust-plan", action="store_true", help="check the planned sources only, not the whole tree")
            sub.add_argument("--drop-cases", type=_cases, default=set(), metavar="CASE[,CASE...]", help="with --resume: make the samples of these cases anew")
    sub = commands.add_parser("stage", help="one stage of a whole run in a folder of its own: plan, smoke, generate, resume, verify, upload")
    sub.add_argument("stage", choices=["plan", "smoke", "generate", "resume", "verify", "upload"])
    for option in ("--raw-root", "--config", "--output"):
        sub.add_argument(option, type=Path, required=True)
    sub.add_argument("--target", type=Path, help="where upload copies the data set")
    commands.add_parser("verify", help="check a data set").add_argument("--output", type=Path, required=True)
    return top


def main(argv: list[str] | None = None, spark=None) -> dict:
    """Run a command on the session given, or on one of its own; the result is also printed as JSON."""
    args = parser().parse_args(argv)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("marlspark").getOrCreate()
    from marlspark.plans.generate import generate
    from marlspark.plans.planning import write_audit, write_plan
    from marlspark.plans.verify import raise_first, verify_rows

    out = str(args.output.resolve())
    if args.command == "verify":
        raise_first(verify_rows(spark, out))
        result: dict = {"verified": True}
    else:
        root, config = str(args.raw_root.resolve()), load_config(args.config)
        if args.command == "stage":
            from marlspark.plans.run import run_stage

            result = run_stage(spark, args.stage, root, config, out, args.target)
        elif args.command == "generate":
            result = generate(spark, root, config, args.plan.resolve(), out, args.limit_per_modality, args.resume, args.trust_plan, args.drop_cases)
        else:
            log = logger_of(f"marlspark.{args.command}", Path(out) / "logs" / ("audit.log" if args.command == "audit-raw" else "plan.log"))
            make = write_audit if args.command == "audit-raw" else write_plan
            result = make(spark, root, config, out, str(args.reuse_scan.resolve()) if args.reuse_scan else None)
            log.info("%s | %s", args.command, json.dumps(result, ensure_ascii=False))
    print(json.dumps(result, ensure_ascii=False, indent=2))
    return result


if __name__ == "__main__":
    main()
