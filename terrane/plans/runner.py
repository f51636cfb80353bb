"""Running stages in order, with results kept as tables, and audits of what was run."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrane.session import exists, listing, write_text
from terrane.sources.pages import input_signature

Stage = Callable[[SparkSession, dict[str, DataFrame]], DataFrame]


def _code(f: Callable) -> str:
    """The code of a stage, so that a changed stage runs again."""
    code = getattr(f, "__code__", None)
    return f"{code.co_code.hex()}{code.co_consts!r}{code.co_names!r}" if code and not any(hasattr(c, "co_code") for c in code.co_consts) else getattr(f, "__qualname__", repr(type(f)))


def run_stages(
    spark: SparkSession, stages: list[tuple[str, Stage]], root: str, params: dict[str, object] | None = None, dry: bool = False, inputs: list[str] | None = None
) -> dict[str, object]:
    """Each stage is a function of the results before it. A stage whose table exists for the same parameters, the same code
    and the same input files (path, size and time of change of ``inputs``) is skipped; a summary with times and row counts
    is written beside the tables. ``root`` may lie on any file system Spark can reach."""
    files = [listing(spark, p) for p in inputs or []]
    key = input_signature(params=params or {}, stages=[(n, _code(f)) for n, f in stages], inputs=files)[:12]
    done: dict[str, DataFrame] = {}
    summary: dict[str, object] = {"signature": key, "stages": []}
    for name, f in stages:
        path, began = f"{root}/{key}/{name}", time.time()
        state = "skipped" if exists(spark, f"{path}/_SUCCESS") else "dry" if dry else "run"
        if state == "run":
            f(spark, done).write.mode("overwrite").parquet(path)
        if state != "dry":
            done[name] = spark.read.parquet(path)
        summary["stages"].append({"name": name, "state": state, "seconds": round(time.time() - began, 3), "rows": done[name].count() if name in done else None})
    if not dry:
        write_text(spark, f"{root}/{key}/summary.json", json.dumps(summary, indent=1))
    return summary


def extrapolate(seconds: float, rows: int, all_rows: int, fixed: float = 0.0) -> float:
    """Linear estimate of the time for all rows from a part of them."""
    return fixed + (seconds - fixed) * all_rows / max(rows, 1)


def forbidden_tokens(text: str, tokens: list[str]) -> list[str]:
    """Tokens that must not occur in a configuration or feature list."""
    return sorted(t for t in tokens if t.lower() in text.lower())
