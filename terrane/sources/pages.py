"""Paged feature services: windows, retries, a resumable page store, and a Spark source over windows.

Each window is one task. A page that is already stored is not fetched again; finished windows are
left out by the manifest. The fetch function is given by the caller (there is no network in tests)."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.session import exists

Fetch = Callable[[tuple[float, float, float, float], int, int], tuple[int, dict[str, str], str]]


def input_signature(**parts: object) -> str:
    """Hash of all inputs of a download; a changed input starts anew."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def fetch_page(fetch: Fetch, box: tuple[float, float, float, float], start: int, size: int, tries: int = 6, sleep: Callable[[float], None] = time.sleep) -> dict:
    """One page; waits as told on 429, doubles the wait on 5xx and unreadable answers."""
    wait = 1.0
    for attempt in range(tries):
        status, headers, body = fetch(box, start, size)
        if status == 200:
            try:
                return json.loads(body)
            except ValueError:
                pass
        elif status == 429:
            wait = float(headers.get("Retry-After", wait))
        elif status < 500:
            raise RuntimeError(f"page at {start} refused: {status}")
        if attempt < tries - 1:
            sleep(wait)
            wait = min(wait * 2, 60.0)
    raise RuntimeError(f"page at {start} failed {tries} times")


def fetch_window(fetch: Fetch, store: str, window: int, box: tuple[float, float, float, float], size: int, most_pages: int = 10_000) -> int:
    """Store all pages of a window as files; gives the number of features."""
    total = 0
    for page in range(most_pages):
        path = Path(store) / f"window_{window:06d}_page_{page:05d}.geojson"
        if path.exists():
            data = json.loads(path.read_text())
        else:
            data = fetch_page(fetch, box, page * size, size)
            path.parent.mkdir(parents=True, exist_ok=True)
            part = path.with_suffix(".part")
            part.write_text(json.dumps(data))
            part.rename(path)
        n = len(data.get("features", []))
        total += n
        if n < size:
            return total
    raise RuntimeError(f"window {window}: more than {most_pages} pages; nothing is recorded as finished")


def download(spark: SparkSession, windows: DataFrame, fetch: Fetch, store: str, size: int, signature: str) -> DataFrame:
    """(window, features) of the windows (window, xmin, ymin, xmax, ymax) not yet in the manifest of this signature.

    ``store`` is a folder all executors share."""
    manifest = f"{store}/manifest_{signature[:16]}"
    todo = windows
    if exists(spark, manifest):
        todo = windows.join(spark.read.schema("window int, features long").parquet(manifest), "window", "left_anti")

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = [(int(r.window), fetch_window(fetch, store, int(r.window), (r.xmin, r.ymin, r.xmax, r.ymax), size)) for r in batch.itertuples()]
            yield pd.DataFrame(rows, columns=["window", "features"])

    todo.select("window", "xmin", "ymin", "xmax", "ymax").mapInPandas(run, "window int, features long").write.mode("append").parquet(manifest)
    return spark.read.schema("window int, features long").parquet(manifest)


def missing_windows(targets: DataFrame, ratio: str, least: float) -> DataFrame:
    """Boxes of targets that are not covered enough, for the next round of a top-up download."""
    return targets.where(F.col(ratio) < least).select("xmin", "ymin", "xmax", "ymax").distinct()
