"""The user's own command per item: the engine's one hook for foreign programs."""

from __future__ import annotations

import shlex
import subprocess
import sys
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a command's output that are kept.
LOG_CHARS = 20_000


def fill_command(template: str, values: dict[str, str]) -> list[str]:
    """The template as arguments with every {name} filled in. Values are never split or read by a shell."""
    out = []
    for part in shlex.split(template):
        for name, value in values.items():
            part = part.replace("{" + name + "}", value)
        out.append(part)
    if not out:
        raise ValueError("the command is empty")
    return out


def run_command(items: DataFrame, template: str, key: str, names: list[str], timeout: float | None = None) -> DataFrame:
    """key, status, return_code, stdout, stderr, error, started_at, finished_at of the command run once per row of items.

    A command that fails, is missing or takes too long gives a row with `failed`; the job goes on. Tasks may be repeated after a
    loss of executors, so commands have to be safe to run twice.
    """
    kind = dict(items.dtypes)[key]
    fill_command(template, {})

    def one(row: dict) -> dict:
        now = lambda: datetime.now(timezone.utc).isoformat(timespec="seconds")
        out = {key: row[key], "return_code": None, "stdout": "", "stderr": "", "error": None, "started_at": now()}
        try:
            done = subprocess.run(fill_command(template, {n: str(row[n]) for n in names}), capture_output=True, timeout=timeout, check=False)
            out |= {"return_code": done.returncode, "stdout": done.stdout.decode(errors="replace")[-LOG_CHARS:], "stderr": done.stderr.decode(errors="replace")[-LOG_CHARS:]}
        except (OSError, subprocess.TimeoutExpired) as e:
            out["error"] = str(e)
        return out | {"status": "success" if out["return_code"] == 0 else "failed", "finished_at": now()}

    columns = [key, "status", "return_code", "stdout", "stderr", "error", "started_at", "finished_at"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            frame = pd.DataFrame([one(r) for r in pdf.to_dict("records")], columns=columns)
            yield frame.astype({"return_code": "Int32"})

    return items.select(key, *[n for n in names if n != key]).mapInPandas(
        run, f"{key} {kind}, status string, return_code int, stdout string, stderr string, error string, started_at string, finished_at string"
    )
