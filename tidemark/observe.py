"""What a stage did: counters gathered by the jobs themselves, and a line of JSON for the log."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger("tidemark")


def counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows, and whatever else is asked, while another action runs over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]), seen


def report(stage: str, stats: dict, started: float, push: Callable[[str, dict], None] | None = None) -> dict:
    """Logs the stage's numbers, and pushes them if there is somewhere to push to; a failing push is only logged."""
    out = stats | {"stage": stage, "seconds": round(time.time() - started, 3), "finished_at": time.time()}
    log.info(json.dumps(out, default=str))
    if push:
        try:
            push(stage, out)
        except Exception as e:  # the stage itself is done
            log.warning("couldn't push the numbers of %s: %s", stage, e)
    return out
