"""Static tables that a running stream sees as they are now: one version of each per micro-batch.

A static frame that is joined to a stream keeps the files it was planned with until the query starts
anew. Inside ``foreachBatch`` a keyed table can be read afresh instead. Which version a micro-batch
reads, and what its clock says, is noted beside the query's checkpoint before it is used, so a
micro-batch that is tried again after a failure, in this process or the next one, gives the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from .files import claim, read_text
from .upsert import UpsertTable

Clock = Callable[[int], datetime]


@dataclass(frozen=True)
class Moment:
    """What a micro-batch was first tried with: its time, and the rows of the live tables by name."""

    clock: datetime
    tables: Mapping[str, DataFrame]


def moment_of(
    spark: SparkSession,
    checkpoint: str,
    batch_id: int,
    tables: Mapping[str, UpsertTable],
    clock: Clock | None = None,
) -> Moment:
    """The moment that belongs to this micro-batch; ``clock`` gives the time of one by its number.

    The tables' clean-up must keep as many versions as come while one micro-batch is tried.
    """
    note = f"{checkpoint.rstrip('/')}/live/{batch_id:012d}.json"
    now = datetime.now() if clock is None else clock(batch_id)
    said = {"clock": now.isoformat(), "versions": {name: table.current_commit().version for name, table in tables.items()}}
    if not claim(spark, note, json.dumps(said)):
        said = json.loads(read_text(spark, note))
    rows = {name: table.read(version=said["versions"][name]) for name, table in tables.items()}
    return Moment(datetime.fromisoformat(said["clock"]), rows)
