"""Audit columns of gold models. Both values are injectable so a run is reproducible."""
from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Audit:
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    loaded_at: str | None = None  # None -> current_timestamp() of the query


def with_audit(df: DataFrame, audit: Audit | None) -> DataFrame:
    if audit is None:
        return df
    ts = F.current_timestamp() if audit.loaded_at is None else F.lit(audit.loaded_at).cast("timestamp")
    return df.withColumns({"_loaded_at": ts, "_run_id": F.lit(audit.run_id)})
