"""Values an operator may need besides its rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """``now`` pins the processing time (tests, replays); ``attributes`` are the
    job-level values every expression can read."""

    now: datetime | None = None
    op_id: str = "op"
    op_name: str = "operator"
    attributes: dict[str, str] = field(default_factory=dict)

    def now_column(self) -> Column:
        if self.now is None:
            return F.current_timestamp()
        return F.lit(self.now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
