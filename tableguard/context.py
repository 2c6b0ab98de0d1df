"""Run context: the scalars every check, load and report is stamped with.

A run is identified by ``dq_key`` and grouped by ``run_hour`` (the wall-clock
hour the run belongs to).  ``as_of`` is the business date the run compares
against; it replaces the warehouse's ``current_date`` so that back-fills and
tests are reproducible.  ``now`` is captured once per run and used for every
start/end/audit timestamp, so a whole suite shares one instant.
"""

from __future__ import annotations

import datetime as _dt
import getpass
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hour(ts: _dt.datetime) -> _dt.datetime:
    return ts.replace(minute=0, second=0, microsecond=0)


@dataclass(frozen=True)
class RunContext:
    run_hour: _dt.datetime
    now: _dt.datetime
    dq_key: int
    as_of: _dt.date
    env: str = "DEV"
    db_user: str = ""
    unix_user: str = ""

    @classmethod
    def create(
        cls,
        run_hour: _dt.datetime | str | None = None,
        *,
        as_of: _dt.date | str | None = None,
        now: _dt.datetime | str | None = None,
        dq_key: int | None = None,
        env: str = "DEV",
        db_user: str = "",
        unix_user: str | None = None,
    ) -> "RunContext":
        """Build a context; every omitted field defaults from the clock.

        ``run_hour`` is truncated to the hour, ``as_of`` defaults to its date and
        ``dq_key`` to the epoch seconds of ``now``.
        """
        if isinstance(now, str):
            now = _dt.datetime.fromisoformat(now)
        now = now or _dt.datetime.now().replace(microsecond=0)
        if isinstance(run_hour, str):
            run_hour = _dt.datetime.fromisoformat(run_hour)
        run_hour = _hour(run_hour or now)
        if isinstance(as_of, str):
            as_of = _dt.date.fromisoformat(as_of)
        as_of = as_of or run_hour.date()
        if dq_key is None:
            dq_key = int(now.replace(tzinfo=_dt.timezone.utc).timestamp())
        if unix_user is None:
            try:
                unix_user = getpass.getuser()
            except Exception:  # no login name in some containers
                unix_user = ""
        return cls(run_hour=run_hour, now=now, dq_key=dq_key, as_of=as_of,
                   env=env, db_user=db_user, unix_user=unix_user)

    def with_(self, **changes) -> "RunContext":
        return replace(self, **changes)

    # -- literal columns -------------------------------------------------
    # TIMESTAMP_NTZ literals are built from text so that neither the Python
    # nor the session time zone shifts the wall-clock value.
    def run_hour_col(self) -> Column:
        return F.lit(self.run_hour.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def now_col(self) -> Column:
        return F.lit(self.now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def as_of_col(self) -> Column:
        return F.lit(self.as_of)

    def partition_values(self) -> dict[str, str]:
        """The four load partition strings for this run (zero padded)."""
        h = self.run_hour
        return {
            "dl_partition_year": f"{h.year:04d}",
            "dl_partition_month": f"{h.month:02d}",
            "dl_partition_day": f"{h.day:02d}",
            "dl_partition_hour": f"{h.hour:02d}",
        }
