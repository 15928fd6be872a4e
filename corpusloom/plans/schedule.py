"""When the daily job runs. One at a time; runs that were missed become one, and a run that is too late waits for the next day."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable

log = logging.getLogger(__name__)


def last_slot(now: dt.datetime, hour: int, minute: int) -> dt.datetime:
    """The latest time of day at or before now."""
    slot = now.replace(hour=hour, minute=minute, second=0, microsecond=0)
    return slot if slot <= now else slot - dt.timedelta(days=1)


def is_due(now: dt.datetime, last_run: dt.datetime | None, hour: int, minute: int, grace: dt.timedelta = dt.timedelta(hours=1)) -> bool:
    """Is there a slot since the last run that is not older than the grace? Several missed slots are one."""
    slot = last_slot(now, hour, minute)
    return now - slot <= grace and (last_run is None or last_run < slot)


def run_daily(job: Callable[[], object], hour: int, minute: int, now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc), sleep: Callable[[float], None] = time.sleep, rounds: int | None = None, check_s: float = 30.0) -> int:
    """Look every check_s seconds whether the job is due; rounds: how often, None for ever. Returns the number of runs; one that raises is logged."""
    runs, last, k = 0, now(), 0
    while rounds is None or k < rounds:
        k += 1
        if is_due(started := now(), last, hour, minute):
            last, runs = started, runs + 1
            try:
                job()
            except Exception:  # the next day is another run
                log.exception("the scheduled run failed")
        sleep(check_s)
    return runs
