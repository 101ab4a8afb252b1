"""All queries of the suite."""

from __future__ import annotations

from meterline.suite import business, checks, rows, runs
from meterline.suite.frames import Entry


def all_entries() -> dict[str, Entry]:
    return {**rows.ENTRIES, **business.ENTRIES, **checks.ENTRIES, **runs.ENTRIES}
