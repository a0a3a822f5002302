from __future__ import annotations


def plain(slot):
    """(type letter, value) of a slot struct."""
    found = [(name, value) for name, value in slot.asDict().items() if value is not None]
    assert len(found) <= 1
    return found[0] if found else None


def point(row):
    return row["measurement"], dict(row["tags"]), {k: plain(v) for k, v in row["fields"].items()}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
