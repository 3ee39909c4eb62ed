"""Objects that outlive a task."""

from __future__ import annotations

import sys
import types


def per_worker(key, make):
    """What ``make`` gives, made once and kept for the life of the Python worker, which serves many tasks.

    For read-only models and caches of bounded size; functions of this subpackage travel by value, so a
    module variable of theirs would start anew in every task.
    """
    store = sys.modules.setdefault("_fleetgauge_worker", types.ModuleType("_fleetgauge_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
