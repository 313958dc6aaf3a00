"""Objects that stay in a Python worker from one task to the next."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable


def kept(key: tuple, make: Callable):
    """What ``make`` returns, made once per worker process.

    Task functions travel with the job and bring fresh globals to every task, so the objects hang on
    a module of the process itself.
    """
    module = sys.modules.setdefault("tomelight_worker", types.ModuleType("tomelight_worker"))
    if key not in module.__dict__:
        module.__dict__[key] = make()
    return module.__dict__[key]
