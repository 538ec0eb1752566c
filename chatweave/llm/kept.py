"""What a Python worker keeps between tasks: that of one operator, as workers serve all stages in turn."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_KEPT: dict[tuple, Any] = {}


def keep(key: tuple, make: Callable[[], Any]) -> Any:
    """The value of ``key``, made once, in place of what was kept before."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Called by operators that keep nothing, so that they do not run beside what another one left."""
    _KEPT.clear()
