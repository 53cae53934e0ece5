"""Parameter bounds, which are part of each served query's contract."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable


def bounds(**limits: tuple[float, float]) -> Callable:
    """Refuse calls whose named parameters lie outside the given ends, both allowed.

    The unchecked plan stays reachable through ``inspect.unwrap``.
    """

    def guard(plan: Callable) -> Callable:
        signature = inspect.signature(plan)

        @functools.wraps(plan)
        def checked(*args, **kwargs):
            call = signature.bind(*args, **kwargs)
            call.apply_defaults()
            for name, (low, high) in limits.items():
                value = call.arguments[name]
                if not low <= value <= high:
                    raise ValueError(f"{name} must be between {low} and {high}, got {value}")
            return plan(*args, **kwargs)

        return checked

    return guard
