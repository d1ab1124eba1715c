"""Spans around engine calls: start, stop and exception events for attached handlers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

Handler = Callable[[str, dict[str, Any], dict[str, Any]], None]
_HANDLERS: dict[str, Handler] = {}


def attach(name: str, handler: Handler) -> None:
    _HANDLERS[name] = handler


def detach(name: str) -> None:
    _HANDLERS.pop(name, None)


def emit(event: str, measured: dict[str, Any], about: dict[str, Any]) -> None:
    for handler in list(_HANDLERS.values()):
        handler(event, measured, about)


@contextmanager
def span(event: str, **about: Any) -> Iterator[dict[str, Any]]:
    """Emits ``event.start``, then ``event.stop`` with the duration, or ``event.exception`` and raises."""
    began = time.monotonic_ns()
    emit(f"{event}.start", {"system_time": time.time_ns()}, about)
    try:
        yield about
    except BaseException as e:
        emit(f"{event}.exception", {"duration": time.monotonic_ns() - began}, about | {"status": "error", "error": e})
        raise
    emit(f"{event}.stop", {"duration": time.monotonic_ns() - began}, {"status": "ok"} | about)
