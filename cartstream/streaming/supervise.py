"""Run several streams side by side; one that fails is restarted alone."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


class StreamsFailed(RuntimeError):
    """Some streams failed more often than allowed."""


def supervise(
    starters: Mapping[str, Callable[[], StreamingQuery]],
    restarts: int = 3,
    poll_seconds: float = 5.0,
    fail_fast: bool = False,
) -> None:
    """Start every stream and wait until none is left.

    A stream that fails continues from its checkpoint, up to `restarts` times
    without a batch done in between. The rest keep running meanwhile, and also
    when it is given up, unless `fail_fast` stops them all then. A stream whose
    table is not there yet waits, as long as another one may still fill it.
    """
    running: dict[str, StreamingQuery | None] = dict.fromkeys(starters)
    failures = dict.fromkeys(starters, 0)
    given_up: dict[str, str] = {}

    def failed(name: str, error: Exception) -> None:
        running[name] = None
        failures[name] += 1
        log.warning("stream %s failed (%d): %s", name, failures[name], error)
        if failures[name] > restarts:
            del running[name]
            given_up[name] = str(error).splitlines()[0]

    while running:
        for name in list(running):
            query = running[name]
            if query is None:
                try:
                    running[name] = starters[name]()
                except PySparkException as error:
                    others = any(q is not None and q.isActive for q in running.values())
                    if others and error.getCondition() == "PATH_NOT_FOUND":
                        log.info("stream %s waits for its table", name)
                    else:
                        failed(name, error)
                continue
            if query.lastProgress and query.lastProgress["numInputRows"]:
                failures[name] = 0
            if not query.isActive:
                error = query.exception()
                if error is None:
                    del running[name]
                else:
                    failed(name, error)
        if given_up and fail_fast:
            for query in filter(None, running.values()):
                query.stop()
            break
        if running:
            time.sleep(poll_seconds)

    if given_up:
        raise StreamsFailed("; ".join(f"{name}: {why}" for name, why in given_up.items()))
