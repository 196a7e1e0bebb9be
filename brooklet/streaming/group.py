"""A group of named streaming queries that are started, drained and restarted together."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .sinks import Sink, checkpoint_path

log = logging.getLogger(__name__)

POLL_SECONDS = 0.5


@dataclass(frozen=True)
class Output:
    """A sink, and how to build the frame that it writes.

    The frame is built anew at every start, so a restart sees the static tables as they are then.
    """

    build: Callable[[], DataFrame]
    sink: Sink


class NamedQuery:
    """One output as a running query."""

    def __init__(self, output: Output, checkpoint_base: str, available_now: bool) -> None:
        self.name = output.sink.name
        self._output = output
        self._checkpoint = checkpoint_path(checkpoint_base, self.name)
        self._available_now = available_now
        self.query: StreamingQuery | None = None

    def start(self) -> None:
        self._start(self._available_now)

    def _start(self, available_now: bool) -> None:
        writer = self._output.sink.writer(self._output.build(), self._checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        self.query = writer.queryName(self.name).start()

    def catch_up(self) -> None:
        """Starts a run that ends with the input that is there now."""
        self._start(True)

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
            self.query = None

    def restart(self) -> None:
        self.stop()
        self.start()

    def drain(self) -> None:
        if self.query is None:
            return
        if self._available_now:
            self.query.awaitTermination()
        else:
            self.query.processAllAvailable()


class QueryGroup:
    """Outputs in starting order. ``before_start`` steps run first, once per start of the group.

    With ``available_now`` every query ends once it has read what was there at its start.
    """

    def __init__(
        self,
        spark: SparkSession,
        outputs: list[Output],
        checkpoint_base: str,
        before_start: list[Callable[[], None]] | None = None,
        available_now: bool = False,
    ) -> None:
        self.spark = spark
        self._before_start = before_start or []
        self.queries = {
            o.sink.name: NamedQuery(o, checkpoint_base, available_now) for o in outputs
        }
        if len(self.queries) != len(outputs):
            raise ValueError("two outputs have the same name")

    def add(self, output: Output, checkpoint_base: str, available_now: bool = False) -> None:
        """One more query, started after the others."""
        if output.sink.name in self.queries:
            raise ValueError("two outputs have the same name")
        self.queries[output.sink.name] = NamedQuery(output, checkpoint_base, available_now)

    def start(self) -> None:
        for step in self._before_start:
            step()
        for query in self.queries.values():
            query.start()

    def catch_up_and_start(self) -> None:
        """Works off what is there in a run that ends, and then follows what comes."""
        for step in self._before_start:
            step()
        for query in self.queries.values():
            query.catch_up()
        for query in self.queries.values():
            query.query.awaitTermination()
        for query in self.queries.values():
            query.start()

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()

    def drain(self) -> None:
        """Waits until all input that is there has been processed."""
        for query in self.queries.values():
            query.drain()

    def restart(self, name: str) -> None:
        self.queries[name].restart()

    def try_restart(self, name: str) -> bool:
        """Restarts a query; an error is logged and the group goes on."""
        try:
            self.restart(name)
            return True
        except Exception:
            log.warning("could not restart query %s", name, exc_info=True)
            return False

    def await_termination(
        self, seconds: float | None = None, restart_every: Mapping[str, float] | None = None
    ) -> None:
        """Waits until a query ends or the time is over; restarts queries when they are due."""
        periods = dict(restart_every or {})
        unknown = set(periods) - set(self.queries)
        if unknown:
            raise ValueError(f"no queries {sorted(unknown)}")
        started = time.monotonic()
        end = None if seconds is None else started + seconds
        due = {name: started + period for name, period in periods.items()}
        while not self._ended():
            now = time.monotonic()
            if end is not None and now >= end:
                return
            for name in [n for n, at in due.items() if at <= now]:
                self.try_restart(name)
                due[name] = now + periods[name]
            stops = [*due.values(), now + POLL_SECONDS, *([] if end is None else [end])]
            time.sleep(max(0.0, min(stops) - now))

    def _ended(self) -> bool:
        """True once a query has ended by itself; its error, if any, is raised."""
        ended = [q.query for q in self.queries.values() if q.query and not q.query.isActive]
        for query in ended:
            problem = query.exception()
            if problem is not None:
                raise problem
        return bool(ended)
