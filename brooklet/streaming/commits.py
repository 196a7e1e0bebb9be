"""What a keyed table consists of, version by version, as small files that are created once and never changed."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from .files import children, claim, read_text, remove

Position = tuple[int, int]


@dataclass(frozen=True)
class Batch:
    """A micro-batch in the log: the attempt at it that counts, where its rows are, and what they hold."""

    run: int
    number: int
    writer: str
    attempt: str
    folder: str
    rows: int
    rejected: int
    low: int | None = None
    high: int | None = None

    @property
    def position(self) -> Position:
        return self.run, self.number


@dataclass(frozen=True)
class Piece:
    """A folder of a snapshot: one month and bucket, with the bounds of the range column in microseconds."""

    snapshot: str
    month: str
    bucket: int
    rows: int
    low: int | None = None
    high: int | None = None

    @property
    def place(self) -> tuple[str, int]:
        return self.month, self.bucket


@dataclass(frozen=True)
class Commit:
    """A version of a table: layers of pieces from old to new, then the batches of the log.

    ``folder`` is where the next batch goes. ``run`` and ``writer`` are those of the newest batch ever
    written, ``rejects`` the folders of rejected rows whose batches have been folded, and
    ``written`` and ``rejected`` the rows of all batches ever written.
    """

    version: int = -1
    layers: tuple[tuple[Piece, ...], ...] = ()
    batches: tuple[Batch, ...] = ()
    folder: str = ""
    run: int = -1
    writer: str = ""
    rejects: tuple[str, ...] = ()
    written: int = 0
    rejected: int = 0

    def folders(self) -> set[str]:
        """All data folders that this version names, below the table's path."""
        named = {f"log/folder={b.folder}" for b in self.batches} | {f"log/folder={self.folder}"}
        named |= {f"snapshot/snapshot={p.snapshot}" for layer in self.layers for p in layer}
        return named | {f"rejects/{r}" for r in self.rejects}

    def to_json(self) -> str:
        return json.dumps(asdict(self), separators=(",", ":"))

    @staticmethod
    def from_json(text: str) -> Commit:
        state = json.loads(text)
        state["layers"] = tuple(tuple(Piece(**p) for p in layer) for layer in state["layers"])
        state["batches"] = tuple(Batch(**b) for b in state["batches"])
        state["rejects"] = tuple(state["rejects"])
        return Commit(**state)


@dataclass
class CommitLog:
    """The versions of one table. A change is tried again on top of one that came first."""

    spark: SparkSession
    path: str
    _held: Commit = field(default_factory=Commit)

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:012d}.json"

    def versions(self) -> list[int]:
        names = children(self.spark, self.path) or []
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def at(self, version: int) -> Commit:
        if version < 0:
            return Commit()
        if self._held.version != version:
            self._held = Commit.from_json(read_text(self.spark, self._file(version)))
        return self._held

    def current(self) -> Commit:
        """The newest version: one folder is listed and one file is read."""
        versions = self.versions()
        return self.at(versions[-1]) if versions else Commit()

    def change(self, made: Callable[[Commit], Commit]) -> Commit:
        while True:
            before = self.current()
            after = made(before)
            if after == before:
                return before
            after = replace(after, version=before.version + 1)
            if claim(self.spark, self._file(after.version), after.to_json()):
                return after

    def forget(self, keep: int) -> list[Commit]:
        """Removes all versions but the newest ``keep``; gives those that stay."""
        versions = self.versions()
        for version in versions[:-keep]:
            remove(self.spark, self._file(version))
        return [self.at(version) for version in versions[-keep:]]
