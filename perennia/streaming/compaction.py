"""Folders of batches merged into fewer, so that the state of a stream of any age is read from few files.

`stream_state` and `stream_partials` leave a folder for each batch. `compact` merges them by size tiers: `fan` neighbours
of one tier become one run of the next, so n batches are read as at most `fan` folders for each of log(n) tiers, and a
row is rewritten once a tier. Merged aggregates may be merged again, so a run may overlap what it was made of.

Nothing is replaced in place. Runs are folders of their own, and a manifest names those that make up a version; writing it
is the commit. A compaction that fails leaves the version before it, and a reader keeps the folders it has listed
until `remove_merged` is called. The last batch is never merged, since it may be under way, and a stream that starts
again may write it again. A folder belongs to one checkpoint: a stream that counts its batches anew needs a new one.

    folder/batch=7                              a batch, as the stream wrote it
    folder/_merged/manifest/00000003.json       the runs of version 3, and the last batch in them
    folder/_merged/run/0-63-<id>                what batches 0 to 63 make together
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import SparkSession

from perennia.operators.fold import merge_partials
from perennia.plans.store import _commit, _versions

#: Neighbours of one tier that are merged into one of the next.
FAN = 8
KEYS = ("type", "key")
_MERGED = "_merged"


class Run(NamedTuple):
    """Batches `first` to `last`, in the folders `parts`: one, or several that are still to be merged."""

    tier: int
    first: int
    last: int
    parts: tuple[str, ...]


class Runs(NamedTuple):
    version: int = 0
    runs: tuple[Run, ...] = ()

    @property
    def covered(self) -> int:
        """The last batch that a run holds."""
        return self.runs[-1].last if self.runs else -1


def tiers(runs: Iterable[Run], fan: int = FAN) -> list[Run]:
    """Neighbouring runs put together, wherever `fan` of one tier meet; in the order of their batches."""
    stack: list[Run] = []
    for run in runs:
        stack.append(run)
        while len(stack) >= fan and len({r.tier for r in stack[-fan:]}) == 1:
            group = stack[-fan:]
            parts = tuple(p for r in group for p in r.parts)
            stack[-fan:] = [Run(group[0].tier + 1, group[0].first, group[-1].last, parts)]
    return stack


def _hadoop(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _batches(spark: SparkSession, folder: str) -> list[int]:
    path, files = _hadoop(spark, folder)
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def read_runs(spark: SparkSession, folder: str, version: int | None = None) -> Runs:
    """The given version, or the last one written to its end; no runs for a folder that was never compacted."""
    base = f"{folder}/{_MERGED}"
    for v in reversed(_versions(spark, base)) if version is None else [version]:
        text = "".join(r.value for r in spark.read.text(f"{base}/manifest/{v:08d}.json", wholetext=True).collect())
        try:
            found = json.loads(text)
        except ValueError:
            continue  # a compaction was stopped while it committed
        return Runs(v, tuple(Run(r[0], r[1], r[2], tuple(r[3])) for r in found["runs"]))
    return Runs()


def live_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders that hold the state: the runs of the last version, and the batches after them."""
    # Batches first: those that a compaction takes meanwhile are then read twice, which does no harm, never not at all.
    batches = _batches(spark, folder)
    current = read_runs(spark, folder)
    names = [p for run in current.runs for p in run.parts] + [f"batch={b}" for b in batches if b > current.covered]
    return [f"{folder}/{name}" for name in names]


def compact(spark: SparkSession, folder: str, fan: int = FAN) -> Runs:
    """Merge what has gathered since the last compaction; returns the version that now holds.

    Only folders that become part of a larger run are read. One compaction of a folder may run at a time, beside any
    readers and the stream itself: of two, one fails at its commit.
    """
    if fan < 2:
        raise ValueError("fan must be at least 2")
    current = read_runs(spark, folder)
    fresh = [Run(0, b, b, (f"batch={b}",)) for b in _batches(spark, folder)[:-1] if b > current.covered]
    planned = [run for run in tiers([*current.runs, *fresh], fan) if run.tier > 0]
    if planned == list(current.runs):
        return current
    runs = []
    for run in planned:
        if len(run.parts) > 1:
            name = f"{_MERGED}/run/{run.first}-{run.last}-{uuid.uuid4().hex}"
            parts = spark.read.parquet(*[f"{folder}/{p}" for p in run.parts])
            # Files of the advised size, as many as the rows need, however many partitions the merge has.
            merge_partials(parts, *KEYS).hint("rebalance").write.parquet(f"{folder}/{name}")
            run = run._replace(parts=(name,))
        runs.append(run)
    known = _versions(spark, f"{folder}/{_MERGED}")
    new = Runs(known[-1] + 1 if known else 1, tuple(runs))
    _commit(spark, f"{folder}/{_MERGED}", new)
    return new


def remove_merged(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the last `keep` versions reads; returns their names.

    For when readers of older versions are done; a compaction must not run meanwhile, as its runs are in no version yet.
    """
    if keep < 1:
        raise ValueError("the last version cannot be removed")
    found = [read_runs(spark, folder, v) for v in _versions(spark, f"{folder}/{_MERGED}")]
    # A version whose commit was stopped half-way names nothing, and is none of the last ones.
    kept = [runs for runs in found if runs.version][-keep:]
    if not kept:
        return []
    covered = min(runs.covered for runs in kept)
    named = {p for runs in kept for run in runs.runs for p in run.parts}
    path, files = _hadoop(spark, f"{folder}/{_MERGED}/run")
    old = [f"{_MERGED}/run/{s.getPath().getName()}" for s in files.listStatus(path)]
    gone = [f"batch={b}" for b in _batches(spark, folder) if b <= covered] + [name for name in old if name not in named]
    for name in gone:
        files.delete(_hadoop(spark, f"{folder}/{name}")[0], True)
    return gone
