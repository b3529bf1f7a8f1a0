import os
import random

import pytest
from helpers import write_array
from test_random import random_events
from test_streaming import rows

from perennia import fold, read_events, stream_events
from perennia.streaming import compaction, jobs
from perennia.streaming.compaction import Run, compact, live_folders, read_runs, remove_merged, tiers


def _arrive(folder, batches, seed=5, size=40):
    """Files that arrive one by one, in no order of the times in them."""
    events = random_events(seed, batches * size)
    for i in range(batches):
        name = write_array(folder, events[i * size : (i + 1) * size], f"part{seed}-{i:02}.txt")
        os.utime(name, (10**9 + seed * 100 + i, 10**9 + seed * 100 + i))


def _stream(spark, folder, start=jobs.stream_partials, **more):
    out = folder + "-out"
    start(stream_events(spark, folder, 1), out + "/state", out + "/checkpoint", **more).awaitTermination()
    return out + "/state"


def test_few_runs_hold_any_number_of_batches():
    rng = random.Random(1)
    for fan in (2, 3, 8):
        runs, rewritten = [], 0
        for first in range(0, 1000, 10):
            batches = [Run(0, b, b, (f"batch={b}",)) for b in range(first, first + 10)]
            planned = tiers([*runs, *batches], fan)
            rewritten += sum(r.last - r.first + 1 for r in planned if len(r.parts) > 1)
            # Every batch is in just one run, in order.
            assert [b for r in planned for b in range(r.first, r.last + 1)] == list(range(first + 10))
            # A run is merged from neighbours at once, whatever tiers it passes.
            assert all(sum(r.tier == t for r in planned) < fan for t in range(11))
            runs = [r._replace(parts=(f"run{rng.random()}",)) if len(r.parts) > 1 else r for r in planned]
        depth = next(t for t in range(1, 11) if fan**t >= 1000)
        assert len(runs) <= fan * depth and rewritten <= 1000 * depth
    assert tiers([]) == []


@pytest.mark.parametrize("start", [jobs.stream_state, jobs.stream_partials])
def test_compacted_state_is_the_batch_state(spark, folder, start):
    _arrive(folder, 6)
    state = _stream(spark, folder, start)
    want = rows(fold(read_events(spark, folder)))
    assert read_runs(spark, state).runs == () and rows(jobs.read_state(spark, state)) == want
    first = compact(spark, state, fan=2)
    # Five batches may be merged: one run of four, and one that waits.
    assert [(r.tier, r.first, r.last) for r in first.runs] == [(2, 0, 3)]
    assert [os.path.basename(f).split("-")[0] for f in live_folders(spark, state)] == ["0", "batch=4", "batch=5"]
    assert rows(jobs.read_state(spark, state)) == want
    assert compact(spark, state, fan=2) == first
    assert sorted(remove_merged(spark, state, keep=1)) == [f"batch={b}" for b in range(4)]
    assert rows(jobs.read_state(spark, state)) == want
    # The stream goes on from its checkpoint, and the next merge reaches what it adds.
    _arrive(folder, 3, seed=6)
    _stream(spark, folder, start)
    want = rows(fold(read_events(spark, folder)))
    assert rows(jobs.read_state(spark, state)) == want
    assert [(r.tier, r.first, r.last) for r in compact(spark, state, fan=2).runs] == [(3, 0, 7)]
    assert rows(jobs.read_state(spark, state)) == want
    assert remove_merged(spark, state) == [] and len(remove_merged(spark, state, keep=1)) == 5
    assert rows(jobs.read_state(spark, state)) == want


def test_a_stream_compacts_as_it_goes(spark, folder, monkeypatch):
    monkeypatch.setattr(compaction.compact, "__defaults__", (2,))
    _arrive(folder, 5)
    state = _stream(spark, folder, compact_every=2)
    assert read_runs(spark, state).covered == 1
    assert rows(jobs.read_state(spark, state)) == rows(fold(read_events(spark, folder)))


def test_failed_and_repeated_work_changes_nothing(spark, folder, monkeypatch):
    _arrive(folder, 5)
    state = _stream(spark, folder)
    want = rows(fold(read_events(spark, folder)))
    reader = jobs.read_state(spark, state)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(compaction, "_commit", fails)
        with pytest.raises(OSError):
            compact(spark, state, fan=2)
    assert read_runs(spark, state).runs == () and rows(jobs.read_state(spark, state)) == want
    # A commit that was stopped half-way is passed over, and its version is not used again.
    os.makedirs(f"{state}/_merged/manifest")
    with open(f"{state}/_merged/manifest/00000001.json", "w") as file:
        file.write('{"version": 1, "ru')
    assert compact(spark, state, fan=2).version == 2
    assert rows(jobs.read_state(spark, state)) == want and rows(reader) == want
    # The last batch written again counts once; a batch beside the run it is in, too.
    spark.read.parquet(f"{state}/batch=4").write.mode("overwrite").parquet(f"{state}/again")
    spark.read.parquet(f"{state}/again").write.mode("overwrite").parquet(f"{state}/batch=4")
    assert rows(jobs.read_state(spark, state)) == want
    # What the failed compaction left goes with the merged batches; a stopped commit after the last version does no harm.
    with open(f"{state}/_merged/manifest/00000003.json", "w") as file:
        file.write('{"vers')
    gone = remove_merged(spark, state, keep=1)
    assert len(gone) == 5 and sum(name.startswith("_merged") for name in gone) == 1
    assert rows(jobs.read_state(spark, state)) == want
    with pytest.raises(ValueError):
        remove_merged(spark, state, keep=0)
    with pytest.raises(ValueError):
        compact(spark, state, fan=1)
