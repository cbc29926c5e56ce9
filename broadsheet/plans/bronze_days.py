"""Bronze's batch folders merged into files by day.

Every batch owns a folder, which a replay overwrites; a stream leaves thousands. Batches
that are closed, all but the latest of each writer, move into a table beside bronze, by
day, up to a mark for each writer. Readers take the days, and the folders past the marks.
A merged batch that is played again all the same is a folder again, which hides its rows
in the days until the next merge.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.plans.snapshots import DATA, KEEP_SECONDS, Snapshot, Snapshots
from broadsheet.sources.tables import balanced

PARTITIONS = ("source_type", "bronze_date")
# In the manifest: how far each writer is merged, which merged batches are folders again,
# which batches a unit may hold, and which folders nobody needs any more, since when.
THROUGH, AGAIN, HOLDS, LEFT = "through", "again", "holds", "left"

Batch = tuple[str, int]


def batches(table: Snapshots, bronze: str) -> list[Batch]:
    """The batches that have a folder."""
    found = []
    root = table.path(bronze)
    for writer in table.fs.listStatus(root) if table.fs.exists(root) else ():
        name = writer.getPath().getName()
        if name.startswith("writer="):
            for batch in table.fs.listStatus(writer.getPath()):
                own = batch.getPath().getName()
                if own.startswith("batch_id="):
                    found.append((name.removeprefix("writer="), int(own.removeprefix("batch_id="))))
    return found


def _again(snapshot: Snapshot) -> set[Batch]:
    return {(w, b) for w, b in snapshot.state.get(AGAIN, [])}


def open_batches(table: Snapshots, bronze: str, snapshot: Snapshot) -> list[Batch]:
    """Those whose folder is read: not merged yet, or there again."""
    marks, again = snapshot.state.get(THROUGH, {}), _again(snapshot)
    return [(w, b) for w, b in batches(table, bronze) if b > marks.get(w, -1) or (w, b) in again]


def read_folders(spark: SparkSession, bronze: str, chosen: Iterable[Batch]) -> DataFrame:
    paths = [f"{bronze}/writer={w}/batch_id={b}" for w, b in chosen]
    if not paths:
        return spark.createDataFrame([], S.BRONZE)
    rows = spark.read.schema(S.BRONZE).option("basePath", bronze).parquet(*paths)
    return rows.select(*S.BRONZE.names)


def _is_one_of(chosen: Iterable[Batch]):
    """Batches by writer, so that the test is as long as there are writers with some."""
    by_writer: dict[str, list[str]] = {}
    for w, b in sorted(chosen):
        by_writer.setdefault(w, []).append(str(b))
    test = F.lit(False)
    for w, bs in by_writer.items():
        test = test | ((F.col("writer") == w) & F.col("batch_id").isin(bs))
    return test


def read(table: Snapshots, bronze: str, snapshot: Snapshot) -> DataFrame:
    """All of bronze: the days, without what is a folder again, and the open folders."""
    days = table.read(snapshot).select(*S.BRONZE.names)
    again = _again(snapshot)
    if again:
        days = days.filter(~_is_one_of(again))
    return days.unionByName(read_folders(table.spark, bronze, open_batches(table, bronze, snapshot)))


def played_again(table: Snapshots, writer: str, batch: int) -> None:
    """Note that a batch was written, if it is one that was merged before."""
    snapshot = table.current()
    if snapshot is None or batch > snapshot.state.get(THROUGH, {}).get(writer, -1):
        return

    def step(base: Snapshot) -> Snapshot:
        left = [x for x in base.state.get(LEFT, []) if (x[0], x[1]) != (writer, batch)]
        again = sorted(_again(base) | {(writer, batch)})
        state = base.state | {AGAIN: [list(x) for x in again], LEFT: left}
        return Snapshot(base.version, base.parts, base.schemas, state)

    table.change(step)


def merge(table: Snapshots, bronze: str) -> int:
    """Move the closed batches into the days; returns how many. Nothing is lost or seen
    twice whenever it stops: until the manifest is published the folders count, and from
    then on the days do."""
    base = table.current() or Snapshot()
    there, again = open_batches(table, bronze, base), _again(base)
    last: dict[str, int] = {}
    for w, b in there:
        last[w] = max(b, last.get(w, b))
    closed = [(w, b) for w, b in there if b < last[w] or (w, b) in again]
    if not closed:
        return 0
    # Of batches that were merged before, the older rows go: the units that may hold some are written anew.
    holds = base.state.get(HOLDS, {})
    may_hold = lambda folder: any(w in holds[folder] and holds[folder][w][0] <= b <= holds[folder][w][1] for w, b in again)
    stale = [u for u in base.units() if may_hold(u.folder)]
    rows = read_folders(table.spark, bronze, closed)
    ranges: dict[str, list[int]] = {}
    for w, b in [*closed, *((w, b) for u in stale for w, bs in holds[u.folder].items() for b in bs)]:
        low, high = ranges.get(w, (b, b))
        ranges[w] = [min(low, b), max(high, b)]
    if stale:
        rows = rows.unionByName(table.read(base, units=stale).select(*S.BRONZE.names).filter(~_is_one_of(again)))
    unit = table.write(balanced(rows, *PARTITIONS), "merged", base.version + 1, PARTITIONS)
    gone, since = {u.folder for u in stale}, time.time()

    def step(now: Snapshot) -> Snapshot:
        if not gone <= {u.folder for u in now.units()} or now.state.get(THROUGH) != base.state.get(THROUGH):
            raise RuntimeError(f"{table.root} was merged by another job meanwhile")
        units = [*(u for u in now.units() if u.folder not in gone), unit]
        marks = dict(now.state.get(THROUGH, {}))
        for w, b in closed:
            marks[w] = max(b, marks.get(w, b))
        held = {f: r for f, r in now.state.get(HOLDS, {}).items() if f not in gone} | {unit.folder: ranges}
        # A batch that came again since this merge began is newer than what was merged.
        later = _again(now) - again
        left = [*now.state.get(LEFT, []), *([w, b, since] for w, b in closed if (w, b) not in later)]
        state = now.state | {THROUGH: marks, HOLDS: held, LEFT: left, AGAIN: [list(x) for x in sorted(later)]}
        made = now.with_units(DATA, units, S.BRONZE)
        return Snapshot(made.version, made.parts, made.schemas, state)

    table.change(step)
    return len(closed)


def vacuum(table: Snapshots, bronze: str, keep_seconds: float = KEEP_SECONDS) -> int:
    """Delete the folders of batches that were merged more than `keep_seconds` ago, and
    what the days no longer hold; returns the number of folders and files deleted."""
    snapshot = table.current()
    if snapshot is None:
        return 0
    old = [x for x in snapshot.state.get(LEFT, []) if x[2] <= time.time() - keep_seconds]

    def step(base: Snapshot) -> Snapshot:
        state = base.state | {LEFT: [x for x in base.state.get(LEFT, []) if x not in old]}
        return Snapshot(base.version, base.parts, base.schemas, state)

    deleted = 0
    if old:
        again = _again(table.change(step))
        for writer, batch, _ in old:
            if (writer, batch) not in again:
                deleted += table.fs.delete(table.path(f"{bronze}/writer={writer}/batch_id={batch}"), True)
    return deleted + table.vacuum(keep_seconds)
