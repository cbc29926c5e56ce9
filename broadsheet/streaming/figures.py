"""Live figures kept as partial aggregates that can be merged.

Each micro-batch is reduced to one row for each window it touches. A window's figure is
the merge of its rows, so no state is held in the stream and no row comes too late: what
reaches a window after its close is a correction, kept apart so that one can see which
figures have changed since. Batches are folded by generation, so a reader finds few files
however many batches there were.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet import schemas as S
from broadsheet.operators import monitoring as M
from broadsheet.plans.lake import Lake
from broadsheet.plans.snapshots import DATA, Snapshot, Snapshots, Unit
from broadsheet.streaming.feed import TRIGGER, start

CORRECTIONS = "corrections"
# So many units of a generation become one of the next.
FAN = 8
DELAY = "1 hour"
# Batches between two looks for files that nobody needs.
VACUUM_EVERY = 50
KEY, LATEST = "window_start", "latest"


@dataclass(frozen=True)
class Figure:
    """A figure by tumbling windows: what is counted of the rows, in SQL, whose sums are
    those of merged rows, and what is shown."""

    width: str
    counted: dict[str, str]
    shown: Callable[[DataFrame], DataFrame]

    def partial(self, rows: DataFrame, time: str = "analyzed_at") -> DataFrame:
        """One row for each window; merged in the map tasks already."""
        made = rows.groupBy(F.window(time, self.width)).agg(
            *(F.expr(c).alias(n) for n, c in self.counted.items()), F.max(time).alias(LATEST)
        )
        return made.select(F.col("window.start").alias(KEY), F.col("window.end").alias("window_end"), *self.counted, LATEST)

    def merged(self, partials: DataFrame) -> DataFrame:
        sums = [F.sum(n).alias(n) for n in self.counted]
        ends = F.max("window_end").alias("window_end")
        return partials.groupBy(KEY).agg(ends, *sums, F.max(LATEST).alias(LATEST)).select(*partials.columns)


_FAKE, _REAL = (f"count_if(prediction = '{label}')" for label in (S.FAKE, S.REAL))

FIGURES = {
    "daily": Figure(
        M.DAY,
        {"total": "count(*)", "fake": _FAKE, "real": _REAL, "latency": "coalesce(sum(latency_ms), 0D)", "timed": "count(latency_ms)"},
        lambda df: M.daily_figures(df.select(
            F.col(KEY).alias("day"), "total", "fake", "real", F.try_divide("latency", "timed").alias("avg_response_ms")
        )),
    ),
    "hourly": Figure(
        M.HOUR, {"fake": _FAKE, "real": _REAL}, lambda df: df.select(F.col(KEY).alias("hour"), "fake", "real")
    ),
    "rate": Figure(M.MINUTE, {"n": "count(*)"}, lambda df: df.select(KEY, "n")),
}


def _with(snapshot: Snapshot, generations: dict[str, int], merged: dict[str, int] | None = None) -> Snapshot:
    """Generations of the folders that are still named, and how far writers are folded."""
    named = {u.folder for part in (DATA, CORRECTIONS) for u in snapshot.units(part)}
    state = snapshot.state | {"generations": {f: g for f, g in generations.items() if f in named}}
    return replace(snapshot, state=state | ({"merged": merged} if merged is not None else {}))


def add_batch(table: Snapshots, figure: Figure, rows: DataFrame, writer: str, batch: int, delay: str = DELAY) -> None:
    """Add the rows of a micro-batch; one that is played again replaces itself. Windows that
    had closed, `delay` before the latest time of the batches before, go to the corrections."""
    partial = figure.partial(rows).persist()
    try:

        def step(base: Snapshot) -> Snapshot:
            base.check_open(writer, batch)
            own = lambda u: (u.writer, u.batch) == (writer, batch)
            kept = {part: [u for u in base.units(part) if not own(u)] for part in (DATA, CORRECTIONS)}
            seen = None
            if kept[DATA]:
                # A row for each window and unit that is left after folding.
                until = F.max(LATEST) - F.expr(f"INTERVAL {delay}")
                seen = table.read(base, units=kept[DATA]).agg(until.alias("closed")).first().closed
            late = F.lit(False) if seen is None else F.col("window_end") <= F.lit(seen)
            generations = dict(base.state.get("generations", {}))
            for part, chosen in ((DATA, ~late), (CORRECTIONS, late)):
                # All of one batch's windows are few rows.
                unit = table.write(partial.filter(chosen).coalesce(1), writer, batch, (), part)
                generations[unit.folder] = 0
                base = base.with_units(part, [*kept[part], unit], partial.schema)
            return _with(base, generations)

        table.change(step)
    finally:
        partial.unpersist()


def fold(table: Snapshots, figure: Figure, fan: int = FAN) -> int:
    """Merge the oldest `fan` units of a generation into one of the next, while there are as
    many; returns the number of units left. The latest batch of each writer stays, as it
    may be played again."""
    while True:
        base = table.current()
        generations = base.state.get("generations", {})
        chosen: dict[str, list[Unit]] = {}
        for part in (DATA, CORRECTIONS):
            last: dict[str, int] = {}
            for u in base.units(part):
                last[u.writer] = max(u.batch, last.get(u.writer, u.batch))
            by_generation: dict[int, list[Unit]] = {}
            for u in base.units(part):
                if u.writer == "merged" or u.batch < last[u.writer]:
                    by_generation.setdefault(generations.get(u.folder, 0), []).append(u)
            full = [g for g, units in sorted(by_generation.items()) if len(units) >= fan]
            if full:
                chosen[part] = by_generation[full[0]]
        if not chosen:
            return sum(len(base.units(part)) for part in (DATA, CORRECTIONS))
        new = {}
        for part, units in chosen.items():
            rows = figure.merged(table.read(base, part, units)).coalesce(1)
            new[part] = table.write(rows, "merged", base.version + 1, (), part)

        def step(now: Snapshot) -> Snapshot:
            through, made = dict(now.state.get("merged", {})), dict(now.state.get("generations", {}))
            for part, units in chosen.items():
                gone = {u.folder for u in units}
                if not gone <= {u.folder for u in now.units(part)}:
                    raise RuntimeError(f"{table.root} was folded by another job meanwhile")
                for u in units:
                    if u.writer != "merged":
                        through[u.writer] = max(u.batch, through.get(u.writer, u.batch))
                made[new[part].folder] = max(made.get(f, 0) for f in gone) + 1
                now = now.with_units(part, [*(u for u in now.units(part) if u.folder not in gone), new[part]])
            return _with(now, made, through)

        table.change(step)


def to_figure(
    predictions: DataFrame, lake: Lake, name: str, trigger: str | None = TRIGGER, delay: str = DELAY, fan: int = FAN
) -> StreamingQuery:
    """Keep a figure up to date with a stream of predictions; see `read_figure`. A new
    checkpoint adds to what is there."""
    figure, stream = FIGURES[name], f"figure-{name}"

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = lake.figure(spark, name)
        add_batch(table, figure, batch, lake.stream_id(spark, stream), batch_id, delay)
        fold(table, figure, fan)
        if batch_id % VACUUM_EVERY == 0:
            table.vacuum()

    return start(predictions, each, lake.checkpoint(stream), stream, trigger)


def read_figure(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """The figure over all rows that have come, late ones included."""
    figure, table = FIGURES[name], lake.figure(spark, name)
    base = table.current()
    rows = table.read(base).unionByName(table.read(base, CORRECTIONS))
    return figure.shown(figure.merged(rows))


def read_corrections(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """What late rows added to windows after they had closed, by window."""
    figure, table = FIGURES[name], lake.figure(spark, name)
    return figure.merged(table.read(table.current(), CORRECTIONS)).drop("window_end", LATEST)
