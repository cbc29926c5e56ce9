"""Which ids silver holds, for a question whose cost follows the batch that asks.

The ids of each batch are a run that nobody changes: files by bucket of the id's hash,
sorted by id, and beside them a Bloom filter of ten bits for each id, cut into pages of
4 KB. A batch asks the filters first, and then reads the ids of those buckets only in
which a filter says that one of its own may be. Runs of like size are merged, so there
are few of them however many batches have come.

Runs and filters are parts of silver's own table: rows and ids appear in one step, and a
batch that is played again asks all runs but its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.joins import broadcast_if_few
from broadsheet.plans.snapshots import OWN_WRITERS, UNIT, Snapshot, Snapshots, Unit

IDS, FILTERS = "ids", "filters"
# Of strange ids about one in a hundred passes a filter of this make.
BITS_PER_ID, HASHES = 10, 7
# Fixed value: bits of the bitmap that Spark builds.
PAGE_BITS = 8 * 4096
BUCKET_IDS, MAX_BUCKETS = 1 << 18, 4_096
# More runs than this are merged, those of like size first.
MAX_RUNS, LIKE = 8, 2.0
# Rows of filters to a file.
FILE_PAGES = 1 << 14

ID_SCHEMA, FILTER_SCHEMA = "id STRING, bucket INT", "page INT, bits BINARY"


@dataclass(frozen=True)
class Run:
    """The ids of a batch, or of several merged: their folders and how they are hashed."""

    writer: str
    batch: int
    ids: str
    filters: str
    n: int
    pages: int
    buckets: int


def runs_of(snapshot: Snapshot) -> list[Run]:
    return [Run(**r) for r in snapshot.state.get("runs", [])]


def with_runs(snapshot: Snapshot, runs: Iterable[Run]) -> Snapshot:
    runs = list(runs)
    for part, folder in ((IDS, "ids"), (FILTERS, "filters")):
        snapshot = snapshot.with_units(part, [Unit(r.writer, r.batch, getattr(r, folder)) for r in runs])
    return Snapshot(
        snapshot.version, snapshot.parts, snapshot.schemas, snapshot.state | {"runs": [asdict(r) for r in runs]}
    )


def _hash(seed: int) -> Column:
    return F.xxhash64("id", F.lit(seed))


def _bits() -> list[Column]:
    """The bits that an id sets in its page."""
    within = lambda seed: F.pmod(_hash(seed), F.lit(PAGE_BITS))
    # An odd step meets no bit twice.
    step = within(3).bitwiseOR(F.lit(1).cast("long"))
    return [(within(2) + step * k) % PAGE_BITS for k in range(HASHES)]


def write_run(table: Snapshots, ids: DataFrame, writer: str, batch: int) -> Run | None:
    """Write the distinct `ids` as a run that no manifest names yet; None of no ids."""
    n = ids.count()
    if not n:
        return None
    pages = math.ceil(n * BITS_PER_ID / PAGE_BITS)
    buckets = min(MAX_BUCKETS, math.ceil(n / BUCKET_IDS))
    by_bucket = ids.select("id", F.pmod(_hash(1), F.lit(buckets)).cast("int").alias("bucket"))
    by_bucket = by_bucket.repartition(buckets, "bucket").sortWithinPartitions("bucket", "id")
    own = table.write(by_bucket, writer, batch, ["bucket"], IDS)
    # Ids meet at their page as two numbers and are spread into bits there, with no second shuffle.
    files = math.ceil(pages / FILE_PAGES)
    paged = ids.select(F.pmod(_hash(0), F.lit(pages)).cast("int").alias("page"), F.array(*_bits()).alias("bits"))
    made = paged.repartition(files, "page").select("page", F.explode("bits").alias("bit")).groupBy("page")
    bits = made.agg(F.bitmap_construct_agg("bit").alias("bits")).sortWithinPartitions("page")
    filters = table.write(bits, writer, batch, (), FILTERS)
    return Run(writer, batch, own.folder, filters.folder, n, pages, buckets)


def _read(table: Snapshots, part: str, paths: Sequence[str], schema: str) -> DataFrame:
    reader = table.spark.read.schema(f"{schema}, {UNIT} STRING").option("basePath", f"{table.root}/{part}")
    return reader.parquet(*paths)


def possible(table: Snapshots, runs: Sequence[Run], ids: DataFrame) -> DataFrame:
    """(id, unit, bucket) of the `ids` that the filter of a run lets pass."""
    asked = F.array(*(F.struct(F.lit(r.filters).alias(UNIT), F.lit(r.ids).alias("run"), F.lit(r.pages).alias("pages"),
                               F.lit(r.buckets).alias("buckets")) for r in runs))
    probes = ids.select("id", F.inline(asked)).select(
        "id", UNIT, "run", F.pmod(_hash(0), F.col("pages")).cast("int").alias("page"),
        F.pmod(_hash(1), F.col("buckets")).cast("int").alias("bucket"), F.array(*_bits()).alias("at"),
    )
    filters = _read(table, FILTERS, [table.folder(r.filters, FILTERS) for r in runs], FILTER_SCHEMA)
    byte = lambda bit: F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = lambda bit: F.call_function("shiftright", byte(bit).cast("int"), (bit % 8).cast("int")) % 2 == 1
    passed = filters.join(broadcast_if_few(probes), [UNIT, "page"]).filter(F.forall("at", is_set))
    return passed.select("id", F.col("run").alias(UNIT), "bucket")


def known(table: Snapshots, snapshot: Snapshot, ids: DataFrame, without: tuple[str, int] | None = None) -> DataFrame:
    """The `ids` that silver holds, but for those it has from the batch `without`. No file
    of silver's rows is read; of ids, the buckets in which a filter lets one pass."""
    runs = [r for r in runs_of(snapshot) if (r.writer, r.batch) != without]
    if not runs:
        return ids.limit(0)
    # At most the buckets of all runs.
    pairs = possible(table, runs, ids).select(UNIT, "bucket").distinct().collect()
    if not pairs:
        return ids.limit(0)
    paths = [f"{table.folder(p.unit, IDS)}/bucket={p.bucket}" for p in pairs]
    there = _read(table, IDS, paths, ID_SCHEMA).select("id")
    return there.join(broadcast_if_few(ids), "id", "left_semi").distinct()


def like_sized(runs: Sequence[Run]) -> list[Run]:
    """Runs to merge: the smallest ones, up to the first that is much larger than those
    before it together. So each id is merged again only when its run has grown."""
    chosen, total = [], 0
    for run in sorted(runs, key=lambda r: r.n):
        if len(chosen) > 1 and run.n > LIKE * total:
            break
        chosen.append(run)
        total += run.n
    return chosen


def merge_runs(table: Snapshots, most: int = MAX_RUNS) -> int:
    """Merge runs while there are more than `most`; returns how many there are then. The
    latest run of each writer stays by itself, as its batch may be played again."""
    while True:
        snapshot = table.current()
        runs = runs_of(snapshot)
        last: dict[str, int] = {}
        for r in runs:
            last[r.writer] = max(r.batch, last.get(r.writer, r.batch))
        closed = [r for r in runs if r.writer in OWN_WRITERS or r.batch < last[r.writer]]
        chosen = like_sized(closed) if len(runs) > most else []
        if len(chosen) < 2:
            return len(runs)
        ids = _read(table, IDS, [table.folder(r.ids, IDS) for r in chosen], ID_SCHEMA).select("id")
        new = write_run(table, ids, "merged", snapshot.version + 1)
        folders = {r.ids for r in chosen}

        def step(base: Snapshot) -> Snapshot:
            held = runs_of(base)
            if not folders <= {r.ids for r in held}:
                # Silver was rebuilt meanwhile.
                return base
            through = dict(base.state.get("merged", {}))
            for r in chosen:
                if r.writer not in OWN_WRITERS:
                    through[r.writer] = max(r.batch, through.get(r.writer, r.batch))
            base = with_runs(base, [*(r for r in held if r.ids not in folders), new])
            return Snapshot(base.version, base.parts, base.schemas, base.state | {"merged": through})

        table.change(step)
