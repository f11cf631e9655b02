"""Published alerts that stay right when rows come late.

Alerts are kept as versions. `refresh` brings them up to date with a
landing: it takes the states of the commits that are new since the last
version, lists the windows they touch, computes those windows alone from
the landed states, and writes a new version of the hours these windows
start in. Late rows are no special case: the windows that they touch are
computed again, and those of a server whose first event is now earlier,
where its warm-up was. What is not touched is not read.

A version is a set of folders, one for each hour, and a manifest that
names them; the manifest is written last, as one file. A reader takes the
newest manifest and reads the folders it names, so it sees a version
whole, and a publication that was cut off leaves the one before.

The window offset comes from the earliest event landed so far, so a
stream needs none in advance. If an earlier event changes it, all windows
move, and the version is computed anew from the states.

One `refresh` at a time. The driver reads the names of commits, and the
hours there are: both grow with time, not with rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import slot_start
from ..operators.alerts import label
from ..operators.status import landed_status
from ..operators.warmup import drop_warmup_by_first
from ..operators.windows import OVERLAP, slot_window_aggregates, slots_from_seconds, window_starts
from ..schemas import MetricPair, with_window_times
from .commits import if_there, landing
from .ingest import read_landed_times, read_states, states_table

MANIFEST, DATA, LEDGER, FIRSTS = "manifest", "data", "ledger", "firsts"

MANIFEST_SCHEMA = "version long, offset int, merged array<string>, parts array<struct<hour:long,version:long>>, touched long, late long"
KEYS_SCHEMA = "server_id string, ws long, hour long"
FIRSTS_SCHEMA = "server_id string, slot long"
LEDGER_SCHEMA = "server_id string, ws long, late boolean"

#: Slots of a window, as seconds from its start.
_SLOTS = [k * K.SLIDE_SECONDS for k in range(OVERLAP)]


@dataclass(frozen=True)
class Version:
    """A published version: the commits it holds, the folder's version of each hour, and how many
    windows it computed, `late` of them in place of published ones."""

    number: int
    offset: int
    merged: frozenset[str]
    parts: dict[int, int]
    touched: int
    late: int


def _at(out: str, kind: str, version: int) -> str:
    return f"{out.rstrip('/')}/{kind}/v={version}"


def versions(spark: SparkSession, out: str) -> DataFrame:
    """The manifests of all versions; none before the first."""
    path = f"{out.rstrip('/')}/{MANIFEST}"
    return if_there(
        lambda: spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(path),
        lambda: spark.createDataFrame([], MANIFEST_SCHEMA),
    )


def current(spark: SparkSession, out: str, version: int | None = None) -> Version | None:
    """The newest version (or the one asked for), None if there is none."""
    rows = versions(spark, out)
    row = (rows if version is None else rows.filter(F.col("version") == version)).orderBy(F.desc("version")).first()
    if row is None:
        return None
    return Version(row.version, row.offset, frozenset(row.merged or ()), {p.hour: p.version for p in row.parts or ()}, row.touched, row.late)


def _rows_schema(pair: MetricPair, full_time: bool) -> T.StructType:
    fields = with_window_times(pair.output_schema) if full_time else pair.output_schema
    return T.StructType([*fields.fields, T.StructField("ws", T.LongType())])


def _read_hours(spark: SparkSession, out: str, pair: MetricPair, full_time: bool, parts: dict[int, int]) -> DataFrame:
    schema = _rows_schema(pair, full_time)
    paths = [f"{_at(out, DATA, v)}/hour={h}" for h, v in sorted(parts.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_published(spark: SparkSession, out: str, pair: MetricPair, full_time: bool = False, version: int | None = None) -> DataFrame:
    """Alert rows of the newest version, or of an earlier one; none before the first."""
    now = current(spark, out, version)
    return _read_hours(spark, out, pair, full_time, now.parts if now else {}).drop("ws")


def read_ledger(spark: SparkSession, out: str, version: int) -> DataFrame:
    """The windows that a version computed: server_id, ws (start, epoch seconds), late (whether it was published before)."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(_at(out, LEDGER, version))


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Equal on columns, where null is a value."""
    same = None
    for c in columns:
        one = a[c].eqNullSafe(b[c])
        same = one if same is None else same & one
    return same


def _hour(sec: Column | str) -> Column:
    return F.floor((F.col(sec) if isinstance(sec, str) else sec) / 3600).cast("long")


def touched_windows(slots: DataFrame, firsts: DataFrame, before: DataFrame | None) -> DataFrame:
    """Windows (server_id, ws) to compute for touched slots (server_id, slot).

    `firsts` has each server's first slot (server_id, slot) with the new
    ones, `before` without them. The windows that hold a touched slot are
    touched. Where a server's first slot moved, the two windows that were
    its warm-up are ordinary ones now, touched or not. Warm-up windows are
    left out.
    """
    windows = slots.select("server_id", F.explode(window_starts(F.col("slot"))).alias("ws"))
    if before is not None:
        old, new = before.alias("old"), firsts.alias("new")
        moved = old.join(new, F.col("old.server_id").eqNullSafe(F.col("new.server_id")) & (F.col("new.slot") < F.col("old.slot")))
        was_warmup = F.array(*[F.col("old.slot") - s for s in _SLOTS[1:]])
        windows = windows.union(moved.select("old.server_id", F.explode(was_warmup).alias("ws")))
    return drop_warmup_by_first(windows.distinct(), firsts)


def windows_of(states: DataFrame, keys: DataFrame, hours: list[int], pair: MetricPair, offset: int) -> DataFrame:
    """The windows `keys` (server_id, ws) from landed states: only the hours and the slots of these windows are read and merged."""
    needed = keys.select("server_id", F.explode(F.array(*[F.col("ws") + s for s in _SLOTS])).alias("slot")).distinct()
    found = states.filter(F.col("hour").isin(hours)).withColumn("slot", slot_start(F.col("sec"), offset))
    found = found.join(needed, _same(found, needed, "server_id", "slot"), "left_semi").drop("slot")
    windows = slot_window_aggregates(slots_from_seconds(found, pair, offset), pair, by_server=False)
    return windows.join(keys, _same(windows, keys, "server_id", "ws"), "left_semi")


def refresh(
    spark: SparkSession,
    landed_base: str,
    pair: MetricPair,
    out: str,
    thresholds: tuple[float, float] | None = None,
    full_time: bool = False,
) -> Version | None:
    """Publish a version that holds all commits of a landing; the newest one if nothing is new, None if nothing landed."""
    land, now = landing(spark, landed_base), current(spark, out)
    names = land.names(states_table(pair))
    fresh = [n for n in names if now is None or not land.within(n, now.merged)]
    if not fresh:
        return now
    offset = int(landed_status(read_landed_times(spark, landed_base), pair).first().window_offset)
    version = now.number + 1 if now else 1
    if now is not None and now.offset != offset and now.parts:
        now, fresh = None, names  # all windows move: nothing published can stay
    states = read_states(spark, land, pair)

    # 1. What is touched, and each server's first slot.
    slots = read_states(spark, land, pair, fresh).select("server_id", slot_start(F.col("sec"), offset).alias("slot")).distinct()
    before = spark.read.schema(FIRSTS_SCHEMA).parquet(_at(out, FIRSTS, now.number)) if now else None
    all_slots = slots if before is None else slots.unionByName(before)
    all_slots.groupBy("server_id").agg(F.min("slot").alias("slot")).write.mode("overwrite").parquet(_at(out, FIRSTS, version))
    firsts = spark.read.schema(FIRSTS_SCHEMA).parquet(_at(out, FIRSTS, version))
    keys_path = _at(out, "keys", version)
    touched_windows(slots, firsts, before).withColumn("hour", _hour("ws")).write.mode("overwrite").parquet(keys_path)
    keys = spark.read.schema(KEYS_SCHEMA).parquet(keys_path)
    hours = sorted(r.hour for r in keys.select("hour").distinct().collect())

    # 2. The ledger: which of them replace published windows.
    old = _read_hours(spark, out, pair, full_time, {h: v for h, v in now.parts.items() if h in set(hours)} if now else {})
    known = old.select("server_id", "ws")
    late = keys.join(known, _same(keys, known, "server_id", "ws"), "left_semi").select("server_id", "ws", F.lit(True).alias("late"))
    new = keys.join(known, _same(keys, known, "server_id", "ws"), "left_anti").select("server_id", "ws", F.lit(False).alias("late"))
    late.unionByName(new).write.mode("overwrite").parquet(_at(out, LEDGER, version))
    counts = read_ledger(spark, out, version).agg(F.count(F.lit(1)).alias("touched"), F.count_if("late").alias("late")).first()

    # 3. The touched windows, and the others of their hours as they were.
    reach = sorted({h + d for h in hours for d in (0, 1)})  # a window's slots may lie in the next hour
    rows = label(windows_of(states, keys, reach, pair, offset), pair, thresholds, full_time, carried=("ws",))
    stay = old.join(keys, _same(old, keys, "server_id", "ws"), "left_anti")
    both = stay.unionByName(rows).withColumn("hour", _hour("ws"))
    both.hint("rebalance", "hour").write.mode("overwrite").partitionBy("hour").parquet(_at(out, DATA, version))

    # 4. The manifest makes it the newest version.
    parts = {**(now.parts if now else {}), **dict.fromkeys(hours, version)}
    row = (version, offset, names, sorted(parts.items()), counts.touched, counts.late)
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(_at(out, MANIFEST, version))
    return current(spark, out, version)
