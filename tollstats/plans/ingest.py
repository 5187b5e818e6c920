"""From raw monthly records to the station dimension and the traffic fact.

The load can be repeated: stations and records already stored are left alone.
One load at a time may write to a store, as new ids continue from the highest
stored one.
"""

from __future__ import annotations

from typing import NamedTuple, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.functions.casts import CASTS, unreadable
from tollstats.operators.dedup import dedup_counted
from tollstats.operators.joins import broadcast_if_small
from tollstats.operators.surrogate import ID_BUCKETS, assign_ids
from tollstats.plans.activity import station_activity
from tollstats.schema import (
    FLUJO_NAMES,
    FLUJO_SCHEMA,
    ID_COLUMN,
    MALFORMED,
    MEASURE_COLUMNS,
    STATION_COLUMNS,
    STATION_KEY,
    Tables,
)
from tollstats.sources.staging import ensure_checkpoint_dir, staged_table

YEAR = "anio"
# Years of a batch that are listed in the filter of the stored records.
LISTED_YEARS = 512


class Store(Protocol):
    """Where the two tables are kept: a parquet store or a database."""

    assigns_ids: bool

    def peaje(self) -> DataFrame: ...
    def flujo_peaje(self) -> DataFrame: ...
    def append_peaje(self, rows: DataFrame) -> None: ...
    def append_flujo(self, rows: DataFrame) -> None: ...


def _same_key(left: DataFrame, right: DataFrame, null_safe: bool) -> list[Column]:
    if null_safe:
        return [left[k].eqNullSafe(right[k]) for k in STATION_KEY]
    return [left[k] == right[k] for k in STATION_KEY]


def dim_extract(raw: DataFrame) -> DataFrame:
    """Distinct stations named by the raw records."""
    return raw.select(*[F.col(raw_name).alias(name) for raw_name, name in STATION_COLUMNS]).distinct()


def dim_new(candidates: DataFrame, existing: DataFrame, null_safe: bool = True) -> DataFrame:
    """Stations not yet stored.

    A missing key part equals a missing key part. With ``null_safe=False`` it
    equals nothing, so such a station is new on every load.
    """
    stored = existing.select(*STATION_KEY)
    return candidates.join(stored, _same_key(candidates, stored, null_safe), "left_anti")


def number_stations(
    new: DataFrame, existing: DataFrame, buckets: int = ID_BUCKETS
) -> DataFrame:
    """Give new stations the ids after the highest stored one, or from 1."""
    highest = existing.agg(F.coalesce(F.max("id_peaje"), F.lit(0))).scalar()
    return assign_ids(new, STATION_KEY, "id_peaje", after=highest, buckets=buckets)


def fact_typed(raw: DataFrame) -> DataFrame:
    """Typed measures plus the station's key columns."""
    return raw.select(
        CASTS[ID_COLUMN.kind](F.col(ID_COLUMN.raw)).alias(ID_COLUMN.name),
        *[F.col(raw_name).alias(name) for raw_name, name in STATION_COLUMNS],
        *[CASTS[c.kind](F.col(c.raw)).alias(c.name) for c in MEASURE_COLUMNS],
    )


def fact_lookup(typed: DataFrame, peaje: DataFrame, null_safe: bool = True) -> DataFrame:
    """Replace the station's key columns by its id; rows without a station drop out."""
    stations = peaje.select("id_peaje", *STATION_KEY).distinct()
    joined = typed.join(broadcast_if_small(stations), _same_key(typed, stations, null_safe))
    return joined.select(*FLUJO_NAMES)


def fact_rejected(typed: DataFrame, peaje: DataFrame, null_safe: bool = True) -> DataFrame:
    """The rows ``fact_lookup`` drops."""
    stations = peaje.select(*STATION_KEY).distinct()
    return typed.join(stations, _same_key(typed, stations, null_safe), "left_anti")


def whole_lines(raw: DataFrame) -> DataFrame:
    """The raw records without the lines that a scan found malformed."""
    return raw.where(F.col(MALFORMED).isNull()) if MALFORMED in raw.columns else raw


def load_rejected(
    raw: DataFrame, peaje: DataFrame, null_safe: bool = True, conflicts: DataFrame | None = None
) -> DataFrame:
    """The raw records that are not, or not wholly, loaded, with the reasons.

    ``reasons`` lists the raw columns whose text cannot be read, ID also if it
    is missing, and ``station`` where no station matches. Records without an id
    or a station are not stored; others are, with nulls for what is unreadable.
    A malformed line (see ``scan_csv``) has the single reason ``fields`` and is
    not stored.

    ``conflicts`` (see ``load_fact``) adds the reason ``duplicate`` where the
    batch has another record of the same id that was stored instead, and
    ``changed`` where an earlier load stored the id with other values or in
    another year. Equal copies of a stored record are no loss and not listed.
    """
    # Raw and stored names differ in case only, which Spark does not tell apart.
    keys = [F.col(k).alias(f"_{k}") for k in STATION_KEY]
    stations = peaje.groupBy(*keys).agg(F.min("id_peaje").alias("_station"), F.lit(True).alias("known"))
    pairs = [(F.col(raw_name), F.col(f"_{name}")) for raw_name, name in STATION_COLUMNS]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    joined = raw.join(broadcast_if_small(stations), same, "left")
    number = CASTS[ID_COLUMN.kind](F.col(ID_COLUMN.raw))
    reasons = [
        F.when(number.isNull(), F.lit(ID_COLUMN.raw)),
        *[F.when(unreadable(F.col(c.raw), c.kind), F.lit(c.raw)) for c in MEASURE_COLUMNS],
        F.when(F.col("known").isNull(), F.lit("station")),
    ]
    if conflicts is not None:
        listed = conflicts.select(*[F.col(c).alias(f"_{c}") for c in conflicts.columns])
        joined = joined.join(broadcast_if_small(listed), number == F.col(f"_{ID_COLUMN.name}"), "left")
        own = _content([F.col("_station"), *[CASTS[c.kind](F.col(c.raw)) for c in MEASURE_COLUMNS]])
        lost = F.col("known").isNotNull() & ~own.eqNullSafe(F.col("_stored"))
        reasons.append(F.when(lost, F.col("_reason")))
    found = F.array_compact(F.array(*reasons))
    if MALFORMED in raw.columns:
        found = F.when(F.col(MALFORMED).isNotNull(), F.array(F.lit("fields"))).otherwise(found)
    return joined.withColumn("reasons", found).where(F.size("reasons") > 0).select(*raw.columns, "reasons")


def _content(values: list[Column] | None = None) -> Column:
    """Everything a stored record says besides its id, as one value that can be compared."""
    names = [name for name in FLUJO_NAMES if name != ID_COLUMN.name]
    kinds = [FLUJO_SCHEMA[name].dataType for name in names]
    columns = values or [F.col(name) for name in names]
    return F.struct(*[c.cast(kind).alias(name) for c, kind, name in zip(columns, kinds, names)])


class Bounds(NamedTuple):
    """Ids and years of a batch; ``years`` is None where there are too many to list."""

    low: int
    high: int
    years: list[int | None] | None

    def ids(self) -> Column:
        return F.col(ID_COLUMN.name).between(self.low, self.high)

    def in_years(self) -> Column:
        if self.years is None:
            return F.lit(True)
        listed = F.col(YEAR).isin([y for y in self.years if y is not None])
        listed = F.coalesce(listed, F.lit(False))
        return listed | F.col(YEAR).isNull() if None in self.years else listed & F.col(YEAR).isNotNull()


def batch_bounds(batch: DataFrame) -> Bounds | None:
    """What of the stored records a batch can meet; None for a batch without ids.

    One job for a batch of a usual number of years, a second one beyond.
    """
    ids = F.min(ID_COLUMN.name).alias("low"), F.max(ID_COLUMN.name).alias("high")
    years = batch.where(F.col(ID_COLUMN.name).isNotNull()).groupBy(YEAR).agg(*ids).limit(LISTED_YEARS + 1).collect()
    if not years:
        return None
    if len(years) > LISTED_YEARS:
        span = batch.agg(*ids).first()
        return Bounds(span["low"], span["high"], None)
    return Bounds(min(r["low"] for r in years), max(r["high"] for r in years), [r[YEAR] for r in years])


def fact_new(
    fact: DataFrame, existing: DataFrame, bounds: Bounds | None = None, fixed_years: bool = False
) -> DataFrame:
    """Records whose id is not yet stored; one without an id is always new.

    With the batch's ``bounds`` only stored ids in its range are read: parquet
    skips row groups, a database rows. ``fixed_years`` states the rule that an
    id never moves to another year; then only the batch's years are read.
    """
    if bounds is not None:
        existing = existing.where(bounds.ids() & (bounds.in_years() if fixed_years else F.lit(True)))
    return fact.join(existing.select("id_flujo"), "id_flujo", "left_anti").select(*fact.columns)


def judged(batch: DataFrame, existing: DataFrame, bounds: Bounds, fixed_years: bool = False) -> DataFrame:
    """The records of a batch (see ``dedup_counted``) that are new or meet a conflict.

    ``stored`` is the record that stays in the store, ``reason`` null for a
    record without conflict. Whole stored records are read of the batch's years
    only, and of other years just the ids in its range, to find those that
    moved; with ``fixed_years`` these are not read.
    """
    near = existing.where(bounds.ids() & bounds.in_years()).select(ID_COLUMN.name, _content().alias("stored"))
    joined = batch.join(near, ID_COLUMN.name, "left").withColumn("moved", F.lit(False))
    if not fixed_years and bounds.years is not None:
        elsewhere = existing.where(bounds.ids() & ~bounds.in_years()).select(ID_COLUMN.name).distinct()
        joined = joined.drop("moved").join(elsewhere.withColumn("moved", F.lit(True)), ID_COLUMN.name, "left")
        joined = joined.fillna(False, ["moved"])
    own, stored = _content(), F.col("stored")
    reason = (
        F.when(stored.isNotNull() & (F.col("differing") | ~own.eqNullSafe(stored)), "changed")
        .when(stored.isNull() & F.col("moved"), "changed")
        .when(stored.isNull() & F.col("differing"), "duplicate")
    )
    new = stored.isNull() & ~F.col("moved")
    return (
        joined.select(*FLUJO_NAMES, F.when(new, own).otherwise(stored).alias("stored"), reason.alias("reason"), new.alias("new"))
        .where(F.col("new") | F.col("reason").isNotNull())
    )


def load_dim(store: Store, raw: DataFrame, buckets: int = ID_BUCKETS) -> None:
    """Append the stations the store lacks, numbered unless the store does that."""
    existing = store.peaje()
    new = dim_new(dim_extract(raw), existing)
    store.append_peaje(new if store.assigns_ids else number_stations(new, existing, buckets))


def load_fact(
    store: Store, raw: DataFrame, fixed_years: bool = False, activity: bool = False
) -> DataFrame | None:
    """Append the records the store lacks, one per id; those without an id are left out.

    With ``activity`` the bitmaps of the new records' stations are appended as
    well, so that distinct stations can be counted without reading the records.

    Returns the conflicts met: the id, the record that is stored, and why others
    of that id are not (``duplicate`` or ``changed``, see ``load_rejected``);
    None where no record has an id. The batch is staged once, compared with
    what is stored once, and the staged copies are removed.
    """
    typed = fact_typed(raw).where(F.col(ID_COLUMN.name).isNotNull())
    batch = dedup_counted(fact_lookup(typed, store.peaje()), ID_COLUMN.name)
    with staged_table(batch, "batch") as batch:
        bounds = batch_bounds(batch)
        if bounds is None:
            return None
        with staged_table(judged(batch, store.flujo_peaje(), bounds, fixed_years), "judged") as rows:
            ensure_checkpoint_dir(rows.sparkSession)
            conflicts = rows.where(F.col("reason").isNotNull()).select(ID_COLUMN.name, "stored", "reason")
            conflicts = conflicts.dropDuplicates([ID_COLUMN.name]).checkpoint()
            new = rows.where("new").select(*FLUJO_NAMES)
            store.append_flujo(new)
            if activity:
                store.append_activity(station_activity(Tables(store.peaje(), new)))
    return conflicts


def load(store: Store, raw: DataFrame, fixed_years: bool = False, activity: bool = False) -> DataFrame:
    """Load stations and records; what was left out comes back (see ``load_rejected``).

    ``fixed_years`` states that a stored id never moves to another year, so that
    only the batch's years of the store are read. ``activity`` also keeps the
    bitmaps of active stations, which the store must be able to take.
    """
    records = whole_lines(raw)
    load_dim(store, records)
    conflicts = load_fact(store, records, fixed_years, activity)
    return load_rejected(raw, store.peaje(), conflicts=conflicts)
