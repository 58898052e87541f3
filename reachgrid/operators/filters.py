"""Selecting municipalities, grid cells and travel times by user lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.schema import (
    CELL,
    FACT_COLUMNS,
    HOSPITAL,
    MUNICIPALITY,
    TEMPLATE_COLUMNS,
    require_columns,
)
from reachgrid.sources.lists import LINE_NUMBER

_MASK = "_mask"

# Keys that a scan is told one by one, and ranges that it is told of longer lists.
LISTED = 200
RANGES = 64


def geofilter_cells(
    municipalities: DataFrame,
    admin_units: DataFrame,
    cell_municipality: DataFrame,
    cell_people: DataFrame,
) -> DataFrame:
    """Inhabited grid cells of the listed municipalities, each once.

    Every step only asks whether a partner exists, so repeated keys on either
    side multiply nothing and no row is widened before the final distinct.
    """
    require_columns(municipalities, [MUNICIPALITY])
    wanted = admin_units.select(MUNICIPALITY).join(
        municipalities.select(MUNICIPALITY), MUNICIPALITY, "left_semi"
    )
    return (
        cell_municipality.select(CELL, MUNICIPALITY)
        .join(wanted, MUNICIPALITY, "left_semi")
        .join(cell_people.select(CELL), CELL, "left_semi")
        .select(CELL)
        .distinct()
    )


def filter_by_cells(travel_times: DataFrame, cells: DataFrame) -> DataFrame:
    """Travel times that start in one of the cells."""
    return travel_times.select(*FACT_COLUMNS).join(cells.select(CELL), CELL, "left_semi")


def filter_by_hospitals(
    travel_times: DataFrame, hospitals: DataFrame, dedupe_keys: bool = False
) -> DataFrame:
    """Travel times to the listed hospitals.

    A hospital listed twice gives its rows twice, unless ``dedupe_keys``.
    """
    require_columns(hospitals, [HOSPITAL])
    kind = "left_semi" if dedupe_keys else "inner"
    return (
        travel_times.select(*FACT_COLUMNS)
        .join(hospitals.select(HOSPITAL), HOSPITAL, kind)
        .select(*FACT_COLUMNS)
    )


def scan_condition(keys: DataFrame, column: str) -> Column:
    """A condition that holds for every key, by which a scan can leave out row groups.

    Up to LISTED keys are named one by one, so that dictionaries and Bloom filters of
    the files answer for them; of more keys the ends of RANGES ranges are taken, as the
    driver never holds a long list. It is a first sieve: a join with the keys decides.
    """
    known = keys.select(column).filter(F.col(column).isNotNull())
    values = [row[0] for row in known.distinct().limit(LISTED + 1).collect()]
    if len(values) <= LISTED:
        return F.col(column).isin(*sorted(values)) if values else F.lit(False)
    dealt = known.repartitionByRange(RANGES, column).withColumn("_range", F.spark_partition_id())
    ends = dealt.groupBy("_range").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return reduce(
        lambda a, b: a | b,
        (F.col(column).between(row["low"], row["high"]) for row in ends.orderBy("low").collect()),
    )


def within(travel_times: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Travel times whose key may be one of the keys; the filter reaches the scan."""
    return travel_times.filter(scan_condition(keys, column))


def _mask(columns: list[str]) -> Column:
    """Number whose bits tell which of the columns carry a value."""
    bits = (F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
            for i, c in enumerate(columns))
    return reduce(lambda a, b: a + b, bits)


def _variants(
    admin_units: DataFrame, columns: list[str], template: DataFrame
) -> DataFrame:
    """Every unit once per set of columns that a row of the template leaves open.

    With the open columns set to NULL, a template with wildcards becomes an
    equality join: of four columns there are at most sixteen sets, and only
    those that occur are listed. A template of open rows only gives one key for
    all units; these are few, and adaptive execution splits such a key.
    """
    occurring = template.agg(F.collect_set(_MASK)).scalar()
    choices = []
    for mask in range(1 << len(columns)):
        fields = [
            (F.col(c) if mask >> i & 1 else F.lit(None).cast("string")).alias(f"_{c}")
            for i, c in enumerate(columns)
        ]
        choice = F.struct(F.lit(mask).alias(_MASK), *fields)
        choices.append(F.when(F.array_contains("_masks", F.lit(mask)), choice))
    return (
        admin_units.withColumn("_masks", occurring)
        .select(*admin_units.columns, F.explode(F.array_compact(F.array(*choices))).alias("_v"))
        .select(*admin_units.columns, "_v.*")
    )


def _prepare(template: DataFrame) -> tuple[DataFrame, list[str]]:
    columns = [c for c in TEMPLATE_COLUMNS if c in template.columns]
    if not columns:
        raise ValueError(
            "Template must have at least one of the columns: "
            + ", ".join(TEMPLATE_COLUMNS)
        )
    require_columns(template, [LINE_NUMBER])
    return template.withColumn(_MASK, _mask(columns)), columns


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    tests = [left[_MASK] == right[_MASK]]
    tests += [left[f"_{c}"].eqNullSafe(right[c]) for c in columns]
    return reduce(lambda a, b: a & b, tests)


def match_template(template: DataFrame, admin_units: DataFrame) -> DataFrame:
    """Units that fit at least one template row, one row per municipality key.

    A template row fits where all its non-null columns are equal; a row without
    any value fits everything. Where units share a key, the one that fits the
    earliest template row is kept.
    """
    require_columns(admin_units, [MUNICIPALITY])
    template, columns = _prepare(template)
    # Equal template rows collapse before the join.
    wanted = template.groupBy(_MASK, *columns).agg(F.min(LINE_NUMBER).alias("_first"))
    units = _variants(admin_units, columns, wanted)
    found = units.join(wanted, _same(units, wanted, columns)).select(
        *(units[c] for c in admin_units.columns), "_first"
    )
    rest = [c for c in admin_units.columns if c != MUNICIPALITY]
    return (
        found.groupBy(MUNICIPALITY)
        .agg(F.min(F.struct("_first", *rest)).alias("_best"))
        .select(
            *(
                F.col(c) if c == MUNICIPALITY else F.col(f"_best.{c}").alias(c)
                for c in admin_units.columns
            )
        )
    )


def unmatched_template_rows(template: DataFrame, admin_units: DataFrame) -> DataFrame:
    """Template rows that fit no unit, with their line numbers."""
    template, columns = _prepare(template)
    units = _variants(admin_units, columns, template)
    units = units.select(_MASK, *(f"_{c}" for c in columns)).distinct()
    return template.join(units, _same(units, template, columns), "left_anti").select(
        LINE_NUMBER, *columns
    )


