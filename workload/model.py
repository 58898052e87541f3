"""The travel-time tables, derived from the given ones.

Customers are grid cells, suppliers are hospitals and order lines are travel
times. A municipality is a block of customers of one nation and segment, so
the number of municipalities grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.functions.geometry import point_wkb, square_wkb
from reachgrid.operators.nearest import cell_table
from reachgrid.plans.scenario import ScenarioTables
from reachgrid.schema import LAYOUT_COMBINED, LAYOUT_SPLIT

# Declared, so that no job has to look into a file before a query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string"
    ),
}

_CELL = "CAST(c_custkey AS STRING) AS Gitterzellen_ID"
_BLOCK = "CAST(floor(c_custkey / 500) AS STRING)"
_MUNICIPALITY = (
    "concat_ws('-', lpad(CAST(c_nationkey AS STRING), 2, '0'), c_mktsegment, "
    f"{_BLOCK}) AS Gemeindeschluessel"
)
_HOSPITAL = "lpad(CAST({} AS STRING), 12, '0')"
_HOSPITAL_COLUMN = _HOSPITAL.format("s_suppkey") + " AS Krankenhaus_Standortnummer"


@dataclass(frozen=True)
class Model:
    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(SCHEMAS[name]).parquet(path)

    @cached_property
    def _areas(self) -> DataFrame:
        on = F.expr("n_regionkey = r_regionkey")
        return self.raw("nation").join(self.raw("region"), on)

    @cached_property
    def admin_units(self) -> DataFrame:
        """Every municipality but those of one district, whose cells stay unknown."""
        municipalities = (
            self.raw("customer")
            .selectExpr("c_nationkey", "c_mktsegment", f"{_BLOCK} AS block", _MUNICIPALITY)
            .distinct()
        )
        return (
            municipalities.join(self._areas, F.expr("c_nationkey = n_nationkey"))
            .where("NOT (n_nationkey = 24 AND c_mktsegment = 'MACHINERY')")
            .selectExpr(
                "Gemeindeschluessel",
                "concat_ws(' ', n_name, c_mktsegment, block) AS Gemeindename",
                "Gemeindeschluessel AS Gemeinde_ID",
                "concat_ws(' ', n_name, c_mktsegment) AS Kreis",
                "concat_ws('-', lpad(CAST(n_nationkey AS STRING), 2, '0'), c_mktsegment)"
                " AS Kreis_ID",
                "n_name AS Regierungsbezirk",
                "lpad(CAST(n_nationkey AS STRING), 2, '0') AS Regierungsbezirk_ID",
                "r_name AS Bundesland",
                "CAST(r_regionkey AS STRING) AS Bundesland_ID",
            )
        )

    @cached_property
    def cell_municipality(self) -> DataFrame:
        return self.raw("customer").selectExpr(_CELL, _MUNICIPALITY)

    @cached_property
    def cell_people(self) -> DataFrame:
        """Cells with a negative balance have no inhabitants and no row; for
        balances below 100 the number is unknown."""
        people = "CASE WHEN c_acctbal >= 100 THEN floor(c_acctbal) END AS Einwohner"
        return self.raw("customer").where("c_acctbal >= 0").selectExpr(_CELL, people)

    @cached_property
    def cells_combined(self) -> DataFrame:
        return self.cell_municipality.join(self.cell_people, "Gitterzellen_ID")

    @cached_property
    def travel_times(self) -> DataFrame:
        """A cell and hospital may repeat, and some times are unknown."""
        on = F.expr("l_orderkey = o_orderkey")
        return (
            self.raw("lineitem")
            .join(self.raw("orders"), on)
            .selectExpr(
                "CAST(o_custkey AS STRING) AS Gitterzellen_ID",
                _HOSPITAL.format("l_suppkey") + " AS Krankenhaus_Standortnummer",
                "CASE WHEN NOT (l_returnflag = 'R' AND l_tax = 0) THEN "
                "CAST(l_quantity * 60 + floor(l_discount * 100 + 0.5D) AS INT) END "
                "AS Fahrzeit_Sekunden",
                "floor(l_extendedprice) AS Fahrstrecke_Meter",
            )
        )

    @cached_property
    def all_hospitals(self) -> DataFrame:
        return self.raw("supplier").selectExpr(_HOSPITAL_COLUMN)

    def hospitals_between(self, low: float, high: float) -> DataFrame:
        """A scenario: the hospitals whose balance lies in a range."""
        chosen = self.raw("supplier").where(f"s_acctbal BETWEEN {low} AND {high}")
        return chosen.selectExpr(_HOSPITAL_COLUMN)

    @cached_property
    def scenario(self) -> DataFrame:
        return self.hospitals_between(5900, 6450)

    @cached_property
    def closed(self) -> DataFrame:
        return self.hospitals_between(2000, 7000)

    @cached_property
    def few_closed(self) -> DataFrame:
        return self.hospitals_between(9000, 9200)

    def tables(self, layout: str = LAYOUT_COMBINED) -> ScenarioTables:
        if layout == LAYOUT_COMBINED:
            cells = cell_table(layout, self.cells_combined)
        else:
            cells = cell_table(
                LAYOUT_SPLIT,
                municipality=self.cell_municipality,
                people=self.cell_people,
            )
        return ScenarioTables(self.travel_times, cells, self.admin_units)

    @cached_property
    def hospital_sites(self) -> DataFrame:
        """Sites with a point each; a low balance leaves the operator open."""
        sites = self.raw("supplier").selectExpr(
            "concat('K', " + _HOSPITAL.format("s_suppkey") + ") AS Krankenhaus_Standort_ID",
            _HOSPITAL_COLUMN,
            "s_name AS Bezeichnung",
            "CASE WHEN s_acctbal >= 3000 THEN concat('Land ', s_nationkey) END AS `Träger`",
            "concat('Weg ', s_suppkey) AS Adresse",
            "concat(lpad(CAST(s_nationkey AS STRING), 2, '0'), '-BUILDING-0')"
            " AS Gemeindeschluessel",
            "s_nationkey + 0.25D AS x",
            "s_acctbal / 200 AS y",
        )
        return sites.withColumn("geometry", point_wkb(F.col("x"), F.col("y"))).drop("x", "y")

    @cached_property
    def polygons(self) -> DataFrame:
        """A unit square per municipality of the cells, the unknown ones too."""
        areas = (
            self.raw("customer")
            .selectExpr(_MUNICIPALITY, "c_nationkey AS x", "length(c_mktsegment) AS y")
            .distinct()
        )
        return areas.select(
            "Gemeindeschluessel",
            F.expr("concat('Ort ', Gemeindeschluessel) AS Gemeindename"),
            square_wkb(F.col("x"), F.col("y")).alias("geometry"),
        )

    @cached_property
    def template(self) -> DataFrame:
        """A template row per supplier: which columns it fills follows from the
        balance, and some name an area there is none of."""
        return (
            self.raw("supplier")
            .join(self._areas, F.expr("s_nationkey = n_nationkey"))
            .selectExpr(
                "s_suppkey + 1 AS Zeile",
                "CASE WHEN s_acctbal BETWEEN 9700 AND 9800 THEN r_name END AS Bundesland",
                "CASE WHEN s_acctbal BETWEEN 8800 AND 9900 THEN n_name END"
                " AS Regierungsbezirk",
                "CASE WHEN s_acctbal < 8000 THEN concat(n_name, ' FURNITURE') END AS Kreis",
                "CASE WHEN s_acctbal < 4000 THEN concat(n_name, ' FURNITURE 1')"
                " WHEN s_acctbal BETWEEN 8000 AND 8800 THEN 'Nirgendwo'"
                " WHEN s_acctbal > 9900 THEN concat(n_name, ' BUILDING 2')"
                " END AS Gemeindename",
            )
        )
