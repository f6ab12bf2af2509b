"""The workbook's model over the three stored tables, and its views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.aggregates import shares_of
from tidemark.operators.model import LogicalModel, Measure, Relationship
from tidemark.schemas import KEY
from tidemark.streaming.app import VehicleTables

LOCATION, VEHICLES, TOTALS = "location", "vehicles", "totals"
# The relationships of the model and the names its views use.
RELATIONSHIPS = (Relationship(LOCATION, "county", TOTALS, "county"), Relationship(LOCATION, KEY, VEHICLES, KEY))
FIELDS = {
    "county": (LOCATION, "county"),
    "city": (LOCATION, "city"),
    "make": (VEHICLES, "make"),
    "model": (VEHICLES, "model"),
    "electric_range": (VEHICLES, "electric_range"),
    "total_county": (TOTALS, "county"),
    "total_make": (TOTALS, "make"),
    "vehicle_count": (TOTALS, "vehicle_count"),
    "avg_electric_range": (TOTALS, "avg_electric_range"),
}
ROWS = Measure("count", table=VEHICLES)


def workbook_model(tables: VehicleTables) -> LogicalModel:
    """The model over the catalog entries of a warehouse's tables."""
    names = tables.config
    scans = {LOCATION: names.location_table, VEHICLES: names.evdata_table, TOTALS: names.aggregate_table}
    return LogicalModel({name: tables.scan(entry) for name, entry in scans.items()}, RELATIONSHIPS, FIELDS)


def average_and_largest_range(model: LogicalModel) -> DataFrame:
    """Largest range and the average fixed at county and make, by county and make."""
    fixed = Measure("avg", "electric_range", fixed=("county", "make"))
    return model.view(["county", "make"], {"max_electric_range": Measure("max", "electric_range"), "fixed_avg_range": fixed})


def county_and_make(model: LogicalModel) -> DataFrame:
    """Vehicles by county and, within it, make, each as a share of its ring."""
    return shares_of(model.view(["county", "make"], {"row_count": ROWS}), "county", "make")


def make_and_model(model: LogicalModel) -> DataFrame:
    """Vehicles by make and, within it, model, each as a share of its ring."""
    return shares_of(model.view(["make", "model"], {"row_count": ROWS}), "make", "model")


def make_and_city(model: LogicalModel) -> DataFrame:
    """Vehicles of each city and make."""
    return model.view(["city", "make"], {"row_count": ROWS})


def stored_measures(model: LogicalModel, dimensions: tuple[str, ...] = ()) -> DataFrame:
    """Average and sum of the stored averages, and the sum of the ranges themselves."""
    measures = {
        "avg_of_averages": Measure("avg", "avg_electric_range"),
        "sum_of_averages": Measure("sum", "avg_electric_range"),
        "sum_electric_range": Measure("sum", "electric_range"),
    }
    return model.view(dimensions, measures)
