"""Reference tables: files with a built-in fallback, SQL views, and sets of datasets."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from kerbside import schemas
from kerbside.sources.files import read_csv, read_json

log = logging.getLogger(__name__)

# The rows used where a reference file is missing.
TAXI_ROWS = [
    (1, "SHZ2770", "Standard", "Toyota Carolla", 4, "Yellow", "TMA73889"),
    (2, "SHY4378", "Mini Cab", "Suzuki Swift", 4, "Green", "TMC04591"),
    (3, "SHX6464", "Standard", "Toyota Prius", 4, "Blue", "TMA12020"),
    (4, "SHX4872", "Premier", "Toyota Camry Hybrid", 4, "Silver", "TMB02825"),
    (5, "SHY9111", "Maxi Cab", "Mercedes Viano", 7, "Cream", "TMC45713"),
]
DRIVER_ROWS = [
    (1, "John Tan", 91234567, 1, 4.5),
    (2, "Mary Lim", 92345678, 2, 4.8),
    (3, "Ahmad Rahman", 93456789, 3, 4.2),
    (4, "Sarah Wong", 94567890, 4, 4.9),
    (5, "David Chen", 95678901, 5, 4.6),
]
PASSENGER_ROWS = [
    (1, "Alice Johnson", "Gold", 28, "F", 450.75, "Orchard Road", "Ms", 81234567),
    (2, "Bob Smith", "Silver", 35, "M", 320.50, "Marina Bay", "Mr", 82345678),
    (3, "Carol Lee", "Standard", 42, "F", 180.25, "Tampines", "Mrs", 83456789),
]
FALLBACKS = {
    "taxis": (schemas.TAXI, TAXI_ROWS),
    "drivers": (schemas.DRIVER, DRIVER_ROWS),
    "passengers": (schemas.PASSENGER, PASSENGER_ROWS),
}
_READERS = {"taxis": read_json}


def _missing_path(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or str(error))


def _read(spark: SparkSession, name: str, path: str) -> DataFrame:
    return _READERS.get(name, read_csv)(spark, path)


def load_dim(
    spark: SparkSession, name: str, path: str, fallback: tuple[str, list[tuple]] | None = None
) -> DataFrame:
    """A reference file, or the fallback rows where the path does not exist. Other errors are raised."""
    try:
        return _read(spark, name, path)
    except AnalysisException as error:
        if not _missing_path(error):
            raise
        log.warning("no %s at %s, using the built-in rows", name, path)
        schema, rows = fallback or FALLBACKS[name]
        return spark.createDataFrame(rows, schema)


def register_views(spark: SparkSession, dims: Mapping[str, DataFrame]) -> None:
    for name, df in dims.items():
        df.createOrReplaceTempView(name)


def load_datasets(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The datasets whose path exists; the others are skipped with a warning."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = _read(spark, name, path)
        except AnalysisException as error:
            if not _missing_path(error):
                raise
            log.warning("skipping %s: no file at %s", name, path)
    return found
