"""Containers for the DataFrames of one layer.

Both containers are lazy: a table's plan is built the first time it is asked
for, so a query that needs two silver tables does not analyse all seven.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame

from tallyward.specs import HOSPITALS, Hospital


#: Column that names the hospital in a frame of all hospitals.
HOSPITAL_COLUMN = "hospital_name"


class LazyFrames(Mapping):
    """A mapping whose values are built on first access and then kept."""

    def __init__(self, builders: Mapping[object, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[object, DataFrame] = {}

    def __getitem__(self, key) -> DataFrame:
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __contains__(self, key) -> bool:  # without building the value
        return key in self._builders

    def __iter__(self) -> Iterator:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class BronzeLayer:
    """Bronze inputs of the silver layer.

    ``frames[(hospital name, entity)]`` is that hospital's landing table in its
    own column names (dates as epoch milliseconds). ``claims`` / ``cptcodes``
    are the bronze tables loaded from the CSV files (with lineage columns).
    ``combined[entity]``, where a source has it, holds all hospitals in conformed
    columns and the hospital's name in ``hospital_name``.
    """

    def __init__(
        self,
        frames: Mapping[tuple[str, str], DataFrame],
        claims: Callable[[], DataFrame] | DataFrame | None = None,
        cptcodes: Callable[[], DataFrame] | DataFrame | None = None,
        hospitals: Sequence[Hospital] = HOSPITALS,
        combined: Mapping[str, Callable[[], DataFrame]] | None = None,
    ):
        self.frames = frames
        self.combined = LazyFrames(combined or {})
        self._files = LazyFrames(
            {k: (v if callable(v) else (lambda v=v: v)) for k, v in (("claims", claims), ("cptcodes", cptcodes)) if v is not None}
        )
        self.hospitals = tuple(hospitals)

    @property
    def claims(self) -> DataFrame | None:
        return self._files["claims"] if "claims" in self._files else None

    @property
    def cptcodes(self) -> DataFrame | None:
        return self._files["cptcodes"] if "cptcodes" in self._files else None

    def has_file(self, name: str) -> bool:
        return name in self._files

    def conformed(self, hospital: Hospital, entity: str) -> DataFrame:
        df = self.frames[(hospital.name, entity)]
        renames = dict(hospital.renames_for(entity))
        return df.withColumnsRenamed(renames) if renames else df


SILVER_TABLES = {
    "departments": "dim_departments",
    "encounters": "fact_encounters",
    "patients": "dim_patients",
    "providers": "dim_providers",
    "transactions": "fact_transactions",
    "cptcodes": "dim_cptcodes",
    "claims": "fact_claims",
}


class SilverLayer:
    """The seven silver tables, by attribute (``silver.providers``) or by table
    name (``silver.table("dim_providers")``)."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        unknown = set(builders) - set(SILVER_TABLES)
        if unknown:
            raise KeyError(f"unknown silver tables: {sorted(unknown)}")
        self._frames = LazyFrames(builders)

    def _get(self, attr: str) -> DataFrame:
        if attr not in self._frames:
            raise KeyError(f"silver table {SILVER_TABLES[attr]} is not available in this layer")
        return self._frames[attr]

    departments = property(lambda self: self._get("departments"))
    encounters = property(lambda self: self._get("encounters"))
    patients = property(lambda self: self._get("patients"))
    providers = property(lambda self: self._get("providers"))
    transactions = property(lambda self: self._get("transactions"))
    cptcodes = property(lambda self: self._get("cptcodes"))
    claims = property(lambda self: self._get("claims"))

    def table_names(self) -> list[str]:
        return [SILVER_TABLES[a] for a in self._frames]

    def table(self, name: str) -> DataFrame:
        attr = {v: k for k, v in SILVER_TABLES.items()}[name]
        return self._get(attr)

    def tables(self) -> dict[str, DataFrame]:
        return {SILVER_TABLES[a]: self._frames[a] for a in self._frames}
