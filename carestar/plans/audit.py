"""Contract checks over a loaded warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from carestar.functions.dates import FIRST_DAY, LAST_DAY
from carestar.operators import quality
from carestar.plans import dims, facts
from carestar.schemas import ENTITIES, FOREIGN_KEYS, UNIQUE, WAREHOUSE
from carestar.sources.landing import LandingZone
from carestar.sources.literal import no_rows
from carestar.sources.store import TableStore


def landing_widths(zone: LandingZone) -> DataFrame:
    """Values longer than their landing column, and missing required ones."""
    return reduce(
        DataFrame.unionByName,
        [quality.width_violations(zone.read(entity), entity) for entity in ENTITIES.values()],
    )


def keys(store: TableStore) -> DataFrame:
    """Duplicated keys per uniqueness contract."""
    tables = {name: store.read(name) for name in UNIQUE}
    return quality.unique_violations(tables, UNIQUE, ignore_null=["fact_medication_daily"])


def references(store: TableStore) -> DataFrame:
    """Orphan fact rows per foreign key."""
    tables = {name: store.read(name) for name in WAREHOUSE}
    return quality.foreign_key_violations(tables, FOREIGN_KEYS)


def dropped(store: TableStore) -> DataFrame:
    """Source rows that the loads made no fact of, as they have no patient: what the loads
    set aside, of all fact tables."""
    asides = [facts.dropped_name(fact) for fact in ("fact_encounter", "fact_condition", "fact_medications")]
    held = [store.read(aside) for aside in asides if store.exists(aside)]
    return reduce(DataFrame.unionByName, held) if held else no_rows(store.spark, facts.DROPPED)


def dropped_encounters(store: TableStore) -> DataFrame:
    """Encounters that no fact row was made for, as they have no patient."""
    staged = store.read(ENTITIES["encounters"].staging_table)
    source = facts.encounter_source(staged, FIRST_DAY, LAST_DAY)
    return facts.rows_without_patient(
        source, store.read(dims.PATIENT.table), "encounter_date"
    )
