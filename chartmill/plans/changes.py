"""Bringing staged roll-ups up to date with observations that came late.

The anti-join of a load drops what comes after its encounter was staged.  Here a batch of new observations and encounters
names the keys it affects; the job runs again over these alone, with all that is known about them now, and its rows take the
place of the staged ones.  The outcome is that of a full run, in whatever order the batches come, and a batch that is
replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed
from chartmill.operators.lookups import anti_staged, distinct_keys, one_per_key, semi_on
from chartmill.operators.membership import may_be_in, semi_on_delta
from chartmill.plans import care, reports
from chartmill.plans.registration import Tables


def replaced(staged: DataFrame, affected: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The staged rows but for those of the affected keys, and the new rows of these."""
    return anti_staged(staged, affected, keys).unionByName(rows.select(*staged.columns))


def affected_encounters(obs: DataFrame, new_obs: DataFrame, new_encounters: DataFrame | None) -> DataFrame:
    """(person_id, encounter_id) of new observations, and of known ones whose encounter is new."""
    keys = ["person_id", "encounter_id"]
    found = new_obs.select(*keys)
    if new_encounters is not None:
        found = found.unionByName(semi_on_delta(obs.select(*keys), new_encounters, ["encounter_id"]))
    return distinct_keys(found)


def triage_changes(src: Tables, new_obs: DataFrame, new_encounters: DataFrame | None = None, **settings) -> tuple[DataFrame, DataFrame]:
    """The affected keys and their vitals, out of all observations in `src`, which holds the new ones too."""
    keys = ["person_id", "encounter_id"]
    affected = affected_encounters(src["obs"], new_obs, new_encounters).persist()
    known = {**src, "obs": semi_on_delta(src["obs"], affected, keys), "encounter": may_be_in(src["encounter"], affected, ["encounter_id"])}
    return affected, care.triage(known, staged=None, **settings)


def regimen_changes(src: Tables, new_obs: DataFrame, new_encounters: DataFrame | None = None, drug_concept: int = fixed.REGIMEN_CONCEPT,
                    change_concepts: Sequence[int] = fixed.REGIMEN_CHANGE_CONCEPTS, staged: DataFrame | None = None, **settings) -> tuple[DataFrame, DataFrame]:
    """The affected persons and all their regimens: a late drug can move a first intake to another encounter.

    With the staged regimens at hand, only persons with new drugs or encounters have theirs made again; where there are new
    reasons alone, the staged rows stay but for the reason, which is looked up anew."""
    drug = F.col("concept_id") == drug_concept
    asked = F.col("concept_id").isin(drug_concept, *change_concepts)
    known_obs = src["obs"].where(asked)
    if staged is None:
        affected = distinct_keys(affected_encounters(known_obs, new_obs.where(asked), new_encounters).select("person_id")).persist()
        known = {**src, "obs": semi_on_delta(src["obs"], affected, ["person_id"])}
        return affected, reports.regimens(known, drug_concept=drug_concept, change_concepts=change_concepts, **settings)
    whole = affected_encounters(known_obs, new_obs.where(drug), new_encounters).select("person_id", F.lit(True).alias("again"))
    reasons = new_obs.where(asked & ~drug).select("person_id", F.lit(False).alias("again"))
    affected = one_per_key(whole.unionByName(reasons), ["person_id"], F.max("again").alias("again")).persist()
    names = reports.full_names(src, settings.get("locale", "en"))
    renewed = semi_on(staged, affected.where(~F.col("again")), {"person_id": "person_id"}).drop("reason_for_change").join(
        reports.reasons_for_change(src, names, change_concepts), "encounter_id", "left").select(*staged.columns)
    again = affected.where("again").select("person_id")
    if again.isEmpty():
        return affected, renewed
    known = {**src, "obs": semi_on_delta(src["obs"], again, ["person_id"])}
    return affected, renewed.unionByName(reports.regimens(known, drug_concept=drug_concept, change_concepts=change_concepts, **settings))


def brought_up_to_date(staged: DataFrame, keys: Sequence[str], change: Callable[[], tuple[DataFrame, DataFrame]], write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The staged table after a change, as `write` stores it."""
    affected, rows = change()
    try:
        return write(replaced(staged, affected, rows, keys))
    finally:
        affected.unpersist()


