"""Repairs over versions: plan, execute, detect anew, take back.

A store is a folder with clubs/v=<stamp>, repairs/v=<stamp> and queue/v=<stamp>. Nothing is overwritten: a run reads the newest
version, writes the audit rows and the queue, and last the new version of the clubs, whose success mark makes the run
count. The version before it is the backup. A run that is lost on the way leaves rows that no reader sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.operators import resolve, state
from kartoteka.operators.shared import versions

# The columns that an orphan verdict clears. An identity drags its registry fields along, a coordinate its evidence.
BUNDLES = {
    "phone": ("phone", "phone_kind", "phone_e164"),
    "phone_e164": ("phone", "phone_kind", "phone_e164"),
    "email": ("email",),
    "website": ("website",),
    "fb_url": ("fb_url",),
    "ig_url": ("ig_url",),
    "oib": ("oib", "udruga_id", "president", "president_role", "registry_status", "registry_naziv", "registry_url"),
    "address": ("address",),
}
GEO_BUNDLE = ("lat", "lng", "geo_source", "geo_truth_source")


def bundles(entities: DataFrame, include_geo: bool = False) -> dict[str, list[str]]:
    """Field by field the columns to clear that the entities have; coordinates only when asked for, as grounds may be shared."""
    known = BUNDLES | ({"latlng": GEO_BUNDLE} if include_geo else {})
    return {f: cols for f, b in known.items() if (cols := [c for c in b if c in entities.columns])}


def plan(entities: DataFrame, verdicts: DataFrame | None = None, include_geo: bool = False) -> DataFrame:
    """(id, column, old_value, reason) of what would be cleared: a dry run. Verdicts are detected unless given."""
    return state.quarantine_plan(entities, resolve.detect(entities) if verdicts is None else verdicts, bundles(entities, include_geo))


class Store:
    """The versions below one shared folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def versions(self) -> list[str]:
        """Stamps of finished runs, oldest first."""
        return versions(self.spark, f"{self.base}/clubs")

    def _read(self, part: str, stamp: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{part}/v={stamp}")

    def _write(self, df: DataFrame, part: str, stamp: str) -> None:
        if stamp in (known := self.versions()) or known and stamp <= known[-1]:
            raise ValueError(f"version {stamp} is not after {known[-1]}")
        df.write.mode("overwrite").parquet(f"{self.base}/{part}/v={stamp}")  # over what a lost run of this stamp has left

    def clubs(self, stamp: str | None = None) -> DataFrame:
        return self._read("clubs", stamp or self.versions()[-1])

    def begin(self, clubs: DataFrame, stamp: str) -> None:
        """The first version: no repairs, an empty queue."""
        none = clubs.select("id", F.lit("").alias("column"), F.lit("").alias("old_value"), F.lit("").alias("reason")).limit(0)
        self._write(state.audit_rows(none), "repairs", stamp)
        self._write(clubs.select("id", F.array().cast("array<string>").alias("fields")).limit(0), "queue", stamp)
        self._write(clubs, "clubs", stamp)

    def queue(self) -> DataFrame:
        return self._read("queue", self.versions()[-1])

    def history(self) -> DataFrame:
        """Audit rows of all finished runs, with their stamp as `batch`."""
        runs = [self._read("repairs", v).withColumn("batch", F.lit(v)) for v in self.versions()]
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    def execute(self, planned: DataFrame, stamp: str) -> bool:
        """Applies a plan to the newest version; false, and no new version, if there is nothing to do."""
        clubs, queue = self.clubs(), self.queue()
        self._write(state.audit_rows(planned), "repairs", stamp)
        # The audit rows now stand; the clubs and the queue follow them, not the plan's lineage.
        done = self._read("repairs", stamp).select("id", F.col("field").alias("column"), "old_value", "reason")
        if done.isEmpty():
            return False
        columns = [c for b in bundles(clubs, True).values() for c in b]
        self._write(state.merge_queue(queue, done), "queue", stamp)
        self._write(state.apply_plan(clubs, done, columns), "clubs", stamp)
        return True

    def run(self, stamp: str, include_geo: bool = False) -> bool:
        """Detects anew on the newest version and executes."""
        return self.execute(plan(self.clubs(), None, include_geo), stamp)

    def take_back(self, batch: str, stamp: str) -> None:
        """A version in which what `batch` cleared has its old values again where nothing has filled it since."""
        clubs = self.clubs()
        old = self._read("repairs", batch).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "old_value"))).alias("_old"))
        joined = clubs.join(old, "id", "left")
        kinds = dict(clubs.dtypes)
        back = [F.coalesce(F.col(c), F.try_element_at("_old", F.lit(c)).cast(kinds[c])).alias(c) if c != "id" else F.col(c) for c in clubs.columns]
        rows = self._read("repairs", batch).select("id", "field", F.lit(None).cast("string").alias("old_value"), F.col("old_value").alias("new_value"), F.lit(f"back:{batch}").alias("reason"))
        self._write(rows, "repairs", stamp)
        self._write(self.queue(), "queue", stamp)
        self._write(joined.select(*back), "clubs", stamp)
