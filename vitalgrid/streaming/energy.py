"""Meter stream: rolling windows, forecasts, errors, refits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.scoring import alert_tier, clock_text
from vitalgrid.operators.additive import AdditiveForecaster, Moments, lags, product_sums
from vitalgrid.operators.forecasting import (
    Forecaster,
    fit_forecaster,
    readings,
    score_windows,
    training_runs,
)
from vitalgrid.operators.registry import Registry
from vitalgrid.operators.sequences import bounded_history, sliding_sequence
from vitalgrid.streaming import logs

#: Rows of a series that are carried over beyond its window.
SPARE = 10


@dataclass
class EnergyStream:
    """Tables of one deployment under `folder`, and the micro-batch handler.

    The rolling window of a series is carried over in a table that holds its newest rows. So a
    micro-batch is windowed like a batch: a busy series is cut into chunks and spread over tasks.
    `keep` rows of a series are carried over: unless given, ten more than a window has.
    """

    spark: SparkSession
    folder: str
    value: str = "use_kw"
    columns: tuple[str, ...] = ()
    steps: int = 60
    keep: int | None = None
    first_windows: int = 100
    refit_every: int = 100
    high: float = 1.5
    medium: float = 1.0
    kind: str = "additive"
    compact_every: int = 100
    keep_versions: int = 20
    registry: Registry = field(init=False)

    def __post_init__(self):
        self.keep = self.steps + SPARE if self.keep is None else self.keep
        self.registry = Registry(self.spark, f"{self.folder}/registry", keep=self.keep_versions)

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str) -> DataFrame | None:
        return logs.read_log_or_none(self.spark, self.table(name))

    def _tail(self, batch_id: int) -> DataFrame | None:
        """Newest rows per series as of the batch before.

        A batch stores the series it touched, and every `compact_every`-th batch stores all; so
        only the batches since then are read, and per series the newest stored batch counts.
        """
        since = (batch_id - 1) // self.compact_every * self.compact_every
        past = logs.read_batches(self.spark, self.table("tail"), max(0, since), batch_id - 1)
        if past is None:
            return None
        newest = past.groupBy("series_id").agg(F.max("batch_id").alias("batch_id"))
        return past.join(newest, ["series_id", "batch_id"]).drop("batch_id")

    def windows(self, batch: DataFrame, batch_id: int, with_target: bool = False) -> DataFrame:
        """Windows that end in this batch (with a target: whose next reading is in it)."""
        tail = self._tail(batch_id)
        fresh = batch.withColumn("_fresh", F.lit(True))
        rows = fresh
        if tail is not None:
            touched = tail.join(batch.select("series_id").distinct(), "series_id", "left_semi")
            rows = fresh.unionByName(touched.withColumn("_fresh", F.lit(False)))
        found = sliding_sequence(
            rows, readings(self.value, self.columns), self.steps, with_target, target=self.value
        )
        return found.filter("_fresh").drop("_fresh")

    def store_tail(self, batch: DataFrame, batch_id: int) -> None:
        tail, rows = self._tail(batch_id), batch
        if tail is not None:
            if batch_id % self.compact_every:
                tail = tail.join(batch.select("series_id").distinct(), "series_id", "left_semi")
            rows = batch.unionByName(tail.select(*batch.columns))
        logs.append_batch(
            bounded_history(rows, self.keep), self.table("tail"), batch_id, keep=2 * self.compact_every + 2
        )

    def sequence_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Appends the windows of the batch to `sequences`."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            logs.append_batch(self.windows(batch, batch_id), self.table("sequences"), batch_id)
            self.store_tail(batch, batch_id)
        finally:
            batch.unpersist()

    # Forecasts -------------------------------------------------------------------------------

    def load(self, version: int) -> Forecaster | AdditiveForecaster:
        facts = self.registry.facts(version)
        if "weights" in facts:
            return AdditiveForecaster.from_facts(facts)
        stages, _ = self.registry.load(version)
        columns = {name: tuple(scale) for name, scale in facts["columns"]}
        return Forecaster(facts["steps"], tuple(facts["scale"]), stages, {}, columns)

    @property
    def inputs(self) -> int:
        return self.steps * max(1, len(self.columns))

    def _centre(self, batch: DataFrame, before: Row | None) -> float:
        """What sums are taken around: the mean of the first batch that has a reading."""
        if before is not None and before["centre"] is not None:
            return before["centre"]
        return batch.agg(F.avg(F.col(f"`{self.value}`").cast("double"))).first()[0] or 0.0

    def _add_moments(self, windows: DataFrame, batch_id: int, centre: float) -> None:
        """The sums so far with those of this batch: a table of one size in every batch."""
        fresh = windows.select(lags("sequence", self.columns).alias("features"), "target")
        sums = product_sums(fresh, self.inputs, centre)
        past = logs.read_batches(self.spark, self.table("moments"), 0, batch_id - 1)
        if past is not None:
            newest = past.groupBy().agg(F.max("batch_id").alias("newest"))
            past = past.join(F.broadcast(newest), F.col("batch_id") == F.col("newest")).select("i", "j", "total")
            sums = sums.unionByName(past).groupBy("i", "j").agg(F.sum("total").alias("total"))
        logs.append_batch(sums.coalesce(1), self.table("moments"), batch_id, keep=2)

    def _publish(self, version: int, batch_id: int, centre: float) -> bool:
        if self.kind == "additive":
            sums = logs.read_batch(self.spark, self.table("moments"), batch_id)
            model = AdditiveForecaster.of(Moments.none(self.inputs, centre).filled(sums), self.steps, self.columns)
        else:
            history = logs.read_batches(self.spark, self.table("history"), 0, batch_id).drop("batch_id")
            model = fit_forecaster(history, self.value, self.steps, self.kind, columns=self.columns)
        if model is None:
            return False
        logs.append_batch(
            training_runs(self.spark, [model.run]).drop("run"), self.table("runs"), version
        )
        if self.kind == "additive":
            self.registry.save(version, None, batch_id=batch_id, **model.facts())
        else:
            self.registry.save(
                version, model.stages, steps=model.steps, scale=list(model.scale), batch_id=batch_id,
                columns=[[name, list(scale)] for name, scale in model.columns.items()],
            )
        return True

    def forecast_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Forecasts every reading of the batch from the readings before it, then refits.

        There is no forecast until `first_windows` readings had a full window before them (of one
        series that is `steps + first_windows` rows); the model is then fitted on all so far, and
        not before: many short series hold no window at all. Later it is refitted once per batch that
        completes another `refit_every` forecasts.

        The additive model is refitted from the sums of all batches, to which a batch adds its own:
        it costs the same however long the stream has run. Other kinds keep all readings and are
        refitted on them.
        """
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.kind != "additive":
                logs.append_batch(batch, self.table("history"), batch_id)
            before = logs.state_before(self.spark, self.table("progress"), batch_id)
            version = before["version"] if before else None
            centre = self._centre(batch, before)
            windows = self.windows(batch, batch_id, True).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                found = windows.count()
                if version is not None:
                    scored = score_windows(self.load(version), windows)
                    logs.append_batch(
                        scored.withColumns({
                            "clock": clock_text(F.unix_seconds("time")),
                            "tier": alert_tier(F.col("predicted"), self.high, self.medium),
                            "model_version": F.lit(version),
                        }),
                        self.table("predictions"), batch_id,
                    )
                if self.kind == "additive":
                    self._add_moments(windows, batch_id, centre)
            finally:
                windows.unpersist()
            self.store_tail(batch, batch_id)
            self._refit(before, found, batch_id, version, centre)
        finally:
            batch.unpersist()

    def _refit(self, before: Row | None, found: int, batch_id: int, version: int | None, centre: float) -> None:
        """Counters of the batch before decide; they are stored after the model, with its version,
        so that a repeated batch decides the same."""
        windows = (before["windows"] if before else 0) + found
        earlier = before["predictions"] if before else 0
        made = 0 if version is None else found
        if version is None:
            due = windows >= self.first_windows
        else:
            due = (earlier + made) // self.refit_every > earlier // self.refit_every
        if due and self._publish(batch_id + 1, batch_id, centre):
            version = batch_id + 1
        state = self.spark.range(1).select(
            F.lit(windows).cast("bigint").alias("windows"),
            F.lit(earlier + made).cast("bigint").alias("predictions"),
            F.lit(version).cast("int").alias("version"),
            F.lit(centre).cast("double").alias("centre"),
        )
        logs.append_batch(state, self.table("progress"), batch_id, keep=50)
