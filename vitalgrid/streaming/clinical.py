"""Clinical stream: score unlabelled rows, train on labelled ones in blocks.

All state is in tables keyed by batch id, so a repeated micro-batch replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalgrid.functions.cleaning import binary_label, route_by_label
from vitalgrid.operators.augment import augment_minority
from vitalgrid.operators.classifiers import RiskModel, Sizes, fit_risk_model
from vitalgrid.operators.registry import Registry
from vitalgrid.operators.sequences import blocks, stratified_split
from vitalgrid.schemas import TEXT_CATEGORIES
from vitalgrid.session import materialize
from vitalgrid.sources.messages import decode_clinical, split_corrupt
from vitalgrid.streaming import logs, runtime

# What a fit raises over its rows. Anything else (a lost executor, a full disk) fails the batch,
# which is then repeated.
DATA_ERRORS = (ValueError, IllegalArgumentException)
# Batches for which the state of a stream is kept: the newest counts, older ones are for repeats.
STATES = 50
# Model versions that are kept.
VERSIONS = 20
NUMERIC = ["age", "trestbps", "chol", "fbs", "thalch", "exang", "oldpeak", "ca"]


@dataclass
class ClinicalStream:
    """Tables of one deployment under `folder`, and the two micro-batch handlers."""

    spark: SparkSession
    folder: str
    block_rows: int = 5
    incremental: bool = False
    sizes: Sizes = field(default_factory=Sizes)
    registry: Registry = field(init=False)

    def __post_init__(self):
        self.registry = Registry(self.spark, f"{self.folder}/registry", keep=VERSIONS)
        self._loaded: tuple[int, RiskModel] | None = None

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str) -> DataFrame | None:
        return logs.read_log_or_none(self.spark, self.table(name))

    # Routing ---------------------------------------------------------------------------------

    def parse(self, messages: DataFrame) -> DataFrame:
        return decode_clinical(messages)

    def start_dual(
        self, messages: DataFrame, score_every: str | None = None, train_every: str | None = None
    ) -> list[StreamingQuery]:
        """Two queries with their own triggers and checkpoints on one parsed stream."""
        to_score, to_train = route_by_label(split_corrupt(self.parse(messages))[0])
        return [
            runtime.start(to_score, self.score_batch, self.table("checkpoints/score"), score_every),
            runtime.start(to_train, self.train_batch, self.table("checkpoints/train"), train_every),
        ]

    def route_batch(self, batch: DataFrame, batch_id: int) -> None:
        """One query for both routes: rows to score, rows to train on, malformed rows."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_corrupt(batch)
            to_score, to_train = route_by_label(good)
            logs.append_batch(to_score, self.table("to_score"), batch_id)
            logs.append_batch(to_train, self.table("to_train"), batch_id)
            logs.append_batch(bad, self.table("quarantine"), batch_id)
        finally:
            batch.unpersist()

    # Scoring ---------------------------------------------------------------------------------

    def score_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Holds the batch, which several writes read, and scores it."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._score(batch, batch_id)
        finally:
            batch.unpersist()

    def _score(self, batch: DataFrame, batch_id: int) -> None:
        """Scores the batch and rows that arrived before there was a model.

        Without a model the rows wait in `pending`. The newest complete version is read once per
        batch, so a model that is published meanwhile serves the next one.
        """
        version = self.registry.latest()
        if version is None:
            logs.append_batch(batch, self.table("pending"), batch_id)
            return
        rows = batch
        drained = logs.state_before(self.spark, self.table("drained"), batch_id)
        since = -1 if drained is None else drained["upto"]
        waiting = logs.read_batches(self.spark, self.table("pending"), since + 1, batch_id - 1)
        if waiting is not None:
            rows = rows.unionByName(waiting.drop("batch_id"))
        scored = self._model(version).score(rows, "id")
        logs.append_batch(
            scored.withColumn("model_version", F.lit(version)), self.table("predictions"), batch_id
        )
        mark = self.spark.range(1).select(F.lit(batch_id).alias("upto"))
        logs.append_batch(mark, self.table("drained"), batch_id, keep=STATES)

    def _model(self, version: int) -> RiskModel:
        """A version, read from the folder once as long as it is the newest."""
        if self._loaded is None or self._loaded[0] != version:
            stages, preprocessor = self.registry.load(version)
            self._loaded = version, RiskModel(preprocessor, stages)
        return self._loaded[1]

    # Training --------------------------------------------------------------------------------

    def _state_before(self, batch_id: int) -> tuple[int, DataFrame | None]:
        """Blocks cut so far and the rows left over, as of the newest earlier batch."""
        last = logs.state_before(self.spark, self.table("blocks_done"), batch_id)
        if last is None:
            return 0, None
        return last["blocks"], logs.read_batch(self.spark, self.table("remainder"), last["batch_id"])

    def train_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Holds the batch, which counts and writes read, and trains on its full blocks."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._train(batch, batch_id)
        finally:
            batch.unpersist()

    def _train(self, batch: DataFrame, batch_id: int) -> None:
        """Cuts the new rows, with the rest of the last batch in front, into full blocks, and
        refits on them; rows that fill no block wait.

        Order is `(arrival batch, id)`. All full blocks of a batch are used at once: every block
        is in exactly one fit.
        """
        arrived = batch.withColumn("arrival", F.lit(batch_id).cast("bigint"))
        first, waiting = self._state_before(batch_id)
        rows = arrived if waiting is None else waiting.select(*arrived.columns).unionByName(arrived)

        ordered = rows.withColumn("_order", F.col("arrival"))
        cut = blocks(ordered, self.block_rows, "_order", "id", full_only=False).drop("_order")
        full = int(rows.count() // self.block_rows)
        taken = cut.filter(F.col("block") < full).withColumn("block", F.col("block") + first)
        logs.append_batch(taken, self.table("blocks"), batch_id)
        logs.append_batch(cut.filter(F.col("block") >= full).drop("block"), self.table("remainder"), batch_id, keep=STATES)
        logs.append_batch(
            self.spark.range(1).select(F.lit(first + full).cast("bigint").alias("blocks")),
            self.table("blocks_done"), batch_id, keep=STATES,
        )
        if full:
            self.fit(batch_id)

    def fit(self, batch_id: int) -> None:
        """Model from the blocks of this batch, or from all so far; published as version
        `batch_id + 1`. Blocks that cannot be fitted go to `failed_blocks`."""
        blocks_log = self.table("blocks")
        fresh = logs.read_batch(self.spark, blocks_log, batch_id)
        chosen = logs.read_batches(self.spark, blocks_log, 0, batch_id).drop("batch_id") if self.incremental else fresh
        earlier = self.registry.latest(before=batch_id + 1)
        rows = (
            chosen.drop("arrival", "block")
            .withColumn("label", binary_label(F.col("num")))
            .withColumns({c: F.col(c).cast("double") for c in NUMERIC})
        )
        try:
            if earlier is None:
                rows = augment_minority(rows, seed=42).drop("synthetic")
                model = fit_risk_model(rows, NUMERIC, TEXT_CATEGORIES, sizes=self.sizes)
            else:
                _, preprocessor = self.registry.load(earlier)
                model = fit_risk_model(
                    rows, NUMERIC, TEXT_CATEGORIES, preprocessor=preprocessor, sizes=self.sizes
                )
        except DATA_ERRORS as error:  # the stream goes on with the version it has
            logs.append_batch(
                fresh.withColumn("reason", F.lit(str(error)[:500])),
                self.table("failed_blocks"), batch_id,
            )
            return
        self.registry.save(
            batch_id + 1, model.stages, model.preprocessor,
            mode="initial" if earlier is None else "incremental" if self.incremental else "retrain",
            batch_id=batch_id,
        )


def initial_training(
    spark: SparkSession, df: DataFrame, registry: Registry, sizes: Sizes = Sizes(),
    evaluate: Callable[[DataFrame], None] | None = None,
) -> int:
    """First version from a labelled table, before any stream runs."""
    rows = df.withColumn("label", binary_label(F.col("num"))).withColumns(
        {c: F.col(c).cast("double") for c in NUMERIC}
    )
    # The split reads the rows three times and every fitted statistic again; they are decoded once and split once.
    split = materialize(stratified_split(materialize(rows, "decoded"), "label", "id"), "initial")
    model = fit_risk_model(
        split.filter("part = 'train'").drop("part"), NUMERIC, TEXT_CATEGORIES, sizes=sizes
    )
    if evaluate is not None:
        evaluate(model.score(split.filter("part = 'test'").drop("part"), "id", "label"))
    return registry.save((registry.latest() or 0) + 1, model.stages, model.preprocessor, mode="initial")
