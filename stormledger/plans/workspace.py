"""Where a run keeps its tables, views and models, and what each of them was built from."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..config import Config
from ..operators.models import load_model
from ..sources.tables import write_table


@dataclass(frozen=True)
class Step:
    """One target of a run. Tables and models are stored; views stay lazy."""

    name: str
    kind: str  # "table", "view" or "model"
    build: Callable[[Workspace], DataFrame | PipelineModel]
    save: Callable[[DataFrame, str], None] = write_table
    drop: tuple[str, ...] = ()
    # Whether a plan exists before the run, i.e. without a trained model.
    plannable: bool = True
    # Whether the session also gets a view of the stored table.
    shown: bool = False


@dataclass(frozen=True)
class Mark:
    """The build of a stored target: its id, the settings, and the ids of the builds it was made from."""

    build: str
    settings: str
    inputs: dict[str, str]


def write_mark(spark: SparkSession, root: str, name: str, settings: str, inputs: dict[str, str]) -> Mark:
    """Record a finished build under a new id."""
    mark = Mark(uuid.uuid4().hex, settings, inputs)
    row = [(json.dumps(mark.__dict__, sort_keys=True),)]
    spark.createDataFrame(row, "mark string").coalesce(1).write.mode("overwrite").text(f"{root}/_built/{name}")
    return mark


def read_mark(spark: SparkSession, root: str, name: str) -> Mark | None:
    try:
        row = spark.read.text(f"{root}/_built/{name}").first()
    except AnalysisException:
        return None
    return Mark(**json.loads(row[0])) if row is not None and row[0] != "{}" else None


def erase_mark(spark: SparkSession, root: str, name: str) -> None:
    """Until the target is finished anew, it counts as not built."""
    spark.createDataFrame([("{}",)], "mark string").coalesce(1).write.mode("overwrite").text(f"{root}/_built/{name}")


@dataclass
class Workspace:
    spark: SparkSession
    cfg: Config
    root: str
    forecasts: DataFrame | None = None
    # Names the content of `forecasts`; whoever passes other forecasts names them otherwise.
    forecasts_id: str = ""
    steps: dict[str, Step] = field(default_factory=dict)
    views: dict[str, DataFrame] = field(default_factory=dict)
    # In a dry run nothing is stored, so a missing table is planned from its own inputs.
    dry: bool = False
    _marks: dict[str, Mark | None] = field(default_factory=dict)
    _view_inputs: dict[str, dict[str, str]] = field(default_factory=dict)
    # Builds read by the targets being built, innermost last.
    _reading: list[dict[str, str]] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _current(self, name: str) -> Mark | None:
        if name not in self._marks:
            self._marks[name] = read_mark(self.spark, self.root, name)
        return self._marks[name]

    def _note(self, inputs: dict[str, str]) -> None:
        if self._reading:
            self._reading[-1].update(inputs)

    def _stored(self, name: str) -> dict[str, str]:
        mark = self._current(name)
        return {name: mark.build if mark else "unknown"}

    def read(self, name: str) -> DataFrame:
        drop = self.steps[name].drop if name in self.steps else ()
        self._note(self._stored(name))
        return self.spark.read.parquet(self.path(name)).drop(*drop)

    def get(self, name: str) -> DataFrame:
        """A table by name, or a view, planned on first use."""
        step = self.steps.get(name)
        if step is None or (step.kind == "table" and not self.dry):
            return self.read(name)
        if name not in self.views:
            self.views[name], self._view_inputs[name] = self.built(step)
        self._note(self._view_inputs.get(name, {}))
        return self.views[name]

    def scan(self) -> DataFrame:
        self._note({"forecasts": self.forecasts_id})
        return self.forecasts

    def model(self, key: str) -> PipelineModel:
        self._note(self._stored(f"model_{key}"))
        return load_model(self.path(f"model_{key}"))

    def built(self, step: Step) -> tuple[DataFrame | PipelineModel, dict[str, str]]:
        """What a step makes, and the builds of the stored targets it read, also through views."""
        self._reading.append({})
        try:
            return step.build(self), self._reading[-1]
        finally:
            self._reading.pop()

    def erase(self, name: str) -> None:
        erase_mark(self.spark, self.root, name)
        self._marks[name] = None

    def mark(self, name: str, inputs: dict[str, str]) -> None:
        self._marks[name] = write_mark(self.spark, self.root, name, self.cfg.fingerprint(), inputs)

    def is_built(self, name: str) -> bool:
        """Whether a target is finished, under the present settings and from the present builds of its inputs."""
        mark = self._current(name)
        if mark is None or mark.settings != self.cfg.fingerprint():
            return False
        now = {i: self.forecasts_id if i == "forecasts" else self._stored(i)[i] for i in mark.inputs}
        return now == mark.inputs
