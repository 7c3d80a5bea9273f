"""Publishing datasets behind gates that are measured by the write itself.

Every gate is an aggregate over the rows being written (``DataFrame.observe``) and a rule on its value, so no gate costs a
job of its own.  Datasets are written to folders nobody names yet; when all are measured, one manifest names the
folder to use of each: the new one where its gates hold, else the one before.  A build whose datasets all fail is not
published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regweave.manifests import ManifestLog
from regweave.operators.guards import COUNT_SLACK, SHRINK_GUARD, GateError, require_columns


@dataclass(frozen=True)
class Gate:
    """A named rule on measured values: ``rule`` gets them and what the last publication measured, and returns a reason to refuse."""

    name: str
    values: dict[str, Column]
    rule: Callable[[dict, dict], str | None]


def only_source(allowed: str) -> Gate:
    """Every row stems from one source."""
    bad = F.when(~F.col("source").eqNullSafe(F.lit(allowed)), F.coalesce("source", F.lit("none")))
    return Gate("only_source", {"foreign": F.count(bad), "first_foreign": F.min(bad)},
                lambda v, _: f"{v['foreign']} rows of {v['first_foreign']}" if v["foreign"] else None)


def floor(least: int) -> Gate:
    """At least so many rows."""
    return Gate("floor", {}, lambda v, _: f"{v['rows']} rows, expected {least}" if v["rows"] < least else None)


def all_present(column: str, expected: list[str]) -> Gate:
    """A row for each of the expected values."""
    counts = {f"with_{x}": F.count_if(F.col(column) == x) for x in expected}
    return Gate("all_present", counts, lambda v, _: f"missing {', '.join(x for x in expected if not v[f'with_{x}'])}" if any(not v[f"with_{x}"] for x in expected) else None)


def shaped(column: str, pattern: str) -> Gate:
    """Every value of a column has a shape; nulls have none."""
    return Gate("shaped", {f"odd_{column}": F.count_if(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))},
                lambda v, _: f"{v[f'odd_{column}']} values of {column}" if v[f"odd_{column}"] else None)


def rejected_share(flag: str, most: float) -> Gate:
    """At most this share of the rows is flagged."""
    return Gate("rejected_share", {"rejected": F.count_if(F.col(flag))},
                lambda v, _: f"{v['rejected']} of {v['rows']} rows rejected" if v["rejected"] > most * v["rows"] else None)


def declared(count: int, slack: float = 0.0) -> Gate:
    """The publisher's own count, exactly or within a share of it and ten rows."""
    return Gate("declared", {}, lambda v, _: f"{v['rows']} rows, {count} declared"
                if abs(v["rows"] - count) > (max(COUNT_SLACK, slack * count) if slack else 0) else None)


def not_shrunk(share: float = SHRINK_GUARD) -> Gate:
    """Not fewer rows than this share of the last publication."""
    return Gate("not_shrunk", {}, lambda v, old: f"{v['rows']} rows, {old['rows']} before" if old and v["rows"] < share * old["rows"] else None)


@dataclass
class Dataset:
    """What to publish under a name: how to get the rows, columns they must have, and the gates they pass."""

    name: str
    read: Callable[[], DataFrame]
    gates: list[Gate]
    required: tuple[str, ...] = ()


class Publication:
    """Published datasets below one folder of a file system that all executors reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.log = ManifestLog(spark, f"{self.root}/manifest")

    def publish(self, datasets: list[Dataset]) -> list[tuple[str, str, str]]:
        """Write, measure and name the datasets; returns (dataset, status, reason) of each.

        ``published``: the new rows are in use; ``kept``: a gate refused them or they could not be made, the last ones
        stay; ``missing``: as before, but there are none.  Nothing is committed if no dataset is published.
        """
        version = self.log.newest()
        before = self.log.read(version).get("datasets", {})
        now, report = dict(before), []
        for data in datasets:
            old = before.get(data.name)
            try:
                values, folder = self._write(data)
                reasons = [f"{g.name}: {r}" for g in data.gates if (r := g.rule(values, old["values"] if old else {}))]
            except GateError as error:
                reasons = [str(error)]
            if reasons:
                report.append((data.name, "kept" if old else "missing", "; ".join(reasons)))
            else:
                now[data.name] = {"folder": folder, "values": values}
                report.append((data.name, "published", ""))
        if not any(status == "published" for _, status, _ in report):
            raise GateError(f"nothing to publish: {report}")
        self.log.commit(version + 1, {"datasets": now, "report": report})
        return report

    def _write(self, data: Dataset) -> tuple[dict, str]:
        rows = require_columns(data.read(), list(data.required), data.name)
        measures = {"rows": F.count(F.lit(1))} | {k: v for g in data.gates for k, v in g.values.items()}
        seen, folder = Observation(), f"{data.name}/{uuid.uuid4().hex}"
        rows.observe(seen, *[v.alias(k) for k, v in measures.items()]).write.parquet(f"{self.root}/{folder}")
        return dict(seen.get), folder

    def read(self, name: str) -> DataFrame:
        """The dataset in use."""
        return self.spark.read.parquet(f"{self.root}/{self.log.read()['datasets'][name]['folder']}")

    def report(self) -> DataFrame:
        """The report of the last publication."""
        return self.spark.createDataFrame([tuple(r) for r in self.log.read()["report"]], "dataset string, status string, reason string")
