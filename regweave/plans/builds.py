"""End-to-end builds: the registry, the directory and the park grids."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave import schemas, sinks
from regweave.operators.dedupe import merge_by_priority, union_all
from regweave.operators.directory import attach_aliases, drop_shadowing_aliases, link_mirrors, relabel, without_known_hosts
from regweave.operators.documents import combined_document, manifest, network_document, talkgroup_document
from regweave.operators.enrich import attach_activity, attach_nodes, fill_grid
from regweave.operators.guards import GateError, decide, keep_last_good, source_counts
from regweave.operators.history import fold_snapshot, generalise_postal, withhold_unvetted
from regweave.operators.ids import assign_ids, interval_ids, node_child_table
from regweave.operators.normalize import merge_registers
from regweave.operators.prefix import apply_entities
from regweave.operators.spatial import park_grids, park_grids_segregated
from regweave.plans.policy import Policy
from regweave.session import stored
from regweave.sources.registers import REGISTERS


# What says that the cluster failed and not the source: such a build must not go on with fewer sources.
_LOST = re.compile("OutOfMemoryError|No space left|ExecutorLost|FetchFailed|SparkContext was shut down|Connection refused|Disk quota")


def collect_streams(
    readers: dict[str, Callable[[], DataFrame]], include_restricted: bool = False
) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]]]:
    """Read every source on its own; a failing one is reported and left out.

    Each source is stored once, so its failure shows here, and the merge reads columns
    instead of parsing text again.  Lost executors, memory or storage stop the build.  No source at all is an error.
    """
    streams: dict[str, DataFrame] = {}
    report: list[tuple[str, str, str]] = []
    policy = Policy(include_restricted)
    for tag, read in readers.items():
        if not policy.allows(tag):
            report.append((tag, "refused", "restricted"))
            continue
        try:
            streams[tag] = stored(read())
            report.append((tag, "ok", ""))
        except Exception as error:  # any read or parse failure of one source
            if _LOST.search(str(error)):
                raise
            report.append((tag, "skipped", str(error)))
    if not streams:
        raise GateError(f"no source could be read: {report}")
    return streams, report


def register_readers(spark: SparkSession, paths: dict[str, str], synced_at: str | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Readers of the known register adapters for the given paths."""
    return {tag: (lambda tag=tag, path=path: REGISTERS[tag].read(spark, path, synced_at)) for tag, path in paths.items()}


@dataclass
class Lookups:
    """Reference tables of a registry build; absent ones skip their step."""

    postal: DataFrame | None = None
    city: DataFrame | None = None
    entities: DataFrame | None = None
    nodes: DataFrame | None = None
    activity: DataFrame | None = None


@dataclass
class Prior:
    """What the previous build left: history, current ledger, history ledger."""

    history: DataFrame | None = None
    current_ids: DataFrame | None = None
    history_ids: DataFrame | None = None


@dataclass
class Built:
    """Tables of one build."""

    current: DataFrame
    history: DataFrame
    ledger: DataFrame
    history_ledger: DataFrame
    nodes: DataFrame
    report: list[tuple[str, str, str]] = field(default_factory=list)


def build_current(streams: list[DataFrame], lookups: Lookups, include_restricted: bool = False, policy: Policy | None = None) -> DataFrame:
    """Merge, grid fill (before entities, on purpose), entities, nodes, activity.

    Without the opt-in no row of a restricted source is merged and the activity columns stay at their defaults.
    The merge leaves its rows partitioned by callsign and every later join is on that
    column, so the records are shuffled once.
    """
    policy = policy or Policy(include_restricted)
    out = merge_registers([policy.rows(stream) for stream in streams])
    if lookups.postal is not None and lookups.city is not None:
        out = fill_grid(out, lookups.postal, lookups.city)
    if lookups.entities is not None:
        out = apply_entities(out, lookups.entities, clean_keys=True)
    if lookups.nodes is not None:
        out = attach_nodes(out, lookups.nodes, clean_keys=True)
    activity = policy.admit("activity", lookups.activity)
    if activity is not None:
        out = attach_activity(out, activity, clean_keys=True)
    return schemas.conform(out, schemas.RECORD)


def build_registry(streams: list[DataFrame], lookups: Lookups, prior: Prior, as_of: str, include_restricted: bool = False) -> Built:
    """Current records, history, ids and the node child table of one build; what the policy refused is in the report.

    The current table feeds four outputs and is stored once.
    """
    spark = streams[0].sparkSession
    policy = Policy(include_restricted)
    current = stored(build_current(streams, lookups, policy=policy))
    empty = spark.createDataFrame([], schemas.HISTORY)
    old = prior.history if prior.history is not None else empty
    vetted = generalise_postal(withhold_unvetted(schemas.conform(old, schemas.HISTORY), current))
    history = stored(fold_snapshot(vetted, current, as_of))
    no_ids = current.limit(0).withColumn("id", F.lit(None).cast("bigint"))
    no_history_ids = empty.withColumn("id", F.lit(None).cast("bigint"))
    prior_ids = prior.current_ids if prior.current_ids is not None else no_ids
    prior_hist = prior.history_ids if prior.history_ids is not None else no_history_ids
    ledger = assign_ids(current, prior_ids, prior_hist)
    return Built(
        current=current, history=history, ledger=ledger, history_ledger=interval_ids(history, ledger, prior_hist),
        nodes=node_child_table(ledger), report=policy.report,
    )


def write_registry(built: Built, out: str, spark: SparkSession) -> None:
    """Write all tables of a registry build below ``out`` (a new dated folder)."""
    sinks.write_current(built.current, f"{out}/current")
    sinks.write_history(built.history, f"{out}/history")
    sinks.write_ledger(built.ledger, f"{out}/ids_current")
    sinks.write_ledger(built.history_ledger, f"{out}/ids_history")
    sinks.write_nodes_child(built.nodes, f"{out}/nodes")
    if built.report:
        sinks.write_build_report(spark, built.report, f"{out}/report")


@dataclass
class DirectoryInputs:
    """Parsed inputs of a directory build; ``networks`` are rows of the JSON sources."""

    registry: DataFrame | None
    hosts: DataFrame | None
    aliases: DataFrame | None
    networks: list[DataFrame]
    mirrored: DataFrame | None = None


def assemble_directory(inputs: DirectoryInputs) -> DataFrame:
    """Fresh directory rows: standalone hosts by address, aliases, mirror links."""
    parts = []
    if inputs.registry is not None:
        rows = inputs.registry
        if inputs.hosts is not None:
            rows = merge_by_priority([rows, without_known_hosts(inputs.hosts, rows)], "id")
        rows = schemas.conform(rows, schemas.REFLECTOR)
        if inputs.aliases is not None:
            rows = attach_aliases(rows, inputs.aliases)
        parts.append(rows)
    for rows in inputs.networks:
        rows = schemas.conform(rows, schemas.REFLECTOR)
        parts.append(link_mirrors(rows, inputs.mirrored) if inputs.mirrored is not None else rows)
    return drop_shadowing_aliases(union_all(parts))


def build_directory(inputs: DirectoryInputs, previous: DataFrame | None, attempted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Published rows and the decision per network.

    The outputs are made from the rows that are published, not from the fresh ones, so
    a network that keeps its old set is described by that set everywhere.
    """
    fresh = stored(assemble_directory(inputs))
    old = previous if previous is not None else fresh.limit(0)
    decisions = stored(decide(source_counts(old), source_counts(fresh), attempted))
    return stored(relabel(keep_last_good(old, fresh, decisions))), decisions


def write_directory(rows: DataFrame, credits: DataFrame, talkgroups: DataFrame | None, out: str, today: str, rights: str = "",
                    license_url: str = "") -> None:
    """Documents, manifest and flat tables of a directory build."""
    sinks.write_documents(network_document(rows, credits, today, rights, license_url), "network", f"{out}/networks")
    sinks.write_documents(combined_document(rows, credits, today, rights, license_url), "document", f"{out}/combined")
    manifest(rows, today).write.json(f"{out}/manifest")
    sinks.write_reflectors(rows, f"{out}/reflectors")
    if talkgroups is not None:
        sinks.write_documents(talkgroup_document(talkgroups, today), "system", f"{out}/talkgroup_documents")
        sinks.write_talkgroups(talkgroups, f"{out}/talkgroups")


def write_parks(parks: DataFrame, boundaries: DataFrame, open_boundaries: DataFrame | None, out: str, summits: DataFrame | None = None,
                include_restricted: bool = False) -> list[tuple[str, str, str]]:
    """Parks and both grid sets; the share-alike set goes to its own folder, summits are written with the opt-in only.

    Returns (dataset, status, reason) of what was left out.
    """
    policy = Policy(include_restricted)
    sinks.write_parks(parks, f"{out}/parks")
    sinks.write_park_grids(park_grids(parks, boundaries), f"{out}/park_grids")
    if open_boundaries is not None:
        sinks.write_segregated_grids(stored(park_grids_segregated(parks, open_boundaries)), f"{out}/park_grids_osm")
    summits = policy.admit("summits", summits)
    if summits is not None:
        sinks.write_summits(summits, f"{out}/summits")
    return policy.report
