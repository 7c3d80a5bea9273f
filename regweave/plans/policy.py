"""Opt-in policy of a build: what may not be passed on stays out unless the caller asks for it.

One policy goes with a build from the choice of sources to the last sink.  Sources are named by their tag, which
every record carries, so rows of a restricted source are also stopped when they come in some other way; whole datasets are
named by what they add.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.functions.labels import RESTRICTED_DATASETS, RESTRICTED_SOURCES
from regweave.operators.guards import GateError


@dataclass
class Policy:
    """``include_restricted`` opens everything; ``report`` collects (name, status, reason) of what was left out."""

    include_restricted: bool = False
    report: list[tuple[str, str, str]] = field(default_factory=list)

    def allows(self, name: str) -> bool:
        """Is a source or dataset free to use in this build."""
        return self.include_restricted or name not in (*RESTRICTED_SOURCES, *RESTRICTED_DATASETS)

    def admit(self, name: str, data: DataFrame | None) -> DataFrame | None:
        """A dataset if it may be used, else none, which is reported."""
        if data is None or self.allows(name):
            return data
        entry = (name, "refused", "restricted")
        if entry not in self.report:
            self.report.append(entry)
        return None

    def rows(self, records: DataFrame, column: str = "source") -> DataFrame:
        """Records without those of restricted sources; rows without a source are kept."""
        if self.include_restricted:
            return records
        return records.filter(F.col(column).isNull() | ~F.col(column).isin(*RESTRICTED_SOURCES))

    def choose(self, known: Iterable[str], wanted: Iterable[str] | None = None) -> list[str]:
        """Sources to read: all that are allowed, or those asked for by name; a refused or unknown name is an error."""
        known = list(known)
        if wanted is None:
            return [tag for tag in known if self.allows(tag)]
        wanted = list(wanted)
        if unknown := [tag for tag in wanted if tag not in known]:
            raise GateError(f"unknown source(s): {', '.join(unknown)}")
        if refused := [tag for tag in wanted if not self.allows(tag)]:
            raise GateError(f"{', '.join(refused)}: restricted; opt in to read it and keep the output to yourself")
        return wanted
