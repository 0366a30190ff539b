"""Batch replay: the three message tables to registry, index and outcomes, without a stream.

Gives the same index as the streaming ingest of the same messages in arrival order.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ..operators import outcomes as O
from ..operators.decode import decode_creations, decode_deletions
from ..operators.index_state import deletion_outcomes, live_rows, stored
from ..operators.routing import create_indices, route_existing, route_missing, seed_system_indices
from ..operators.validate import accepted, rejected, validate_deletions, validate_index_creations
from ..session import settle
from ..streaming.ingest import IngestSettings, ingest_rows, parsed_documents


@dataclass(frozen=True)
class Replay:
    settings: IngestSettings
    documents: DataFrame
    deletions: DataFrame
    creations: DataFrame
    registry: DataFrame

    @property
    def deletes(self) -> DataFrame:
        return accepted(self.deletions)

    @property
    def routed(self) -> DataFrame:
        return route_existing(accepted(self.documents), self.registry)

    @property
    def missing(self) -> DataFrame:
        return route_missing(accepted(self.documents), self.registry)

    def rows(self) -> DataFrame:
        """The change log: every version of every chunk, and marker rows."""
        return ingest_rows(self.routed, self.settings)

    def live(self, replace_document: bool = False) -> DataFrame:
        log = self.rows()
        # replace_document looks at the log twice
        return live_rows(settle(log) if replace_document else log, self.deletes, replace_document)

    def outcomes(self) -> DataFrame:
        # three branches look at the documents: parse them once
        return replace(self, documents=settle(self.documents))._outcomes()

    def _outcomes(self) -> DataFrame:
        # outcomes and the judging of deletions need the keys of rows only
        columns = [*O.MESSAGE_KEY, "index_name", "doc_id", "row_id", "chunk_id", "error", "arrival"]
        rows = settle(self.rows().select(*columns))
        judged = deletion_outcomes(self.deletes, self.registry, stored(rows))
        return O.union_outcomes(
            O.rejected_outcomes(rejected(self.creations)),
            O.creation_outcomes(accepted(self.creations), self.registry),
            O.rejected_outcomes(rejected(self.deletions)),
            O.judged_deletion_outcomes(judged),
            O.rejected_outcomes(rejected(self.documents)),
            O.missing_index_outcomes(self.missing),
            O.document_outcomes(rows),
        )


def registry_of(creations: DataFrame, settings: IngestSettings) -> DataFrame:
    """The registry after all valid creations, settled, as every later step reads it."""
    seeds = seed_system_indices(creations.sparkSession, settings.system_topics, settings.dim)
    return settle(seeds.unionByName(create_indices(seeds, accepted(creations), settings.dim)))


def replay(documents: DataFrame, deletions: DataFrame, creations: DataFrame, settings: IngestSettings) -> Replay:
    parsed = validate_index_creations(decode_creations(creations))
    return Replay(
        settings=settings,
        documents=parsed_documents(documents, settings),
        deletions=validate_deletions(decode_deletions(deletions)),
        creations=parsed,
        registry=registry_of(parsed, settings),
    )
