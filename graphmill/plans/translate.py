"""Translation (P1, P2): a source and its mapping specs become staged frames per key."""

from __future__ import annotations

from typing import Protocol, Sequence

from pyspark.sql import DataFrame

from graphmill.model import EDGES_INGEST, NODES_INGEST, EdgeMapping, NodeMapping

StagingKey = tuple[str, str, str]  # (job_name, operation, arguments)


class Translator(Protocol):
    """``DataFrame -> {staging key: [DataFrame]}``."""

    def translate(self, data: DataFrame, model, translation_id: str) -> dict[StagingKey, list[DataFrame]]: ...


class MappingTranslator:
    """The built-in translator; the model is a list of ``NodeMapping`` / ``EdgeMapping``.

    Each mapping compiles to one ``select`` (plus its optional filter) over the source, so Catalyst prunes
    the source columns to those the mappings use and pushes the filters into the scan.
    """

    def translate(self, data: DataFrame, model: Sequence[NodeMapping | EdgeMapping], translation_id: str) -> dict[StagingKey, list[DataFrame]]:
        out: dict[StagingKey, list[DataFrame]] = {}
        for m in model:
            op = NODES_INGEST if isinstance(m, NodeMapping) else EDGES_INGEST
            out.setdefault((translation_id, op, m.arguments), []).append(m.apply(data))
        return out


class IdentityTranslator:
    """Every row of the source becomes a node of one label (``MockPerson`` in the reference tests)."""

    def __init__(self, label: str = "MockPerson"):
        self.label = label

    def translate(self, data: DataFrame, model, translation_id: str) -> dict[StagingKey, list[DataFrame]]:
        return {(translation_id, NODES_INGEST, self.label): [data.select("*")]}
