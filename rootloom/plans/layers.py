"""The layers of one corpus, each computed once from the one before.

Entries and their lines are each read once, and lines meet their entry in one join and one grouping. A layer is written to the checkpoint
folder when something first asks for it and is read from there afterwards; the files go with the object (see ``held``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from rootloom.functions import strip_ws
from rootloom.operators import body, claimgraph, concepts, evidence, origins
from rootloom.rules.model import DiscoursePack, Profile
from rootloom.session import held


class Layers:
    """``corrected``: entries with corrected chapters; ``lines``: scanned lines; profiles: of roots and of initials."""

    def __init__(self, corrected: DataFrame, lines: DataFrame, pack: DiscoursePack, lookup: Profile, initial: Profile):
        self._corrected, self._lines, self.pack, self.lookup, self.initial = corrected, lines, pack, lookup, initial

    @cached_property
    def entries(self) -> DataFrame:
        return held(self._corrected)

    @cached_property
    def _read(self) -> DataFrame:
        """Per entry: segments of its body, and what the source layer asks of its texts (whether they are empty)."""
        wide = evidence.source_evidence(self.entries, self._lines, self.pack, with_body=True)
        return held(body.segment_arrays(wide, self.pack).select(
            "entry_id", "segments", "boundary_pos", "ocr_confidence", "coverage_state",
            F.substring(strip_ws(F.col("body_text")), 1, 1).alias("body_text"),
            F.substring("human_corrected_text", 1, 1).alias("human_corrected_text")))

    @cached_property
    def claims(self) -> DataFrame:
        return held(claimgraph.extract_claims(body.segment_rows(self._read), self.pack))

    @cached_property
    def origins(self) -> DataFrame:
        return held(origins.origins(self.entries, self._read.select("entry_id", "boundary_pos"), self.pack))

    @cached_property
    def branches(self) -> DataFrame:
        return held(origins.branches(self.claims, self.origins, self.pack))

    @cached_property
    def references(self) -> DataFrame:
        refs = origins.resolve_cross_refs(origins.cross_refs(self.claims, self.pack), self.entries, self.lookup)
        return held(origins.reference_edges(refs, self.entries, self.lookup))

    @cached_property
    def conflicts(self) -> DataFrame:
        return held(origins.entry_conflicts(self.references))

    @cached_property
    def bundles(self) -> DataFrame:
        """Source bundles with the residuals of later layers."""
        return held(evidence.with_conflicts(evidence.source_bundles(self.entries, self._read, self.pack, self.initial), self.conflicts))

    @cached_property
    def gate(self) -> DataFrame:
        return held(concepts.ontology_gate(self.bundles, self.origins))

    @cached_property
    def concepts(self) -> DataFrame:
        return concepts.concepts(self.origins, self.branches, self.bundles, self.gate, self.pack)
