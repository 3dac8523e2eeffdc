"""Readers and writers; every read names its schema."""

from .tables import (
    read_concept_vectors,
    read_cues,
    read_gold,
    read_notes,
    read_ontology,
    read_patients,
    read_terms,
    write_patients,
    write_report,
    write_terms,
)

__all__ = [
    "read_concept_vectors",
    "read_cues",
    "read_gold",
    "read_notes",
    "read_ontology",
    "read_patients",
    "read_terms",
    "write_patients",
    "write_report",
    "write_terms",
]
