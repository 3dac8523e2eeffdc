"""Micro-batches of notes and patients.

No operator relates rows of different notes or patients, so each batch goes
through the batch operator unchanged and no state or watermark is kept.  A
batch writes to a folder named by its id and replaces what a failed attempt
left there, so a replay leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.layout import fill_batch
from ..functions.storage import passing_tables
from ..operators.mapping import enrich_notes
from ..operators.models import RiskModels
from ..operators.scoring import summarize_risk
from ..operators.symptoms import symptom_mentions
from ..operators.validate import quarantined_rows, valid_rows, validate_patients

Outputs = Callable[[DataFrame], Mapping[str, DataFrame]]


def run_stream(
    rows: DataFrame, outputs: Outputs, out: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Start a query that writes every output of a batch below ``out``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = fill_batch(batch).persist()
        try:
            with passing_tables(batch.sparkSession, "batch"):
                for name, frame in outputs(held).items():
                    frame.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_phenotypes(
    notes: DataFrame, concepts: DataFrame, keys: Sequence[str], text: str, out: str, checkpoint: str, top_k: int = 3, **run
) -> StreamingQuery:
    """Notes to mentions with negation and ranked concepts, in ``out/mentions``."""
    return run_stream(
        notes, lambda batch: {"mentions": enrich_notes(batch, concepts, keys, text, top_k)}, out, checkpoint, **run
    )


def stream_concepts(
    notes: DataFrame, keys: Sequence[str], text: str, out: str, checkpoint: str, **run
) -> StreamingQuery:
    """Notes to graded, negation-marked symptom mentions, in ``out/mentions``."""
    return run_stream(notes, lambda batch: {"mentions": symptom_mentions(batch, keys, text)}, out, checkpoint, **run)


def stream_risk(
    patients: DataFrame, out: str, checkpoint: str, models: RiskModels | None = None, **run
) -> StreamingQuery:
    """Patients to scores and summaries in ``out/risk``; rejected rows in ``out/quarantine``."""

    def outputs(batch: DataFrame) -> Mapping[str, DataFrame]:
        checked = validate_patients(batch)
        return {
            "risk": summarize_risk(valid_rows(checked), models=models),
            "quarantine": quarantined_rows(checked),
        }

    return run_stream(patients, outputs, out, checkpoint, **run)
