"""The batch operators over arriving rows."""

from .micro_batches import run_stream, stream_concepts, stream_phenotypes, stream_risk

__all__ = ["run_stream", "stream_concepts", "stream_phenotypes", "stream_risk"]
