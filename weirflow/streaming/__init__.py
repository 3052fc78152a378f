from weirflow.streaming.ingest import apply_batches, ingest, maintain, maintain_partial, redrive
from weirflow.streaming.progress import ProgressTable

__all__ = ["ProgressTable", "apply_batches", "ingest", "maintain", "maintain_partial", "redrive"]
