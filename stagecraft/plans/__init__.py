"""Jobs built from the operators: the ingest run."""

from .ingest import IngestRun, RunSummary, check_parameters, file_ingest

__all__ = ["IngestRun", "RunSummary", "check_parameters", "file_ingest"]
