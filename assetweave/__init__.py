"""assetweave: content-message ingest, profiling, reconciliation and status jobs on PySpark."""

from assetweave.session import build_session, materialize, shared_dir

__all__ = ["build_session", "materialize", "shared_dir"]
