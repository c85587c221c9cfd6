"""quirebase: document ingestion and retrieval as Spark DataFrame jobs."""

from quirebase.session import build_session, load

__all__ = ["build_session", "load"]
