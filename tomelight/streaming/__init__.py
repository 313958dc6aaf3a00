from . import ingest

__all__ = ["ingest"]
