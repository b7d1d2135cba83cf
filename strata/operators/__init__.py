from . import ingest, quality, views

__all__ = ["ingest", "quality", "views"]
