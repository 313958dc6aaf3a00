from . import files, store

__all__ = ["files", "store"]
