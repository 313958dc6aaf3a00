from . import jobs

__all__ = ["jobs"]
