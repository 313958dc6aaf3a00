from . import constants, text, vectors

__all__ = ["constants", "text", "vectors"]
