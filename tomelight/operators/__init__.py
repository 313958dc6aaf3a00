from . import (
    chunking,
    classify,
    contextual,
    corpus,
    joins,
    overlap,
    positions,
    retrieval,
    sparse,
    summarize,
    topk,
    words,
)

__all__ = [
    "chunking",
    "classify",
    "contextual",
    "corpus",
    "joins",
    "overlap",
    "positions",
    "retrieval",
    "sparse",
    "summarize",
    "topk",
    "words",
]
