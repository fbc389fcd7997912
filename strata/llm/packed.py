"""Findings on their way back to documents, packed: one row for each pair of buckets, then one for each document."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

from strata.llm import textbatch as tb

DEALT = "to int, doc binary, found binary"
GATHERED = "doc_id long, found binary"


def runs(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    if not len(sorted_keys):
        return []
    cut = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return list(zip(cut.tolist(), [*cut[1:].tolist(), len(sorted_keys)], strict=True))


def deal(doc: np.ndarray, found: np.ndarray, buckets: int) -> pd.DataFrame:
    """Rows of ``found`` and their documents, packed by the documents' bucket."""
    to = (tb.mix(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    to, doc, found = to[order], doc[order], found[order]
    parts = runs(to)
    return pd.DataFrame({"to": np.array([to[i] for i, _ in parts], np.int32),
                         "doc": [doc[i:j].tobytes() for i, j in parts],
                         "found": [found[i:j].tobytes() for i, j in parts]})


def gather(kind: type, width: int = 1) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of one bucket of documents: each document's findings in one row."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc = np.frombuffer(b"".join(pdf["doc"]), np.int64)
        found = np.frombuffer(b"".join(pdf["found"]), kind).reshape(-1, width)
        order = np.argsort(doc, kind="stable")
        doc, found = doc[order], found[order]
        parts = runs(doc)
        return pd.DataFrame({"doc_id": np.array([doc[i] for i, _ in parts], np.int64),
                             "found": [found[i:j].tobytes() for i, j in parts]})

    return run
