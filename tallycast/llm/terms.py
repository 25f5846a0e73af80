"""Terms of whole texts as Arrow arrays: runs of bytes of a kind, A-Z lowered, compared byte by byte."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallycast.llm.batches import text_bytes
from tallycast.llm.words import LOWER

BYTES = np.arange(256)
# Letters are A-Z, a-z and every byte of a character beyond ASCII.
LETTERS = (BYTES >= 0x80) | ((BYTES >= 0x41) & (BYTES <= 0x5A)) | ((BYTES >= 0x61) & (BYTES <= 0x7A))
LETTERS_DIGITS = LETTERS | ((BYTES >= 0x30) & (BYTES <= 0x39))


def terms_of(texts: pa.LargeStringArray, inside: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The terms of all texts in order, and offsets: terms ``offsets[i]`` to ``offsets[i + 1]`` are those of text i."""
    data, text_starts = text_bytes(texts)
    kept = inside[data]
    first = kept.copy()
    first[1:] &= ~kept[:-1]
    heads = text_starts[:-1][text_starts[:-1] < len(data)]
    first[heads] = kept[heads]
    chars = LOWER[data[kept]]
    starts = np.append(np.flatnonzero(first[kept]), len(chars)).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(chars))
    return terms, np.searchsorted(np.flatnonzero(first), text_starts)
