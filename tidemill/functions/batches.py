"""Arrow batches of texts, cut into slices of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in order, in slices of about ``most`` bytes, one text at least.

    Spark cuts batches by rows, so their bytes grow with the texts.  Python
    objects made for one slice are gone before the next is taken.
    """
    if not len(texts):
        yield texts
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield texts.slice(start, end - start)
