"""Classes and shingle sets of texts, computed in tasks over Arrow batches."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Sequence

from pyspark import cloudpickle


_SEED = 42


def split_bytes(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; null has none."""
    return (text or b"").lower().split()


def class_digest(words: list[bytes]) -> bytes:
    """Digest of a text's words: equal for texts that differ in white space and case only."""
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


def shingle_hashes(words: list[bytes], size: int):
    """Hashes of the distinct shingles, those of Spark's ``xxhash64``. Fewer words than a shingle are one; no
    words give none."""
    import numpy as np
    import xxhash

    if len(words) > size:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    else:
        shingles = [b" ".join(words)] if words else []
    found = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), dtype=np.uint64)
    return np.unique(found).view(np.int64)


def task(order: Sequence[str], size: int | None = None):
    """Function of a task over the ``order`` columns and the bytes of ``content``: the order columns, ``class``
    and, with a ``size`` of shingles, ``shingles``."""
    names = [*order, "class", *(["shingles"] if size else [])]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            classes, sets = [], []
            for text in batch.column("content"):
                words = split_bytes(text.as_py())
                classes.append(class_digest(words))
                if size:
                    sets.append(shingle_hashes(words, size))
            columns = [*map(batch.column, order), pa.array(classes, pa.binary())]
            if size:
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = np.concatenate([*sets, np.zeros(0, np.int64)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
