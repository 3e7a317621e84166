"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space: space and the range tab .. carriage return.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use in ``body``.

    An expression named inside a lambda is evaluated again for every element;
    a lambda variable is not, so the value goes through a one-element array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return let(F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)),
               lambda t: F.when(t == "", F.array().cast("array<string>"))
               .otherwise(F.split(t, f"[{SPACE}]+")))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def crc_fold(key: Column, folds: int = 3) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null keys: fold of the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def stretches(batches: Iterator[pa.Array], max_bytes: int = 4 << 20) -> Iterator[list]:
    """Values of Arrow batches in lists of about ``max_bytes`` (a longer value is a
    list of its own), so what a worker holds beside a batch stays small."""
    for batch in batches:
        lo = 0
        while lo < len(batch):
            n = len(batch) - lo
            while n > 1 and batch.slice(lo, n).nbytes > max_bytes:
                n = (n + 1) // 2
            yield batch.slice(lo, n).to_pylist()
            lo += n
