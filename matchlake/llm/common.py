"""Small helpers that the corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


# Characters of texts that a worker handles at once.
SLICE_CHARS = 1_000_000


def slices(batches: Iterable[pa.Array]) -> Iterator[list[str | None]]:
    """The texts of Arrow batches in runs of about SLICE_CHARS characters, or of one text."""
    for batch in batches:
        run, size = [], 0
        for text in batch:
            run.append(text.as_py())
            size += len(run[-1] or "")
            if size >= SLICE_CHARS:
                yield run
                run, size = [], 0
        if run:
            yield run


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


class Recent(dict):
    """Results of `compute` by text, kept while they are in use.

    When more than `size` are kept, they become the old ones, and come back one by one as they are asked
    for; what was old before goes. Results for texts longer than `longest` are not kept.
    """

    def __init__(self, compute: Callable[[str], bytes], size: int, longest: int):
        self.compute, self.size, self.longest = compute, size, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        if found is None:
            found = self.compute(text)
        if len(text) <= self.longest:
            self[text] = found
        return found

    def age(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
