"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.session import scratch_path
from tableferry.sources.files import delete_path

SLICE_BYTES = 2 << 20


_shipped: set[str] = set()

#: Paths of the tables that ``saved`` wrote and nobody deleted yet.
written: list[str] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    if package.is_dir():
        with tempfile.NamedTemporaryFile(prefix=f"{package.name}-", suffix=".zip", delete=False) as out, zipfile.ZipFile(out, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(out.name)
        atexit.register(Path(out.name).unlink, missing_ok=True)  # executors fetch it from the driver until then
    _shipped.add(context.applicationId)


def saved(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    written.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``saved`` returned, once nothing will read them again."""
    for table in tables:
        delete_path(spark, table._written_at)
        if table._written_at in written:
            written.remove(table._written_at)


def discard_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables of ``saved`` by their paths."""
    for path in list(paths):
        delete_path(spark, path)
        if path in written:
            written.remove(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Begin a collection in the driver, after which Spark deletes the shuffles of frames that nobody holds any more."""
    spark._jvm.java.lang.System.gc()


@contextmanager
def tidy(spark: SparkSession, keep: list[DataFrame]) -> Iterator[None]:
    """Delete the tables that ``saved`` writes inside, but for those in ``keep`` at the end.

    Nothing that leaves the block may still read the others.
    """
    before = set(written)
    yield
    kept = {table._written_at for table in keep}
    discard_paths(spark, [p for p in written if p not in before and p not in kept])


def width(spark: SparkSession) -> int:
    """The session's shuffle width, used wherever an operator names its own number of partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(column: str = "text"):
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class Row:
    """A row's columns on their way through Arrow, with the text only once.

    ``packed`` gives a struct of the other columns and of whether the text is
    null; with a column ``text`` beside it, ``unpacked`` gives all columns back.
    """

    def __init__(self, docs: DataFrame, payload: list[str] | None, text: str):
        self.payload = docs.columns if payload is None else payload
        self.text = text if text in self.payload and isinstance(docs.schema[text].dataType, T.StringType) else None
        self.flag = "no_text"
        while self.flag in self.payload:
            self.flag += "_"
        self.null = F.col(f"`{text}`").isNull()

    def packed(self) -> Column:
        return F.struct(self.null.alias(self.flag), *[F.col(f"`{c}`") for c in self.payload if c != self.text])

    def unpacked(self, row: str = "row", text: str = "text") -> Column:
        own = F.when(~F.col(f"{row}.{self.flag}"), F.col(text))
        return F.struct(*[(own if c == self.text else F.col(f"{row}.`{c}`")).alias(c) for c in self.payload])


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x), x as double; null for a null vector and for one with null or non-finite components.

    What a long cannot hold becomes the largest or smallest long.
    """
    x = vector.cast("array<double>")
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~broken, F.transform(x, lambda c: F.floor(c * scale).cast("long")))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``size`` bytes of ``column`` (at least one row each)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths) - lengths) // size
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of runs that begin at ``starts`` and have ``lengths``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


_kept: dict[object, object] = {}


def kept(name: object, make: Callable[[], object]) -> object:
    """One large object per Python process and kind, such as a tokenizer with its cache.

    Workers outlive their stages, so asking for another kind drops what was kept.
    """
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


class PieceCache:
    """Ids of text pieces that are encoded on their own, kept between batches.

    ``encode`` maps a list of pieces to a list of id sequences. Pieces are told
    apart by Arrow, so Python sees each different one once per batch. Past ``limit``
    pieces the cache keeps the quarter seen most; it never changes a result.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 200_000):
        self.encode, self.limit = encode, limit
        self.slot: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.seen = np.zeros(1 << 12, np.int64)
        self.used = 0

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        return array if need <= len(array) else np.concatenate([array, np.zeros(max(need - len(array), len(array)), array.dtype)])

    def _add(self, pieces: list[str], ids: list) -> None:
        n, sizes = len(self.slot), [len(x) for x in ids]
        self.start, self.size, self.seen = (self._room(x, n + len(pieces)) for x in (self.start, self.size, self.seen))
        self.flat = self._room(self.flat, self.used + sum(sizes))
        end = np.cumsum(np.array(sizes, np.int64)) + self.used
        self.size[n : n + len(pieces)] = sizes
        self.start[n : n + len(pieces)] = end - self.size[n : n + len(pieces)]
        self.seen[n : n + len(pieces)] = 0
        self.flat[self.used : end[-1]] = np.fromiter((x for one in ids for x in one), np.int32, int(end[-1]) - self.used)
        self.used = int(end[-1])
        self.slot.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def _forget(self) -> None:
        pieces, seen = list(self.slot), self.seen[: len(self.slot)]
        keep = [(pieces[s], s) for s in np.argsort(-seen, kind="stable")[: self.limit // 4].tolist() if seen[s] > 1]
        ids = [self.flat[a : a + n].tolist() for a, n in ((int(self.start[s]), int(self.size[s])) for _, s in keep)]
        self.slot, self.used = {}, 0
        if keep:
            self._add([p for p, _ in keep], ids)

    def look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces (an array of strings) in order, and how many ids each piece has."""
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.slot) > self.limit:
            self._forget()
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_pylist()
        if fresh := [p for p in different if p not in self.slot]:
            self._add(fresh, self.encode(fresh))
        at = np.fromiter(map(self.slot.__getitem__, different), np.int64, len(different))[coded.indices.to_numpy()]
        self.seen[: len(self.slot)] += np.bincount(at, minlength=len(self.slot))
        return self.flat[ragged(self.start[at], self.size[at])], self.size[at]

    def look_up_lists(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of lists of pieces, and where each list's ids begin and end."""
        ids, sizes = self.look_up(lists.flatten())
        ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = lists.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]
