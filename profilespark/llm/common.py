"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
#: The same as a regular expression that Java, Python and RE2 read alike.
WHITE_RE = r"[\x20\x09-\x0D]"


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text, a null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of other characters than white space, in order."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WHITE_RE + "+")).otherwise(F.array().cast("array<string>"))


def count_of(text: Column, characters: str) -> Column:
    """How many characters of the text are among the given ones."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


#: Rows whose texts a task holds as Python objects at a time.
ROWS_AT_A_TIME = 256


def small_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few hundred."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
            yield batch.slice(at, ROWS_AT_A_TIME)


_SHIPPED: set[str] = set()


def _ship_package(sc: SparkContext) -> None:
    """Sends this package's modules to the executors, once per application, so that tasks can import them."""
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # read by the driver alone, which serves it to the executors
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def release_memory() -> None:
    """Gives memory that Arrow and the C library hold for later back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def map_arrow(rows: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` of a function of this package.

    Spark keeps workers from stage to stage beside the executor's heap, so a task that ends releases what it freed.
    """
    _ship_package(rows.sparkSession.sparkContext)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release_memory()

    return rows.mapInArrow(released, schema)
