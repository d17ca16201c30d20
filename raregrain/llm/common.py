"""What the operators share: the registry, input tables, and files in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import materialise, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its oracle text."""
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def crc32_sql(text: str, tab: str) -> str:
    """The unsigned CRC-32 of a string's UTF-8 bytes as a SQL expression; ``tab`` is the list ``crc32_sql.table``."""
    data = (f"list_transform(range(0, octet_length(encode({text}))), "
            f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)")
    return (f"xor(list_reduce([4294967295::BIGINT] || {data}, "
            f"lambda c, b: xor(c >> 8, {tab}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


crc32_sql.table = ("list_transform(range(256), lambda i: list_reduce([i::BIGINT] || repeat([0::BIGINT], 8), "
                   "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, so that extra input columns never clash."""
    name, taken = f"__{stem}", {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 22}


def bounded_batches(spark: SparkSession) -> None:
    """Send texts to Python in small batches: Spark's 10,000 rows of text fill an executor's memory.

    Smaller settings of the session stay.
    """
    for name, most in BATCH.items():
        now = spark.conf.get(name).rstrip("bB")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:
            spark.conf.set(name, most)


_HELD: dict[str, dict] = {}


def worker_memory(owner: str) -> dict:
    """A dictionary that the tasks of an operator share while a Python worker stays in use for it."""
    return _HELD.setdefault(owner, {})


def begin(owner: str) -> None:
    """Called where a task starts: what tasks of other operators left in a reused worker is given back.

    So the stages of a pipeline do not add up.
    """
    others = [held for name, held in _HELD.items() if name != owner and held]
    for held in others:
        held.clear()
    if others:
        gc.collect()
    give_back()


def give_back() -> None:
    """Return free memory to the system; also called where a task ends, as its worker may stay idle for long."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions: the one knob that says how wide the work is dealt out."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared store, usable in the driver and in tasks."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def shared_uri(spark: SparkSession) -> str:
    """A new folder name under the shared folder, as a URI."""
    path = scratch_path(spark)
    if "://" in path:
        return path
    return path.replace("file:", "file://", 1) if path.startswith("file:/") else f"file://{path}"


def write_atomically(fs: pafs.FileSystem, path: str, chunks) -> None:
    """Write the byte chunks to a private name, then move it: a retried or doubled task leaves one whole file."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(part, path)


def from_files(docs: DataFrame) -> DataFrame:
    """``docs`` itself if each row still knows its place in a file, else a stored copy that does.

    Operators that visit the rows twice name a row's place by its file and row number;
    only a bare scan of Parquet files has them.
    """
    try:
        docs.select("_metadata.row_index")
    except Exception:  # the analyser knows no such column: not a plain scan
        return materialise(docs)
    return docs


SPLIT_ROWS = 1 << 13  # rows of a file that share a key


def split_key() -> "F.Column":
    """The stretch of its file that a row is in: the same for every visit.

    Spark's own splits are not: their size follows the cores that are there when a scan starts.
    So the rows of one key may be in several tasks.
    """
    return F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / SPLIT_ROWS))


def ordered_cuts(df: DataFrame, column: str, parts: int) -> list:
    """At most ``parts`` - 1 cut values that deal the rows out evenly in the order of ``column``."""
    if parts < 2:
        return []
    probs = [i / parts for i in range(1, parts)]
    cuts = df.select(F.percentile_approx(column, F.lit(probs), 10 * parts).alias("c")).first()["c"] or []
    return sorted(set(cuts))
