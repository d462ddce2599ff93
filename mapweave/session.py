"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "mapweave") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("MAPWEAVE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``mapweave`` importable in Python workers (grouped stitcher, PBF reader).

    The package is zipped once per application and handed to
    ``SparkContext.addPyFile``, so executors get it whatever their working
    directory or environment.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="mapweave-pkg-"), "mapweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def is_local(master: str) -> bool:
    """Whether driver and executors are one process, so that its own folders serve all of them."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` as the cluster names it. Only where it is
    unset on a local master (tests) a scratch folder is made; elsewhere an unset
    folder raises, as executors would each write a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="mapweave-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


# staged tables that nobody has dropped yet, by application
_STAGED: dict[str, list[str]] = {}


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used where an intermediate result is read several times (area edges and
    rows): it is computed once, later plans start from a scan, and a lost
    executor costs a re-read instead of a recomputation of the lineage. The table
    belongs to the innermost open :func:`staging` block, or else to the
    application, which drops it at its end or on :func:`drop_staged`.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark).rstrip('/')}/mapweave/{name}-{uuid.uuid4().hex}"
    if app not in _STAGED:
        _STAGED[app] = []
        atexit.register(_drop_at_exit, spark)
    _STAGED[app].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_tables(spark: SparkSession) -> list[str]:
    """Paths of the staged tables that are still there."""
    return list(_STAGED.get(spark.sparkContext.applicationId, []))


def drop_staged(spark: SparkSession, since: int = 0) -> None:
    """Delete the staged tables of this application (those after the first ``since``)."""
    paths = _STAGED.get(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(paths) > since:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def _drop_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        drop_staged(spark)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are dropped at its end; use results before."""
    before = len(staged_tables(spark))
    try:
        yield
    finally:
        drop_staged(spark, before)


DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def _width(kind: T.DataType, value: str, depth: int = 0) -> str:
    """SQL text: bytes that a value takes in Spark's row format (fixed slot and what it points to)."""
    if isinstance(kind, T.StructType):
        parts = [_width(f.dataType, f"{value}.`{f.name}`", depth) for f in kind.fields]
        return f"coalesce({' + '.join(['16', *parts])}, 16)"
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, T.StructType) and all(isinstance(f.dataType, T.NumericType) for f in inner.fields):
            return f"coalesce(24 + size({value}) * {16 + 8 * len(inner.fields)}, 16)"
        x = f"_w{depth}"
        each = _width(inner, x, depth + 1)
        return f"coalesce(24 + aggregate(transform({value}, {x} -> CAST({each} AS bigint)), 0L, (a, b) -> a + b), 16)"
    if isinstance(kind, T.MapType):
        keys = _width(T.ArrayType(kind.keyType), f"map_keys({value})", depth)
        return f"({keys} + {_width(T.ArrayType(kind.valueType), f'map_values({value})', depth)})"
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return f"coalesce(16 + octet_length({value}), 16)"
    return "16"


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows of a staged frame in Spark's row format, from one aggregate over it."""
    row = " + ".join(["16", *[_width(f.dataType, f"`{f.name}`") for f in df.schema.fields]])
    return int(df.agg(F.sum(F.expr(f"CAST({row} AS bigint)"))).first()[0] or 0)


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("mapweave.broadcast.maxBytes", str(DEFAULT_BROADCAST_LIMIT)))


def sized_join(table: DataFrame, df: DataFrame | None = None) -> DataFrame:
    """A staged ``table`` (or ``df``, made of its rows) that joins broadcast only if the rows fit Spark's own limit.

    The planner holds the bytes of the compressed file against
    ``spark.sql.autoBroadcastJoinThreshold``, but rows of cells and edges take many times as much
    in the driver. Here they are measured (:func:`measured_bytes`); above the limit the frame gets a
    ``merge`` hint, so both sides are shuffled, sorted and spilled where they must be.
    """
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    df = table if df is None else df
    return df if measured_bytes(table) <= limit else df.hint("merge")


def sized_broadcast(df: DataFrame, name: str, limit_bytes: int | None = None) -> DataFrame:
    """Stage ``df`` and mark it for broadcast only if its measured rows fit.

    The rows are measured in the format in which they would be broadcast
    (:func:`measured_bytes`) against ``limit_bytes`` (default
    ``mapweave.broadcast.maxBytes`` or 64 MiB). Above the limit the frame is
    returned with a ``shuffle_hash`` hint, so no planner estimate can turn it
    into a broadcast.
    """
    table = materialize(df, name)
    limit = broadcast_limit(df.sparkSession) if limit_bytes is None else limit_bytes
    return F.broadcast(table) if measured_bytes(table) <= limit else table.hint("shuffle_hash")
