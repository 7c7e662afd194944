"""Tables written to the folder that driver and executors share, and joins that check a size before broadcasting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a key table is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000

_own: dict[str, str] = {}
#: Staged tables that stand, each with a weak reference to the file index that all plans over it share.
_standing: dict[str, tuple[SparkSession, object]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where that is unset (tests, one machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="hearthline-")
    return _own[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it again: lineage ends there, and a lost executor
    costs no recomputation. With ``by``, each value of that column has a folder. The table goes by ``unstage``, or once no plan of this driver reads it any more."""
    spark = df.sparkSession
    sweep(spark)
    path = new_folder(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._hearthline_path = path
    _standing[path] = spark, spark._jvm.java.lang.ref.WeakReference(out._jdf.queryExecution().analyzed().relation().location())
    return out


def _delete(spark: SparkSession, path: str) -> None:
    _standing.pop(path, None)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def unstage(*tables: DataFrame) -> None:
    """Deletes staged tables that no later table reads."""
    for t in tables:
        if path := getattr(t, "_hearthline_path", None):
            _delete(t.sparkSession, path)


def sweep(spark: SparkSession) -> None:
    """Deletes the staged tables of which no frame, and no frame derived from one, is left: what the JVM has collected.
    Results that somebody still holds stand, whoever else works on the session meanwhile."""
    for path, (owner, index) in list(_standing.items()):
        if owner.sparkContext is not spark.sparkContext:
            _standing.pop(path, None)  # of a session that has ended
        elif index.get() is None:
            _delete(spark, path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def keyed_join(left: DataFrame, keys: DataFrame, on, how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Joins a wide table with a narrow staged one: by broadcast if that has at most ``rows`` rows, else by a shuffle
    in which adaptive execution splits hot keys."""
    return left.join(F.broadcast(keys) if is_small(keys, rows) else keys, on, how)


def with_row_key(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written once with a key that tells its rows apart, whatever their ids, and the key's name."""
    row = fresh(df, "_row")
    return stage(df.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
