"""Tables, and the folder that the driver and all executors share.

Lineage is cut by writing a table below ``spark.checkpoint.dir``, which every executor can read after another
one is lost. Nothing is ever kept in a machine-local folder of a cluster.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new path below the session's checkpoint folder. Where none is set, a temporary folder is used in local mode only (tests); elsewhere that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def quoted(name: str) -> str:
    """A column's name as SQL and ``F.col`` take it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


class Kept:
    """The one large object that a Python worker keeps between tasks, by its key, and whether the running task asked for it."""

    key, value, asked = None, None, False


def kept(key: tuple, make: Callable):
    """What ``make`` gives, kept by this worker as long as its tasks ask for the same key: tables of several operators never lie in one worker."""
    if Kept.key != key:
        Kept.key = Kept.value = None
        gc.collect()
        Kept.value, Kept.key = make(), key
    Kept.asked = True
    return Kept.value


#: What modules let go at the end of a task, besides: tables that are quickly made again.
forgets: list[Callable[[], None]] = []


def release() -> None:
    """Gives memory that Python, Arrow and the C library keep for later back to the system, where that is possible."""
    gc.collect()  # functions sent for a task refer to themselves, so what they hold doesn't go by itself
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def ended() -> None:
    """The end of a task: an object that an earlier one kept goes unless this one asked for it."""
    if not Kept.asked:
        Kept.key = Kept.value = None
    Kept.asked = False
    for forget in forgets:
        forget()
    release()


#: Bytes of an Arrow batch on its way to a Python worker, about. Spark's 10,000 rows of whole texts may have 64 MB, in each of several buffers beside the heap and in each worker.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession | None) -> None:
    """Lowers the session's limit of an Arrow batch's bytes to BATCH_BYTES. It stays so, since a query's last plan runs after the query has returned; a lower limit is left."""
    if spark is None:
        return
    spark_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    now = spark.conf.get(_BATCH, None)
    if now is None or not 0 < spark_bytes(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)


def tidy(run):
    """A batch function that releases what it no longer needs at the end of a task: Python workers live on beside the executor's heap. Its batches are small."""
    small_batches(SparkSession.getActiveSession())

    def wrapped(batches):
        yield from run(batches)
        ended()  # by its name in this module: what a sent function itself refers to is a copy

    return wrapped


def filtered(docs: DataFrame, run) -> DataFrame:
    """``docs`` through a batch function that keeps its columns. They are named by place meanwhile, so their own names may be any."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    return plain.mapInArrow(tidy(run), plain.schema).toDF(*docs.columns)


def free(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, with underscores added until none is among those taken (upper and lower case count as equal)."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and its lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_digest(id_: Column, text: Column) -> Column:
    """128 bits that tell rows apart by id and text; a null id is one of its own, a null text is empty."""
    return F.unhex(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit("|"), id_.isNull().cast("string"), F.md5(F.coalesce(text, F.lit(""))))))


def dropped(*frames: DataFrame) -> None:
    """Deletes the folders of staged tables that nothing reads any more; one that is gone already is passed over."""
    for df in frames:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Rows of one key from which on it is a hot key, at least; and how many hot keys there are at most.
HOT_ROWS, HOT_KEYS = 1000, 100_000


def looked_up(rows: DataFrame, table_: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table_``, in which each key is once; ``how`` is inner or left. Both should be staged: they are read twice.

    A key of very many rows is joined by broadcast, so no task gets all its rows. Such keys have over HOT_ROWS rows each, and where there are more than
    HOT_KEYS of them, over 1 / HOT_KEYS of all rows: HOT_KEYS at most, whatever the size. All other keys are joined as Spark chooses.
    """
    (number,) = free(keys, "rows")
    hot = staged(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(number)).where(F.col(number) > HOT_ROWS))
    n = hot.count()
    if not n:
        return rows.join(table_, keys, how)
    if n > HOT_KEYS:
        hot = hot.where(F.col(number) > rows.count() // HOT_KEYS)
    named = F.broadcast(hot.select(*keys))
    of_hot = table_.join(named, keys, "left_semi")
    cold = rows.join(named, keys, "left_anti").join(table_, keys, how)
    return rows.join(named, keys, "left_semi").join(F.broadcast(of_hot), keys, how).unionByName(cold)


def width(spark: SparkSession) -> int:
    """How many partitions a shuffle has in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filled(column: pa.Array) -> pa.Array:
    """The text column with nulls as empty texts, with 32-bit or 64-bit offsets as it came."""
    return column.fill_null("") if column.null_count else column


def range_of(rows: DataFrame, id_col: str, ranges: int) -> Column:
    """The range, by approximate quantiles, that an integer id lies in: a balanced tree of comparisons. Null ids are in the first one."""
    if dict(rows.dtypes)[id_col] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col}: ids must be integers here, not {dict(rows.dtypes)[id_col]}")
    known = rows.where(F.col(id_col).isNotNull())
    bounds = sorted({int(x) for x in known.approxQuantile(id_col, [k / ranges for k in range(1, ranges)], 0.25 / ranges)}) if ranges > 1 else []

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF({quoted(id_col)} < {bounds[mid]}L, {tree(lo, mid)}, {tree(mid + 1, hi)})"

    return F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(F.expr(tree(0, len(bounds))))
