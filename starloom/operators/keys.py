"""Surrogate keys and key uniqueness, without a one-task sort of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.warehouse import conform, settle


def _running_offset(counts: DataFrame, order: str) -> DataFrame:
    """Rows before each group; ``counts`` holds one row per bucket or file."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")


def dense_keys(df: DataFrame, natural_key: str, name: str, buckets: int = 256) -> DataFrame:
    """Number a table 1..n by a unique natural key.

    The natural key's hash picks a bucket, rows are numbered inside their bucket and
    shifted by the sizes of the buckets before it. The same rows always get the same
    keys, and only one row per bucket meets in one task.
    """
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(natural_key), F.lit(buckets)))
    counts = rows.groupBy("__bucket").agg(F.count("*").alias("__rows"))
    # Never more than ``buckets`` rows.
    offsets = F.broadcast(_running_offset(counts, "__bucket"))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy(natural_key))
    numbered = rows.join(offsets, "__bucket").select(
        (inside + F.col("__offset")).cast("int").alias(name), *df.columns
    )
    return numbered


def _offsets(sizes: DataFrame, part: str, bucket: Column) -> DataFrame:
    """(part, __offset) from (part, __rows): rows of the parts before, buckets in turn and parts in order inside them.

    Only a bucket's sum, and one bucket's parts, meet in one task.
    """
    placed = sizes.withColumn("__bucket", bucket)
    totals = placed.groupBy("__bucket").agg(F.sum("__rows").alias("__rows"))
    # As many rows as there are buckets.
    starts = F.broadcast(_running_offset(totals, "__bucket"))
    before = Window.partitionBy("__bucket").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__rows").over(before), F.lit(0))
    offsets = placed.withColumn("__inside", inside).join(starts, "__bucket")
    return offsets.select(part, (F.col("__offset") + F.col("__inside")).alias("__offset"))


#: Files whose offsets are sent to every executor, at about 40 bytes each; of more, rows are joined by a shuffle.
BROADCAST_FILES = 1 << 20


def positional_keys(scan: DataFrame, name: str, buckets: int = 256) -> DataFrame:
    """Number the rows of a Parquet scan without moving any row.

    A row's key is its position in its file plus the rows of the files before it, where files are in
    the order of a hash of their paths. Keys are unique, and 1..n if the scan has all rows of its files; rows
    may have been filtered, which leaves gaps, but not joined. A lost task gives the same keys
    when it is rerun. The offsets are written first, one row per file, and summed up hash bucket by hash
    bucket. Two paths of one hash are refused.
    """
    path = F.xxhash64(F.col("_metadata.file_path"))
    sized = scan.groupBy(F.col("_metadata.file_path").alias("__path")).agg(
        (F.max("_metadata.row_index") + 1).alias("__rows")
    )
    files = settle(sized.select(F.xxhash64("__path").alias("__file"), "__rows"), "file_sizes")
    if not repeated_keys(files, ["__file"]).isEmpty():
        raise ValueError("two files have paths of the same hash; rename one")
    offsets = _offsets(files, "__file", F.pmod("__file", F.lit(buckets)))
    offsets = settle(offsets, "file_offsets")
    if offsets.count() <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    placed = scan.withColumns({"__file": path, "__position": F.col("_metadata.row_index")})
    key = F.col("__offset") + F.col("__position") + 1
    return placed.join(offsets, "__file").withColumn(name, key).drop("__file", "__position", "__offset")


#: Low bits of a written place that count rows; the task that wrote the row is above them (``monotonically_increasing_id``).
ROW_BITS = 33
#: Tasks whose offsets stand in the plan as one list of at most half a megabyte; those of more are joined.
LISTED_TASKS = 1 << 16


def written_place() -> Column:
    """Task and row number of a row in the write that it is part of."""
    return F.monotonically_increasing_id()


def task_offsets(written: DataFrame, place: str, buckets: int = 256) -> DataFrame:
    """(tarefa, antes): every task of a write, and the rows that the tasks before it wrote.

    Reads the one column of places; one row a task is moved.
    """
    task = F.shiftright(place, ROW_BITS)
    sizes = settle(written.groupBy(task.alias("tarefa")).agg(F.count("*").alias("__rows")), "task_sizes")
    # Tasks next to each other share a bucket, so keys go up as places do while there are at most 65,536 tasks.
    bucket = F.floor(F.col("tarefa") / buckets) % buckets
    return _offsets(sizes, "tarefa", bucket).withColumnRenamed("__offset", "antes")


def keys_from_places(written: DataFrame, offsets: DataFrame, place: str, name: str) -> DataFrame:
    """The written rows, numbered 1..n as they are read; ``offsets`` is what ``task_offsets`` gave.

    The key is an expression over the place, so rows are neither moved nor written again, and a reader who does not ask for
    the key does not read the place. Places are in the files: a key is the same at every reading, also from copied files.
    """
    task, row = F.shiftright(place, ROW_BITS), F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    listed = offsets.limit(LISTED_TASKS + 1).collect()
    if len(listed) <= LISTED_TASKS and max((r["tarefa"] for r in listed), default=0) <= 4 * LISTED_TASKS:
        antes = dict(listed)
        each = ",".join(str(antes.get(i, 0)) for i in range(max(antes, default=0) + 1))
        before = F.get(F.split(F.lit(each), ",").cast("array<bigint>"), task.cast("int"))
        return written.withColumn(name, before + row + 1).drop(place)
    return written.join(offsets, task == F.col("tarefa")).withColumn(name, F.col("antes") + row + 1).drop(place, "tarefa", "antes")


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key values found on more than one row, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("linhas")).where(F.col("linhas") > 1)


def has_places(df: DataFrame) -> bool:
    """Whether the rows are a plain scan, and so have a file and a place in it."""
    try:
        return bool(df.select("_metadata.file_path", "_metadata.row_index").columns)
    except AnalysisException:
        return False


#: Keys in one block of the overlap test.
BLOCK_KEYS = 1 << 22


def key_runs(scan: DataFrame, key: str) -> DataFrame:
    """(primeira, ultima, linhas) of every run of rows of a file whose keys go up by one from row to row.

    Rows numbered by place are one run for each piece of a file that was read; tasks add their rows up, so no key is moved.
    """
    place = F.col("_metadata.row_index")
    runs = scan.groupBy(F.xxhash64("_metadata.file_path").alias("__file"), (F.col(key) - place).alias("__shift"))
    return runs.agg(F.min(key).alias("primeira"), F.max(key).alias("ultima"), F.count("*").alias("linhas"))


def runs_overlap(runs: DataFrame) -> bool:
    """Whether any two runs have a key in common, or rows have no key.

    Runs are cut at blocks of ``BLOCK_KEYS`` keys; in a block of sorted pieces, an overlap shows between neighbours.
    """
    block = lambda name: F.floor(F.col(name) / BLOCK_KEYS)
    pieces = runs.select("*", F.explode_outer(F.sequence(block("primeira"), block("ultima"))).alias("bloco"))
    sorted_pieces = F.sort_array(F.collect_list(F.struct("primeira", "ultima")))
    blocks = pieces.groupBy("bloco").agg(sorted_pieces.alias("p"), F.count_if(F.col("primeira").isNull()).alias("sem_chave"))
    neighbours = F.arrays_zip(F.col("p"), F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))).alias("q"))
    clash = F.exists(neighbours, lambda n: F.coalesce(n["q"]["primeira"] <= n["p"]["ultima"], F.lit(False)))
    return not blocks.where(clash | (F.col("sem_chave") > 0)).isEmpty()


def refuse_repeated_values(rows: DataFrame, key: str, name: str) -> None:
    """Raise with some of the values (NULL apart) that stand on more than one row, if there are any."""
    found = [r[0] for r in repeated_keys(rows.where(F.col(key).isNotNull()), [key]).select(key).limit(5).collect()]
    if found:
        raise ValueError(f"{name}.{key} is not unique: {', '.join(map(repr, found))}")


def stable_keys(rows: DataFrame, natural_key: str, schema: T.StructType, registry: str, table: str) -> DataFrame:
    """Number a table by a unique natural key so that a key once given never changes.

    ``registry/table`` holds every member with the key, the first column of ``schema``, and the attributes of its first load. A load
    looks its members up there, numbers those not found from the largest key on without a gap, and appends them. What comes back
    has the attributes of ``rows``, and of members no longer there those of the registry, so that
    older facts still find them. Loads that share a registry must not run side by side.

    A member is appended before it is used; if the load then fails, the next one finds it. Values repeated in
    ``rows`` are refused before anything is appended. NULL is a member like others.
    """
    spark, name = rows.sparkSession, schema[0].name
    refuse_repeated_values(rows, natural_key, table)
    path = f"{registry.rstrip('/')}/{table}"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    known = spark.read.schema(schema).parquet(path)
    same = lambda a, b: a[natural_key].eqNullSafe(b[natural_key])
    new = rows.join(known, same(rows, known), "left_anti")
    last = known.agg(F.max(name)).first()[0] or 0
    numbered = dense_keys(new, natural_key, name).withColumn(name, (F.col(name) + last).cast(schema[0].dataType))
    # Written apart first, as the registry is read for it.
    conform(settle(numbered, table), schema).write.mode("append").parquet(path)
    # The listing made for the first reading does not know the new files.
    members = spark.read.schema(schema).parquet(path)
    keys = members.select(F.col(name), F.col(natural_key).alias("__natural"))
    present = rows.join(keys, rows[natural_key].eqNullSafe(F.col("__natural"))).select(*schema.names)
    gone = members.join(rows, same(members, rows), "left_anti").select(*schema.names)
    return present.unionByName(gone)
