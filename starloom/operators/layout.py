"""Physical layout of warehouse tables on Parquet, and their maintenance.

- Fact: Hive-style partitions by month (or by day, for tables whose days fill
  files), rows range-partitioned and sorted by the cluster keys inside each
  file, so both partition pruning and Parquet min/max row-group pruning work.
  ``repartitionByRange`` splits a large partition over many tasks, so no
  month, day or hot customer is written by one task. The sort starts with the
  partition column: a partitioned write asks for that order and would replace
  any other.
- Writes of touched partitions are redone after a crash: the new files are
  written beside the table first (``_redo``), then a plan of the files that they replace;
  from then on the change is decided, and whoever writes next carries it out:
  old files go, new ones are moved in their place. Before that it has not
  happened, and is dropped.
- A filter over the hashes of the keys of every partition (``_keys``, bitmaps)
  tells a merge which partitions may hold a key, so that it reads the key
  column of those only.
- Overwrite-style tables (dimensions, aggregates) are written to a fresh
  version directory; the newest complete version is the table.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starloom.operators.joins import checked_broadcast, hash_keys, split_by_keys, with_packed, with_unpacked
from starloom.params import RETENTION_DAYS
from starloom.session import released_shuffles

TIEBREAK = "order_key"
CODEC = "zstd"  # keys are hashes in hexadecimal digits, which Parquet's default codec leaves as they are
PARTITION_COLS = {"month": "order_month", "day": "order_day"}
PARTITION_COL = PARTITION_COLS["month"]
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Layout(NamedTuple):
    grain: str | None  # partitions: a key of PARTITION_COLS, or none
    cluster: tuple[str, ...]


LAYOUTS = {
    "none": Layout(None, ()),
    "date": Layout("month", ("order_date",)),
    "date_channel": Layout("month", ("order_date", "channel")),
    "day_customer_channel": Layout("day", ("customer_id", "channel")),
    "customer": Layout(None, ("customer_id", "order_date")),
    "curve": Layout(None, ("customer_id", "order_date", "channel")),
}
#: Layouts whose cluster columns are of equal rank: rows follow a space-filling curve over them.
CURVES = {"curve"}
CURVE_BITS = 5  # buckets of a column: at most 2 to this
CURVE_SAMPLE = 20_000  # rows that bucket bounds come from
ROUND_ROWS = 1 << 26  # of a stored table that are arranged at a time


class LoadRefused(RuntimeError):
    """Checks failed on the rows that a load was about to publish."""


class PartitionFilterRequired(ValueError):
    """A read of a partitioned fact without a date range."""


def partition_col(layout: str) -> str | None:
    return PARTITION_COLS.get(LAYOUTS[layout].grain)


def with_partition_col(df: DataFrame, date_col: str = "order_date", grain: str = "month") -> DataFrame:
    day = F.col(date_col)
    return df.withColumn(PARTITION_COLS[grain], F.trunc(day, "month") if grain == "month" else day)


def without_partition_col(df: DataFrame) -> DataFrame:
    return df.drop(*PARTITION_COLS.values())


def arrange(df: DataFrame, layout: str = "date_channel", files: int | None = None, tiebreak=(TIEBREAK,)) -> DataFrame:
    """Order rows for a layout without writing them. ``files`` is for tests
    and small copies; by default the session's shuffle settings decide.
    ``tiebreak``: columns that tell rows apart, if the rows have them."""
    tie = [c for c in tiebreak if c in df.columns]
    grain, cluster = LAYOUTS[layout]
    keys = hash_keys(df, but=cluster)
    return with_unpacked(_arranged(with_packed(df, keys), layout, files, tie), keys)


def _arranged(df: DataFrame, layout: str, files: int | None, tie: list) -> DataFrame:
    grain, cluster = LAYOUTS[layout]
    out = with_partition_col(df, grain=grain) if grain else df
    if layout in CURVES:
        place = curve_place(out, cluster)
        rng = ["_curve", *(tie or cluster)]
        out = out.withColumn("_curve", place)
        out = out.repartitionByRange(files, *rng) if files else out.repartitionByRange(*rng)
        return out.sortWithinPartitions("_curve", *cluster).drop("_curve")
    if not cluster:
        # unclustered: spread rows by a hash of the key, i.e. no order at all
        return out.repartition(files, "order_key") if files else out.repartition("order_key")
    keys = [PARTITION_COLS[grain], *cluster] if grain else list(cluster)
    # a unique tie-breaker after the cluster columns lets the range
    # partitioner split one hot cluster value (a day or a customer holding a
    # large share of rows) over several tasks and files
    rng = [*keys, *tie]
    out = out.repartitionByRange(files, *rng) if files else out.repartitionByRange(*rng)
    return out.sortWithinPartitions(*keys)


def curve_place(df: DataFrame, cols, bits: int = CURVE_BITS, sample: int = CURVE_SAMPLE):
    """A row's place on a Z-order curve over the ranks of its columns.

    Each column's values are put in buckets of about equal size, by bounds from
    a bounded sample (they only decide which rows lie together); the buckets'
    bits take turns, so that a range of the curve is narrow in every column.
    """
    total = df.count()
    some = df.select(*cols).sample(fraction=min(1.0, sample / max(total, 1)), seed=11).limit(2 * sample).collect()
    ranks, sizes = [], []
    for k, c in enumerate(cols):
        values = sorted(r[k] for r in some if r[k] is not None)
        # the least value opens no bucket; a value that fills several is one bucket
        bounds = sorted({values[len(values) * i >> bits] for i in range(1, 1 << bits)} - {values[0]}) if values else []
        at = F.lit(0)
        for b in bounds:
            at = at + (F.col(c) >= F.lit(b)).cast("int")
        ranks.append(F.coalesce(at, F.lit(0)))
        sizes.append(len(bounds).bit_length())
    place, out = [], F.lit(0).cast("long")
    for turn in range(max(sizes, default=0)):
        place += [(k, n - 1 - turn) for k, n in enumerate(sizes) if turn < n]
    for k, bit in place:
        out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(ranks[k], bit).bitwiseAND(F.lit(1)).cast("long"))
    return out


def in_place(df: DataFrame, layout: str) -> DataFrame:
    """``arrange`` for rows read from a table whose layout has the same partitions and leading
    cluster columns: a task's rows are narrow ranges already, so they are sorted where they
    are and not shuffled."""
    grain, cluster = LAYOUTS[layout]
    return with_partition_col(df, grain=grain).sortWithinPartitions(PARTITION_COLS[grain], *cluster)


def write_layout(df: DataFrame, path: str, layout: str = "date_channel", files: int | None = None,
                 mode: str = "overwrite", max_records_per_file: int | None = None, finish=None, tiebreak=(TIEBREAK,),
                 arranged: bool = False, stored: bool = False) -> str:
    """``finish(rows, keep)`` is a projection to apply to the arranged rows, which keeps the columns ``keep``:
    what it adds is not shuffled and sorted. ``arranged``: the rows are those of a table in this
    order (``in_place``). ``stored``: the rows are cheap to read again, so that many of them are
    arranged and written in several rounds, of which one is shuffled at a time."""
    col = partition_col(layout)
    fs, _, jvm = _fs(df.sparkSession, path)
    if col:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{KEYS}"), True)  # it would not know the new keys
    rounds = _rounds(df, layout) if stored and not arranged else [df]
    for i, part in enumerate(rounds):
        rows = in_place(part, layout) if arranged else arrange(part, layout, files, tiebreak)
        if finish is not None:
            rows = finish(rows, [c for c in [col] if c])
        # rounds of a partitioned table have partitions of their own, which an overwrite replaces
        w = rows.write.mode("append" if i and not (col and mode == "overwrite") else mode).option("compression", CODEC)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        if len(rounds) > 1:
            w = w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if col:
            w = w.partitionBy(col).option("partitionOverwriteMode", "dynamic")
        with released_shuffles(df.sparkSession):
            w.parquet(path)
    # a write that replaces partitions one by one leaves no mark that it ended; without rows there is no table yet
    if fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{col}=*")) if col else len(rounds) > 1:
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"), True).close()
    return path


def _rounds(df: DataFrame, layout: str) -> list[DataFrame]:
    """The rows in ranges of what the layout orders first (a curve: of its first column), of about
    ``ROUND_ROWS`` rows; whole partitions, if there are. Bounds come from a bounded sample."""
    total = df.count()
    if total <= ROUND_ROWS:
        return [df]
    grain, cluster = LAYOUTS[layout]
    first = F.col("order_date" if grain else cluster[0] if cluster else TIEBREAK)
    start = F.trunc(first, "month") if grain == "month" else first
    some = df.select(start.alias("_at")).sample(fraction=min(1.0, CURVE_SAMPLE / total), seed=11).limit(2 * CURVE_SAMPLE).collect()
    values, n = sorted(r[0] for r in some if r[0] is not None), -(-total // ROUND_ROWS)
    bounds = sorted({values[len(values) * i // n] for i in range(1, n)} - {values[0]}) if values else []
    lows, highs = [None, *bounds], [*bounds, None]
    return [df.where((F.lit(True) if lo is None else first >= F.lit(lo))
                     & (F.lit(True) if hi is None else (first < F.lit(hi)) | (first.isNull() if lo is None else F.lit(False))))
            for lo, hi in zip(lows, highs, strict=True)]


def read_fact(spark: SparkSession, path: str, date_from=None, date_to=None,
              require_partition_filter: bool = True, merge_schema: bool = False) -> DataFrame:
    """Guarded reader: a date range is required (cost governance).

    Both bounds become a filter on the partition column (partition pruning)
    and on ``order_date`` (row-group pruning). Partition columns are read
    with their DATE type. ``merge_schema`` reads partitions written before
    and after a column was added (missing columns read as NULL).
    """
    if require_partition_filter and date_from is None and date_to is None:
        raise PartitionFilterRequired("read_fact needs date_from and/or date_to")
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    df = reader.parquet(path)
    month, day = PARTITION_COLS["month"], PARTITION_COLS["day"]
    if date_from is not None:
        d0 = F.lit(str(date_from)).cast("date")
        if month in df.columns:
            df = df.filter(F.col(month) >= F.trunc(d0, "month"))
        if day in df.columns:
            df = df.filter(F.col(day) >= d0)
        df = df.filter(F.col("order_date") >= d0)
    if date_to is not None:
        d1 = F.lit(str(date_to)).cast("date")
        for c in (month, day):
            if c in df.columns:
                df = df.filter(F.col(c) <= d1)
        df = df.filter(F.col("order_date") <= d1)
    return df


def _in_partitions(col: str, values: list):
    """Rows of the given partitions; None stands for the one without a date."""
    known = [v for v in values if v is not None]
    cond = F.col(col).isin(known) if known else F.lit(False)
    return cond | F.col(col).isNull() if None in values else cond


REDO, ROWS, KEYS, REFUSED, BATCH = "_redo", "rows", "_keys", "_refused", "_batch"
#: A merge of more keys does not ask the key filter, which would name nearly all partitions by chance.
FILTER_KEYS = 4096
#: Places of a partition's key filter for each of its keys: one key in so many is found by chance.
PLACES_A_KEY = 1024
BITMAP_PLACES = 32768  # of one of Spark's bitmaps
RECLUSTER_PARTITIONS = 12  # rewritten at a time


def rewrite_partitions(spark: SparkSession, new_rows: DataFrame, path: str,
                       layout: str = "date_channel", read: list | None = None, key: str = TIEBREAK, audit=None,
                       kept: DataFrame | None = None) -> None:
    """Replace the partitions present in ``new_rows``, and drop those of
    ``read`` (the partitions that the rows were taken from) that have no rows
    left. ``kept`` are rows of these partitions that stay as they are: they are
    copied in their order (``in_place``), the new rows come in files of their own.

    The rows are written beside the table, and so are their keys' bitmaps, if there is a
    key filter; then the plan is. A crash before the plan leaves the table as it was, one
    after it is made good by ``recover``.
    """
    col = partition_col(layout)
    recover(spark, path)
    rows, aside = arrange(without_partition_col(new_rows), layout), f"{path}/{REDO}/{ROWS}"
    with released_shuffles(spark):
        if kept is not None:  # by itself, as the rows of a union would be sorted once more
            _write_partitions(in_place(without_partition_col(kept), layout), aside, col, "append")
        _write_partitions(rows, aside, col, "append")
        staged = spark.read.schema(rows.schema).parquet(aside)
        if audit is not None:
            failed = audit(without_partition_col(staged)).checkpoint()
            if not failed.isEmpty():
                load = uuid.uuid4().hex
                failed.withColumn("load", F.lit(load)).write.mode("append").parquet(f"{path}/{REFUSED}")
                recover(spark, path)  # nothing was decided: the new rows go
                raise LoadRefused(f"load {load}: checks failed on {path}")
        changed = _folders(col, read or []) | set(_partitions(spark, aside))
        plan = {ROWS: _files(spark, path, changed)}
        if path_exists(spark, f"{path}/{KEYS}/_SUCCESS") and key in rows.columns:
            _write_partitions(key_filter(staged, col, key), f"{path}/{REDO}/{KEYS}", col, "append")
            plan[KEYS] = _files(spark, f"{path}/{KEYS}", changed)
    publish(spark, f"{path}/{REDO}/plan", json.dumps(plan))
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Carry out a change that was decided, drop one that was not; whether there was one to carry out."""
    fs, _, jvm = _fs(spark, path)
    def at(name):
        return jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not fs.exists(at(REDO)):
        return False
    decided = fs.exists(at(f"{REDO}/plan"))
    if decided:
        plan = json.loads(spark.read.text(f"{path}/{REDO}/plan", wholetext=True).first()[0])
        for name, drop in plan.items():
            _replace(spark, f"{path}/{REDO}/{name}", path if name == ROWS else f"{path}/{name}", drop)
    fs.delete(at(REDO), True)
    return decided


def _folders(col: str, values) -> set[str]:
    return {f"{col}={NULL_PARTITION if v is None else v}" for v in values}


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """The partition folders of a table."""
    fs, p, _ = _fs(spark, path)
    found = fs.listStatus(p) if fs.exists(p) else []
    return [st.getPath().getName() for st in found if st.isDirectory() and "=" in st.getPath().getName()]


def _files(spark: SparkSession, path: str, partitions) -> list[str]:
    """The files of some partition folders, by their names in the table."""
    fs, p, jvm = _fs(spark, path)
    there = sorted(set(partitions) & set(_partitions(spark, path)))
    return [f"{part}/{st.getPath().getName()}" for part in there for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(p, part))]


def _replace(spark: SparkSession, aside: str, path: str, drop: list[str]) -> None:
    """Delete the files ``drop`` of the table at ``path`` and move those of the table ``aside`` into it, one by
    one: file names do not come twice, so what was broken off anywhere is finished by doing it again."""
    fs, _, jvm = _fs(spark, path)
    def at(*names):
        return jvm.org.apache.hadoop.fs.Path("/".join(names))
    for name in drop:
        fs.delete(at(path, name), False)
    for part in _partitions(spark, aside):
        move_files(spark, f"{aside}/{part}", f"{path}/{part}")
    for part in {name.partition("/")[0] for name in drop}:
        if fs.exists(at(path, part)) and not fs.listStatus(at(path, part)):
            fs.delete(at(path, part), True)


def move_files(spark: SparkSession, folder: str, into: str, prefix: str = "") -> None:
    """The files of a folder, if there is one, into another one."""
    fs, p, jvm = _fs(spark, folder)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(into))
    for st in fs.listStatus(p) if fs.exists(p) else []:
        to = jvm.org.apache.hadoop.fs.Path(f"{into}/{prefix}{st.getPath().getName()}")
        fs.delete(to, False)  # a copy that was broken off
        if not fs.rename(st.getPath(), to):
            raise OSError(f"{st.getPath().toString()} could not be moved to {to.toString()}")


def replace_partitions(spark: SparkSession, rows: DataFrame, path: str, col: str, values: list) -> None:
    """Put the rows' partitions in place of those there; those of ``values`` that the rows do not have go.

    Broken off, it leaves some of them without rows: the caller has to do it again."""
    fs, aside, _ = _fs(spark, f"{path}/{REDO}")
    fs.delete(aside, True)
    _write_partitions(rows, f"{path}/{REDO}", col, "append")
    _replace(spark, f"{path}/{REDO}", path, _files(spark, path, _folders(col, values) | set(_partitions(spark, f"{path}/{REDO}"))))
    fs.delete(aside, True)


def _write_partitions(rows: DataFrame, path: str, col: str, mode: str = "overwrite") -> None:
    with released_shuffles(rows.sparkSession):
        rows.write.mode(mode).option("compression", CODEC).option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path)


def publish(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, p, jvm = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, p)


# --- which partitions may hold a key ------------------------------------------

def key_filter(rows: DataFrame, col: str, key: str = TIEBREAK) -> DataFrame:
    """Per partition, bitmaps over the hashes of its keys: (bucket, bits, places, partition).

    The number of places follows the partition's keys (a power of two), so that
    a partition of any size names few keys by chance; empty bitmaps are not kept.
    """
    sizes = rows.groupBy(col).agg(F.count("*").alias("_n"))
    exact = F.greatest(F.lit(BITMAP_PLACES), F.col("_n") * PLACES_A_KEY).cast("double")
    sizes = sizes.select(F.col(col).alias("_part"), F.pow(F.lit(2.0), F.ceil(F.log2(exact))).cast("long").alias("places"))
    placed = rows.select(col, key).join(F.broadcast(sizes), F.col(col).eqNullSafe(F.col("_part"))).withColumn("_at", _place(key, F.col("places")))
    places = placed.select(col, "places", F.bitmap_bucket_number("_at").alias("bucket"), F.bitmap_bit_position("_at").alias("_bit"))
    # a task's share of a bitmap holds few keys in its 4 KB: places are shuffled, bitmaps made behind it
    return places.repartition(col, "places", "bucket").groupBy(col, "places", "bucket") \
        .agg(F.bitmap_construct_agg("_bit").alias("bits")).select("bucket", "bits", "places", col)


def _place(key: str, places):
    return F.pmod(F.xxhash64(F.col(key)), places)


def partitions_of_keys(spark: SparkSession, path: str, col: str, keys: DataFrame, key: str = TIEBREAK) -> list:
    """The partitions that may hold one of the keys, by the filter (built from the table if there is none yet)."""
    if not path_exists(spark, f"{path}/{KEYS}/_SUCCESS"):
        _write_partitions(key_filter(spark.read.parquet(path), col, key), f"{path}/{KEYS}", col)
        fs, done, _ = _fs(spark, f"{path}/{KEYS}/_SUCCESS")
        fs.create(done, True).close()  # a write that replaces partitions one by one leaves no mark
    known = spark.read.parquet(f"{path}/{KEYS}")
    sizes = [r[0] for r in known.select("places").distinct().collect()]  # powers of two
    if not sizes:
        return []
    asked = keys.withColumn("places", F.explode(F.array(*[F.lit(n) for n in sizes]))).withColumn("_at", _place(key, F.col("places"))) \
        .select("places", F.bitmap_bucket_number("_at").alias("bucket"), F.bitmap_bit_position("_at").alias("_bit")).distinct()
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    held = F.expr("cast(_bit % 8 as int)")
    hit = known.join(checked_broadcast(asked), ["places", "bucket"]).where(F.getbit(byte, held) == 1)
    return [r[0] for r in hit.select(col).distinct().collect()]  # days or months


def merge_into(spark: SparkSession, path: str, source: DataFrame, merge_fn, layout: str = "date_channel",
               key: str = TIEBREAK, decided=None, audit=None) -> None:
    """Upsert ``source`` into the partitioned table at ``path``.

    The source is evaluated once (stored beside the table until the merge ends). Read and rewritten are the
    partitions of the source's dates and those that hold any of its keys (a
    correction may have moved a date): the key filter names those that may, and
    a semi join on their key column says which do. Rows without a date are a
    partition like any other. A merge that was broken off is made good first, so
    the same merge run again gives what it would have given at once.
    ``merge_fn(target_subset, source) -> merged rows``. Unless the source has too many
    keys to broadcast their hashes, the subset holds rows that the source may meet only,
    and the other rows of the partitions stay as they are, without a shuffle (as they
    would by ``upsert``); merged rows then lie in files of their own, which
    ``recluster`` puts in order. ``decided(partitions)`` is
    told which partitions are about to change; ``audit(rows)`` gives the checks that
    fail on the new rows, if any, and then nothing is changed (``LoadRefused``).
    """
    recover(spark, path)
    with released_shuffles(spark):
        batch = _stored_batch(spark, source, path)
        try:
            _merge_batch(spark, path, batch, merge_fn, layout, key, decided, audit)
        finally:
            fs, p, _ = _fs(spark, f"{path}/{BATCH}")
            fs.delete(p, True)


def _stored_batch(spark: SparkSession, source: DataFrame, path: str) -> DataFrame:
    """The rows of a merge's source in the table's ``_batch`` folder: compressed, and gone when the merge is."""
    kinds = spark.read.parquet(path).schema
    # Parquet has no columns of nothing but NULL
    typed = [F.col(f"`{f.name}`").cast(kinds[f.name].dataType if f.name in kinds.names else "string").alias(f.name)
             if f.dataType.typeName() == "void" else F.col(f"`{f.name}`") for f in source.schema]
    rows = source.select(*typed)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).parquet(f"{path}/{BATCH}")
    return spark.read.schema(rows.schema).parquet(f"{path}/{BATCH}")


def _merge_batch(spark: SparkSession, path: str, batch: DataFrame, merge_fn, layout: str, key: str, decided, audit) -> None:
    grain, _ = LAYOUTS[layout]
    col = PARTITION_COLS[grain]
    target = spark.read.parquet(path)
    keys = batch.select(key).distinct()
    some = target
    if batch.limit(FILTER_KEYS + 1).count() <= FILTER_KEYS:
        some = target.filter(_in_partitions(col, partitions_of_keys(spark, path, col, keys, key)))
    parts = split_by_keys(some.select(key, col), keys, key)
    held = (some if parts is None else parts[1]).select(key, col).join(keys, key, "left_semi").select(col)
    # one value per day or month: bounded by the table's span of dates
    touched = [r[0] for r in with_partition_col(batch, grain=grain).select(col).unionByName(held).distinct().collect()]
    if not touched:
        return
    if decided is not None:
        decided(touched)
    subset = without_partition_col(target.filter(_in_partitions(col, touched)))
    kept, met = split_by_keys(subset, keys, key) or (None, subset)
    rewrite_partitions(spark, merge_fn(met, batch), path, layout, read=touched, key=key, audit=audit, kept=kept)


def disordered_partitions(spark: SparkSession, path: str, layout: str = "date_channel") -> list:
    """Partitions in which the files' ranges of the first cluster column overlap."""
    col, first = partition_col(layout), LAYOUTS[layout].cluster[0]
    per = spark.read.parquet(path).groupBy(col, F.col("_metadata.file_path").alias("file")).agg(
        F.min(first).alias("lo"), F.max(first).alias("hi"))
    # one row per file; files of one partition are its own only
    before = F.max("hi").over(W.partitionBy(col).orderBy("lo", "file").rowsBetween(W.unboundedPreceding, -1))
    return [r[0] for r in per.withColumn("before", before).filter(F.col("lo") < F.col("before")).select(col).distinct().collect()]


def recluster(spark: SparkSession, path: str, months=None, layout: str = "date_channel") -> None:
    """Re-sort the given partitions by the cluster keys, e.g. after a backfill
    disturbed the order; by default those whose files overlap. They are taken a few
    at a time: each stands for itself, and only a few are shuffled and held twice."""
    parts = disordered_partitions(spark, path, layout) if months is None else list(months)
    parts.sort(key=str)
    for at in range(0, len(parts), RECLUSTER_PARTITIONS):
        some = _in_partitions(partition_col(layout), parts[at:at + RECLUSTER_PARTITIONS])
        rewrite_partitions(spark, spark.read.parquet(path).filter(some), path, layout)


def expired_months(months_df: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Mark partitions wholly older than ``as_of - days`` as expired."""
    cutoff = F.date_sub(F.lit(as_of).cast("timestamp_ntz").cast("date"), days)
    last_day = F.last_day(F.col(PARTITION_COL))
    return months_df.withColumn("expired", last_day < cutoff)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def drop_expired_partitions(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS) -> list:
    """Delete partition directories (months or days) older than the retention
    window. Rows without a date have no age and stay."""
    fs, root, jvm = _fs(spark, path)
    cutoff = (as_of.date() if isinstance(as_of, _dt.datetime) else as_of) - _dt.timedelta(days=days)
    dropped = []
    for st in fs.listStatus(root):
        col, _, value = st.getPath().getName().partition("=")
        if col not in PARTITION_COLS.values() or value == NULL_PARTITION:
            continue
        last = start = _dt.date.fromisoformat(value)
        if col == PARTITION_COLS["month"]:
            last = (start.replace(day=28) + _dt.timedelta(days=4)).replace(day=1) - _dt.timedelta(days=1)
        if last < cutoff:
            fs.delete(st.getPath(), True)
            dropped.append(start)
    return sorted(dropped)


# --- versioned overwrite for dimension / aggregate tables --------------------

def current_version(spark: SparkSession, base: str) -> int | None:
    """The newest version whose write was committed (it has Spark's
    ``_SUCCESS`` file); None when there is none."""
    fs, root, jvm = _fs(spark, base)
    if not fs.exists(root):
        return None
    numbers = [int(st.getPath().getName()[2:]) for st in fs.listStatus(root) if st.getPath().getName().startswith("v=")]
    done = [n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/v={n}/_SUCCESS"))]
    return max(done, default=None)


def write_versioned(spark: SparkSession, df: DataFrame, base: str) -> str:
    """Write the next version under ``base/v=<n>``.

    A version counts once its write is committed, so readers see the old or
    the new one, never a half-written one; what a failed write left behind is
    overwritten by the next.
    """
    target = f"{base.rstrip('/')}/v={(current_version(spark, base) or 0) + 1}"
    df.write.mode("overwrite").parquet(target)
    return target


def read_versioned(spark: SparkSession, base: str) -> DataFrame:
    n = current_version(spark, base)
    if n is None:
        raise FileNotFoundError(f"no complete version under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/v={n}")
