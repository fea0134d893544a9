"""Layer storage: Parquet scans and sinks, keyed upserts.

A layer is a folder with ``data``, where every write makes a new folder of
files, and ``_log``, where commit n is a list of the files that make up the
layer, each with its bucket (a hash of the series key), its rows and its first
and last date.  A commit is written aside and renamed to its number; a number
that is taken is never replaced, so of two writers one has to look again at
what the other committed.  Readers take the newest list: they see a write whole
or not at all, and one that started before an overwrite reads on, because its
files stay until ``vacuum``.  (The rename must fail when the target exists: HDFS
and local disks do so, plain object stores do not.)

An incremental Bronze load appends only the rows whose (series, date) is not
stored yet; it reads the files whose bucket and dates meet those of the batch
and no others.  The key itself is a column of the files, so its type and text
stay as they are.

Saved models are folders of versions with a pointer file (``publish``).
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from ..schemas import KEY, TS

BUCKETS = 64
BUCKET = "key_bucket"
POINTER, LOG, DATA = "CURRENT", "_log", "data"
KEPT_COMMITS = 10  # commits whose files ``vacuum`` leaves alone


class CommitConflict(RuntimeError):
    """Another writer has taken the commit number."""


# ------------------------------------------------------------ version pointer
def _store(spark: SparkSession, path: str):
    """The Hadoop FileContext and Path class for ``path``."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, at.getFileSystem(conf), conf


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the layer now, or None."""
    jvm, fs, _ = _store(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return f"{path}/{stream.readUTF()}"
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Point the layer at ``version`` by an atomic rename, then delete the
    version before it."""
    jvm, fs, conf = _store(spark, path)
    hadoop = jvm.org.apache.hadoop.fs
    old = current_version(spark, path)
    draft = hadoop.Path(f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.writeUTF(version)
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else
                                                fs.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, hadoop.Path(f"{path}/{POINTER}"), options)
    if old and old != f"{path}/{version}":
        fs.delete(hadoop.Path(old), True)


# ----------------------------------------------------------------- commits
def _hadoop(spark: SparkSession, path: str):
    """Path class, file system and file context of ``path``."""
    jvm, fs, conf = _store(spark, path)
    hadoop = jvm.org.apache.hadoop.fs
    return hadoop, fs, hadoop.FileContext.getFileContext(fs.getUri(), conf)


def commit_numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all commits, oldest first."""
    hadoop, fs, _ = _hadoop(spark, path)
    log = hadoop.Path(f"{path}/{LOG}")
    if not fs.exists(log):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(log)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def files_of(spark: SparkSession, path: str, number: int | None = None) -> tuple[int, list[dict]]:
    """A commit (the newest if not given; 0 if there is none) and its files."""
    number = number or (commit_numbers(spark, path) or [0])[-1]
    if not number:
        return 0, []
    return number, read_json_file(spark, f"{path}/{LOG}/{number:020d}.json")


def read_json_file(spark: SparkSession, path: str):
    jvm, fs, _ = _store(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(path))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, number: int, files: list[dict]) -> None:
    """Make ``files`` the layer as commit ``number``, or raise CommitConflict
    if that commit exists."""
    hadoop, fs, context = _hadoop(spark, path)
    draft = hadoop.Path(f"{path}/{LOG}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(files).encode()))
    finally:
        stream.close()
    none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    none[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(draft, hadoop.Path(f"{path}/{LOG}/{number:020d}.json"), none)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            raise CommitConflict(f"commit {number} of {path} is taken") from None
        raise


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_COMMITS) -> int:
    """Delete the writes that none of the last ``keep`` commits uses, and the
    older commits.  Not to be run beside a writer: it would take a write that
    is not committed yet for an old one.  Returns the writes deleted."""
    hadoop, fs, _ = _hadoop(spark, path)
    numbers = commit_numbers(spark, path)
    used = {f["path"].split("/")[1] for n in numbers[-keep:] for f in files_of(spark, path, n)[1]}
    old = [f.getPath() for f in fs.listStatus(hadoop.Path(f"{path}/{DATA}")) if f.getPath().getName() not in used]
    for n in numbers[:-keep]:
        fs.delete(hadoop.Path(f"{path}/{LOG}/{n:020d}.json"), False)
    for at in old:
        fs.delete(at, True)
    return len(old)


# ----------------------------------------------------------------- scans
def read_layer(spark: SparkSession, path: str, schema: StructType | None = None,
               missing_ok: bool = True) -> DataFrame:
    """Read a layer.  A layer that does not exist gives an
    empty frame of ``schema`` when ``missing_ok`` (A2), else raises (A3)."""
    number, files = files_of(spark, path)
    if not number:
        if not missing_ok:
            raise FileNotFoundError(f"no layer at {path}")
        if schema is None:
            raise ValueError("a layer that may be missing needs a schema")
        return spark.createDataFrame([], schema)
    return _scan(spark, path, files, schema)


def _scan(spark: SparkSession, path: str, files: list[dict], schema: StructType | None) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*[f"{path}/{f['path']}" for f in files])


def touched_files(files: list[dict], new: DataFrame) -> list[dict]:
    """The files that may hold a (series, date) of ``new``: those of its
    buckets whose dates meet the batch's dates in that bucket."""
    if KEY not in new.columns or TS not in new.columns:
        return files
    spans = _bucketed(new).groupBy(BUCKET).agg(  # one row a bucket
        F.min(TS).cast("string").alias("lo"), F.max(TS).cast("string").alias("hi"),
        F.count_if(F.col(TS).isNull()).alias("none")).collect()
    of = {r[BUCKET]: r for r in spans}

    def meets(f: dict) -> bool:
        r = of.get(f["bucket"])
        if r is None:
            return False
        dated = r.lo is not None and f["lo"] is not None and f["lo"] <= r.hi and r.lo <= f["hi"]
        return dated or bool(r.none and f["undated"])

    return [f for f in files if f["bucket"] is None or meets(f)]


# ----------------------------------------------------------------- sinks
def _bucketed(df: DataFrame) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(BUCKETS))) if KEY in df.columns else df


def add_files(df: DataFrame, path: str) -> list[dict]:
    """Write the rows of ``df`` to a new folder and describe its files.  Rows
    are dealt by bucket first, a large bucket to several tasks and small ones
    together, so a task writes few files.  Nothing is committed."""
    spark = df.sparkSession
    folder = f"{DATA}/{uuid.uuid4().hex}"
    rows = _bucketed(df)
    if BUCKET in rows.columns:
        rows = rows.hint("rebalance", BUCKET)
    writer = _sorted_by_date(rows).write
    (writer.partitionBy(BUCKET) if BUCKET in rows.columns else writer).parquet(f"{path}/{folder}")
    dated = TS in df.columns
    at = F.col(TS) if dated else F.lit(None).cast("string")
    back = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
    facts = back.select(at.alias("t"), F.col("_metadata.file_path").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("rows"), F.min("t").cast("string").alias("lo"), F.max("t").cast("string").alias("hi"),
        F.count_if(F.col("t").isNull()).alias("undated")).collect()  # one row a file
    out = []
    for r in facts:
        name = r.f[r.f.index(folder):]
        bucket = re.search(rf"/{BUCKET}=(\d+)/", name)
        out.append({"path": name, "bucket": int(bucket.group(1)) if bucket else None, "rows": r.rows,
                    "lo": r.lo, "hi": r.hi, "undated": r.undated})
    return sorted(out, key=lambda f: f["path"])


def write_layer(df: DataFrame, path: str) -> int:
    """Replace a layer, unless the frame is empty.  The plan runs
    once; the rows are counted in the written files.  Returns their number."""
    spark = df.sparkSession
    files = add_files(df, path)
    while files:
        number, _ = files_of(spark, path)
        try:
            commit(spark, path, number + 1, files)
            break
        except CommitConflict:  # an overwrite replaces whatever is there
            continue
    return sum(f["rows"] for f in files)


def _sorted_by_date(df: DataFrame) -> DataFrame:
    """rows leave in (series, date) order inside every file; a sort
    within partitions, no global sort and no extra shuffle."""
    if KEY in df.columns and TS in df.columns:
        return df.sortWithinPartitions(BUCKET, KEY, TS)
    return df


def write_json_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON document (feature config, metrics, metadata, tuning
    summary), stored as text in one file."""
    spark.createDataFrame([(json.dumps(record, default=str),)], "doc string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_json_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def preview(df: DataFrame, n: int = 5, cols: list[str] | None = None,
            key: str = KEY, ts: str = TS) -> DataFrame:
    """the first ``n`` rows of every series (optionally a column subset)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).asc())
    out = df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")
    return out.select(key, ts, *cols) if cols else out


# --------------------------------------------------------------- upserts
def upsert(existing: DataFrame, new: DataFrame, keep: str = "existing",
           keys: list[str] | None = None, order_col: str | None = None) -> DataFrame:
    """Union the stored rows and a new delivery, one row per
    key.  ``keep='existing'``: the stored row wins (A7); ``keep='new'``: the
    newest delivered row wins (A13; ``order_col`` orders rows of the same
    side, newest last).  One shuffle on the keys; every group holds the
    copies of one (series, date), so it is small whatever the skew of the
    series."""
    keys = keys or [KEY, TS]
    cols = existing.columns
    e = existing.withColumn("_src", F.lit(0))
    n = new.select(*cols).withColumn("_src", F.lit(1))
    both = e.unionByName(n)
    src = F.col("_src").asc() if keep == "existing" else F.col("_src").desc()
    order = [src]
    if order_col:
        order.append(F.col(order_col).desc() if keep == "new" else F.col(order_col).asc())
    w = Window.partitionBy(*keys).orderBy(*order)
    return both.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk", "_src")


def new_rows_only(existing: DataFrame, new: DataFrame, keys: list[str] | None = None,
                  order_col: str | None = None) -> DataFrame:
    """A7 for appends: the rows of ``new`` whose key is not stored yet.
    Inside the batch the first copy by ``order_col`` wins; a batch without one
    must be unique per key.  Appending the result equals the keep-existing
    upsert without rewriting the stored layer; replaying the same batch appends
    nothing.  ``new`` is evaluated once more for its date range, so callers
    pass a written or persisted batch."""
    keys = keys or [KEY, TS]
    if order_col:
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
        new = new.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")
    stored = existing.select(*keys)
    if TS in keys:
        # only stored rows inside the batch's date range can collide: a
        # literal range filter reaches the Parquet scan (row-group pruning)
        lo, hi = new.agg(F.min(TS), F.max(TS)).first()
        within = F.col(TS).isNull()
        if lo is not None:
            within = within | F.col(TS).between(_ts_lit(lo, new), _ts_lit(hi, new))
        stored = stored.where(within)
    stored = stored.withColumnsRenamed({k: f"_stored_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys]  # null keys are equal, as in ``upsert``
    return new.join(stored, same, "left_anti")


def _ts_lit(value, df: DataFrame):
    """A literal of the same timestamp type as ``df.date`` (NTZ literals are
    built from ISO text, so no time zone is involved)."""
    if isinstance(df.schema[TS].dataType, TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))
    return F.lit(value)


def append_bronze(spark: SparkSession, new: DataFrame, path: str,
                  order_col: str | None = None) -> int:
    """A7 / L4 incremental load: commit the not-yet-stored rows as further
    files of Bronze.  Only files that may hold a key of the batch are read.
    When another writer commits first, the rows are compared again with what
    the layer holds then.  Returns the rows appended."""
    new = new.checkpoint()  # the batch is read for its range, for the join and for the count
    schema = new.drop(*([order_col] if order_col else [])).schema
    while True:
        number, files = files_of(spark, path)
        existing = _scan(spark, path, touched_files(files, new), schema)
        body = new_rows_only(existing, new, order_col=order_col)
        added = add_files(body.drop(order_col) if order_col else body, path)
        if not added:
            return 0
        try:
            commit(spark, path, number + 1, files + added)
            return sum(f["rows"] for f in added)
        except CommitConflict:
            continue


PAGE, FETCH = "page_no", "fetch"  # columns of Bronze files that pages were merged into; the layer schemas leave them out


def merge_pages(spark: SparkSession, new: DataFrame, path: str, fetch: str) -> int:
    """A8 over several deliveries of one fetch: the row of the lowest page
    stays, whichever came first.  A stored row keeps its page and the name of
    its fetch; it gives way only to a lower page of the same fetch, so rows of
    earlier fetches (and files without these columns) stay as in A7.  Files
    that hold no such row are not rewritten.  The same delivery again changes
    nothing.  Null keys are equal; a null page counts as the last.  Returns
    the rows added or replaced."""
    none = F.coalesce(F.col(PAGE), F.lit(2**31 - 1))
    w = Window.partitionBy(KEY, TS).orderBy(none)
    new = (new.withColumn(PAGE, none).withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")
           .withColumn(FETCH, F.lit(fetch)).checkpoint())
    while True:
        number, files = files_of(spark, path)
        met = touched_files(files, new)
        stored = _scan(spark, path, met, new.schema)
        body = new_rows_only(stored, new)
        late = _late_rows(stored, new).checkpoint() if met else None
        names = set()
        if late is not None:
            found = late.select("_file").distinct().collect()  # at most the files met
            names = {r[0][r[0].rindex(f"/{DATA}/") + 1:] for r in found}
        again = [f for f in files if f["path"] in names]
        if again:
            winners = late.drop("_file")
            body = body.unionByName(new_rows_only(winners, _scan(spark, path, again, new.schema))).unionByName(winners)
        added = add_files(body, path)
        if not added:
            return 0
        try:
            commit(spark, path, number + 1, [f for f in files if f["path"] not in names] + added)
            return sum(f["rows"] for f in added) - sum(f["rows"] for f in again) + (late.count() if again else 0)
        except CommitConflict:
            continue


def _late_rows(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` with a lower page than the stored row of their key and
    fetch, and the file that holds it."""
    old = stored.select(F.col(KEY).alias("_key"), F.col(TS).alias("_ts"), F.col(PAGE).alias("_page"),
                        F.col(FETCH).alias("_fetch"), F.col("_metadata.file_path").alias("_file"))
    same = F.col(KEY).eqNullSafe(F.col("_key")) & F.col(TS).eqNullSafe(F.col("_ts")) & (F.col(FETCH) == F.col("_fetch"))
    return new.join(old, same & (F.col(PAGE) < F.col("_page"))).drop("_key", "_ts", "_page", "_fetch")


# ----------------------------------------------------------------- top-k
def latest(df: DataFrame, n: int = 1, key: str = KEY, ts: str = TS) -> DataFrame:
    """The newest ``n`` rows of every series."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")


def best_per_group(df: DataFrame, group: list[str], metric: str, order_col: str,
                   largest: bool = False) -> DataFrame:
    """Per group, the row with the best ``metric``; the first
    ``order_col`` wins ties."""
    m = F.col(metric).desc_nulls_last() if largest else F.col(metric).asc_nulls_last()
    w = Window.partitionBy(*group).orderBy(m, F.col(order_col).asc())
    return df.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")


# ------------------------------------------------------- fixture deliveries
EXISTING_SHARE = 0.9  # fixed value: share of each series already stored
OVERLAP_ROWS = 10  # fixed value: re-delivered rows in the new batch


def fixture_deliveries(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Existing Bronze = the first 90 % of each series; the new delivery =
    the rest plus the last 10 stored rows, all with close + 1."""
    w = Window.partitionBy(KEY).orderBy(TS)
    b = bars.withColumns({"_rn": F.row_number().over(w),
                          "_n": F.count(F.lit(1)).over(Window.partitionBy(KEY))})
    cut = F.floor(F.col("_n") * F.lit(EXISTING_SHARE))
    existing = b.where(F.col("_rn") <= cut).drop("_rn", "_n")
    new = (b.where(F.col("_rn") > cut - OVERLAP_ROWS)
            .withColumn("close", F.col("close") + 1.0).drop("_rn", "_n"))
    return existing, new


def fixture_predictions(preds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored predictions (made on the bar date) and a second run that
    re-predicts the newest 20 % of dates one day later with y_pred + 1."""
    w = Window.partitionBy(KEY).orderBy(TS)
    base = preds.select(KEY, TS, "y_true", "y_pred", F.col(TS).alias("prediction_date"))
    b = base.withColumns({"_rn": F.row_number().over(w),
                          "_n": F.count(F.lit(1)).over(Window.partitionBy(KEY))})
    new = (b.where(F.col("_rn") > F.floor(F.col("_n") * F.lit(0.8)))
            .withColumns({"y_pred": F.col("y_pred") + 1.0,
                          "prediction_date": F.timestamp_add("DAY", F.lit(1), F.col(TS))})
            .drop("_rn", "_n"))
    return base, new
