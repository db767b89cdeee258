"""Sinks and table maintenance.

Tables are Parquet folders. Writes are append-only or replace whole
partitions, so a failed or retried job never leaves half-updated rows:

* a replacement is staged in full, then named in a small journal, then moved
  into place; whoever opens the table for writing next finishes a journal that
  was left behind (``recover``), and a stage without a journal is dropped;
* rows appended under a batch id replace those of the same batch, so a repeated
  run adds nothing;
* run ids are claimed by creating a file that only one writer can create.

This needs a file system whose renames are whole (HDFS and the like).
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscore.functions.ordering import packed_order
from geoscore.operators.joins import bounded_broadcast

# ---------------------------------------------------------------------------
# Append, schema evolution, slice replace
# ---------------------------------------------------------------------------
def append(df: DataFrame, path: str, partition_by: list[str] | None = None, batch: str | None = None) -> None:
    """Append a result to a table (new columns merge on read).

    With ``batch`` the rows go to the table's partition of that batch id
    (column ``batch``) and replace what an earlier attempt left there. A table
    is appended to either with batch ids or without, not both."""
    if batch is not None:
        _replace(df.withColumn("batch", F.lit(batch)), path, ["batch", *(partition_by or [])], 1, [(batch,)])
        return
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by this module, merging evolved schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS`` - missing columns appear as NULL."""
    for name, dtype in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(dtype))
    return df


def replace_slices(df: DataFrame, path: str, partition_by: list[str],
                   slices: list[tuple] | None = None) -> None:
    """Delete-then-insert of slices.

    The table is partitioned by the slice keys (e.g. score, trade, project):
    exactly the partitions that occur in ``df`` are replaced, all others stay.
    ``slices`` (a few key tuples, in the order of ``partition_by``) names
    slices that are to be replaced even if ``df`` holds no row for them; those
    end up empty. A replacement that fails half-way is finished by the next
    one, or by :func:`recover`.
    """
    _replace(df, path, partition_by, len(partition_by), slices or [])


JOURNAL, STAGED = "_replacement.json", "_staged"  # names that Spark's readers skip


def _replace(df: DataFrame, path: str, layout: list[str], depth: int, named: list[tuple]) -> None:
    """Replace the folders of the first ``depth`` partition columns that occur
    in ``df`` or are ``named``: stage, journal, move."""
    spark = df.sparkSession
    recover(spark, path)
    stage = f"{STAGED}/{uuid.uuid4().hex}"
    df.write.partitionBy(*layout).parquet(f"{path}/{stage}")
    found = _folders(spark, f"{path}/{stage}", depth)
    cleared = {_partition_path(spark, layout[:depth], values) for values in named} - set(found)
    _write_journal(spark, path, {"stage": stage, "replace": found, "clear": sorted(cleared)})
    recover(spark, path)


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``path``, relative to it."""
    fs, where = _file_system(spark, path)
    level = [(where, "")]
    for _ in range(depth):
        level = [(st.getPath(), f"{name}/{st.getPath().getName()}".lstrip("/"))
                 for folder, name in level for st in fs.listStatus(folder)
                 if st.isDirectory() and "=" in st.getPath().getName()]
    return sorted(name for _, name in level)


def _write_journal(spark: SparkSession, path: str, journal: dict) -> None:
    """Write the journal beside the table's data: whole or not at all."""
    fs, where = _file_system(spark, f"{path}/{JOURNAL}")
    _, draft = _file_system(spark, f"{path}/{JOURNAL}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(journal).encode()))
    finally:
        out.close()
    if not fs.rename(draft, where):
        raise OSError(f"could not write {where}")


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a replacement whose journal is there; drop what was only staged.
    Returns whether there was one to finish. Every step may be repeated."""
    fs, journal = _file_system(spark, f"{path}/{JOURNAL}")
    pending = fs.exists(journal)
    if pending:
        size = fs.getFileStatus(journal).getLen()
        todo = json.loads(_read_all(spark, fs, journal, size))
        for folder in todo["replace"]:
            _, staged = _file_system(spark, f"{path}/{todo['stage']}/{folder}")
            _, place = _file_system(spark, f"{path}/{folder}")
            if fs.exists(staged):  # else it was moved before
                fs.delete(place, True)
                fs.mkdirs(place.getParent())
                if not fs.rename(staged, place):
                    raise OSError(f"could not move {staged}")
        for folder in todo["clear"]:
            _delete(spark, f"{path}/{folder}")
        fs.delete(journal, False)
    _delete(spark, f"{path}/{STAGED}")
    return pending


def _read_all(spark: SparkSession, fs, where, size: int) -> str:
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(size))).decode()
    finally:
        stream.close()


def _in_slices(cols: list[str], slices: list[tuple]):
    """Condition on literal slice keys (null-safe)."""
    out = F.lit(False)
    for values in slices:
        one = F.lit(True)
        for c, v in zip(cols, values):
            one = one & F.col(c).eqNullSafe(F.lit(v))
        out = out | one
    return out


def _partition_path(spark: SparkSession, cols: list[str], values: tuple) -> str:
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(named.getPartitionPathString(c, None if v is None else str(v)) for c, v in zip(cols, values))


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path, whatever its scheme."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def replaced_view(old: DataFrame, new: DataFrame, slice_cols: list[str],
                  slices: list[tuple] | None = None) -> DataFrame:
    """S8 as a DataFrame: ``old`` without the replaced slices, plus ``new``.

    With ``slices`` (literal key tuples) the old rows are filtered, which
    reaches the scan, and a slice without new rows is cleared; else the slices
    are those that occur in ``new``."""
    if slices is not None:
        return old.where(~_in_slices(slice_cols, slices)).unionByName(new)
    return old.join(new.select(*slice_cols).distinct(), slice_cols, "left_anti").unionByName(new)


# ---------------------------------------------------------------------------
# Keyed update from a staging frame
# ---------------------------------------------------------------------------
def keyed_update(old: DataFrame, staging: DataFrame, key_cols: list[str],
                 value_cols: list[str]) -> DataFrame:
    """``UPDATE old SET v = s.v FROM staging s WHERE key = key``.

    Unmatched old rows keep their values; staging rows without a match are
    not inserted; a matched NULL overwrites (a match marker, not coalesce).
    A key staged several times updates its row once, with the greatest of its
    value tuples (NULL lowest), so an update never adds rows.
    """
    s = (staging.groupBy(*key_cols).agg(F.max(F.struct(*value_cols)).alias("_v"))
         .select(*key_cols, *[F.col(f"_v.{c}").alias(f"_new_{c}") for c in value_cols], F.lit(True).alias("_matched")))
    j = old.join(s, key_cols, "left")
    for c in value_cols:
        j = j.withColumn(c, F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return j.select(*old.columns)


# ---------------------------------------------------------------------------
# Run registry
# ---------------------------------------------------------------------------
def next_run_id(spark: SparkSession, path: str) -> int:
    """``coalesce(max(id), 0) + 1``.

    Only a registry that doesn't exist, or holds no run yet, starts at 1; one
    that can't be read raises, so an earlier run is never overwritten."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where) or not any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(where)):
        return 1
    m = read_table(spark, path).agg(F.max("id")).first()[0]
    return int(m or 0) + 1


def claim_run_id(spark: SparkSession, path: str) -> int:
    """The next run id that no other writer holds. A claim is a file
    below the registry that only one writer can create; the id of a run that
    failed after its claim stays unused."""
    rid = next_run_id(spark, path)
    while not _create_new(spark, f"{path}/_claimed/{rid}"):
        rid += 1
    return rid


def _create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there. One writer succeeds."""
    fs, where = _file_system(spark, path)
    fs.mkdirs(where.getParent())
    try:
        if fs.getScheme() == "file":  # Hadoop's local file system checks first and creates later
            open(where.toUri().getPath(), "x").close()
        else:
            fs.create(where, False).close()
    except (FileExistsError, Py4JJavaError) as error:
        if isinstance(error, Py4JJavaError) and not fs.exists(where):
            raise
        return False
    return True


def register_run(spark: SparkSession, path: str, trade: str, model_kind: str,
                 params: dict, metrics: dict) -> int:
    """Append one run (parameters and metrics as JSON) and return its id."""
    rid = claim_run_id(spark, path)
    row = spark.createDataFrame(
        [(rid, trade, model_kind, json.dumps(params, sort_keys=True),
          json.dumps(metrics, sort_keys=True))],
        "id long, fk_metier string, fk_modele string, parametres string, metrics string",
    ).withColumn("date", F.current_timestamp())
    append(row, path)
    return rid


def metric_of(runs: DataFrame, metric: str, json_col: str = "metrics"):
    """X14 + A6: numeric value of a JSON field (text order would rank 9e-05
    above 0.9)."""
    return F.get_json_object(F.col(json_col), f"$.{metric}").cast("double")


def best_runs(runs: DataFrame, group_cols: list[str], metric, higher_is_better: bool = True,
              id_col: str = "id", candidates: DataFrame | None = None) -> DataFrame:
    """Best run per group, ties to the newest id.

    ``candidates`` (ids of this session's runs) restricts the search - a
    semi join, so the id list can be any size. Two hash aggregates: the best
    metric of each group, then the newest id among the runs that have it (the
    groups' bests are broadcast when few enough).
    """
    if candidates is not None:
        runs = runs.join(candidates.select(id_col).distinct(), id_col, "left_semi")
    m = metric if not isinstance(metric, str) else F.col(metric)
    key = m if higher_is_better else -m
    ranked = runs.where(m.isNotNull()).select(*group_cols, id_col, m.alias("_m"), key.alias("_key"))
    tops = ranked.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)]).agg(F.max("_key").alias("_top"))
    same = F.col("_key") == F.col("_top")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return ranked.join(bounded_broadcast(tops), same).groupBy(*group_cols).agg(
        F.max(id_col).alias("best_id"), F.max("_m").alias("best_metric"))


def latest_runs(runs: DataFrame, group_cols: list[str], id_col: str = "id") -> DataFrame:
    """Newest run id per group."""
    return runs.groupBy(*group_cols).agg(F.max(id_col).alias("latest_id"))


def with_active_flag(runs: DataFrame, best: DataFrame, group_cols: list[str],
                     id_col: str = "id") -> DataFrame:
    """``actif = (id = best id of its group)`` derived, not updated."""
    b = best.select(*group_cols, F.col("best_id"))
    return (runs.join(b, group_cols, "left")
            .withColumn("actif", F.coalesce(F.col(id_col) == F.col("best_id"), F.lit(False)))
            .drop("best_id"))


# ---------------------------------------------------------------------------
# Status log
# ---------------------------------------------------------------------------
def current_status(log: DataFrame, key_cols: list[str], status_col: str = "status",
                   ts_col: str = "ts", tiebreak: str | None = None) -> DataFrame:
    """Current status per project = status of its latest log entry.

    The statuses' hashes go through one hash aggregate, under a packed
    ordering; the few distinct statuses are looked up by hash afterwards."""
    name = F.xxhash64(status_col)
    latest = log.groupBy(*key_cols).agg(
        F.max_by(name, packed_order(log, [ts_col] + ([tiebreak] if tiebreak else []))).alias("_status"),
        F.count(F.lit(1)).alias("n_updates"))
    names = log.select(F.col(status_col), name.alias("_status")).distinct()
    return latest.join(bounded_broadcast(names), "_status").select(*key_cols, status_col, "n_updates")


def log_status(spark: SparkSession, path: str, project_ids: DataFrame, status: str,
               key_col: str = "id_projet", batch: str | None = None) -> None:
    """Append a status change for a set of projects."""
    append(project_ids.select(key_col).distinct()
           .withColumn("status", F.lit(status)).withColumn("ts", F.current_timestamp()), path, batch=batch)


# ---------------------------------------------------------------------------
# Model artifacts
# ---------------------------------------------------------------------------
def save_model(model, base: str, trade: str, kind: str, run_id: int) -> str:
    """Persist a fitted model under trade/kind/run id."""
    path = os.path.join(base, trade, kind, str(run_id))
    model.write().overwrite().save(path)
    return path


def load_model(loader, base: str, trade: str, kind: str, run_id: int):
    """Load the artifact of a run (``loader`` is e.g. ``PipelineModel``)."""
    return loader.load(os.path.join(base, trade, kind, str(run_id)))


def save_artifacts(spark: SparkSession, base: str, trade: str, kind: str, run_id: int,
                   features: list[str], params: dict, importances: DataFrame | None = None,
                   data: DataFrame | None = None) -> None:
    """What a run was trained with, beside its model: selected features,
    parameters, importances and the training rows (X and y)."""
    path = os.path.join(base, trade, kind, f"{run_id}_artifacts")
    row = spark.createDataFrame([(json.dumps(features), json.dumps(params, sort_keys=True))], "features string, params string")
    row.write.mode("overwrite").parquet(f"{path}/settings")
    if importances is not None:
        importances.write.mode("overwrite").parquet(f"{path}/importances")
    if data is not None:
        data.write.mode("overwrite").parquet(f"{path}/data")


def load_features(spark: SparkSession, base: str, trade: str, kind: str, run_id: int) -> list[str]:
    """The selected features of a run, in training order."""
    path = os.path.join(base, trade, kind, f"{run_id}_artifacts", "settings")
    return json.loads(spark.read.parquet(path).first()["features"])
