"""Sources, sinks and stage materialisation.

* ``read_table`` — Parquet scan with the projection stated up front, so the
  physical scan's ``ReadSchema`` holds only the needed columns.
* ``read_csv`` — CSV with an explicit schema (no inference pass) and
  ``multiLine`` quoting so note text with embedded newlines stays one record.
* ``write_csv`` / ``write_jsonl`` / ``write_text`` — partitioned sinks; one
  file per task, never funnelled through one task unless ``single_file`` is
  asked for on a small result.
* ``materialize`` — the compute-or-load stage cache: Parquet under the shared
  ``spark.checkpoint.dir`` (or a caller path, tied to its input by a
  fingerprint). Reading it back cuts lineage, so a lost executor recomputes
  from the written stage, not from scratch.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortkit.session import ensure_checkpoint_dir


# Timestamp layouts for text sinks, with microseconds (the
# writers' defaults keep only milliseconds and would lose precision).
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_LTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_TS_OPTIONS = {"timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_LTZ_FORMAT}


def read_table(spark: SparkSession, base: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table ``base/name.parquet``, pruned to ``columns`` when given."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             multiline: bool = True, header: bool = True) -> DataFrame:
    """CSV with header; quoted fields may span lines; types from ``schema``.

    With no schema, types are inferred — a second pass over the file, kept as
    a convenience for small exports only.
    """
    reader = (spark.read.options(**_TS_OPTIONS).option("header", header).option("multiLine", multiline)
              .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV export with a header. ``single_file`` is for small final results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**_TS_OPTIONS).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines, one record per row (arrays stay arrays)."""
    df.write.mode(mode).options(**_TS_OPTIONS).json(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.options(**_TS_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A file holding one JSON array of records (``json.dump(list)``), one row per element."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def register_tables(spark: SparkSession, base: str, names: Sequence[str]) -> None:
    """Expose tables as temporary views so SQL texts can name them (``FROM t``)."""
    for n in names:
        read_table(spark, base, n).createOrReplaceTempView(n)


def write_text(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> str:
    """Plain text sink of one string column, one line per row."""
    df.select(column).write.mode(mode).text(path)
    return path


def read_text(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return spark.read.text(path, wholetext=whole_file)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cohortkit-stages/{name}-{uuid.uuid4().hex[:12]}"


def drop_old_stages(spark: SparkSession, hours: float = 24.0) -> int:
    """Delete unnamed stages last changed more than ``hours`` ago; returns how many.

    A stage has to outlive the DataFrames that read it, which only the caller
    knows; a scheduled job calls this with more hours than its longest run.
    Named stages (``materialize`` with a path) and streams are left alone.
    """
    fs, folder = _folder(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortkit-stages")
    if not fs.exists(folder):
        return 0
    oldest = time.time() * 1000 - hours * 3_600_000
    gone = [c.getPath() for c in fs.listStatus(folder)
            if re.search("-[0-9a-f]{12}$", c.getPath().getName()) and c.getModificationTime() < oldest]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path) of ``path``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, marker = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


#: Sources whose rows a plan's text does not tell.
_UNSEEN_SOURCES = re.compile(r"\b(LogicalRDD|ExternalRDD|LocalRelation|StreamingRelation)\b")


def fingerprint(df: DataFrame, version: str = "") -> str | None:
    """A digest of what ``df`` is computed from: its plan, and path, size and modification time of every input file.

    Equal queries over untouched files agree, in other sessions too. ``version``
    stands for what neither shows, such as the code of a Python function. None
    where the plan holds rows of the session itself (created frames, RDDs).
    """
    spark = df.sparkSession
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(1 << 20))                   # wide nodes are cut short otherwise
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    files = df.inputFiles()
    if _UNSEEN_SOURCES.search(plan) or not files:
        return None
    state = hashlib.sha256(version.encode())
    numbers: dict[str, int] = {}                        # attributes by the order in which they come
    state.update(re.sub(r"#(\d+)L?", lambda m: f"#{numbers.setdefault(m[1], len(numbers))}", plan).encode())
    for f in sorted(files):
        fs, hpath = _folder(spark, f)
        status = fs.getFileStatus(hpath)
        state.update(f"\n{f} {status.getLen()} {status.getModificationTime()}".encode())
    return state.hexdigest()[:32]


def materialize(df: DataFrame, path: str | None = None, name: str = "stage", version: str = "") -> DataFrame:
    """Compute-or-load: read the stage under ``path`` if it was made from the same input, else write then read.

    A named stage lies in a folder ``path``/<fingerprint> (see
    :func:`fingerprint`): when an input file or the query has changed, the
    stage is rebuilt, and the folders of older inputs are dropped once the new one is
    finished. An unfinished write (no success marker) counts as absent. Where
    there is no fingerprint, the stage is always rebuilt. The returned
    DataFrame scans the written Parquet, so its lineage starts at the stage.
    Without ``path`` a fresh folder under ``spark.checkpoint.dir`` is used (a
    shared folder on a cluster).
    """
    spark = df.sparkSession
    if path is None:
        target = stage_path(spark, name)
        df.write.parquet(target)
        return spark.read.schema(df.schema).parquet(target)
    mark = fingerprint(df, version)
    target = f"{path.rstrip('/')}/{mark or 'unknown-' + uuid.uuid4().hex[:12]}"
    if mark is None or not _exists(spark, target):
        df.write.mode("overwrite").parquet(target)
        fs, folder = _folder(spark, path)
        own = target.rsplit("/", 1)[1]
        for child in fs.listStatus(folder):
            if child.getPath().getName() != own:
                fs.delete(child.getPath(), True)
    return spark.read.schema(df.schema).parquet(target)
