"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

# folders of local sessions that name none, by application
_OWN: dict[str, str] = {}


def build_session(app_name: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library's results rely on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps mean UTC everywhere in the library."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own; a cluster
    without the setting is refused, since a driver-local folder would be lost
    to the executors.  That folder goes with the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemill-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return _OWN[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidemill/{app}/{label}-{uuid.uuid4().hex}"


def _on_file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the path's own file system."""
    files, target = _on_file_system(spark, path)
    return files.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where there is no folder."""
    files, target = _on_file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(target)] if files.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _on_file_system(spark, path)
    files.mkdirs(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of a file or folder, from its file system's own listing."""
    files, target = _on_file_system(spark, path)
    return files.getContentSummary(target).getLength()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, spelled as Spark reports file paths."""
    files, target = _on_file_system(spark, path)
    return files.makeQualified(target).toString()


def publish_folder(spark: SparkSession, staged: str, target: str, overwrite: bool = False) -> None:
    """Give a finished folder its public name; what had the name before is put back if that fails, else removed."""
    files, new = _on_file_system(spark, staged)
    _, public = _on_file_system(spark, target)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
    held = files.exists(public)
    if held and not overwrite:
        raise FileExistsError(f"{target} already exists")
    if held and not files.rename(public, old):
        raise OSError(f"{target} cannot be replaced")
    if not files.rename(new, public):
        if held:
            files.rename(old, public)
        raise OSError(f"{staged} cannot become {target}")
    if held:
        files.delete(old, True)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and survives executor loss."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def materialize_counted(df: DataFrame, of: Column | None = None) -> tuple[DataFrame, int]:
    """The same, with the number of rows (those ``of`` a condition), counted while they are written."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation()
    counted = F.count(F.lit(1)) if of is None else F.count_if(of)
    stored = materialize(df.observe(seen, counted.alias("rows")))
    return stored, seen.get["rows"]
