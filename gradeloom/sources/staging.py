"""Tables written to the shared folder, to pin a result and cut its lineage."""

import re
import tempfile
import uuid

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_SINGLE_PROCESS = re.compile(r"local(\[[\d*,]+\])?")
_LOCAL_FOLDERS = {}
_STAGED = {}


def staging_dir(spark):
    """Shared folder named by the session; a single-process run gets one of its own."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not _SINGLE_PROCESS.fullmatch(spark.conf.get("spark.master", "")):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="gradeloom-")
    return _LOCAL_FOLDERS[application]


def staging_path(spark, name):
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df, name, **options):
    """Write ``df`` once, with the given writer options, and read it back.

    The files outlive lost executors, later readers do not repeat the work, and
    the planner knows the real size of the result.
    """
    path = staging_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    _STAGED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_staged(spark):
    """Delete the tables staged so far, once no result reads them any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        place = hadoop(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
