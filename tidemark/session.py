"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Environment variable -> Hadoop option of the S3A connector.
OBJECT_STORE_OPTIONS = {
    "S3_ENDPOINT": "fs.s3a.endpoint",
    "S3_ACCESS_KEY": "fs.s3a.access.key",
    "S3_SECRET_KEY": "fs.s3a.secret.key",
    "S3_PATH_STYLE": "fs.s3a.path.style.access",
}


def object_store_conf(env=None) -> dict[str, str]:
    """S3A settings taken from the environment; credentials never live in code."""
    env = os.environ if env is None else env
    conf = {f"spark.hadoop.{opt}": env[name] for name, opt in OBJECT_STORE_OPTIONS.items() if env.get(name)}
    if conf:
        conf["spark.hadoop.fs.s3a.impl"] = "org.apache.hadoop.fs.s3a.S3AFileSystem"
        conf.setdefault("spark.hadoop.fs.s3a.path.style.access", "true")
    return conf


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` keys use ``_`` for ``.``-free options only."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **object_store_conf(),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ensure_session(builder.getOrCreate())


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, in a session somebody else made; instants are stored with bounds scans can skip by."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without that setting (tests) falls back to a
    folder of this machine; on a cluster executors could not see one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so retries cannot mix."""
    return f"{scratch_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder; none if it is not there."""
    files, at = _folder(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    files, at = _folder(spark, path)
    files.delete(at, True)


def put_line(spark: SparkSession, path: str, line: str) -> None:
    """Replace a small file by one line of ASCII text."""
    files, at = _folder(spark, path)
    out = files.create(at, True)
    out.writeBytes(line + "\n")
    out.close()


def get_line(spark: SparkSession, path: str) -> str | None:
    """The line of :func:`put_line`; None if there is none, or not a whole one."""
    files, at = _folder(spark, path)
    if not files.exists(at):
        return None
    scanner = spark._jvm.java.util.Scanner(files.open(at)).useDelimiter("\\A")
    text = scanner.next() if scanner.hasNext() else ""
    scanner.close()
    return text[:-1] if text.endswith("\n") else None


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables; frames that still read them must have been used before."""
    remove(spark, f"{scratch_root(spark)}/tidemark")


def cut_lineage(df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Unlike a cached or locally checkpointed frame, the files outlive lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
