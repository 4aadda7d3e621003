"""Small file-system helpers over the Hadoop FileSystem API (local, HDFS, object
stores alike) — used for pointer files and partition listings only; data is
always read and written by Spark."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def publish_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` at once and only if it does not exist yet.

    The text goes to a sibling file first; renaming that one never replaces an
    existing file.  Readers see the whole file or none, and of two writers of
    the same path one gets ``False``.
    """
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    p = fs.makeQualified(p)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"._tmp_{uuid.uuid4().hex}_{p.getName()}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        context.rename(tmp, p, how)
        return True
    except Py4JJavaError as e:
        fs.delete(tmp, False)
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
            return False
        raise


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly below ``path`` (hidden ones left out)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if st.isFile() and not st.getPath().getName().startswith("."))


def list_partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=<v>`` sub-directories directly below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(column + "="):
            out.append(name.split("=", 1)[1])
    return sorted(out)


def list_partition_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of ``k=v`` sub-directories directly below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if st.isDirectory() and "=" in st.getPath().getName())


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, from the file system's own summary."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of the names, sizes and times of all files below ``path`` (hidden ones left out)."""
    fs, p = _fs(spark, path)
    found = []
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            inside = f.getPath().toString()[len(fs.makeQualified(p).toString()):].lstrip("/")
            if not any(part.startswith(("_", ".")) and "=" not in part for part in inside.split("/")):
                found.append((inside, f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:32]
