"""Small files on whatever file system a path is on: created whole or not at all, read, listed, deleted."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_new(spark: SparkSession, path: str, data: bytes) -> bool:
    """Creates a file with all of its content; False where there is one already. Of several writers that try at once exactly one succeeds, and
    a reader sees the whole file or none.

    The content goes to a file of another name first. A local file system gives it its name by a hard link, which fails if the name is taken;
    others by a rename, which must be atomic and refuse a name that is taken, as HDFS does.
    """
    files, jvm = file_system(spark, path), spark.sparkContext._jvm
    folder, name = path.rsplit("/", 1)
    files.mkdirs(hadoop_path(spark, folder))
    fresh = hadoop_path(spark, f"{folder}/.{name}.{uuid.uuid4().hex[:12]}")
    out = files.create(fresh, False)
    out.write(bytearray(data))
    out.close()
    try:
        at = files.resolvePath(fresh)
        if at.toUri().getScheme() in (None, "file"):
            source = jvm.java.io.File(at.toUri().getPath())
            try:
                jvm.java.nio.file.Files.createLink(jvm.java.io.File(source.getParentFile(), name).toPath(), source.toPath())
                return True
            except Py4JJavaError as error:
                if "FileAlreadyExists" in error.java_exception.getClass().getName():
                    return False
                raise
        target = hadoop_path(spark, path)
        return not files.exists(target) and bool(files.rename(fresh, target))
    finally:
        files.delete(fresh, False)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    stream = file_system(spark, path).open(hadoop_path(spark, path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, those that start with a dot left out; none where there is no folder."""
    files, at = file_system(spark, folder), hadoop_path(spark, folder)
    if not files.exists(at):
        return []
    return sorted(n for n in (s.getPath().getName() for s in files.listStatus(at)) if not n.startswith("."))


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths, below the folder, of the files in it and in its folders, but for those that start with a dot or an underscore."""
    files, at = file_system(spark, folder), hadoop_path(spark, folder)
    if not files.exists(at):
        return []
    base, out, found = files.getFileStatus(at).getPath().toUri().getPath().rstrip("/") + "/", [], files.listFiles(at, True)
    while found.hasNext():
        path = found.next().getPath()
        if path.getName()[0] not in "._":
            out.append(path.toUri().getPath().removeprefix(base))
    return sorted(out)


def fresh() -> str:
    return uuid.uuid4().hex[:12]


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a folder that nobody else knows yet its name; False, and the folder is gone, where the name is taken."""
    files, to = file_system(spark, target), hadoop_path(spark, target)
    files.mkdirs(to.getParent())
    if not files.exists(to) and files.rename(hadoop_path(spark, source), to):
        return True
    files.delete(hadoop_path(spark, source), True)
    return False


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Of a file, or of all files below a folder; 0 where there is nothing."""
    files, at = file_system(spark, path), hadoop_path(spark, path)
    return files.getContentSummary(at).getLength() if files.exists(at) else 0


def modified_ms(spark: SparkSession, path: str) -> int:
    return file_system(spark, path).getFileStatus(hadoop_path(spark, path)).getModificationTime()
