"""Files of the tables' own storage, through the Hadoop file system that Spark uses for the
same paths: create-if-absent, remove, list, join parts into one file."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


#: Bytes of the buffer through which parts are joined.
_BUFFER = 4 << 20


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; False if it was not there."""
    return file_system(spark, path).delete(_path(spark, path), True)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int, bool]]:
    """(name, bytes, changed at, folder) of what lies in a folder, sorted; empty if absent."""
    if not exists(spark, path):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime(), s.isDirectory())
                  for s in file_system(spark, path).listStatus(_path(spark, path)))


def status(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, changed at) of a file."""
    s = file_system(spark, path).getFileStatus(_path(spark, path))
    return s.getLen(), s.getModificationTime()


def _already_there(exc: Py4JJavaError) -> bool:
    return "AlreadyExists" in exc.java_exception.getClass().getName()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this content, or return False if the name is taken. Of any
    number of callers exactly one succeeds."""
    fs, where, jvm = file_system(spark, path), _path(spark, path), spark._jvm
    fs.mkdirs(where.getParent())
    data = text.encode()
    try:
        if fs.getScheme() == "file":
            # The local file system's own create is a check and a write; this one is atomic.
            options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW
            options[1] = jvm.java.nio.file.StandardOpenOption.WRITE
            jvm.java.nio.file.Files.write(jvm.java.nio.file.Paths.get(where.toUri().getPath(),
                                          spark.sparkContext._gateway.new_array(jvm.String, 0)), data, options)
        else:
            out = fs.create(where, False)
            out.write(data)
            out.close()
    except Py4JJavaError as exc:
        if _already_there(exc):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def may_splice(spark: SparkSession, path: str) -> bool:
    """Whether files may be joined without moving their bytes (``concat``) where ``path`` lies."""
    return file_system(spark, path).getScheme() not in ("file", "viewfs")


def join_files(spark: SparkSession, parts: list[str], target: str, consume: bool = False) -> None:
    """One file from the bytes of all parts in order, put in place by a rename when it is
    complete. A file system that can splice blocks (``concat``) moves no byte; elsewhere they are
    copied through a fixed buffer, and unpacked on the way where a part's name ends like those of a
    Hadoop codec (only if not :func:`may_splice`). With ``consume`` each part is removed once it is
    copied, so that the disk never holds all of them twice."""
    fs, jvm, conf = file_system(spark, target), spark._jvm, spark._jsc.hadoopConfiguration()
    done = _path(spark, target)
    building = _path(spark, f"{target}._building")
    fs.mkdirs(done.getParent())
    out = fs.create(building, True)
    try:
        spliced = False
        if parts and may_splice(spark, target):
            out.close()
            try:
                sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
                for i, p in enumerate(parts):
                    sources[i] = _path(spark, p)
                fs.concat(building, sources)
                spliced = True
            except Py4JJavaError:
                out = fs.create(building, True)
        if not spliced:
            codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
            for p in parts:
                packed = None if may_splice(spark, target) else codecs.getCodec(_path(spark, p))
                stream = file_system(spark, p).open(_path(spark, p))
                try:
                    if packed is not None:
                        stream = packed.createInputStream(stream)
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, _BUFFER, False)
                finally:
                    stream.close()
                if consume:
                    remove(spark, p)
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(done.toUri() if done.isAbsolute() and done.toUri().getScheme()
                                                        else fs.getUri(), conf).rename(building, done, options)
