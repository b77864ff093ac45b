"""The few file-system calls Spark's readers and writers do not offer, on whatever store a path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    store, hadoop_path = _handle(spark, path)
    return store.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """A path in full, encoded as in ``_metadata.file_path``."""
    store, hadoop_path = _handle(spark, path)
    return store.makeQualified(hadoop_path).toUri().toASCIIString()


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder, hidden ones left out; empty when the folder is absent."""
    store, path = _handle(spark, folder)
    if not store.exists(path):
        return []
    names = (status.getPath().getName() for status in store.listStatus(path))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    store, path = _handle(spark, folder)
    return store.getContentSummary(path).getLength()


def delete_folder(spark: SparkSession, folder: str) -> None:
    store, path = _handle(spark, folder)
    store.delete(path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A file of a few hundred bytes."""
    store, hadoop_path = _handle(spark, path)
    stream = store.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    store, hadoop_path = _handle(spark, path)
    stream = store.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the complete folder ``new`` in the place of ``path``."""
    store, target = _handle(spark, path)
    store.delete(target, True)
    if not store.rename(_handle(spark, new)[1], target):
        raise OSError(f"cannot move {new} to {path}")


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole, or return False if there is one already."""
    store, target = _handle(spark, path)
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/_{uuid.uuid4().hex}-{name}"
    write_text(spark, aside, text)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_handle(spark, aside)[1], store.makeQualified(target), keep)
    except Py4JJavaError as error:
        delete_folder(spark, aside)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True
