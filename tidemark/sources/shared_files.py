"""Small files and folders in the store that Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """(file system, path) as Hadoop's client knows them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text at ``path`` at once: readers see the old one or the new one."""
    files, place = _place(spark, path)
    draft = place.suffix(".draft")
    stream = files.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(files.makeQualified(draft), files.makeQualified(place), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text at ``path``; None if there is none."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    files, place = _place(spark, folder)
    return sorted(each.getPath().getName() for each in files.listStatus(place)) if files.exists(place) else []


def bytes_in(spark: SparkSession, folder: str) -> int:
    files, place = _place(spark, folder)
    return files.getContentSummary(place).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, place = _place(spark, path)
    files.delete(place, True)
