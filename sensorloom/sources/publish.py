"""Make a written folder visible in one step.

What is written file by file is seen file by file. A batch that readers must see whole or not at
all is therefore staged in a folder that nobody lists, and takes its place by one rename of that
folder, which HDFS, local disks and object stores with real folders do as one operation.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _context(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = where.getFileSystem(conf)
    return files.makeQualified(where), files


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _context(spark, path)
    return files.exists(where)


def publish(spark: SparkSession, staged: str, place: str) -> bool:
    """Move a staged folder to its place; False, and nothing moves, if the place is taken.

    Of several writers that publish to one place, one gets it: the rename does not replace.
    """
    source, _ = _context(spark, staged)
    target, files = _context(spark, place)
    if files.exists(target):
        return False
    files.mkdirs(target.getParent())
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    no_options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    context = fs.FileContext.getFileContext(target.toUri(), files.getConf())
    try:
        context.rename(source, target, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True
