"""Partition-directory listing through the Hadoop FileSystem of the output path.

Which ``col=value`` partitions exist is metadata: one directory per value, so its size is bounded by the number of
partitions, not by the data. Listing the directories avoids a scan job that would open every data file's footer.
Only committed partitions are visible (Spark's writers move them out of ``_temporary`` on commit).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def partition_values(spark: SparkSession, path: str, column: str, committed: bool = False) -> list[str] | None:
    """The values of the ``column=value`` sub-directories directly under ``path``; None when ``path`` does not exist.
    Values are returned as directory text (URL-escaped characters decoded). With ``committed`` only those that hold a
    success marker of their own."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    prefix = f"{column}="
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if committed and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                continue
            out.append(jvm.java.net.URLDecoder.decode(name[len(prefix):], "UTF-8"))
    return out


def file_names(spark: SparkSession, path: str) -> list[str] | None:
    """The names of the files directly under ``path``; None when ``path`` does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()] if fs.exists(p) else None


def delete(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and all below it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """What a small file holds; None when it does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small file; without ``overwrite`` an existing one fails the call."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, overwrite)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file; an existing target fails the call."""
    jvm = spark.sparkContext._jvm
    p, q = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(q) or not fs.rename(p, q):
        raise FileExistsError(f"{path} could not become {to}")
