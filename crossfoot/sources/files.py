"""Fingerprints of source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.runtime import ref


def file_fingerprints(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, file_name, size_bytes, sha256) of every file; executors stream each file through its hash, whatever its size."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        _streamed_sha256(spark, "path").alias("sha256"),
    )


def _streamed_sha256(spark: SparkSession, path: str) -> Column:
    """SHA-256 of the file that column ``path`` names, read by Spark's executors a buffer at a time.

    No SQL function and no reader passes on a file in pieces (``binaryFile`` holds its content in one cell, several times
    over, and stops at 2 GB), so the column calls Hadoop's file system and commons-codec through Catalyst's expressions:
    ``DigestUtils.sha256Hex(new AutoCloseInputStream(new Path(path).getFileSystem(conf).open(new Path(path))))``.
    """
    jvm = spark.sparkContext._jvm
    nodes, catalyst = jvm.org.apache.spark.sql.classic.ExpressionUtils, jvm.org.apache.spark.sql.catalyst.expressions
    to_class, none = jvm.java.lang.Class.forName, jvm.scala.Option.empty()

    def kind(name):
        return jvm.org.apache.spark.sql.types.ObjectType(to_class(name))

    def seq(*items):
        return jvm.org.apache.spark.api.python.PythonUtils.toSeq(list(items))

    def new(name, *args):
        return catalyst.objects.NewInstance(to_class(name), seq(*args), seq(), True, kind(name), none)

    def call(target, method, returns, *args):
        return catalyst.objects.Invoke(target, method, returns, seq(*args), seq(), True, True, True)

    def static(name, method, returns, *args):
        return catalyst.objects.StaticInvoke(to_class(name), returns, method, seq(*args), seq(), True, True, True, none)

    settings = "org.apache.spark.util.SerializableConfiguration"
    shared = jvm.org.apache.spark.util.SerializableConfiguration(spark._jsparkSession.sessionState().newHadoopConf())
    conf = call(catalyst.Literal(shared, kind(settings)), "value", kind("org.apache.hadoop.conf.Configuration"))
    place = new("org.apache.hadoop.fs.Path", call(nodes.expression(ref(path)._jc), "toString", kind("java.lang.String")))
    system = call(place, "getFileSystem", kind("org.apache.hadoop.fs.FileSystem"), conf)
    opened = call(system, "open", kind("org.apache.hadoop.fs.FSDataInputStream"), place)
    stream = new("org.apache.commons.io.input.AutoCloseInputStream", opened)  # closes at the end of the file
    digest = static("org.apache.commons.codec.digest.DigestUtils", "sha256Hex", kind("java.lang.String"), stream)
    text = jvm.org.apache.spark.sql.types.DataType.fromDDL("string")
    return Column(nodes.column(static("org.apache.spark.unsafe.types.UTF8String", "fromString", text, digest)))


def content_fingerprint(df: DataFrame, table: str) -> DataFrame:
    """(table_name, n_rows, fingerprint) of a table's content, whatever files and order it comes in.

    Every row becomes text in which each cell tells its length, so no two rows share a text. Of its MD5, two numbers of
    60 bits are taken, and each is added up over all rows. The sums split over any number of tasks; no file is ever held
    as a whole.
    """
    sums = [F.coalesce(F.sum(number), F.lit(0)).cast("string") for number in row_numbers(df)]
    return df.agg(F.count("*").alias("n_rows"), F.concat_ws("-", *sums).alias("fingerprint")).select(
        F.lit(table).alias("table_name"), "n_rows", "fingerprint"
    )


def row_digest(df: DataFrame) -> Column:
    """MD5 of a row's text, in which each cell tells its length."""
    cells = [ref(c).cast("string") for c in df.columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]))


def row_numbers(df: DataFrame) -> list[Column]:
    """Two numbers of 60 bits out of :func:`row_digest`, to be added up."""
    return [F.conv(F.substring(row_digest(df), at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]


def folder_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(file_name, sha256) per folder, from the fingerprints of its files in order of their names."""
    parts = F.array_sort(F.collect_list(F.struct("file_name", "sha256")))
    folder = F.element_at(F.split("path", "/"), -2)
    return fingerprints.groupBy(folder.alias("folder")).agg(F.sha2(F.concat_ws("", F.transform(parts, lambda x: x["sha256"])), 256).alias("sha256")).select(
        F.col("folder").alias("file_name"), "sha256"
    )


def unchanged_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table_name, unchanged) from two fingerprints; a table that one side lacks has changed."""
    tagged = before.select("table_name", F.struct("n_rows", "fingerprint").alias("b"), F.lit(None).alias("a")).unionByName(
        after.select("table_name", F.lit(None).alias("b"), F.struct("n_rows", "fingerprint").alias("a"))
    )
    met = tagged.groupBy("table_name").agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return met.select("table_name", F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("unchanged"))


def unchanged_files(before: DataFrame, after: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(file_name, before, after, expected, unchanged) for every file seen on any side.

    ``expected`` holds (file_name, sha256). A file that is absent on one side counts as changed.
    """
    sides = {"before": before, "after": after, "expected": expected}
    tagged = [
        df.select("file_name", F.lit(side).alias("side"), "sha256") for side, df in sides.items() if df is not None
    ]
    rows = tagged[0]
    for more in tagged[1:]:
        rows = rows.unionByName(more)
    wide = rows.groupBy("file_name").pivot("side", list(sides)).agg(F.max("sha256"))
    same = F.coalesce(F.col("before") == F.col("after"), F.lit(False))
    if expected is not None:
        same = same & F.coalesce(F.col("after") == F.col("expected"), F.lit(False))
    return wide.withColumn("unchanged", same)
