"""Replay an archive of raw lines as a stream source.

Lines are sent unparsed (the consumer parses with the declared schema),
stripped, blank lines dropped, optionally only the first ``limit`` lines (in the
order of the files and of the lines in them). The
offline stand-in for a message topic is a folder that a file stream reads. All
source files are read and written by one parallel job; the files it wrote then
appear in the landing folder segment by segment, with rising modification
times, which is the order a file stream takes them in. With the Kafka connector
present, ``topic`` publishes instead.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.sources.files import expand_paths
from eventmart.sources.messages import stream_source

# ASCII whitespace stripped from both ends of a line (space, \t, \n, \v, \f, \r).
WHITESPACE = " \t\n\x0b\x0c\r"


def clean_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines stripped of surrounding whitespace; blank ones dropped."""
    v = F.btrim(F.col(value_col), F.lit(WHITESPACE))
    return lines.withColumn(value_col, v).filter(F.length(value_col) > 0)


def _same_form(path):
    """One spelling of a path, however many slashes follow its scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def archive_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[int, str]]:
    """(seq, file) in delivery order: seq numbers the given files or folders, a folder's files go by name."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for seq, source in enumerate(expand_paths(spark, paths)):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
        listed = [st.getPath() for st in path.getFileSystem(conf).listStatus(path) if st.isFile()]
        files += sorted((seq, p.toString()) for p in listed if not p.getName().startswith(("_", ".")))
    return files


def archive_lines(spark: SparkSession, files: Sequence[tuple[int, str]]) -> DataFrame:
    """(seq, place, value): the clean lines of the files; place numbers the files. One scan of all files."""
    if not files:
        return spark.createDataFrame([], "seq int, place int, value string")
    text = spark.read.text([f for _, f in files]).select(
        "value", _same_form(F.url_decode("_metadata.file_path")).alias("_from"))
    order = spark.createDataFrame([(seq, place, f) for place, (seq, f) in enumerate(files)], "seq int, place int, path string")
    order = order.select("seq", "place", _same_form(F.col("path")).alias("_from"))
    # a row per archive file; every line has one
    return clean_lines(text.join(F.broadcast(order), "_from").select("seq", "place", "value"))


def _first_lines(spark: SparkSession, files: list[tuple[int, str]], limit: int) -> DataFrame:
    """The first ``limit`` lines in delivery order.

    Lines per file give the files that are sent whole and the one that is cut; of that
    one, lines per split give the whole splits, and only the split where the limit
    falls has its lines numbered.
    """
    counted = dict(archive_lines(spark, files).groupBy("place").count().collect())     # a row per file
    left, whole, cut = limit, [], None
    for place, file in enumerate(files):
        n = counted.get(place, 0)
        if n > left:
            cut = file
            break
        whole.append(file)
        left -= n
    taken = archive_lines(spark, whole)
    return taken.unionByName(_head(spark, cut, left)) if cut and left else taken


def _head(spark: SparkSession, file: tuple[int, str], n: int) -> DataFrame:
    """The first n clean lines of one file."""
    seq, path = file
    # read alone, a file is cut into the same splits each time; ids rise with the position in a split
    lines = clean_lines(spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("_split"),
                                                     F.monotonically_increasing_id().alias("_at")))
    before, split, left = [], None, n
    for start, count in sorted(tuple(r) for r in lines.groupBy("_split").count().collect()):      # a row per split
        if count > left:
            split = start
            break
        before.append(start)
        left -= count
    part = Window.partitionBy("_split").orderBy("_at")
    cut = lines.filter(F.col("_split") == F.lit(split)).withColumn("_n", F.row_number().over(part)).filter(F.col("_n") <= left)
    head = lines.filter(F.col("_split").isin(before)).unionByName(cut.drop("_n"))
    return head.select(F.lit(seq).alias("seq"), F.lit(-1).alias("place"), "value")


def replay(spark: SparkSession, paths: Sequence[str], dest: str | None = None, limit: int = 0,
           topic: str | None = None, bootstrap: str | None = None, rate: float = 0.0,
           rows_per_file: int = 0) -> int:
    """Send the lines of ``paths`` (files, globs or folders) to ``dest`` or ``topic``.

    Absent inputs are an error. Each file (or folder) is a segment; the
    consumer gets the segments in the given order. Files of one segment may arrive
    in any order among themselves: keep a segment's time span under the
    consumer's watermark delay and no row is judged late. ``limit``: send only the
    first so many lines of the archive, in its order (0: all of them); ``rate`` is the most lines per second on average (0: no bound);
    ``rows_per_file`` bounds the lines of a landing file. Returns the number of
    lines sent.
    """
    files = archive_files(spark, paths)
    lines = (_first_lines(spark, files, limit) if limit else archive_lines(spark, files)).drop("place")
    if topic:
        # untested here: needs the connector; the broker's quota sets the rate
        (lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
        return lines.count()
    return sum(n for _, n in write_segments(lines, dest, "seq", rate, rows_per_file))


def write_segments(df: DataFrame, dest: str, segment_col: str, rate: float = 0.0,
                   rows_per_file: int = 0) -> list[tuple]:
    """Deliver the text rows of ``df`` to ``dest`` in ascending order of ``segment_col``.

    One job writes all segments beside the landing files; each file is then
    moved into place (a rename) and gets the next modification time. Needs a
    file system that keeps given times (HDFS, local); on object stores deliver
    one segment per call. Returns (segment, lines) in order.
    """
    spark = df.sparkSession
    dest = dest.rstrip("/")
    aside = f"{dest}/_segments-{uuid.uuid4().hex[:12]}"
    # rebalance: AQE packs a small segment into one file and splits a large
    # one into advisory-size files (never a whole segment in one task)
    writer = df.hint("rebalance", segment_col).write.partitionBy(segment_col)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(aside)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new_path = jvm.org.apache.hadoop.fs.Path
    root = new_path(dest)
    fs = root.getFileSystem(conf)
    staged = spark.read.text(aside)
    if segment_col not in staged.columns:   # no row, no folder
        fs.delete(new_path(aside), True)
        return []
    sizes = [tuple(r) for r in staged.groupBy(segment_col).count().orderBy(segment_col).collect()]
    landed = [st.getModificationTime() for st in fs.listStatus(root) if st.isFile()]
    stamp = max([int(time.time() * 1000), *[t + 1000 for t in landed]])
    began, sent = time.time(), 0
    for value, n in sizes:
        folder = new_path(f"{aside}/{segment_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        for part in sorted(st.getPath().toString() for st in fs.listStatus(folder)):
            name = part.rsplit("/", 1)[1]
            if name.startswith(("_", ".")):
                continue
            stamp += 1000  # some file systems keep whole seconds
            fs.setTimes(new_path(part), stamp, -1)
            if not fs.rename(new_path(part), new_path(f"{dest}/{stamp}-{name}")):
                raise OSError(f"could not deliver {part}")
        sent += n
        if rate:
            time.sleep(max(0.0, sent / rate - (time.time() - began)))
    fs.delete(new_path(aside), True)
    return sizes


def capped_stream(spark: SparkSession, path: str, dest: str, max_rows: int) -> DataFrame:
    """A file stream over ``path`` whose micro-batches never exceed ``max_rows`` lines, whatever its files.

    The files that are there now are measured; where one holds more than the cap, all
    are landed again in ``dest`` in files of at most that many lines, in the order of
    their modification times. The stream then takes as many files a batch as the
    largest of them allows. For drain-and-stop runs: files that arrive later were not measured.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = [(st.getModificationTime(), st.getPath().toString()) for st in root.getFileSystem(conf).listStatus(root)
              if st.isFile() and not st.getPath().getName().startswith(("_", "."))]
    files = [f for _, f in sorted(listed)]
    if not files:
        return stream_source(spark, "files", path=path)
    largest = spark.read.text(files).groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] or 1
    if largest <= max_rows:
        return stream_source(spark, "files", path=path, max_rows=max_rows, rows_per_file=largest)
    write_segments(archive_lines(spark, list(enumerate(files))).drop("place"), dest, "seq", rows_per_file=max_rows)
    landed = spark.read.text(dest).groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] or 1
    return stream_source(spark, "files", path=dest, max_rows=max_rows, rows_per_file=landed)
