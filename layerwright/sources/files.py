"""File-level sources: listings, byte-true copies, checksums and partition values taken from paths."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import digests

PARQUET_ONLY = "*.parquet"
# Fixed value: the last byte of the mark that ends every Parquet file.
LAST_BYTE = "1"
UNCUT = str(1 << 60)
# Files up to this size are summed by one task, which takes about two seconds; handing over an unfinished md5 takes one.
PIECE_BYTES = 256 << 20


def file_manifest(spark: SparkSession, path: str, pattern: str = PARQUET_ONLY) -> DataFrame:
    """(path, size, modified_at) of the matching files below ``path``; no content is read."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))


def cut_bytes(spark: SparkSession, paths: str | Sequence[str], pattern: str, piece: str = UNCUT) -> DataFrame:
    """The files below ``paths`` as rows, cut after every :data:`LAST_BYTE`; each file lies in one partition, in order.

    Spark's text source reads the bytes as they are, with the session's own credentials and whatever the size of a
    file.  It runs in a session of its own, where no file is cut or shares a partition; the caller's keeps its settings.
    With ``piece``, files are cut into pieces of that many bytes and share partitions up to that size.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", piece)
    own.conf.set("spark.sql.files.openCostInBytes", UNCUT if piece == UNCUT else "1")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    reader = own.read.option("lineSep", LAST_BYTE).option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", "true").text([paths] if isinstance(paths, str) else list(paths))


def pieces_at_once(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame | None:
    """:func:`cut_bytes` in pieces of :data:`PIECE_BYTES`, or of more, so that one task for each partition can run at once.

    None where no file is larger than such a piece, or where the tasks at once or the md5 between them are not known.
    Only listings are read.
    """
    context = spark.sparkContext
    conf = context.getConf()
    if "spark.default.parallelism" in dict(conf.getAll()) or conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return None
    if not digests.can_resume():
        return None
    tasks, piece = context.defaultParallelism // int(conf.get("spark.task.cpus", "1")), PIECE_BYTES
    cut = cut_bytes(spark, paths, pattern, str(piece))
    settings = cut.sparkSession.conf

    def partitions(cost: str) -> int:
        settings.set("spark.sql.files.openCostInBytes", cost)
        return cut.select("value").rdd.getNumPartitions()

    # Where files cost more to open than a partition holds, each piece is a partition.
    pieces = partitions(UNCUT)
    settings.set("spark.sql.files.maxPartitionBytes", UNCUT)
    if pieces == (whole := partitions(UNCUT)):
        return None
    piece = max(piece, piece * (pieces - whole) // max(tasks, 1))
    settings.set("spark.sql.files.maxPartitionBytes", str(piece))
    while partitions("1") > tasks:
        piece += piece // 8
        settings.set("spark.sql.files.maxPartitionBytes", str(piece))
        if piece > int(UNCUT):
            return None
    cuts = partitions(UNCUT) > whole
    settings.set("spark.sql.files.openCostInBytes", "1")
    return cut if cuts else None


def _runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[int, memoryview]]:
    """(first row, bytes) of each run of rows that agree in ``keys``."""
    data, edges = batch["data"].cast(pa.large_binary()), {0} if len(batch["data"]) else set()
    for key in keys:
        edges.update(pc.indices_nonzero(pc.not_equal(batch[key][1:], batch[key][:-1])).to_numpy() + 1)
    starts = sorted(map(int, edges))
    for start, stop in zip(starts, [*starts[1:], len(data)]):
        part = data[start:stop]
        offsets = memoryview(part.buffers()[1]).cast("q")[part.offset : part.offset + len(part) + 1]
        yield start, memoryview(part.buffers()[2])[offsets[0] : offsets[-1]]


def _md5(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, md5) of rows ``path, size, data`` that hold whole files in order; a file in pieces is an error."""
    path, left, digest = None, 0, None

    def done() -> pa.RecordBatch:
        if left:
            raise ValueError(f"{path}: {left} bytes were not seen here, the file was cut or changed while it was read")
        return pa.RecordBatch.from_pydict({"path": [path], "md5": [digest.hexdigest()]})

    for batch in batches:
        for row, data in _runs(batch, "path"):
            if batch["path"][row].as_py() != path:
                if digest:
                    yield done()
                path, left, digest = batch["path"][row].as_py(), batch["size"][row].as_py(), hashlib.md5()
            # The file's last piece may have got a byte too many: a file need not end with the byte it is cut at.
            piece = data[:left]
            digest.update(piece)
            left -= len(piece)
    if digest:
        yield done()


def _md5_of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, md5) of rows ``path, size, start, length, data`` that hold pieces of files, all pieces in one barrier stage.

    A task takes over the unfinished md5 of the piece before its own; until that is there, it reads no further.
    """
    barrier, begun, news, path, start, digest = BarrierTaskContext.get(), {}, {}, None, None, None

    def exchange(ended: bool) -> bool:
        """Hand over news (bytes summed, file's size, md5 so far) and take those of all tasks; true if all have ended."""
        told = [json.loads(message) for message in barrier.allGather(json.dumps([ended, news]))]
        news.clear()
        for _, theirs in told:
            begun.update(theirs)
        all_ended = all(theirs for theirs, _ in told)
        if all_ended or not any(theirs for _, theirs in told):
            for name, (seen, of, _) in begun.items():
                if seen < of:
                    raise ValueError(f"{name}: {of - seen} bytes were not seen, the file changed while it was read")
            if not all_ended:
                raise ValueError(f"{path}: no task has the bytes before {start}, the file changed while it was read")
        return all_ended

    def done() -> Iterator[pa.RecordBatch]:
        if start or at < size:
            news[path] = [at, size, digest.state().hex()]
        if at == size:
            yield pa.RecordBatch.from_pydict({"path": [path], "md5": [digest.hexdigest()]})

    for batch in batches:
        for row, data in _runs(batch, "path", "start"):
            if (batch["path"][row].as_py(), batch["start"][row].as_py()) != (path, start):
                if digest:
                    yield from done()
                path, start, size, length = (batch[k][row].as_py() for k in ("path", "start", "size", "length"))
                # Spark gives a piece the lines that begin after its start, up to the byte that follows it.
                while start and not start < begun.get(path, [0])[0] <= start + length:
                    exchange(ended=False)
                at, digest = (begun[path][0], digests.Md5(bytes.fromhex(begun[path][2]))) if start else (0, digests.Md5())
            # As above, the last piece may have got a byte too many.
            data = data[: size - at]
            digest.update(data)
            at += len(data)
    if digest:
        yield from done()
    while not exchange(ended=True):
        pass


def checksum_manifest(spark: SparkSession, path: str | Sequence[str], pattern: str = PARQUET_ONLY) -> DataFrame:
    """(path, size, md5) of each matching file; no job runs before the result is asked for.

    One task streams a file's bytes, so memory is bounded for files of any size.  Files above :data:`PIECE_BYTES` are
    cut, and the tasks of a barrier stage read their pieces one after another and hand on the unfinished md5.  Empty files
    are left out, as Spark's sources do not list them.
    """
    pieces = pieces_at_once(spark, path, pattern)
    cut = cut_bytes(spark, path, pattern) if pieces is None else pieces
    rows = cut.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.concat("value", F.lit(LAST_BYTE)).cast("binary").alias("data"),
    )
    if pieces is None:
        sums = rows.drop("start", "length").mapInArrow(_md5, "path string, md5 string")
    else:
        # The shuffle ends the barrier stage, which takes no limit or other change of its partitions.
        sums = rows.mapInArrow(_md5_of_pieces, "path string, md5 string", barrier=True).repartition("path")
    sums = sums.withColumnRenamed("path", "summed")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    listed = listed.load([path] if isinstance(path, str) else list(path))
    listed = listed.select("path", F.col("length").alias("size"), F.col("_metadata.file_path").alias("listed"))
    summed = listed.join(sums, F.col("listed") == F.col("summed"), "left")
    return summed.select("path", "size", "md5")


def copy_parquet(spark: SparkSession, folders: Sequence[str], staging: str) -> DataFrame:
    """Copy the Parquet files below ``folders`` byte for byte into ``staging``: (path, size, md5, copy).

    One job copies all files, a task each; a second one reads originals and copies and pairs them by size and md5.
    An original whose copy is missing has a null ``copy``.
    """
    cut = cut_bytes(spark, folders, PARQUET_ONLY)
    cut.write.option("lineSep", LAST_BYTE).option("compression", "none").text(staging)
    same = Window.partitionBy("size", "md5").orderBy("path")
    originals = checksum_manifest(spark, folders).withColumn("k", F.row_number().over(same))
    copies = checksum_manifest(spark, staging, "part-*").withColumn("k", F.row_number().over(same))
    return originals.join(copies.withColumnRenamed("path", "copy"), ["size", "md5", "k"], "left").drop("k")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def path_value(path: Column, name: str) -> Column:
    """Integer value of the ``name=value`` folder in a path; null when there is none."""
    return F.nullif(F.regexp_extract(path, f"{name}=(\\d+)", 1), F.lit("")).cast("int")


def with_path_values(df: DataFrame, names: list[str]) -> DataFrame:
    """Add partition values read from the file path of each row (needs a file-based ``df``)."""
    return df.select("*", *[path_value(F.col("_metadata.file_path"), n).alias(n) for n in names])


def rows_per_file(df: DataFrame) -> DataFrame:
    """(path, row_count) of a file-based table; only footers and metadata are read."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))


def not_yet_loaded(manifest: DataFrame, load_log: DataFrame) -> DataFrame:
    """Manifest rows whose path is not in the load log."""
    return manifest.join(load_log.select("path").distinct(), "path", "left_anti")
