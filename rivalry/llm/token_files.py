"""Token files: whole texts as ids in directly addressable files, in document order.

Documents are dealt by ranges of doc_id (ties by position, so one id that a
third of the rows share still spreads), encoded where they land and written as
files of bounded size into the shared folder.  A file counts only if the
manifest, a table that Spark commits, names it; a lost executor's files are
simply never named.

Null text: no ids but the end.  Null doc_id: before all others.  Repeated rows
are all written; an empty table gives no files.  Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rivalry.llm.common import docs_of, table
from rivalry.llm.packed_codes import Reader, encode
from rivalry.llm.tokens import WordIds, texts
from rivalry.session import work_dir

MANIFEST = "shard int, part int, path string, n_docs long, n_tokens long"


def open_folder(uri: str):
    """The file system and the path of a folder that all executors reach."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, tokenizer: str, end: int = 1, folder: str | None = None,
                      max_ids: int = 1 << 23, shards: int | None = None) -> DataFrame:
    """Write the files and return their manifest, with ``first``: the ids in all files before.

    A file is closed at ``max_ids`` ids (a longer document has one of its own).
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "token-files")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs_of(docs).withColumn("_at", F.monotonically_increasing_id())
               .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "_at")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_at"))

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        words, shard = WordIds(tokenizer), TaskContext.get().partitionId()
        system, base = open_folder(folder)
        tail = int(end).to_bytes(4, "little")
        ids, codes, held, rows = [], [], 0, []

        def close():
            nonlocal ids, codes, held
            path = f"{base}/{shard:06d}-{len(rows):04d}-{uuid.uuid4().hex[:8]}.dac"
            system.create_dir(base, recursive=True)
            with system.open_output_stream(path) as f:
                f.write(encode(ids, codes))
            rows.append((shard, len(rows), path, len(ids), held))
            ids, codes, held = [], [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                code = words.text(text) + tail
                if held and held + len(code) // 4 > max_ids:
                    close()
                ids.append(doc_id)
                codes.append(code)
                held += len(code) // 4
        if ids:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["shard", "part", "path", "n_docs", "n_tokens"])

    manifest = table(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    # One row a file: few, whatever the input.
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, manifest: DataFrame, folder_of=open_folder) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Each document is read on its own, by random access.
    """
    def read(batches):
        import pyarrow as pa
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                system, path = folder_of(path)
                with system.open_input_file(path) as f:
                    reader = Reader(f)
                    ids, starts = reader.docs()
                    crc = [zlib.crc32(reader.ids(a, b).astype("<u4").tobytes())
                           for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts[:-1] + first, pa.int64()),
                     pa.array(starts[1:] - starts[:-1], pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (manifest.select("path", "first").repartition(n)
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def write_and_read(docs: DataFrame, tokenizer: str, end: int = 1, max_ids: int = 1 << 23) -> DataFrame:
    return read_token_files(docs.sparkSession, write_token_files(docs, tokenizer, end, max_ids=max_ids))
