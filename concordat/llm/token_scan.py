"""Token counts of flat, unindexed token files by a scan for end-of-document ids.

A file holds only ids of fixed width, each document ended by one separator.
Blocks of any file are scanned apart: a block reports the positions of its
separators; a prefix scan over a file's blocks then says how many documents
ended before a block and where the last one did, which stitches documents
that cross block boundaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.llm.encode import ENCODE_BYTES, word_encoder
from concordat.llm.memory import sliced
from concordat.storage import AtomicWriter, bounded_batches, file_size, materialize, open_input, scratch, ship

BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2, root: str | None = None) -> DataFrame:
    """Write ids of ``docs`` (doc_id, text) to flat files, one for each input partition.

    Returns (path, ordinal, doc_id): the documents' order in each file, as
    little-endian ids of ``width`` bytes. Null texts are empty documents: a
    separator alone. Rows with null or repeated ids are kept as they are.
    Nothing is shuffled; a file's memory does not grow with its length.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    root = root or scratch(spark, "flat-tokens")
    kind = {2: "<u2", 4: "<u4"}[width]

    def write(batches):
        from pyspark import TaskContext

        enc = word_encoder(tokenizer)
        path, done = f"{root}/part-{TaskContext.get().partitionId():06d}.tok", 0
        rows = []
        with AtomicWriter(path) as out:
            for batch in batches:
                n = batch.num_rows
                ids, _ = enc.encode(batch.column(1), end_id)
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"an id needs more than {width} bytes")
                out.write(ids.astype(kind).tobytes())
                rows.append(pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array(range(done, done + n), pa.int64()), batch.column(0)], names=["path", "ordinal", "doc_id"]))
                done += n
        yield from rows

    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return materialize(plain.mapInArrow(sliced(1, write, ENCODE_BYTES), "path string, ordinal long, doc_id long"), "flat-order")


def scan_separators(spark: SparkSession, paths: DataFrame, end_id: int, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(path, ordinal, start, n_tokens) of each document in the files of ``paths`` (path).

    ``start`` is its first id in the file, ``n_tokens`` leaves out the
    separator. Ids after a file's last separator are a last, unended document
    if there are any. Empty files give no rows; repeated paths count once.
    """
    ship(spark)
    kind = {2: "<u2", 4: "<u4"}[width]

    def cut(batches):
        for batch in batches:
            rows = []
            for p in batch.column(0).to_pylist():
                size = file_size(p)
                if size % width:
                    raise ValueError(f"{p} ends within an id")
                total = size // width
                rows += [(p, at, min(block_ids, total - at), total) for at in range(0, total, block_ids)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["path", "at", "n", "total"])

    def scan(batches):
        for batch in batches:
            for p, at, n, total in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                with open_input(p) as f:
                    f.seek(at * width)
                    ids = np.frombuffer(f.read(n * width), dtype=kind)
                ends = (np.flatnonzero(ids == end_id) + at).tolist()
                if at + n == total and (not len(ids) or ids[-1] != end_id):
                    ends.append(total)  # the unended rest
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([at], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], names=["path", "at", "ends"])

    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = paths.select("path").where("path is not null").distinct().mapInArrow(cut, "path string, at long, n long, total long")
    found = materialize(blocks.repartition(many, "path", "at").mapInArrow(scan, "path string, at long, ends array<long>"), "separators")
    # Two passes of one prefix scan over a file's blocks: documents ended before, and where the last of them ended.
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("path", "at", F.size("ends").alias("k"), F.array_max("ends").alias("m")).select("path", "at", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"), F.coalesce(F.max("m").over(before), F.lit(-1)).alias("last"))
    each = found.join(carried, ["path", "at"]).select("path", "base", F.concat(F.array("last"), "ends").alias("e"))
    return each.select("path", "base", "e", F.posexplode(F.expr("slice(e, 2, size(e) - 1)")).alias("i", "end")).select(
        "path", (F.col("base") + F.col("i")).alias("ordinal"), (F.expr("e[i]") + 1).alias("start"), (F.col("end") - F.expr("e[i]") - 1).alias("n_tokens")
    )


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_id, n_tokens, path, start) for each row of ``docs``, counted in its flat file."""
    order = write_flat(docs, tokenizer, end_id, width)
    counts = scan_separators(docs.sparkSession, order.select("path"), end_id, width, block_ids)
    return order.join(counts, ["path", "ordinal"]).select("doc_id", "n_tokens", "path", "start")
