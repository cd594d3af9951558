"""Token-ID output: a wavelet matrix file per shard of documents in id order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm import wavelet
from concordat.llm.encode import ENCODE_BYTES, word_encoder
from concordat.llm.memory import give_back, sliced
from concordat.storage import bounded_batches, materialize, open_input, scratch, ship, write_bytes

SHARD_IDS = 2_000_000
MANIFEST = "shard long, part long, n_docs long, n_ids long, path string"


def write_index(docs: DataFrame, tokenizer: str, end_id: int, bits: int = 16, root: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write index files in ascending doc_id order.

    Returns the manifest (shard, part, n_docs, n_ids, path), a row for each
    file; files of one ``shard`` follow each other by ``part``, shards by number.
    Null texts are empty and still get an end id. A special token's own text gets
    its id, as the library does. Null ids come first; repeated
    ids each keep a row, ordered by text. Columns other than these two are not
    read, so their names cannot clash. A shard is a range of ids; a file closes
    at about ``shard_ids`` ids, so memory does not grow with the input.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    root = root or scratch(spark, "token-index")
    kind = np.uint16 if bits <= 16 else np.uint32

    def write(batches):
        from pyspark import TaskContext

        shard, part = TaskContext.get().partitionId(), 0
        enc = word_encoder(tokenizer, True)
        ids, lengths, owners, held = [], [], [], 0

        def flush():
            nonlocal part, ids, lengths, owners, held
            path = f"{root}/shard-{shard:06d}-{part:05d}.wmx"
            write_bytes(path, wavelet.build(np.concatenate(ids), owners, np.concatenate(lengths), bits))
            row = pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "part": pa.array([part], pa.int64()), "n_docs": pa.array([len(owners)], pa.int64()), "n_ids": pa.array([held], pa.int64()), "path": pa.array([path])})
            part, ids, lengths, owners, held = part + 1, [], [], [], 0
            give_back()
            return row

        for batch in batches:
            got, n = enc.encode(batch.column(1), end_id)
            if len(got) and int(got.max()) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            ids.append(got.astype(kind))
            lengths.append(n)
            owners += batch.column(0).to_pylist()
            held += len(got)
            if held >= shard_ids:
                yield flush()
        if owners:
            yield flush()

    ordered = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(sliced(1, write, ENCODE_BYTES), MANIFEST), "token-manifest")


def read_index(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, path, pos) of every document, from the files.

    ``start`` counts the ids of all documents before it. The manifest has one
    row for millions of ids, so its running sum in one task stays small.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = placed.select("path", "base")

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_input(path) as f:
                    at, rows = base, []
                    for pos, (d, ids) in enumerate(wavelet.WaveletMatrix(f).documents()):
                        rows.append((d, at, len(ids), wavelet.crc_of(ids), path, pos))
                        at += len(ids)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                names = ("doc_id", "start", "n_tokens", "ids_crc32", "path", "pos")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    many = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    return files.repartition(many, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string, pos long")
