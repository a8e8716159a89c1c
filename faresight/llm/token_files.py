"""Token-id files: flat unsigned integers plus 64-bit document offsets.

A data set is a folder below a path that all executors share:

* ``part-00000.bin``  token ids of the part's documents, back to back, as
  little-endian unsigned integers of the manifest's ``id_type``;
* ``part-00000.off``  64-bit little-endian offsets, in ids from the part's
  start; document i is ``ids[off[i]:off[i + 1]]``; one more than documents;
* ``part-00000.ids``  the documents' 64-bit ids in the same order, and
  ``part-00000.nul`` one byte per document, 1 where that id is null;
* ``manifest.json``   per part its documents, ids and their prefix sums: the
  part's base in the whole sequence.

Parts are ranges of document ids in ascending order (null first), so the parts
in a row are one sorted sequence.  A task writes under a name of its own and
renames when complete; a repeated task writes the same bytes.  Files of local
or mounted folders are memory-mapped; others are opened through
``pyarrow.fs``.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm import tokens

END_ID = 2
_PART_SCHEMA = "part int, name string, docs long, ids long"
_BACK_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Documents per Arrow batch read back.
_BATCH = 4096


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        u = urlparse(path)
        if u.scheme == "file":
            return pafs.LocalFileSystem(), u.path
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    fs, base = _filesystem(folder)
    enc = tokens.encoder(vocabulary, tokens.byte_parts)
    end = np.array([end_id], dtype=enc.dtype).tobytes()
    part = TaskContext.get().partitionId()
    name, own = f"{base}/part-{part:05d}", uuid.uuid4().hex
    ids: list[int | None] = []
    lengths: list[int] = []
    out = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            out = fs.open_output_stream(f"{name}.bin.{own}")
        for text in batch.column(1):
            raw = enc.encode(text.as_py() or "") + end
            out.write(raw)
            lengths.append(len(raw) // enc.dtype.itemsize)
        ids.extend(batch.column(0).to_pylist())
    if out is None:
        return
    out.close()
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype("<u8")
    for kind, data in (("off", offsets), ("ids", np.array([i or 0 for i in ids], dtype="<i8")),
                       ("nul", np.array([i is None for i in ids], dtype="u1"))):
        with fs.open_output_stream(f"{name}.{kind}.{own}") as f:
            f.write(data.tobytes())
    for kind in ("off", "ids", "nul", "bin"):
        fs.move(f"{name}.{kind}.{own}", f"{name}.{kind}")
    yield pa.RecordBatch.from_pylist([{"part": part, "name": f"part-{part:05d}", "docs": len(ids),
                                       "ids": int(offsets[-1])}],
                                     schema=pa.schema([("part", pa.int32()), ("name", pa.string()),
                                                       ("docs", pa.int64()), ("ids", pa.int64())]))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, parts: int | None = None) -> dict:
    """Encode whole texts and write them in ascending id order; returns the manifest.

    Null text is empty: its document is the end id alone.  Rows with equal ids
    stay rows of their own, ordered by the text's hash; a null id comes first.
    An empty table gives a manifest without parts.  Other columns are not read.
    The driver gets one row per part.
    """
    spark = docs.sparkSession
    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_id"), F.xxhash64("_text")]
    ordered = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
               .repartitionByRange(parts, *order).sortWithinPartitions(*order))
    rows = ordered.mapInArrow(lambda b: _write_part(b, folder, vocabulary, end_id), _PART_SCHEMA).collect()
    rows.sort(key=lambda r: r["part"])
    doc_bases = [0, *accumulate(r["docs"] for r in rows)]
    id_bases = [0, *accumulate(r["ids"] for r in rows)]
    id_type = np.dtype(tokens.encoder(vocabulary, tokens.byte_parts).dtype).str
    manifest = {"id_type": id_type, "end_id": end_id, "docs": doc_bases[-1], "ids": id_bases[-1],
                "parts": [{"name": r["name"], "docs": r["docs"], "ids": r["ids"], "doc_base": d, "id_base": i}
                          for r, d, i in zip(rows, doc_bases, id_bases, strict=False)]}
    with fs.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    fs, base = _filesystem(folder)
    with fs.open_input_stream(f"{base}/manifest.json") as f:
        return json.loads(f.read())


def _map(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """The file as an array: mapped where it is local, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if fs.get_file_info(path).size else np.empty(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=dtype)


def part_documents(folder: str, part: dict, id_type: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document id, ids of all documents before it, its ids) of one part, in order."""
    fs, base = _filesystem(folder)
    name = f"{base}/{part['name']}"
    ids, offsets = _map(fs, f"{name}.bin", id_type), _map(fs, f"{name}.off", "<u8")
    docs, null = _map(fs, f"{name}.ids", "<i8"), _map(fs, f"{name}.nul", "u1")
    for i in range(len(docs)):
        a, b = int(offsets[i]), int(offsets[i + 1])
        yield (None if null[i] else int(docs[i])), part["id_base"] + a, ids[a:b]


def _read_back(batches: Iterator[pa.RecordBatch], folder: str, id_type: str) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    for batch in batches:
        for part in batch.to_pylist():
            rows: list[tuple] = []
            for doc_id, start, ids in part_documents(folder, part, id_type):
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if len(rows) == _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files.

    One task per part; a part's files are mapped, not loaded.
    """
    manifest = read_manifest(folder)
    id_type = manifest["id_type"]
    parts = [(i, p["name"], p["id_base"]) for i, p in enumerate(manifest["parts"])]
    table = spark.createDataFrame(parts, "part int, name string, id_base long")
    if parts:
        table = table.repartitionByRange(len(parts), "part")
    return table.mapInArrow(lambda b: _read_back(b, folder, id_type), _BACK_SCHEMA)
