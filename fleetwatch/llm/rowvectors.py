"""Decisions about rows, applied where the rows are.

A row of a Parquet table is known by its file and its number in the file. A stage decides on slim rows that carry this
identity; the decisions, one small number a row, are written as vectors, one for each stretch of ``STRETCH`` rows of a
file. While a file is scanned, a task loads the vectors of the rows it reads and looks each row up: no text is shuffled,
and only two numbers a row leave the JVM.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.session import work_path

STRETCH = 1 << 18
HELD = 8  # vectors that a worker keeps


def stored(docs: DataFrame, name: str) -> DataFrame:
    """The table itself if its rows come straight from Parquet files, else a written copy of it."""
    try:
        docs.select(*identity(docs)).schema  # noqa: B018
        return docs
    except AnalysisException:
        path = work_path(docs.sparkSession, name)
        docs.write.parquet(path)
        return docs.sparkSession.read.schema(docs.schema).parquet(path)


def identity(docs: DataFrame) -> list[Column]:
    """Columns file (a hash of its address) and row of a table read from Parquet."""
    place = docs.metadataColumn("_metadata")
    return [F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row")]


def write_vectors(decisions: DataFrame, name: str) -> str:
    """Writes vectors of the numbers ``n`` of (file, row, n) to the shared folder and returns its address.

    Rows may repeat; the largest number counts. Each row that will be looked up must occur.
    """
    folder = work_path(decisions.sparkSession, name)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        key, vector, done = None, None, 0

        def close() -> None:
            temp = posixpath.join(path, f"_temporary-{uuid.uuid4().hex}")
            with store.open_output_stream(temp, compression=None) as out:
                out.write(vector.astype("<i4").tobytes())
            store.move(temp, posixpath.join(path, f"{key[0]}-{key[1]}"))

        for batch in batches:
            for k, own in batch.groupby(["file", "stretch"], sort=False):
                if k != key:
                    if key is not None:
                        close()
                        done += 1
                    key, vector = k, np.full(STRETCH, -1, np.int32)
                np.maximum.at(vector, own["row"].to_numpy() % STRETCH, own["n"].to_numpy())
        if key is not None:
            close()
            done += 1
        yield pd.DataFrame({"vectors": [done]})

    keyed = decisions.select("file", "row", F.col("n").cast("int").alias("n"), F.floor(F.col("row") / STRETCH).alias("stretch"))
    keyed = keyed.repartition("file", "stretch").sortWithinPartitions("file", "stretch")
    keyed.mapInPandas(write, "vectors long").agg(F.sum("vectors")).collect()
    return folder


def decided(docs: DataFrame, folder: str) -> Column:
    """The number written for each row of a table read from Parquet; a row without one is an error."""

    def look(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        held: dict[tuple[int, int], np.ndarray] = {}
        for files, rows in batches:
            files, rows = files.to_numpy(zero_copy_only=False), rows.to_numpy(zero_copy_only=False)
            out = np.full(len(rows), -1, np.int32)
            for file, stretch in sorted(set(zip(files.tolist(), (rows // STRETCH).tolist(), strict=True))):
                if (file, stretch) not in held:
                    if len(held) >= HELD:
                        held.clear()
                    with store.open_input_stream(posixpath.join(path, f"{file}-{stretch}"), compression=None) as stream:
                        held[file, stretch] = np.frombuffer(stream.read(), "<i4")
                own = (files == file) & (rows // STRETCH == stretch)
                out[own] = held[file, stretch][rows[own] % STRETCH]
            if (out < 0).any():
                raise ValueError("a row has no decision")
            yield pa.array(out)

    return F.arrow_udf(look, "int")(*identity(docs))
