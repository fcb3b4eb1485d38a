"""Artifact files: writing, listing, testing for existence, reading images."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantflow.functions.text import default_store, normal_path


def artifact_manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files below ``root``; contents are not read.

    Spark lists directories in parallel but keeps the listing on the driver.
    For very many files use :func:`probe_artifacts`.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return listing.select(normal_path(F.col("path")).alias("path"), "length")


class _Stores:
    """File systems of paths, opened once for each store in a task.

    ``default`` is the store of paths without a scheme.
    """

    def __init__(self, default: str = "file:") -> None:
        self._open: dict[str, tuple] = {}
        self._default = default

    def locate(self, path: str) -> tuple:
        """(store, file system, path inside it)."""
        from pyarrow import fs

        if path.startswith("/") and self._default != "file:":
            path = self._default + path
        scheme, mark, rest = path.partition("://")
        if not mark or scheme == "file":
            if "" not in self._open:
                self._open[""] = (fs.LocalFileSystem(), "")
            local = "/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path
            return "", self._open[""][0], local
        authority, _, inside = rest.partition("/")
        # Hadoop's names of the object store connector
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        store = f"{scheme}://{authority}"
        if store not in self._open:
            self._open[store] = fs.FileSystem.from_uri(store + "/")
        system, base = self._open[store]
        return store, system, f"{base.rstrip('/')}/{inside}"


def probe_artifacts(
    df: DataFrame, path: str = "generated_filename", name: str = "present"
) -> DataFrame:
    """Add whether the file of each row exists, tested inside the tasks.

    Narrow: no listing, no shuffle and nothing on the driver.  Stores are opened
    once for each task and asked once for each record batch.  Paths without a
    scheme are looked for in the session's default file system.
    """
    default = default_store(df.sparkSession)

    @F.arrow_udf("boolean")
    def exists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyarrow import fs

        stores = _Stores(default)
        for paths in batches:
            asked: dict[str, tuple] = {}
            for i, p in enumerate(paths.to_pylist()):
                if p:
                    store, system, inside = stores.locate(p)
                    _, rows, names = asked.setdefault(store, (system, [], []))
                    rows.append(i)
                    names.append(inside)
            found = np.zeros(len(paths), dtype=bool)
            for system, rows, names in asked.values():
                infos = system.get_file_info(names)
                found[rows] = [info.type != fs.FileType.NotFound for info in infos]
            yield pa.array(found)

    return df.withColumn(name, exists(F.col(path)))


def _replace(system, source: str, target: str) -> None:
    """Rename a file, also onto another one."""
    try:
        system.move(source, target)
    except OSError:
        # some stores rename to free names only
        system.delete_file(target)
        system.move(source, target)


def write_artifacts(df: DataFrame, path: str, content: str) -> DataFrame:
    """Write each row's bytes to its path; (path, length) of what was written.

    Lazy.  A repeated task writes the same file again, so retries are harmless.  A
    file has its name only when it is whole: a task that is killed while it writes
    leaves none that is cut short.
    """

    default = default_store(df.sparkSession)

    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores, made = _Stores(default), set()
        for batch in batches:
            paths, sizes = [], []
            for target, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, system, inside = stores.locate(target)
                folder = inside.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                # listings leave out names that start so
                aside = f"{folder}/_{uuid.uuid4().hex}"
                with system.open_output_stream(aside) as out:
                    out.write(data)
                _replace(system, aside, inside)
                paths.append(target)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "length"]
            )

    return df.select(path, content).mapInArrow(save, "path string, length long")


def image_scan(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """(path, height, width, channels, rgb) of the images below ``path``.

    ``rgb`` holds the pixels row by row, three bytes each.  Grey is repeated,
    alpha is dropped.  An unreadable file keeps its row with NULL pixels.
    """
    images = (
        spark.read.format("image")
        .option("dropInvalid", drop_invalid)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("image.*")
    )
    readable = F.col("width") > 0
    return images.select(
        normal_path(F.col("origin")).alias("path"),
        F.when(readable, F.col("height")).alias("height"),
        F.when(readable, F.col("width")).alias("width"),
        F.when(readable, F.col("nChannels")).alias("channels"),
        rgb_bytes(F.when(readable, F.col("data")), F.col("nChannels")).alias("rgb"),
    )


def rgb_bytes(data: Column, channels: Column) -> Column:
    """Pixels of the image source as red, green, blue bytes."""

    @F.arrow_udf("binary")
    def convert(data: pa.Array, channels: pa.Array) -> pa.Array:
        out = []
        for pixels, n in zip(data.to_pylist(), channels.to_pylist()):
            if pixels is None:
                out.append(None)
                continue
            cells = np.frombuffer(pixels, np.uint8).reshape(-1, n)
            # stored blue first; one channel is grey, a fourth is alpha
            rgb = np.repeat(cells, 3, axis=1) if n == 1 else cells[:, 2::-1]
            out.append(rgb.tobytes())
        return pa.array(out, pa.binary())

    return convert(data, channels)
