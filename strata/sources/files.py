"""Directory operations on the session's file systems, and partition folder names."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

#: Fixed value: the folder name Spark gives a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class HadoopFS:
    """Directory operations through the session's Hadoop file systems (hdfs, s3a, gs, file)."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _resolve(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._resolve(path)
        return bool(fs.exists(p))

    def delete(self, path: str) -> None:
        p, fs = self._resolve(path)
        fs.delete(p, True)

    def rename(self, src: str, dst: str) -> None:
        p, fs = self._resolve(src)
        if not fs.rename(p, self._resolve(dst)[0]):
            raise OSError(f"cannot move {src} to {dst}")

    def write_text(self, path: str, text: str) -> None:
        """A small file in one piece: readers see it whole or not at all."""
        p, fs = self._resolve(path)
        part, _ = self._resolve(path.rpartition("/")[0] + "/_" + path.rpartition("/")[2])
        out = fs.create(part, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.exists(p):
            fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"cannot write {path}")

    def folders(self, path: str) -> list[str]:
        """Names of the folders in ``path``; none when it does not exist."""
        p, fs = self._resolve(path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


class ArrowFS:
    """The same operations through pyarrow, for sessions without a JVM (Spark Connect)."""

    def _resolve(self, path: str):
        from pyarrow import fs

        if path.startswith("file:") and not path.startswith("file://"):
            path = "/" + path[len("file:"):].lstrip("/")
        return fs.FileSystem.from_uri(path)

    def exists(self, path: str) -> bool:
        from pyarrow import fs

        filesystem, p = self._resolve(path)
        return filesystem.get_file_info(p).type != fs.FileType.NotFound

    def delete(self, path: str) -> None:
        filesystem, p = self._resolve(path)
        filesystem.delete_dir(p)

    def rename(self, src: str, dst: str) -> None:
        filesystem, p = self._resolve(src)
        filesystem.move(p, self._resolve(dst)[1])

    def write_text(self, path: str, text: str) -> None:
        filesystem, p = self._resolve(path)
        filesystem.create_dir(p.rpartition("/")[0])
        part = p.rpartition("/")[0] + "/_" + p.rpartition("/")[2]
        with filesystem.open_output_stream(part) as out:
            out.write(text.encode("utf-8"))
        filesystem.move(part, p)

    def folders(self, path: str) -> list[str]:
        from pyarrow import fs

        filesystem, p = self._resolve(path)
        found = filesystem.get_file_info(fs.FileSelector(p, allow_not_found=True))
        return sorted(i.base_name for i in found if i.type == fs.FileType.Directory)


def file_system(spark: SparkSession):
    try:
        return HadoopFS(spark)
    except Exception:  # noqa: BLE001 - no JVM gateway (Spark Connect)
        return ArrowFS()


def partition_value(name: str) -> str | None:
    """The value text of a ``key=value`` folder name; None for the null partition."""
    v = name.partition("=")[2]
    return None if v == NULL_PARTITION else unquote(v)


def partition_folders(fs, base: str, key: str) -> list[tuple[str, str | None]]:
    """(path, value text or None) of every ``key=value`` folder of ``base``.

    Folder names only: no file is opened. Levels of other keys above ``key`` are
    descended; names of hidden folders (``_`` or ``.`` first) are skipped.
    """
    found: list[tuple[str, str | None]] = []
    base = base.rstrip("/")
    for name in fs.folders(base):
        k, eq, _ = name.partition("=")
        if not eq or name.startswith(("_", ".")):
            continue
        if unquote(k) == key:
            found.append((f"{base}/{name}", partition_value(name)))
        else:
            found += partition_folders(fs, f"{base}/{name}", key)
    return found
