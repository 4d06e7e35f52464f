"""Files of any kind by song, written by tasks and put in place by the driver's commit.

Rows are (song_id, name, content) and may have a stem. Tasks write ``path/.pending/<run>/<task>/song/stem/name``; only when all have ended are the folders
of the songs and stems that the run wrote moved to their places, each replacing the one there, so a task that fails or runs twice leaves nothing, and a run replaces
only what it wrote. ``content`` is text or bytes."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tactus.sources.wav_blocks import located


def safe(name: str) -> str:
    """A name without parts that lead elsewhere."""
    return name.replace("/", "_").replace("\\", "_").lstrip(".") or "_"


@dataclass
class Written(WriterCommitMessage):
    """Where a task's folders lie, and the folders (song, or song/stem)."""

    place: str
    folders: tuple[str, ...]


class FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.run = path, uuid.uuid4().hex

    def _pending(self) -> tuple[pafs.FileSystem, str, str]:
        fs, root = located(self.path)
        return fs, root, f"{root}/.pending/{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, _, pending = self._pending()
        place, made = f"{pending}/{uuid.uuid4().hex}", {}
        for batch in iterator:
            columns = {c: batch[c] for c in batch.schema.names}
            for i in range(batch.num_rows):
                parts = [safe(columns[c][i].as_py() or "") for c in ("song_id", "stem") if c in columns]
                folder, content = "/".join(parts), columns["content"][i].as_py()
                if folder not in made:
                    fs.create_dir(f"{place}/{folder}", recursive=True)
                    made[folder] = True
                with fs.open_output_stream(f"{place}/{folder}/{safe(columns['name'][i].as_py())}") as f:
                    f.write(content.encode() if isinstance(content, str) else content or b"")
        return Written(place, tuple(made))

    def commit(self, messages: list[Written | None]) -> None:
        fs, root, pending = self._pending()
        replaced = set()
        for m in messages:
            for folder in m.folders if m else ():
                to = f"{root}/{folder}"
                fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
                if folder in replaced:  # another task wrote a part of it
                    for f in fs.get_file_info(pafs.FileSelector(f"{m.place}/{folder}")):
                        fs.move(f.path, f"{to}/{f.base_name}")
                    continue
                if fs.get_file_info(to).type == pafs.FileType.Directory:
                    fs.delete_dir(to)
                fs.move(f"{m.place}/{folder}", to)
                replaced.add(folder)
        self._clear(fs, root, pending)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*self._pending())

    def _clear(self, fs: pafs.FileSystem, root: str, pending: str) -> None:
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(pending)
        with contextlib.suppress(FileNotFoundError, OSError):
            if not fs.get_file_info(pafs.FileSelector(f"{root}/.pending")):  # no other run is at work
                fs.delete_dir(f"{root}/.pending")


class SongFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "song_files"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])


def write_files(rows: DataFrame, path: str) -> None:
    """Write rows (song_id, [stem,] name, content) under ``path``. A song's or stem's files are written by one task, one after another."""
    keys = [c for c in ("song_id", "stem") if c in rows.columns]
    rows.sparkSession.dataSource.register(SongFiles)
    rows.select(*keys, "name", "content").repartition(*keys).write.format("song_files").mode("append").save(path)


def place_of(path: str, *parts: Column) -> Column:
    """Where ``write_files`` puts a file: its folders and its name below ``path``."""
    clean = lambda c: F.when(F.ltrim(F.translate(c, "/\\", "__"), F.lit(".")) == "", "_").otherwise(F.ltrim(F.translate(c, "/\\", "__"), F.lit(".")))
    return F.concat_ws("/", F.lit(path.rstrip("/")), *(clean(p) for p in parts))
