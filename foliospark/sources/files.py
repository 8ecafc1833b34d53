"""A sink of text files, one a row, that becomes visible as a whole or not at all.

``df.write.format("text_files").mode(...).save(folder)`` of (name, body).  Tasks
write below a staging folder beside the target, each file aside and then by one
rename, so an attempt that runs again harms nothing.  Aside is a folder of the
attempt's own, because all that make files in one folder wait for each other; it
goes when the attempt ends.  The driver's commit, when
all tasks have ended, makes the files visible; a failed job deletes the staging
folder and leaves the target as it was.  (A task that still runs when its job has
failed may write into the staging folder again; nothing reads it.)

``overwrite`` swaps the whole folder by two renames, so files that are not
written any more are gone and no reader sees a mixture.  ``append`` moves file
by file over what is there; a commit that is cut off there can be run again.
The folder is a URI that pyarrow opens on the driver and on every executor; names
may have folders.  Rows without a name are an error, a null body is an empty file.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "text_files"


@dataclass
class Written(WriterCommitMessage):
    n: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder.rstrip("/"), overwrite, uuid.uuid4().hex

    def _open(self):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(self.folder)
        top = top.rstrip("/")
        return store, top, f"{top}._staged-{self.job}"

    def write(self, iterator):
        store, _, staged = self._open()
        own = f"{staged}/.{uuid.uuid4().hex}"
        n, made = 0, set()
        try:
            for batch in iterator:
                for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist()):
                    if not name:
                        raise ValueError("a file has no name")
                    target = f"{staged}/{name}"
                    for folder in (own, target.rpartition("/")[0]):
                        if folder not in made:
                            store.create_dir(folder, recursive=True)
                            made.add(folder)
                    aside = f"{own}/.{n}"
                    with store.open_output_stream(aside) as out:
                        out.write(((body or "") + "\n").encode())
                    store.move(aside, target)
                    n += 1
        finally:
            if own in made:
                store.delete_dir(own)
        return Written(n)

    def commit(self, messages):
        from pyarrow import fs

        store, top, staged = self._open()
        store.create_dir(staged, recursive=True)  # a job without rows has written nothing
        if self.overwrite:
            old = f"{top}._old-{self.job}"
            there = store.get_file_info(top).type == fs.FileType.Directory
            if there:
                store.move(top, old)
            else:
                store.create_dir(top.rpartition("/")[0], recursive=True)
            store.move(staged, top)
            if there:
                store.delete_dir(old)
            return
        for info in store.get_file_info(fs.FileSelector(staged, recursive=True)):
            if info.type == fs.FileType.File and not info.base_name.startswith("."):
                target = f"{top}/{info.path[len(staged) + 1:]}"
                store.create_dir(target.rpartition("/")[0], recursive=True)
                store.move(info.path, target)
        store.delete_dir(staged)

    def abort(self, messages):
        store, _, staged = self._open()
        if store.get_file_info(staged).type.name == "Directory":
            store.delete_dir(staged)


class TextFiles(DataSource):
    """The sink under its format's name."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["path"], overwrite)


def seen_by(observed: Observation, what: str = "n") -> int:
    """An observed number; a table that the optimiser knew to be empty has none."""
    return 0 if observed._jo.getRow().length() == 0 else observed.get[what] or 0


def save_files(files: DataFrame, folder: str, name: str = "file_name", body: str = "body", overwrite: bool = False) -> None:
    """Writes a table of files; see the module."""
    files.sparkSession.dataSource.register(TextFiles)
    rows = files.select(F.col(name).cast("string").alias("name"), F.col(body).cast("string").alias("body"))
    rows.write.format(FORMAT).mode("overwrite" if overwrite else "append").save(folder)
