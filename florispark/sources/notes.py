"""Notes: one file a row, whose head is made anew while what people wrote after its end marker stays.

Tasks write whole notes into a staging folder; when all have, the driver moves them into place, and if
one fails, nothing is moved and the folder goes.  A move replaces one note at once; a driver that dies between two moves
leaves each note either old or new, and the next run makes the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# fixed values: the markers between which a note is the machine's
START, END = "<!-- AUTO-START -->", "<!-- AUTO-END -->"


def place(path: str):
    """(file system, path in it) of a URI or an absolute path; any file system that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def content(frontmatter: str, body: str, tail: str) -> str:
    return f"---\n{frontmatter.strip()}\n---\n\n{START}\n\n{body.strip()}\n\n{END}{tail}"


@dataclass
class Written(WriterCommitMessage):
    notes: int


class NoteWriter(DataSourceWriter):
    def __init__(self, path: str, names: list[str]):
        self.path, self.staged = path, f".staged-{uuid.uuid4().hex}"
        missing = {"name", "frontmatter", "body", "tail"} - set(names)
        if missing:
            raise ValueError(f"notes lack columns: {', '.join(sorted(missing))}")

    def _tail(self, fs, file: str, default: str | None) -> str:
        """What stands after the end marker of the note that is there, else the default."""
        from pyarrow.fs import FileType

        if fs.get_file_info(file).type != FileType.NotFound:
            with fs.open_input_stream(file) as f:
                _, mark, tail = f.read().decode().partition(END)
            if mark:
                return tail
        return default or ""

    def write(self, iterator: Iterator) -> Written:
        fs, root = place(self.path)
        fs.create_dir(f"{root}/{self.staged}", recursive=True)
        n = 0
        for row in iterator:
            if not row["name"] or "/" in row["name"] or row["name"].startswith("."):
                raise ValueError(f"not a name of a note: {row['name']!r}")
            text = content(row["frontmatter"] or "", row["body"] or "", self._tail(fs, f"{root}/{row['name']}.md", row["tail"]))
            with fs.open_output_stream(f"{root}/{self.staged}/{row['name']}.md") as f:  # a task that runs again writes the same
                f.write(text.encode())
            n += 1
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileSelector

        fs, root = place(self.path)
        for info in fs.get_file_info(FileSelector(f"{root}/{self.staged}", allow_not_found=True)):
            fs.move(info.path, f"{root}/{info.base_name}")
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*place(self.path))

    def _clear(self, fs, root: str) -> None:
        from pyarrow.fs import FileType

        if fs.get_file_info(f"{root}/{self.staged}").type != FileType.NotFound:
            fs.delete_dir(f"{root}/{self.staged}")


class NoteSource(DataSource):
    """format("notes"): rows of name, frontmatter, body and tail, the tail of a note that isn't there yet."""

    @classmethod
    def name(cls) -> str:
        return "notes"

    def writer(self, schema, overwrite: bool) -> NoteWriter:
        return NoteWriter(self.options["path"], schema.names)


def write_notes(df: DataFrame, path: str) -> None:
    """Notes of (name, frontmatter, body, tail) rows, names being distinct and safe for files; null parts are empty."""
    df.sparkSession.dataSource.register(NoteSource)
    df.select("name", "frontmatter", "body", "tail").write.format("notes").mode("append").option("path", path).save()


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) of the notes at path."""
    rows = spark.read.text(f"{path}/*.md", wholetext=True)
    return rows.select(F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))), r"^(.*)\.md$", 1).alias("name"), F.col("value").alias("text"))
