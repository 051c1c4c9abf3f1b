"""``arrow`` format: a Python data source that writes and reads Arrow IPC
files (Feather v2). Spark has no built-in Arrow file format.

Writing: each task streams its Arrow batches into one ``part-*.arrow`` file
under ``_attempt-*``; only the files of the tasks that Spark counts are moved
to the target when the job commits (with overwrite, in place of the old ones),
so a retried or speculative task leaves nothing to read. Reading: one input
partition per file. Files are addressed through ``pyarrow.fs``; give paths
with a scheme on a cluster (``writers.write_arrow`` does).
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _fs(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return pafs.LocalFileSystem(), path
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class _Written(WriterCommitMessage):
    file: str
    rows: int


class _FilePartition(InputPartition):
    def __init__(self, file: str):
        super().__init__(file)
        self.file = file


class ArrowWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path = path
        self.overwrite = overwrite
        self.attempt = f"_attempt-{uuid.uuid4().hex}"

    def write(self, iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        fs, base = _fs(self.path)
        fs.create_dir(f"{base}/{self.attempt}", recursive=True)
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        name = f"{base}/{self.attempt}/part-{pid:05d}-{uuid.uuid4().hex}.arrow"
        rows = 0
        writer = None
        with fs.open_output_stream(name) as sink:
            for batch in iterator:
                if writer is None:
                    writer = pa.ipc.new_file(sink, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer is not None:
                writer.close()
        return _Written(name if rows else "", rows)

    def commit(self, messages):
        import pyarrow.fs as pafs

        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.path.endswith(".arrow")] if self.overwrite else []
        for m in messages:
            if m is not None and m.file:
                fs.move(m.file, f"{base}/{m.file.rsplit('/', 1)[1]}")
        for path in old:
            fs.delete_file(path)
        self._clear(fs, base)

    def abort(self, messages):
        self._clear(*_fs(self.path))

    def _clear(self, fs, base):
        import pyarrow.fs as pafs

        if fs.get_file_info(f"{base}/{self.attempt}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.attempt}")


class ArrowReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path = path
        self.schema = schema

    def partitions(self):
        import pyarrow.fs as pafs

        fs, base = _fs(self.path)
        infos = fs.get_file_info(pafs.FileSelector(base, recursive=False))
        files = sorted(i.path for i in infos if i.type == pafs.FileType.File and i.path.endswith(".arrow"))
        return [_FilePartition(f) for f in files]

    def read(self, partition):
        import pyarrow as pa

        fs, _ = _fs(self.path)
        names = [f.name for f in self.schema.fields]
        with fs.open_input_file(partition.file) as src:
            reader = pa.ipc.open_file(src)
            for i in range(reader.num_record_batches):
                yield reader.get_batch(i).select(names)


class ArrowDataSource(DataSource):
    @classmethod
    def name(cls):
        return "arrow"

    def schema(self):
        raise ValueError("the arrow format needs an explicit schema when reading")

    def reader(self, schema):
        return ArrowReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        return ArrowWriter(self.options["path"], overwrite)


def register(spark) -> None:
    spark.dataSource.register(ArrowDataSource)
