"""Two-phase writers: tasks write beside the target, the driver lets in what they have told of.

    committed_snapshot(lines, folder)   one JSON line for each row, in order, with a manifest
    committed_blobs(payloads, folder)   one file for each payload, named by its digest

A task writes to a folder of the job below ``_staging`` and tells the names, sizes and
digests of the bytes it has written. Only when all tasks have succeeded are these
files moved to their place, and the manifest, which alone says what a snapshot
holds, is written last. A job that fails takes its staging folder with it. Files are
named by their content, so a job that is run again finds its files there and adds
nothing; attempts of tasks that nobody told of are never seen.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..storage import ship

MANIFEST = "_manifest.json"
STAGING = "_staging"


@dataclass
class _Written(WriterCommitMessage):
    part: int
    files: list[dict] = field(default_factory=list)  # staged, name, bytes, sha256, rows


def _store(uri: str):  # noqa: ANN202
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.uri, self.kind, self.overwrite = options["path"], options["kind"], overwrite
        self.job = options.get("job") or uuid.uuid4().hex
        self.info = json.loads(options.get("info", "{}"))
        store, base = _store(self.uri)
        store.create_dir(f"{base}/{STAGING}/{self.job}", recursive=True)  # by the driver: once it is gone, what still runs can't write

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, base = _store(self.uri)
        staging = f"{base}/{STAGING}/{self.job}"
        told = _Written(part)
        if self.kind == "blobs":
            for b in iterator:
                for content in b.column("content").to_pylist():
                    data = content if isinstance(content, bytes) else (content or "").encode()
                    digest = hashlib.sha256(data).hexdigest()
                    staged = f"{staging}/{uuid.uuid4().hex}"
                    with store.open_output_stream(staged, compression=None) as f:
                        f.write(data)
                    told.files.append({"staged": staged, "name": f"{digest}.bin", "bytes": len(data), "sha256": digest, "rows": 1})
            return told
        staged, digest, size, rows, sink = f"{staging}/{uuid.uuid4().hex}", hashlib.sha256(), 0, 0, None
        for b in iterator:
            for line in b.column("line").to_pylist():
                sink = sink or store.open_output_stream(staged, compression=None)
                data = (line + "\n").encode()
                sink.write(data)
                digest.update(data)
                size, rows = size + len(data), rows + 1
        if sink:
            sink.close()
            told.files.append({"staged": staged, "name": f"part-{part:06}-{digest.hexdigest()[:16]}.jsonl", "bytes": size, "sha256": digest.hexdigest(), "rows": rows})
        return told

    def commit(self, messages: list[_Written | None]) -> None:
        from pyarrow import fs

        store, base = _store(self.uri)
        store.create_dir(base, recursive=True)
        there = {f.base_name for f in store.get_file_info(fs.FileSelector(base)) if f.type == fs.FileType.File}
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.part) for f in m.files]
        added = 0
        for f in files:
            if f["name"] not in there:
                store.move(f["staged"], f"{base}/{f['name']}")
                there.add(f["name"])
                added += 1
        self._clear()
        if self.kind == "snapshot":
            listed = [{"file": f["name"], "bytes": f["bytes"], "sha256": f["sha256"], "rows": f["rows"]} for f in files]
            whole = hashlib.sha256("".join(f["sha256"] for f in listed).encode()).hexdigest()
            manifest = {**self.info, "rows": sum(f["rows"] for f in listed), "sha256": whole, "payloads": listed}
            with store.open_output_stream(f"{base}/{MANIFEST}.{self.job}", compression=None) as out:
                out.write((json.dumps(manifest, indent=2, sort_keys=True) + "\n").encode())
            store.move(f"{base}/{MANIFEST}.{self.job}", f"{base}/{MANIFEST}")
            kept = {f["file"] for f in listed}
            for old in there - kept:
                if old.startswith("part-"):  # of the snapshot before
                    store.delete_file(f"{base}/{old}")

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """The job's staging folder goes, though killed tasks may still be writing into it."""
        from pyarrow import fs

        store, base = _store(self.uri)
        staging = f"{base}/{STAGING}/{self.job}"
        for _ in range(50):
            if store.get_file_info(staging).type != fs.FileType.Directory:
                return
            try:
                store.delete_dir(staging)
            except OSError:
                time.sleep(0.1)


class _Committed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quarrystone_committed"

    def writer(self, schema: object, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)


def _save(rows: DataFrame, **options: str) -> None:
    spark = rows.sparkSession
    ship(spark)
    spark.dataSource.register(_Committed)
    writer = rows.write.format("quarrystone_committed").mode("append")
    writer.options(**options, job=uuid.uuid4().hex).save()


def committed_snapshot(lines: DataFrame, folder: str, **info: str) -> dict:
    """Write the column ``line`` of rows, in their order, as a snapshot; its manifest (rows, sha256, payloads, info). The plan of lines runs once."""
    _save(lines.select("line"), path=folder, kind="snapshot", info=json.dumps(info))
    return read_manifest(folder)


def read_manifest(folder: str) -> dict:
    store, base = _store(folder)
    with store.open_input_stream(f"{base}/{MANIFEST}", compression=None) as f:
        return json.loads(f.read())


def files_of(folder: str) -> list[str]:
    """Paths of the files that a snapshot's manifest lists, in order."""
    return [f"{folder}/{f['file']}" for f in read_manifest(folder)["payloads"]]


def committed_blobs(payloads: DataFrame, folder: str) -> None:
    """Add payloads (content, text or binary) to a folder of blobs; one file for each digest, however many writers there are."""
    _save(payloads.select("content"), path=folder, kind="blobs")


def snapshot_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a snapshot that its manifest lists."""
    return spark.read.schema("value string").text(files_of(folder)).withColumnRenamed("value", "line")
