"""Numbered commits of a folder: who is first wins, and nobody can block.

A commit is a small JSON file ``_commit-N`` that names the data folders which make up version N. It is written in full
under another name and then given its number in one step that fails if the number is taken, so a commit is either
whole or absent: a writer that dies leaves nothing but an unused file. A marker that can't be read (an empty one of an older
release, say) takes its number and no more; the next writer passes it over.

The step is a hard link on local file systems and a rename on those where renames are atomic and refuse to replace
(``RENAMING``). Any other store is asked for a conditional create (``s3a`` has it from Hadoop 3.4.2 on); one that doesn't know this
option refuses the commit, rather than let two writers win.

A commit may carry an *outbox*: rows that were derived from the same base as the version and have to be handed on, with
the place to write them to. ``deliver`` writes what hasn't been delivered yet, so a writer that dies after its commit
has its rows handed on by the next run: at least once, and always those of the committed version.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from beaconfold.sources.scratch import remove_dir

#: File systems whose rename is atomic and fails if the target exists.
RENAMING = ("hdfs", "abfs", "abfss", "ofs")
#: Fixed value: option of Hadoop's file builder for a create that fails if the file exists.
CONDITIONAL_CREATE = "fs.option.create.conditional.overwrite"


class SnapshotConflict(Exception):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Commit:
    version: int
    content: Mapping[str, Any]

    def folders(self) -> set[str]:
        """The data folders this version needs."""
        outbox = [self.content["outbox"]["folder"]] if "outbox" in self.content else []
        return {*self.content.get("folders", []), *outbox}


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, root: str) -> list[str]:
    files, where = _place(spark, root)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def _numbers(names: list[str], kind: str) -> list[int]:
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"_{kind}-(\d+)", n)))


def _content(spark: SparkSession, path: str) -> dict[str, Any] | None:
    files, where = _place(spark, path)
    stream = files.open(where)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    if text.startswith("{"):
        return json.loads(text)
    # Markers of the first release hold the name of one folder.
    return {"folders": [text]} if text.strip() else None


def commits(spark: SparkSession, root: str) -> list[Commit]:
    """Readable commits, oldest first: a handful, as old ones are removed."""
    found = [(n, _content(spark, f"{root}/_commit-{n}")) for n in _numbers(_names(spark, root), "commit")]
    return [Commit(n, c) for n, c in found if c is not None]


def latest(spark: SparkSession, root: str) -> Commit | None:
    """The newest readable commit."""
    for n in reversed(_numbers(_names(spark, root), "commit")):
        if (content := _content(spark, f"{root}/_commit-{n}")) is not None:
            return Commit(n, content)
    return None


def next_number(spark: SparkSession, root: str) -> int:
    """The number after the highest one taken, readable or not."""
    return max(_numbers(_names(spark, root), "commit"), default=0) + 1


def new_folder(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def _write_text(files, where, text: str) -> None:
    stream = files.create(where, True)
    stream.write(text.encode())
    stream.close()


def _is_taken(e: Py4JJavaError) -> bool:
    trace = str(e.java_exception.toString()) + str(e.java_exception.getCause())
    return any(word in trace for word in ("AlreadyExists", "PreconditionFailed", "412"))


def publish(spark: SparkSession, root: str, version: int, content: Mapping[str, Any]) -> Commit:
    """Make a commit; ``SnapshotConflict`` if its number is taken."""
    jvm = spark.sparkContext._jvm
    files, parent = _place(spark, root)
    files.mkdirs(parent)
    resolved = files.resolvePath(parent).toUri()
    final = f"{root}/_commit-{version}"
    conflict = SnapshotConflict(f"version {version} of {root}")
    if resolved.getScheme() != "file" and resolved.getScheme() not in RENAMING:
        try:
            stream = files.createFile(_place(spark, final)[1]).overwrite(False).must(CONDITIONAL_CREATE, True).build()
            stream.write(json.dumps(content).encode())
            stream.close()
        except Py4JJavaError as e:
            raise (conflict if _is_taken(e) else e) from None
        return Commit(version, content)
    pending = new_folder("_pending")
    _write_text(files, _place(spark, f"{root}/{pending}")[1], json.dumps(content))
    try:
        if resolved.getScheme() == "file":
            local = jvm.java.io.File(resolved.getPath())
            jvm.java.nio.file.Files.createLink(jvm.java.io.File(local, f"_commit-{version}").toPath(), jvm.java.io.File(local, pending).toPath())
        elif not files.rename(_place(spark, f"{root}/{pending}")[1], _place(spark, final)[1]):
            raise conflict
    except Py4JJavaError as e:
        raise (conflict if _is_taken(e) else e) from None
    finally:
        remove_dir(spark, f"{root}/{pending}")
    return Commit(version, content)


def outbox(rows: DataFrame, root: str, to: str) -> dict[str, str]:
    """Write rows that a commit will carry, to be delivered as JSON lines under ``to``."""
    folder = new_folder("outbox")
    rows.write.parquet(f"{root}/{folder}")
    return {"folder": folder, "to": to}


def _undelivered(spark: SparkSession, root: str) -> list[Commit]:
    done = set(_numbers(_names(spark, root), "delivered"))
    return [c for c in commits(spark, root) if "outbox" in c.content and c.version not in done]


def deliver(spark: SparkSession, root: str) -> int:
    """Write the outboxes that haven't been delivered, oldest first; returns how many."""
    waiting = _undelivered(spark, root)
    for commit in waiting:
        box = commit.content["outbox"]
        spark.read.parquet(f"{root}/{box['folder']}").write.mode("overwrite").json(box["to"])
        files, mark = _place(spark, f"{root}/_delivered-{commit.version}")
        _write_text(files, mark, "")
    return len(waiting)


def prune(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest commits, with folders no other one needs. Undelivered ones stay."""
    found = commits(spark, root)
    waiting = {c.version for c in _undelivered(spark, root)}
    old = [c for c in found[:-keep] if c.version not in waiting]
    needed = set().union(*(c.folders() for c in found if c not in old))
    for commit in old:
        for mark in ("commit", "delivered"):
            remove_dir(spark, f"{root}/_{mark}-{commit.version}")
        for folder in commit.folders() - needed:
            remove_dir(spark, f"{root}/{folder}")
