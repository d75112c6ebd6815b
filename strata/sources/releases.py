"""One pointer for all tables of a layer: numbered release files.

A release is a small JSON file that says, for every table name, where its rows
are.  Publishing writes new folders first and then one file with the next
number; the file system refuses a number that is taken, so two publishers never
overwrite each other: the later one reads the newer release and tries again.  A
reader that resolves names through one release sees all tables of the same
version, whatever is published meanwhile."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Releases whose folders stay: the current one and that of readers just behind it.
KEEP = 2


class Releases:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/_releases"
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)
        self._io = jvm.org.apache.commons.io.IOUtils

    def _path(self, p: str):
        return self._hadoop.Path(p)

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> dict[str, dict]:
        stream = self._fs.open(self._path(f"{self.folder}/{number:012d}.json"))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict[str, dict]:
        """Table name -> entry of the newest release."""
        while True:
            numbers = self._numbers()
            if not numbers:
                return {}
            try:
                return self._load(numbers[-1])
            except Exception:  # pruned between the listing and the read
                if self._numbers()[-1:] == numbers[-1:]:
                    raise

    def commit(self, update: Callable[[dict[str, dict]], dict[str, dict]]) -> None:
        """Publish ``update`` of the current entries as the next release."""
        while True:
            numbers = self._numbers()
            entries = update(self._load(numbers[-1]) if numbers else {})
            if self._claim(numbers[-1] + 1 if numbers else 1, json.dumps(entries, sort_keys=True)):
                self._prune()
                return

    def _claim(self, number: int, text: str) -> bool:
        """Put the whole file in place under ``number``, unless it is taken."""
        part = self._path(f"{self.folder}/.{number:012d}-{uuid.uuid4().hex}")
        out = self._fs.create(part)
        try:
            self._io.write(text, out, "UTF-8")
        finally:
            out.close()
        gateway = self.spark.sparkContext._gateway
        none = gateway.new_array(self._hadoop.Options.Rename, 1)
        none[0] = self._hadoop.Options.Rename.NONE
        target = self._path(f"{self.folder}/{number:012d}.json")
        try:
            self._hadoop.FileContext.getFileContext(part.toUri(), self._conf).rename(
                self._fs.makeQualified(part), self._fs.makeQualified(target), none)
            return True
        except Exception as e:
            self._fs.delete(part, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def _prune(self) -> None:
        """Remove releases that are out of use, their catalog entries and folders."""
        numbers = self._numbers()
        kept = [e for n in numbers[-KEEP:] for e in self._load(n).values()]
        tables = {e["table"] for e in kept if "table" in e}
        paths = {p for e in kept for p in e["paths"]}
        for n in numbers[:-KEEP]:
            for e in self._load(n).values():
                if "table" in e and e["table"] not in tables:
                    self.spark.sql(f"DROP TABLE IF EXISTS {e['table']}")  # external: its folders go below
                for p in e["paths"]:
                    if p not in paths:
                        self._fs.delete(self._path(p), True)
            self._fs.delete(self._path(f"{self.folder}/{n:012d}.json"), False)

    def remove_unused(self, folder: str, used: set[str]) -> int:
        """Delete the folders at any depth of ``folder`` that neither hold nor are a
        folder in ``used`` (folder names as Spark lists them); returns their number."""
        gone = 0

        def visit(p) -> None:
            nonlocal gone
            here = p.toUri().getPath().rstrip("/")
            if here in used:
                return
            if not any(u.startswith(here + "/") for u in used):
                self._fs.delete(p, True)
                gone += 1
                return
            for s in self._fs.listStatus(p):
                if s.isDirectory():
                    visit(s.getPath())

        if self._fs.exists(self._path(folder)):
            for s in self._fs.listStatus(self._path(folder)):
                if s.isDirectory():
                    visit(s.getPath())
        return gone
