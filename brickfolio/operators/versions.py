"""Published versions of a table: an append-only log with one commit per version.

A version's rows are written to a folder of their own first; its log entry, named by its number, is then moved into place, which fails if another writer has
that number already. The loser reads the log again and decides anew. The store must rename without overwriting, as HDFS does; on a machine's own disk,
where Spark's file system only checks first, writers of one process take turns.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from py4j.protocol import Py4JJavaError

from brickfolio.contracts import ContractError
from brickfolio.operators.publish import content_fingerprint

_TURN = threading.Lock()


@dataclass(frozen=True)
class Version:
    version: int
    key: str
    content_sha256: str
    raw_sha256: str | None
    rows: int
    folder: str


class VersionLog:
    """The versions of the tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}")

    def entries(self) -> DataFrame:
        """All commits: version, key, content_sha256, raw_sha256, rows, folder."""
        schema = "version int, key string, content_sha256 string, raw_sha256 string, rows long, folder string"
        store = self._path("log").getFileSystem(self._conf)
        if not store.exists(self._path("log")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("pathGlobFilter", "*.json").json(f"{self.root}/log")

    def _state(self, key: str) -> tuple[int, Version | None]:
        """The last number of the log, and the key's last version; two rows at most reach the driver."""
        log = self.entries()
        last = log.agg(F.max("version")).first()[0] or 0
        own = log.filter(F.col("key") == key).orderBy(F.desc("version")).limit(1).collect()
        return last, Version(**own[0].asDict()) if own else None

    def _commit(self, entry: Version) -> bool:
        """False if another writer has the number."""
        draft, place = self._path(f"log/.{uuid.uuid4().hex}"), self._path(f"log/{entry.version:010d}.json")
        store = place.getFileSystem(self._conf)
        out = store.create(draft, True)
        out.write(bytearray(json.dumps(asdict(entry)).encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 1)
        none[0] = getattr(self._hadoop, "Options$Rename").NONE
        try:
            with _TURN:
                self._hadoop.FileContext.getFileContext(place.toUri(), self._conf).rename(draft, place, none)
        except Py4JJavaError as error:
            store.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def publish(self, df: DataFrame, key: str, raw_sha256: str | None = None, force: bool = False, retries: int = 10) -> tuple[str, int]:
        """The action taken and the key's version after it: UPLOAD, NEW_VERSION, SKIP_IDENTICAL or SKIP_REPACKAGED; other content without force is an error.

        ``raw_sha256`` is of the source's bytes; without it only the content decides.
        """
        print_ = content_fingerprint(df.withColumn("__all", F.lit(1)), ["__all"]).first()
        digest, rows = (print_.content_sha256, print_.rows) if print_ else ("", 0)
        folder = None
        for _ in range(retries):
            last, now = self._state(key)
            if now and raw_sha256 is not None and now.raw_sha256 == raw_sha256:
                return "SKIP_IDENTICAL", now.version
            if now and now.content_sha256 == digest:
                return ("SKIP_IDENTICAL" if raw_sha256 is None else "SKIP_REPACKAGED"), now.version
            if now and not force:
                raise ContractError(f"{key}: content differs from version {now.version}")
            if folder is None:
                folder = f"{self.root}/data/{uuid.uuid4().hex}"
                df.write.parquet(folder)
            if self._commit(Version(last + 1, key, digest, raw_sha256, rows, folder)):
                return ("NEW_VERSION" if now else "UPLOAD"), last + 1
        raise ContractError(f"{key}: no commit after {retries} tries")

    def read(self, key: str, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one by default."""
        log = self.entries().filter(F.col("key") == key)
        found = (log if version is None else log.filter(F.col("version") == version)).orderBy(F.desc("version")).limit(1).collect()
        if not found:
            raise ContractError(f"{key} has no such version")
        return self.spark.read.parquet(found[0].folder)
