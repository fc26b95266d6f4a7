"""The warehouse: star tables, models and their commits on shared storage.

Layout under ``root``::

    data/<table>/attempt=<id>/...                       dimension rows of one attempt
    data/fact_song_stream/attempt=<id>/year=/month=/    fact cells of one attempt
    data/song_numbers/attempt=<id>/                     a dense number for each song
    data/play_keys/attempt=<id>/year=/month=/           identities of the plays behind fact cells
    data/rejects/attempt=<id>/, data/folded/attempt=<id>/
    data/parts_<mart>/attempt=<id>/year=/month=/        mart parts of single months
    marts/<model>/attempt=<id>/                         a model table of one build
    _commits/<version>.json                             which attempts count
    _scratch/...                                        intermediates, deleted after use

Every write goes to a fresh attempt folder that no reader looks at.  A commit
file then publishes it: it names all attempts that count at its version.
Commit files are created only if absent, under the next number, so of two
writers that started from one version the second one fails to commit, looks
at the new state and tries again.  Readers take one state and see just its
attempts; an attempt that was never committed is garbage that ``vacuum``
removes after a while.

A commit file gets its name in one step that fails if the name is taken, also
between processes: by a hard link on local disks, elsewhere by a rename without
overwrite of Hadoop's ``FileContext``, which is atomic on HDFS and its like.  On
stores where that is a check and a copy (some object stores) let one process write
at a time; writers of one process are kept apart by a lock.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
import uuid
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.schemas import PLAY_KEYS, REJECT, SONG_NUMBERS, STAR_TABLES

DIM_TABLES = ("dim_artist", "dim_song", "dim_date")
NUMBERS = "song_numbers"
PART_TABLES = ("parts_artists", "parts_songs", "parts_patterns")
KEYS = "play_keys"
TABLES = STAR_TABLES | {NUMBERS: SONG_NUMBERS, KEYS: PLAY_KEYS}
FACT = "fact_song_stream"
ATTEMPT = "attempt"
BATCH_ID = re.compile(r"[A-Za-z0-9_.-]+")
_locks: dict[str, threading.Lock] = {}


@dataclass(frozen=True)
class State:
    """What counts at one version.

    Its size is bounded by the calendar months, the number of streams and the loads
    that are still pending, which tiering keeps to a fixed number.
    """

    version: int = 0
    dims: dict[str, list[str]] = field(default_factory=dict)     # table -> attempts, oldest first
    facts: dict[str, dict] = field(default_factory=dict)         # pending batch -> {attempt, months, version, digest}
    months: dict[str, str] = field(default_factory=dict)         # month -> its largest folded attempt
    runs: dict[str, list[str]] = field(default_factory=dict)     # month -> further folded attempts, oldest first
    rows: dict[str, int] = field(default_factory=dict)           # <table or month>/<attempt> -> rows
    rejects: dict[str, str] = field(default_factory=dict)        # pending batch -> attempt
    refused: list[str] = field(default_factory=list)             # attempts with the rejects of folded batches
    folded: list[str] = field(default_factory=list)              # attempts with folded batch ids
    streams: dict[str, int] = field(default_factory=dict)        # stream -> newest epoch
    models: dict[str, str] = field(default_factory=dict)         # model -> attempt
    built: dict[str, str] = field(default_factory=dict)          # model -> what it was built from
    parts: dict[str, list[str]] = field(default_factory=dict)    # month -> [attempt of its mart parts, its sources]

    def folded_runs(self, month: str) -> list[str]:
        """The folded attempts of a month, oldest and largest first."""
        return ([self.months[month]] if month in self.months else []) + self.runs.get(month, [])

    def sources(self) -> dict[str, list[str]]:
        """month -> the attempts that hold cells of it."""
        found = {m: self.folded_runs(m) for m in self.months}
        for fact in self.facts.values():
            for month in fact["months"]:
                found.setdefault(month, []).append(fact["attempt"])
        return found

    @staticmethod
    def signature(attempts: list[str]) -> str:
        """What tells the sources of a month from others: attempts never change."""
        return hashlib.sha256("\n".join(sorted(attempts)).encode()).hexdigest()[:16]

    def attempts(self) -> set[tuple[str, str]]:
        """(table, attempt) of everything that counts."""
        out = {(t, a) for t, found in self.dims.items() for a in found}
        out |= {(t, a) for found in self.sources().values() for a in found for t in (FACT, KEYS)}
        out |= {("rejects", a) for a in [*self.rejects.values(), *self.refused]} | {("folded", a) for a in self.folded}
        out |= {(t, a) for t in PART_TABLES for a, _ in self.parts.values()}
        return out | {(f"marts/{m}", a) for m, a in self.models.items()}

    def pruned(self) -> State:
        """Without row counts of attempts that are gone."""
        used = {f"{t}/{a}" for t, found in self.dims.items() for a in found}
        used |= {f"{m}/{a}" for m in self.months for a in self.folded_runs(m)}
        return replace(self, rows={k: n for k, n in self.rows.items() if k in used},
                       runs={m: r for m, r in self.runs.items() if r})


def check_batch_id(batch_id: str) -> str:
    """Batch ids become folder names: letters, digits, ``_``, ``.`` and ``-`` only."""
    if not BATCH_ID.fullmatch(batch_id) or batch_id.startswith("."):
        raise ValueError(f"invalid batch id {batch_id!r}")
    return batch_id


class Warehouse:
    """``keep_pending``: that many of the newest loads can be replaced by a replay;
    older ones are folded when there are twice as many."""

    def __init__(self, spark: SparkSession, root: str, keep_pending: int = 8):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_pending = keep_pending

    # -- files -------------------------------------------------------------
    def table_path(self, table: str) -> str:
        return f"{self.root}/{table}" if table.startswith("marts/") else f"{self.root}/data/{table}"

    def attempt_path(self, table: str, attempt: str) -> str:
        return f"{self.table_path(table)}/{ATTEMPT}={attempt}"

    def new_attempt(self, label: str) -> str:
        return f"{check_batch_id(label)}-{uuid.uuid4().hex[:12]}"

    def scratch_path(self, label: str) -> str:
        return f"{self.root}/_scratch/{label}-{uuid.uuid4().hex[:12]}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return bool(fs.exists(p))

    def delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)

    def list_dir(self, path: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of what lies under ``path``."""
        p, fs = self._fs(path)
        return sorted((s.getPath().getName(), s.getModificationTime())
                      for s in fs.listStatus(p)) if fs.exists(p) else []

    # -- commits -----------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n, _ in self.list_dir(f"{self.root}/_commits")
                      if re.fullmatch(r"\d+\.json", n))

    def state(self, version: int | None = None) -> State:
        """The newest state, or the one of a version that is still there."""
        if version is None:
            found = self.versions()
            if not found:
                return State()
            version = found[-1]
        p, fs = self._fs(f"{self.root}/_commits/{version:012d}.json")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(**json.loads(text))

    def try_commit(self, base: State, **changes) -> State | None:
        """Publish ``base`` with changes as the next version; None if another
        writer published that version first."""
        new = replace(base, version=base.version + 1, **changes).pruned()
        with _locks.setdefault(self.root, threading.Lock()):
            target, fs = self._fs(f"{self.root}/_commits/{new.version:012d}.json")
            if fs.exists(target):
                return None
            draft, _ = self._fs(f"{self.root}/_commits/.draft-{uuid.uuid4().hex}")
            out = fs.create(draft, False)
            try:
                out.write(bytearray(json.dumps(asdict(new), sort_keys=True).encode()))
            finally:
                out.close()
            try:
                self._name_once(fs, draft, target)
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                    raise
                return None
            finally:
                if fs.exists(draft):
                    fs.delete(draft, False)
        return new

    def _name_once(self, fs, draft, target) -> None:
        """Give a file its final name; a FileAlreadyExistsException if that is taken."""
        gateway = self.spark.sparkContext._gateway
        jvm = gateway.jvm
        if fs.getScheme() == "file":
            at = [jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*at)
            return
        options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(draft, target, options)

    # -- tables ------------------------------------------------------------
    def create_tables(self) -> None:
        """Create each star table's folder if absent (metadata only, no job).

        The schema is fixed in code, so an empty folder already reads as an
        empty, fully typed table.
        """
        for table in STAR_TABLES:
            p, fs = self._fs(self.table_path(table))
            if not fs.exists(p):
                fs.mkdirs(p)

    def read(self, table: str, folders: list[str], extra: str = "") -> DataFrame:
        """Rows of the named folders below a table, with its partition columns."""
        schema = T.StructType([*TABLES[table].fields,
                               *T.StructType.fromDDL(f"{ATTEMPT} string{extra}").fields])
        if table == FACT:
            schema = T.StructType([f for f in schema.fields if f.name != "song_stream_id"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        path = self.table_path(table)
        return self.spark.read.schema(schema).option("basePath", path).parquet(
            *[f"{path}/{f}" for f in folders])

    def read_dim(self, table: str, state: State | None = None) -> DataFrame:
        attempts = (state or self.state()).dims.get(table, [])
        return self.read(table, [f"{ATTEMPT}={a}" for a in attempts]).drop(ATTEMPT)

    def read_rejects(self, batch_id: str) -> DataFrame:
        """What the committed load of a batch refused, with the reasons."""
        state = self.state()
        if batch_id in state.rejects:
            paths = [self.attempt_path("rejects", state.rejects[batch_id])]
            return self.spark.read.schema(REJECT).parquet(*paths)
        if state.refused:
            rows = self.all_rejects(state).where(F.col("batch_id") == batch_id)
            if not rows.isEmpty():
                return rows.drop("batch_id")
        raise KeyError(f"batch {batch_id!r} has no rejected plays")

    def all_rejects(self, state: State | None = None) -> DataFrame:
        """Everything that committed loads refused, with the batch ids."""
        state = state or self.state()
        schema = T.StructType([*REJECT.fields, T.StructField("batch_id", T.StringType())])
        out = self.spark.createDataFrame([], schema)
        if state.refused:
            out = self.spark.read.schema(schema).parquet(*[self.attempt_path("rejects", a) for a in state.refused])
        if state.rejects:
            # Pending attempts are few; their folder names tell the batch.
            names = {a: b for b, a in state.rejects.items()}
            rows = self.spark.read.schema(REJECT).parquet(*[self.attempt_path("rejects", a) for a in names])
            attempt = F.regexp_extract(F.col("_metadata.file_path"), f"{ATTEMPT}=([^/]+)/", 1)
            known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
            out = out.unionByName(rows.withColumn("batch_id", known[attempt]))
        return out

    # -- models ------------------------------------------------------------
    def publish_models(self, attempts: dict[str, str], built: dict[str, str] | None = None) -> None:
        """Make readers see these attempts of the models, all at once.  ``built`` tells
        what they were built from, if that is known."""
        while True:
            state = self.state()
            kept = {m: b for m, b in state.built.items() if m not in attempts}
            if self.try_commit(state, models=state.models | attempts, built=kept | (built or {})):
                return

    def read_model(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.attempt_path(f"marts/{name}", self.state().models[name]))
