"""The archive of bodies (A6, A10), extraction in processes of its own (L4), and what an adapter may do (L3).

An archive is a Parquet folder of bodies under their SHA-256, in folders by the digest's first digit and in ranges of it
inside, so that files can be skipped in a look-up. Bodies are only ever added. One writer at a time stores into an archive; if two did,
a body could be stored twice, and reads would still give it once.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import uuid
from collections.abc import Iterator
from multiprocessing.connection import Connection

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import escape_markdown
from docloom.operators import containers as K
from docloom.operators.pdf import PdfError, pdf_pages
from docloom.operators.scoring import text_check
from docloom.session import exists, ship

#: The largest body that is extracted, and the largest result (fixed values).
MOST_BYTES, MOST_RESULT = 256 << 20, 80 << 20


class Archive:
    """Bodies by content, below ``path``."""

    schema = "sha256 string, byte_size long, body binary, folder string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _stored(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def put(self, bodies: DataFrame) -> DataFrame:
        """Stores the bodies (column ``body``) that are not there yet; sha256, byte_size and stored (only now) of each.

        Nulls are no bodies; repeated ones are stored once; an empty body is one.
        """
        told = bodies.where("body IS NOT NULL").select(F.sha2("body", 256).alias("sha256"), F.octet_length("body").cast("long").alias("byte_size"), "body")
        once = told.groupBy("sha256", "byte_size").agg(F.any_value("body").alias("body"))
        before = self._stored().select("sha256", F.substring("sha256", 1, 1).alias("folder"))
        refs = f"{self.path.rstrip('/')}-refs/{uuid.uuid4().hex}"
        known = told.groupBy("sha256", "byte_size").agg(F.lit(1).alias("_")).drop("_").join(before.select("sha256").distinct().withColumn("old", F.lit(True)), "sha256", "left")
        # what is new is written down before the archive grows, as a later read of the archive would call all of it old
        known.select("sha256", "byte_size", F.col("old").isNull().alias("stored")).write.parquet(refs)
        new = once.join(before.select("sha256"), "sha256", "left_anti").withColumn("folder", F.substring("sha256", 1, 1))
        # by ranges of the digest: a task writes to few folders, and files can be skipped by it
        new.repartitionByRange("sha256").sortWithinPartitions("sha256").write.mode("append").partitionBy("folder").parquet(self.path)
        return self.spark.read.parquet(refs)

    def get(self, refs: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
        """``refs`` (archive_ref, state and more columns) with byte_size, body and error, in one pass without a network.

        Errors, the first that holds: input_not_archived, archive_body_missing, archive_body_too_large, archive_body_corrupt
        (the digest is taken again). A row with an error has no body.
        """
        wanted = refs.where("state = 'archived'").select(F.col("archive_ref").alias("sha256"), F.substring("archive_ref", 1, 1).alias("folder")).distinct()
        held = self._stored().join(wanted, ["sha256", "folder"], "left_semi").groupBy("sha256").agg(F.max(F.struct("byte_size", "body")).alias("s"))
        joined = refs.join(held.select(F.col("sha256").alias("archive_ref"), "s.byte_size", "s.body"), "archive_ref", "left")
        error = (
            F.when(~F.col("state").eqNullSafe("archived"), "input_not_archived")
            .when(F.col("byte_size").isNull(), "archive_body_missing")
            .when(F.col("byte_size") > most_bytes, "archive_body_too_large")
            .when(F.sha2("body", 256) != F.col("archive_ref"), "archive_body_corrupt")
        )
        told = joined.withColumn("error", error)
        return told.withColumn("body", F.when(F.col("error").isNull(), F.col("body")))


# --- extraction ---------------------------------------------------------------------------------------


class Refused(Exception):
    """Why a body has no text; the message is the error's code."""


def _decoded(body: bytes) -> str:
    try:
        return body.decode("utf-8-sig")
    except UnicodeDecodeError:
        raise Refused("text_encoding_invalid") from None


#: How each kind is read; those that are not here are refused.
READERS = {
    "txt": lambda b: escape_markdown(_decoded(b)),
    "html": lambda b: K.html_to_markdown(_decoded(b)),
    "xml": K.gazette_markdown,
    "rtf": lambda b: escape_markdown(K.rtf_text(b) or ""),
    "docx": K.docx_markdown,
    "xlsx": K.xlsx_markdown,
    "pdf": lambda b: "\n".join(t for t in map(escape_markdown, pdf_pages(b)) if t),
}


def extracted(body: bytes, hint: str = "", most_bytes: int = MOST_BYTES) -> dict:
    """kind, markdown and members of one body; for archives each member's text under its name. Refuses by raising."""
    kind = K.detect(body, hint)
    if kind != "zip":
        if kind not in READERS:
            raise Refused("unsupported_document_type")
        return {"kind": kind, "markdown": READERS[kind](body) or "", "members": []}
    members, error = K.zip_members(body, most_bytes)
    if error:
        raise Refused(error)
    parts = []
    for path, member, inner in members:
        if member not in READERS:
            raise Refused("unsupported_document_type")
        title = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        parts.append(f"## {title}\n\n{(READERS[member](inner) or '').strip()}")
    return {"kind": kind, "markdown": "\n\n".join(parts).strip() + "\n", "members": [path for path, *_ in members]}


def answer(body: bytes, hint: str = "") -> dict:
    """What the child process says to one body: a value or an error, never a failure."""
    try:
        value = extracted(body, hint)
        if not value["markdown"].strip():
            raise Refused("extracted_text_empty")
        return value
    except (Refused, PdfError) as e:
        return {"error": str(e)}
    except MemoryError:
        return {"error": "extraction_memory_exceeded"}
    except Exception as e:  # noqa: BLE001  a broken body must not take others with it
        return {"error": "extraction_failed", "category": type(e).__name__}


def serve(memory: int) -> None:
    """The child process: answers bodies from its input, within ``memory`` bytes, until the input ends."""
    import resource

    resource.setrlimit(resource.RLIMIT_AS, (memory, memory))
    asked, told = Connection(0, writable=False), Connection(os.dup(1), readable=False)
    os.dup2(2, 1)  # whatever is printed stays out of the answers
    while True:
        try:
            hint, body = asked.recv_bytes().decode(), asked.recv_bytes()
        except EOFError:
            return
        told.send_bytes(json.dumps(answer(body, hint), ensure_ascii=False).encode())


class Worker:
    """A child process that is started when a body comes, and again after it was lost."""

    def __init__(self, seconds: float, memory: int, most_result: int):
        self.seconds, self.memory, self.most_result, self.child = seconds, memory, most_result, None

    def _start(self) -> None:
        code = f"from docloom.sources.archive import serve; serve({self.memory})"
        env = {**os.environ, "PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
        self.child = subprocess.Popen([sys.executable, "-c", code], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, env=env)
        self.ask, self.hear = Connection(os.dup(self.child.stdin.fileno()), readable=False), Connection(os.dup(self.child.stdout.fileno()), writable=False)

    def close(self) -> None:
        if self.child is None:
            return
        self.child.kill()
        self.child.wait()
        for pipe in (self.ask, self.hear, self.child.stdin, self.child.stdout):
            pipe.close()
        self.child = None

    def __call__(self, body: bytes, hint: str) -> dict:
        if self.child is None:
            self._start()
        try:
            self.ask.send_bytes(hint.encode())
            self.ask.send_bytes(body)
            if not self.hear.poll(self.seconds):
                self.close()
                return {"error": "extraction_timeout"}
            return json.loads(self.hear.recv_bytes(self.most_result))
        except EOFError:
            self.close()
            return {"error": "child_process_failed"}
        except OSError as e:  # too large an answer leaves the pipe unreadable, a lost child leaves it broken
            self.close()
            return {"error": "child_process_failed" if isinstance(e, BrokenPipeError) else "extraction_result_too_large"}


def extract(bodies: DataFrame, seconds: float = 60, memory: int = 2 << 30, most_bytes: int = MOST_BYTES, most_result: int = MOST_RESULT) -> DataFrame:
    """L4: ``bodies`` (column body, and hint if there is one) with kind, markdown, members and error.

    Bodies are read in a child process of each task, with a limit of memory and one of time for each body: one that
    exhausts or crashes the child is a row with an error, and a new child takes the next. Rows without a body keep the
    error that they have; a null body without one is extraction_input_missing.
    """
    ship(bodies.sparkSession)
    hinted = "hint" in bodies.columns

    @F.pandas_udf("struct<kind:string,markdown:string,members:array<string>,error:string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        worker = Worker(seconds, memory, most_result)

        def one(body: bytes | None, hint: str | None) -> tuple:
            if body is None:
                return None, None, None, "extraction_input_missing"
            got = worker(body, hint or "") if len(body) <= most_bytes else {"error": "document_too_large"}
            return got.get("kind"), got.get("markdown"), got.get("members"), got.get("error")

        try:
            for body, hint in batches:
                yield pd.DataFrame([one(b, h) for b, h in zip(body, hint)], columns=["kind", "markdown", "members", "error"])
        finally:
            worker.close()

    read = bodies.withColumn("_read", run("body", "hint" if hinted else F.lit("")))
    before = [F.col("error")] if "error" in bodies.columns else []
    error = F.coalesce(*before, F.col("_read.error")).alias("error")
    return read.select(*[c for c in bodies.columns if c not in ("error", "kind", "markdown", "members")], "_read.kind", "_read.markdown", "_read.members", error)


class Context:
    """L3: all that an adapter may do: read archived bodies, store some, extract and judge texts, ask for links."""

    def __init__(self, archive: Archive, language: str = "", max_depth: int = 1, mode: str = "collect"):
        self.archive, self.language, self.max_depth, self.mode = archive, language or "", max_depth, mode

    def read(self, acquisitions: DataFrame) -> DataFrame:
        return self.archive.get(acquisitions)

    def store(self, bodies: DataFrame) -> DataFrame:
        return self.archive.put(bodies)

    def extract(self, bodies: DataFrame, **limits) -> DataFrame:
        return extract(bodies, **limits)

    def text_quality(self, texts: DataFrame, text: str = "markdown") -> DataFrame:
        """Texts with route and reasons, by the rules of the source's language."""
        return text_check(texts, text, self.language.startswith("vi"))

    def follow_links(self, tasks: DataFrame) -> DataFrame:
        """The tasks (column depth) whose links are followed: those above the greatest depth, and only when collecting."""
        return tasks.where((F.col("depth") < self.max_depth) & F.lit(self.mode == "collect"))
