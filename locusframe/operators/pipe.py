"""Stream records as text through an external command."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

from ..scratch import RECORDS_PER_FILE, materialize
from ..sources.header import merge_layout, per_file
from ..sources.vcf import parse_by_file
from ..sources.vcf_text import infer_header, record_lines

PIPED_SCHEMA = "source_file string, line string, error string"


#: Longest error text kept, a fixed value.
ERROR_CHARS = 32000
#: How the error of a command begins, as opposed to the fault of an answered line.
COMMAND_FAILED = "command "


#: Text handed to the command at once; pieces of input and of answer that wait at most.
PIECE_BYTES, WAITING = 1 << 18, 8


def _command_runner(cmd: Sequence[str], header: Sequence[str], chunk_bytes: int | None):
    """The task that streams the lines of each file through the command and yields what it answers.

    One process serves all neighbouring lines of a file; ``chunk_bytes`` starts another one after so many. Input
    and answer go through two queues of bounded length, each with a thread at the command's end. The task itself
    waits on neither alone: while the command does not read it takes answers, and answers are handed on before
    more is read. So a command that answers only after its input has ended (a sort) fills no memory here. A process
    that fails gives a row without a line that holds the error.
    """
    def run(batches: Iterator) -> Iterator:
        import queue
        import subprocess
        import threading

        import pyarrow as pa

        schema = pa.schema([("source_file", pa.string()), ("line", pa.string()), ("error", pa.string())])

        class Process:
            def __init__(self, source: str, title: str):
                self.source, self.size, self.complaint, self.broken, self.ended = source, 0, [], None, False
                self.child = subprocess.Popen(
                    list(cmd), stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE)
                self.input, self.answers = queue.Queue(WAITING), queue.Queue(WAITING)
                self.threads = [threading.Thread(target=work, daemon=True) for work in (self.write, self.listen, self.hear)]
                for thread in self.threads:
                    thread.start()
                self.waiting, self.waiting_size = [*header, title], 0

            def write(self) -> None:
                reads = True
                while (piece := self.input.get()) is not None:
                    try:
                        if reads:
                            self.child.stdin.write(piece)
                            self.child.stdin.flush()
                    except (BrokenPipeError, ValueError):
                        reads = False  # the status says why; a command may also stop reading when it has enough
                try:
                    self.child.stdin.close()
                except BrokenPipeError:
                    pass

            def listen(self) -> None:
                rest = b""
                while data := self.child.stdout.read1(PIECE_BYTES):
                    cut = data.rfind(b"\n") + 1  # lines end at line feeds alone
                    if cut:
                        self.answers.put(rest + data[:cut])
                        rest = data[cut:]
                    else:
                        rest += data
                if rest:
                    self.answers.put(rest)
                self.answers.put(None)

            def hear(self) -> None:
                kept = 0
                for part in iter(lambda: self.child.stderr.read(4096), b""):
                    if kept < 4 * ERROR_CHARS:
                        self.complaint.append(part)
                        kept += len(part)

            def batch(self, piece: bytes):
                try:
                    text = piece.decode().removesuffix("\n").split("\n")
                except UnicodeDecodeError as error:
                    self.broken, text = f"command answered in other than UTF-8: {error}", []
                return pa.RecordBatch.from_pydict(
                    {"source_file": [self.source] * len(text), "line": text, "error": [None] * len(text)}, schema)

            def answered(self, wait: float | None):
                """The answers that are there; those to come within ``wait`` if there are none, up to the end without a limit."""
                while not self.ended:
                    try:
                        piece = self.answers.get(block=wait != 0, timeout=wait or None)
                    except queue.Empty:
                        return
                    if piece is None:
                        self.ended = True
                    else:
                        yield self.batch(piece)
                    if wait:
                        wait = 0

            def put(self, piece: bytes | None):
                while True:
                    try:
                        self.input.put_nowait(piece)
                        break
                    except queue.Full:
                        if self.ended:
                            self.input.put(piece)  # the command has closed its output: it reads on, or writing ends
                            break
                        yield from self.answered(0.02)
                yield from self.answered(0)

            def take(self, line: str):
                self.waiting.append(line)
                self.size += len(line)
                self.waiting_size += len(line) + 1
                if self.waiting_size > PIECE_BYTES:
                    yield from self.send()

            def send(self):
                piece = ("\n".join(self.waiting) + "\n").encode()
                self.waiting, self.waiting_size = [], 0
                yield from self.put(piece)

            def end(self):
                if self.waiting:
                    yield from self.send()
                yield from self.put(None)
                yield from self.answered(None)
                status = self.child.wait()
                for thread in self.threads:
                    thread.join()
                error = self.broken
                if status != 0:
                    said = b"".join(self.complaint).decode("utf-8", "replace").strip()[:ERROR_CHARS]
                    error = f"command ended with status {status}: {said}"
                if error:
                    yield pa.RecordBatch.from_pydict({"source_file": [self.source], "line": [None], "error": [error]}, schema)

        process, current = None, None
        try:
            for batch in batches:
                files, titles, lines = (batch.column(i).to_pylist() for i in range(3))
                for source, title, line in zip(files, titles, lines):
                    if process is None or (source, title) != current or (chunk_bytes is not None and process.size > chunk_bytes):
                        if process is not None:
                            yield from process.end()
                        process, current = Process(source, title), (source, title)
                    yield from process.take(line)
            if process is not None:
                yield from process.end()
                process = None
        finally:
            if process is not None:
                process.child.kill()

    return run


def pipe_lines(df: DataFrame, cmd: Sequence[str], header: Sequence[str] | None = None,
               chunk_bytes: int | None = None) -> DataFrame:
    """Answer of the command, line by line: source_file, line, error. A failure is a row with an error and no line."""
    lines = record_lines(df, inferred=header is None)
    header = list(header) if header is not None else infer_header(df)
    return lines.mapInArrow(_command_runner(list(cmd), header, chunk_bytes), PIPED_SCHEMA)


def pipe_partitions(
    df: DataFrame, cmd: Sequence[str], header: Sequence[str] | None = None, on_error: str = "quarantine",
    chunk_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run records through ``cmd`` and parse its answer; returns (records, quarantined lines).

    The columns of the result follow the header the command prints, so an annotator may add fields.
    The command runs once: its answer is written to scratch and both results read it there. A file for which
    the command failed anywhere gives no records: its lines are quarantined, as are answers that are no
    records, as (source_file, raw, reason). With ``on_error="fail"`` they raise instead. ``chunk_bytes`` is
    for commands without state only: after so many bytes of a file another process takes over.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', got {on_error!r}")
    answer = materialize(pipe_lines(df, cmd, header, chunk_bytes), "piped")
    failed = materialize(answer.where(F.col("error").isNotNull()).groupBy("source_file").agg(F.min("error").alias("error")), "piped-failures")
    first = failed.orderBy("source_file").first()
    if on_error == "fail" and first is not None:
        raise RuntimeError(f"{' '.join(cmd)} failed on {first.source_file}: {first.error}")
    answered = answer.where(F.col("error").isNull())
    if first is not None:
        answered = answered.join(failed.select("source_file"), "source_file", "left_anti")
    is_header = F.col("line").startswith("#")
    headers = answered.where(is_header).select("source_file", "line").distinct()
    headers = materialize(headers, "piped-headers")
    layout = merge_layout(headers)
    lines = answered.where(~is_header & (F.trim("line") != "")).select("source_file", "line")
    parsed = parse_by_file(lines, per_file(headers), layout, "keep" if on_error == "quarantine" else "fail")
    bad = record_lines(df, inferred=header is None).select("source_file", "line").join(failed, "source_file").select(
        "source_file", F.col("line").alias("raw"), F.col("error").alias("reason"))
    if on_error == "fail":
        return parsed, bad
    parsed = materialize(parsed, "piped-records", RECORDS_PER_FILE)
    bad = bad.unionByName(parsed.where(F.col("corrupt_reason").isNotNull()).select(
        "source_file", F.col("corrupt_line").alias("raw"), F.col("corrupt_reason").alias("reason")))
    good = parsed.where(F.col("corrupt_reason").isNull()).drop("corrupt_line", "corrupt_reason")
    return good, bad
