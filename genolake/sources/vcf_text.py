"""VCF text as a DataFrame: source resolution, line scan and header.

A VCF is read with ``spark.read.text``: one row per line, split by Hadoop
input splits, so plain-text files are scanned by many tasks.  ``.gz`` files
(gzip or BGZF, which is multi-member gzip) are decompressed whole by one
task each; files named ``.bgz`` are refused because the text source would
hand back raw compressed bytes.

The header (``#`` lines) of a file is read from its head, bounded by the
header's size; that of several files is the union of all their headers, their
heads read side by side.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemes that resolve to the local file system; any other scheme is handed
# to Hadoop only when it is in ``remote_schemes``.
_LOCAL_SCHEMES = ("", "file")
DEFAULT_REMOTE_SCHEMES = ("hdfs", "https", "s3a", "gs", "abfs", "abfss", "viewfs")


def resolve_source(source: str, remote_schemes=DEFAULT_REMOTE_SCHEMES) -> str:
    """Map a user source string to a path Spark can read.

    Bare paths and ``file://`` URIs are local.  Other schemes must be listed
    in ``remote_schemes``; the rest raise ``ValueError`` (the reference
    accepts only local paths and https).
    """
    if not isinstance(source, str) or not source:
        raise ValueError("Unsupported source scheme: empty source")
    parsed = urlparse(source)
    scheme = parsed.scheme.lower()
    if len(scheme) == 1:  # a Windows drive letter, not a scheme
        scheme = ""
    if scheme in _LOCAL_SCHEMES:
        path = parsed.path if scheme == "file" else source
        if path.endswith(".bgz"):
            raise ValueError(f"Unsupported compression suffix .bgz: {source}; rename to .gz")
        return path
    if scheme in remote_schemes:
        if source.endswith(".bgz"):
            raise ValueError(f"Unsupported compression suffix .bgz: {source}; rename to .gz")
        return source
    raise ValueError(
        f"Unsupported source scheme: {parsed.scheme}. "
        f"Supported schemes: file://, {', '.join(s + '://' for s in remote_schemes)} or local paths")


def read_lines(spark: SparkSession, source, remote_schemes=DEFAULT_REMOTE_SCHEMES) -> DataFrame:
    """All lines of one or more VCF sources as ``value`` (string).

    Missing local paths raise ``FileNotFoundError``; read errors on remote
    sources raise ``IOError`` naming the source.
    """
    sources = [source] if isinstance(source, str) else list(source)
    paths = [resolve_source(s, remote_schemes) for s in sources]
    try:
        return spark.read.text(paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            local = [p for p in paths if urlparse(p).scheme in _LOCAL_SCHEMES]
            if local:
                raise FileNotFoundError(f"VCF file not found: {', '.join(local)}") from e
        raise IOError(f"Failed to open VCF {', '.join(sources)}: {e}") from e
    except Exception as e:  # remote file systems report as Py4J/IO errors
        raise IOError(f"Failed to open VCF {', '.join(sources)}: {e}") from e


@contextmanager
def naming_source(source, what: str):
    """Read failures inside the block become an ``IOError`` that names the source (S5); own errors pass."""
    try:
        yield
    except (OSError, ValueError, RuntimeError):
        raise
    except Exception as e:
        raise IOError(f"Failed to {what} VCF {source}: {e}") from e


@dataclass
class VcfHeader:
    """What the header declares; small, lives on the driver."""

    lines: list[str] = field(default_factory=list)
    version: str | None = None
    samples: list[str] = field(default_factory=list)
    contigs: list[str] = field(default_factory=list)
    info: dict[str, dict[str, str]] = field(default_factory=dict)
    format: dict[str, dict[str, str]] = field(default_factory=dict)
    filters: list[str] = field(default_factory=list)

    @property
    def contig_index(self) -> dict[str, int]:
        return {c: i for i, c in enumerate(self.contigs)}


def _structured_fields(body: str) -> dict[str, str]:
    """``ID=AF,Number=A,Type=Float,Description="x, y"`` -> dict (quotes kept out)."""
    out, key, val, in_q, cur_is_key = {}, [], [], False, True
    for ch in body:
        if ch == '"':
            in_q = not in_q
            continue
        if not in_q and ch == "=" and cur_is_key:
            cur_is_key = False
            continue
        if not in_q and ch == ",":
            out["".join(key).strip()] = "".join(val)
            key, val, cur_is_key = [], [], True
            continue
        (key if cur_is_key else val).append(ch)
    if key:
        out["".join(key).strip()] = "".join(val)
    return out


def parse_header_lines(lines: list[str]) -> VcfHeader:
    """Parse the ``#`` lines of a VCF (driver side, header-sized input)."""
    h = VcfHeader(lines=[ln.rstrip("\r") for ln in lines])
    for ln in h.lines:
        if ln.startswith("##fileformat="):
            h.version = ln[len("##fileformat="):]
        elif ln.startswith("##") and "=<" in ln and ln.endswith(">"):
            kind = ln[2:ln.index("=<")]
            attrs = _structured_fields(ln[ln.index("=<") + 2:-1])
            ident = attrs.get("ID")
            if ident is None:
                continue
            if kind == "contig":
                if ident not in h.contigs:
                    h.contigs.append(ident)
            elif kind == "INFO":
                h.info.setdefault(ident, attrs)
            elif kind == "FORMAT":
                h.format.setdefault(ident, attrs)
            elif kind == "FILTER":
                if ident not in h.filters:
                    h.filters.append(ident)
        elif ln.startswith("#CHROM"):
            cols = ln.split("\t")
            h.samples = cols[9:]
    return h


def literal_path(uri: str) -> str:
    """A file URI as Spark reports it (percent-encoded) as a path that Spark reads as this one file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def file_header_lines(spark: SparkSession, file: str, first_chunk: int = 128) -> list[str]:
    """The ``#`` lines that start one file.

    ``take`` from its head, growing until the first record line: the jobs read
    the file's first split, and of it little more than the header; of record
    lines only one character comes along.  A header longer than the split is
    filtered out of the whole file.
    """
    lines = spark.read.text(literal_path(file)).select("value", F.col("_metadata.file_block_start").alias("_b"))
    cut = F.when(F.col("value").startswith("#"), F.col("value")).otherwise(F.substring("value", 1, 1))
    n = first_chunk
    while True:
        rows = lines.select(cut.alias("value"), "_b").take(n)
        head = [r["value"] for r in rows if r["_b"] == 0]
        body = next((i for i, v in enumerate(head) if not v.startswith("#")), None)
        if body is not None or len(rows) < n and len(head) == len(rows):
            return head[:body]
        if len(head) < len(rows):
            marked = lines.where(F.col("value").startswith("#")).withColumn("_i", F.monotonically_increasing_id())
            return [r["value"] for r in marked.orderBy("_b", "_i").collect()]
        n *= 4


HEADS_AT_ONCE = 16


def read_header(spark: SparkSession, lines: DataFrame) -> VcfHeader:
    """The header of a source, from the heads of its files (no record is read beyond them).

    Several files: contigs and definitions are the union, first file first;
    the sample columns must agree (same names, same order) wherever a file
    names them, else ``ValueError``: sample values are read by their place.
    """
    files = sorted(lines.inputFiles())
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:  # small jobs, many of them
        heads = list(pool.map(lambda f: file_header_lines(spark, f), files))
    distinct = list(dict.fromkeys(ln for head in heads for ln in head))
    names = {ln for ln in distinct if ln.startswith("#CHROM")}
    if len({tuple(n.rstrip("\r").split("\t")[9:]) for n in names}) > 1:
        raise ValueError(f"the files name different sample columns: {sorted(names)[:4]}")
    return parse_header_lines(distinct)


def body_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Record lines only: header and blank lines removed.

    Adds ``raw_len``: utf-8 bytes of the line plus one newline byte.  The text
    reader ends lines at ``\n``, ``\r\n`` or ``\r``, so no CR reaches here.
    Columns named in ``keep`` pass through.
    """
    v = F.col("value")
    return (lines.where(~v.startswith("#") & (F.length(v) > 0))
            .select(v.alias("value"), (F.octet_length(v) + 1).alias("raw_len"), *keep))
