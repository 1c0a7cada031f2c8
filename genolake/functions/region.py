"""Genomic regions: parse ``chr``, ``chr:a-b``, ``chr:a``, ``chr:a-`` and test overlap.

Coordinates are 1-based and inclusive.  A record occupies
``pos .. pos + length(ref) - 1`` (or ``INFO/END`` when asked), so a deletion
that starts before a region but reaches into it overlaps it.  ``chr:a``
means from ``a`` to the end of the contig, as in the reference's region
strings handed to the VCF library.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_COORD = (1 << 62)  # "to the end of the contig"

_RANGE = re.compile(r"(?P<start>[\d,]+)?(?:-(?P<end>[\d,]*))?")


@dataclass(frozen=True)
class Region:
    chrom: str
    start: int = 1
    end: int = MAX_COORD

    def __str__(self) -> str:
        if self.start == 1 and self.end == MAX_COORD:
            return self.chrom
        if self.end == MAX_COORD:
            return f"{self.chrom}:{self.start}-"
        return f"{self.chrom}:{self.start}-{self.end}"


def parse_region(text: str, contigs=()) -> Region:
    """Parse a region string; raises ``ValueError`` on bad input.

    Contig names may hold colons (``HLA-A*01:01:01:01``): the longest name of
    ``contigs`` that the text starts with is taken first; without one, a text
    of several colons is read up to its last one.
    """
    if text is None or not str(text).strip():
        raise ValueError("empty region")
    text = str(text).strip()
    known = max((c for c in contigs if text == c or text.startswith(c + ":")), key=len, default=None)
    chrom, _, rest = (known, "", text[len(known) + 1:]) if known else (text, "", "") if ":" not in text \
        else text.rpartition(":")
    m = _RANGE.fullmatch(rest)
    if not m or not chrom:
        raise ValueError(f"invalid region: {text!r}")
    start = int(m.group("start").replace(",", "")) if m.group("start") else 1
    end_txt = m.group("end")
    end = int(end_txt.replace(",", "")) if end_txt else MAX_COORD
    if start < 1 or end < start:
        raise ValueError(f"invalid region bounds: {text!r}")
    return Region(chrom, start, end)


def record_end(pos: Column | str = "pos", ref: Column | str = "ref", info: Column | str | None = None) -> Column:
    """Last reference base a record covers."""
    p = F.col(pos) if isinstance(pos, str) else pos
    r = F.col(ref) if isinstance(ref, str) else ref
    end = p + F.greatest(F.length(r), F.lit(1)) - 1
    if info is not None:
        i = F.col(info) if isinstance(info, str) else info
        end = F.coalesce(F.try_element_at(i, F.lit("END")).try_cast("bigint"), end)
    return end


def overlaps(region: Region, chrom: Column | str = "chrom", pos: Column | str = "pos",
             ref: Column | str = "ref", info: Column | str | None = None) -> Column:
    """Record overlaps the region (the filter P1)."""
    c = F.col(chrom) if isinstance(chrom, str) else chrom
    p = F.col(pos) if isinstance(pos, str) else pos
    cond = (c == region.chrom) & (p <= F.lit(region.end))
    if region.start > 1:
        cond = cond & (record_end(p, ref, info) >= F.lit(region.start))
    return cond
