import gzip

import pytest

from genolake.sources.scan import open_vcf
from genolake.sources.vcf_text import parse_header_lines, resolve_source

from .conftest import HEADER, tsv


def test_resolve_local_and_file_uri(tmp_path):
    p = str(tmp_path / "a.vcf")
    assert resolve_source(p) == p
    assert resolve_source(f"file://{p}") == p


REMOTE = "://archive.invalid/cohort-7/calls.vcf"


@pytest.mark.parametrize("scheme,known", [("hdfs", True), ("https", True), ("abfss", True), ("ftp", False), ("s3", False), ("http", False),
                                          ("smb", False), ("jdbc", False)])
def test_schemes(scheme, known):
    if known:
        assert resolve_source(scheme + REMOTE) == scheme + REMOTE
        return
    with pytest.raises(ValueError, match=f"Unsupported source scheme: {scheme}"):
        resolve_source(scheme + REMOTE)
    assert resolve_source(scheme + REMOTE, (scheme,)) == scheme + REMOTE  # where the session can read it


def test_bgz_suffix_refused(tmp_path):
    with pytest.raises(ValueError, match="bgz"):
        resolve_source(str(tmp_path / "x.vcf.bgz"))


def test_missing_file_raises_file_not_found(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        open_vcf(spark, str(tmp_path / "nope.vcf.gz"))


def test_minimal_file_header_only(spark, vcf):
    s = open_vcf(spark, vcf("##fileformat=VCFv4.2"))
    assert s.header.version == "VCFv4.2"
    assert s.header.samples == [] and s.header.contigs == []
    v = s.variants()
    assert v.count() == 0
    assert "genotypes" in v.columns  # full schema even when empty


def test_empty_body_and_header_tables(spark, vcf):
    s = open_vcf(spark, vcf(HEADER))
    h = s.header
    assert h.samples == ["NA1", "NA2", "NA3"]
    assert h.contigs == ["chr1", "chr2", "chr10"]
    assert h.info["AF"]["Number"] == "A" and h.info["AF"]["Description"] == "Allele Frequency, per ALT"
    assert set(h.format) == {"GT", "GQ", "PL"}
    assert s.variants().count() == 0


def test_header_parse_quoted_commas():
    h = parse_header_lines(['##INFO=<ID=X,Number=1,Type=String,Description="a, b=c">'])
    assert h.info["X"]["Description"] == "a, b=c"


def test_multi_member_gzip(spark, tmp_path):
    rows = [("chr1", i, ".", "A", "G", 50, "PASS", ".") for i in range(1, 301)]
    text = HEADER.split("\n#CHROM")[0] + "\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    lines = (text + tsv(*rows) + "\n").encode()
    p = tmp_path / "multi.vcf.gz"
    with open(p, "wb") as f:  # several gzip members, like BGZF blocks
        for i in range(0, len(lines), 1000):
            f.write(gzip.compress(lines[i:i + 1000]))
    s = open_vcf(spark, str(p))
    assert s.variants().count() == 300
    assert s.header.contigs == ["chr1", "chr2", "chr10"]


def test_crlf_line_ends(spark, vcf):
    text = HEADER + "\n" + tsv(("chr1", 5, "rs1", "A", "G", 9.5, "PASS", "DP=3", "GT:GQ", "0/1:7", "1/1:9", "0|0:3"))
    s = open_vcf(spark, vcf(text, newline="\r\n"))
    r = s.variants().first()
    assert r["id"] == "rs1" and r["qual"] == 9.5
    assert [g["gq"] for g in r["genotypes"]] == [7, 9, 3]
    assert r["raw_len"] == len(tsv(("chr1", 5, "rs1", "A", "G", 9.5, "PASS", "DP=3", "GT:GQ", "0/1:7",
                                    "1/1:9", "0|0:3"))) + 1  # the reader ends lines at CRLF; one newline byte


def test_read_failure_is_ioerror_naming_the_source(spark, monkeypatch):
    from genolake.sources import vcf_text

    class Boom:
        def text(self, paths):
            raise RuntimeError("connection reset")

    class FakeSpark:
        read = Boom()

    with pytest.raises(IOError, match="https://example.com/x.vcf"):
        vcf_text.read_lines(FakeSpark(), "https://example.com/x.vcf")


def test_info_end_extends_the_span(spark, vcf):
    text = HEADER + "\n" + tsv(("chr1", 100, ".", "N", "<DEL>", 9, "PASS", "END=5000;SVLEN=-4900"),
                               ("chr1", 200, ".", "A", "G", 9, "PASS", "."))
    s = open_vcf(spark, vcf(text))
    assert s.variants("chr1:4000-4500").count() == 0
    assert s.variants("chr1:4000-4500", use_info_end=True).count() == 1
