import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from genolake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="genolake-test-ck-")
    s = build_session(master="local[*]", shuffle_partitions=8, driver_memory="8g",
                      extra={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


@pytest.fixture()
def vcf(tmp_path):
    """Write a VCF text file and return its path."""
    def write(text: str, name: str = "t.vcf", newline: str = "\n") -> str:
        p = tmp_path / name
        body = text.strip("\n").replace("\n", newline) + newline
        p.write_bytes(body.encode())
        return str(p)
    return write


HEADER = """##fileformat=VCFv4.2
##contig=<ID=chr1,length=1000000>
##contig=<ID=chr2,length=1000000>
##contig=<ID=chr10,length=1000000>
##INFO=<ID=AF,Number=A,Type=Float,Description="Allele Frequency, per ALT">
##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">
##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype Quality">
##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Phred likelihoods">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNA1\tNA2\tNA3"""


def tsv(*rows):
    return "\n".join("\t".join(str(x) for x in r) for r in rows)
