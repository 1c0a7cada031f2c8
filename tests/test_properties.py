"""Property tests: column expressions against plain-Python definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from genolake.functions.alleles import genotype_class
from genolake.operators import regions as R
from genolake.operators.alleles import normalize_alleles

BASES = st.text(alphabet="ACGT", min_size=1, max_size=8)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def py_normalize(pos, ref, alt):
    while len(ref) > 1 and len(alt) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


def py_gt_class(gt):
    if gt is None:
        return "missing"
    alleles = gt.replace("|", "/").split("/")
    if any(a in (".", "") for a in alleles):
        return "missing"
    vals = {int(a) for a in alleles}
    if vals == {0}:
        return "hom_ref"
    if len(vals) == 1:
        return "hom_alt"
    return "het"


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 10**6), BASES, BASES), min_size=1, max_size=30))
def test_normalize_property(spark, cases):
    df = spark.createDataFrame(cases, "pos long, ref string, alt string")
    got = sorted((r["orig_pos"], r["pos"], r["ref"], r["alt"]) for r in normalize_alleles(df).collect())
    want = sorted((p, *py_normalize(p, r, a)) for p, r, a in cases)
    assert got == want


ALLELE = st.sampled_from(["0", "1", "2", "10", "."])


@SETTINGS
@given(st.lists(st.lists(ALLELE, min_size=1, max_size=3).flatmap(
    lambda al: st.sampled_from(["/", "|"]).map(lambda sep: sep.join(al))), min_size=1, max_size=40))
def test_genotype_class_property(spark, gts):
    df = spark.createDataFrame([(g,) for g in gts], "gt string")
    got = [r[0] for r in df.select(genotype_class("gt")).collect()]
    assert got == [py_gt_class(g) for g in gts]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.integers(1, 3000), st.integers(1, 400)),
                min_size=1, max_size=40),
       st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.integers(1, 3000), st.integers(0, 900)),
                min_size=1, max_size=15),
       st.sampled_from([50, 1000]))
def test_binned_pairs_property(spark, vs, rs, width):
    v = spark.createDataFrame([(i, c, p, "A" * n) for i, (c, p, n) in enumerate(vs)],
                              "vid int, chrom string, pos long, ref string")
    r = spark.createDataFrame([(j, c, a, a + ln) for j, (c, a, ln) in enumerate(rs)],
                              "region_id int, chrom string, start long, end long")
    got = sorted((x["vid"], x["region_id"]) for x in
                 R.overlap_pairs(v, r, small_max=0, bin_width=width).collect())
    want = sorted((i, j) for i, (c, p, n) in enumerate(vs) for j, (rc, a, ln) in enumerate(rs)
                  if c == rc and p <= a + ln and p + n - 1 >= a)
    assert got == want
