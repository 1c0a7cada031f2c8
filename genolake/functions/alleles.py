"""Allele and genotype rules as column expressions (T5, A6, A7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed class names used in outputs.
SNV, MNV, INS, DEL, SYMBOLIC = "SNV", "MNV", "INS", "DEL", "SYMBOLIC"
HOM_REF, HET, HOM_ALT, MISSING_GT = "hom_ref", "het", "hom_alt", "missing"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def is_symbolic(alt: Column | str) -> Column:
    """``<DEL>``, ``*``, breakends and other non-sequence alleles."""
    return ~_c(alt).rlike(r"^[ACGTNacgtn]+$")


def allele_class(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    r, a = _c(ref), _c(alt)
    lr, la = F.length(r), F.length(a)
    return (F.when(is_symbolic(a), F.lit(SYMBOLIC))
            .when((lr == 1) & (la == 1), F.lit(SNV))
            .when(lr == la, F.lit(MNV))
            .when(lr < la, F.lit(INS))
            .otherwise(F.lit(DEL)))


def _same_start(a: Column, b: Column) -> Column:
    """Number of leading characters two texts share; linear in their length."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    return F.when(at > 0, at - 1).otherwise(F.least(F.length(a), F.length(b))).cast("int")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def normalize(pos: Column | str = "pos", ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """Parsimony trim: drop the shared suffix, then the shared prefix,
    always keeping one base; ``pos`` moves by the trimmed prefix.

    Returns struct<pos, ref, alt>.  Symbolic alleles are left as they are.
    Left-alignment needs the reference genome and is not done.
    """
    p, r, a = _c(pos), _c(ref), _c(alt)
    short = F.least(F.length(r), F.length(a))
    # Only alleles with both sides longer than one base can be trimmed; all
    # others (most SNVs and indels) pass through without string work.
    keep = is_symbolic(a) | (short < 2)

    def trimmed(t: Column) -> Column:
        pre, suf = t["pre"], t["suf"]
        return F.struct((p + pre).alias("pos"), F.substr(r, pre + 1, F.length(r) - suf - pre).alias("ref"),
                        F.substr(a, pre + 1, F.length(a) - suf - pre).alias("alt"))

    suffix = F.least(_same_start(F.reverse(r), F.reverse(a)), short - 1)
    both = _let(suffix, lambda suf: F.struct(
        F.least(_same_start(r, a), short - suf - 1).alias("pre"), suf.alias("suf")))
    return F.when(keep, F.struct(p.alias("pos"), r.alias("ref"), a.alias("alt"))).otherwise(_let(both, trimmed))


def gt_alleles(gt: Column | str = "gt") -> Column:
    return F.split(_c(gt), "[/|]")


def genotype_class(gt: Column | str = "gt") -> Column:
    """hom_ref / het / hom_alt / missing, blind to phasing and ploidy.

    Any ``.`` or empty allele (or no GT) -> missing; all alleles ``0`` ->
    hom_ref; all alleles the same non-zero number -> hom_alt; otherwise het.
    Regular expressions with literal patterns (compiled once, code-generated);
    the hom_alt test uses a back-reference to the first allele.
    """
    g = _c(gt)
    return (F.when(g.isNull() | g.rlike(r"(^|[/|])\.?([/|]|$)"), F.lit(MISSING_GT))
            .when(g.rlike(r"^0+([/|]0+)*$"), F.lit(HOM_REF))
            .when(g.rlike(r"^0*([1-9][0-9]*)([/|]0*\1)*$"), F.lit(HOM_ALT))
            .otherwise(F.lit(HET)))
