"""Splitting multi-allelic records with all their per-allele values, and substitutions into single bases (T4, T5).

A header's ``Number`` says what a list counts: A one value per ALT, R one per
allele with REF first, G one per genotype.  On the row of allele ``i`` an A key
keeps its ``i``-th value, an R key the values of REF and ``i``, a G key those of
the genotypes made of REF and ``i``: with genotypes (j, k), j <= k, listed at
``k(k+1)/2 + j``, that is 0, ``i(i+1)/2`` and ``i(i+1)/2 + i``; for a haploid
call (one value per allele) 0 and ``i``.  Other keys pass unchanged.

All positions are integer expressions of the allele's number, so every value is
a plain ``get`` from an array; samples are exploded, not looped over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions.alleles import is_symbolic
from ..sources.vcf_text import VcfHeader

PER_ALLELE = ("A", "R", "G")


def genotype_count(n_alts: Column, ploidy: int = 2) -> Column:
    """Number of genotypes of ``n_alts + 1`` alleles."""
    return n_alts + 1 if ploidy == 1 else F.floor((n_alts + 1) * (n_alts + 2) / 2).cast("int")


def genotype_index(j: Column, k: Column) -> Column:
    """Place of the unordered genotype (j, k), j <= k, in a G list."""
    return F.floor(k * (k + 1) / 2).cast("int") + j


def allele_values(values: Column, number: str, idx: Column, n_alts: Column) -> Column:
    """The part of a per-allele list that belongs to ALT ``idx`` (from 1).

    A: one value; R: (REF, allele); G: three values of a diploid list, two of a
    haploid one.  A list of any other length than its Number asks for is null.
    """
    size = F.size(values)
    if number == "A":
        return F.when(size == n_alts, F.get(values, idx - 1))
    if number == "R":
        return F.when(size == n_alts + 1, F.array(F.get(values, F.lit(0)), F.get(values, idx)))
    hetero, homo = genotype_index(F.lit(0), idx), genotype_index(idx, idx)
    diploid = F.array(F.get(values, F.lit(0)), F.get(values, hetero), F.get(values, homo))
    haploid = F.array(F.get(values, F.lit(0)), F.get(values, idx))
    return F.when(size == genotype_count(n_alts), diploid).when(size == genotype_count(n_alts, 1), haploid)


def _typed(text: Column, definition: dict[str, str]) -> Column:
    t = P.INFO_TYPES.get(definition.get("Type", "String"), "string")
    return P.typed_list(text, t)


def _exploded(v: DataFrame, base: list[str]) -> DataFrame:
    """One row per ALT: ``_i`` from 1, ``alt``, ``_n`` alleles (see ``alleles.split_multiallelic`` on the outer form)."""
    return (v.select(*base, F.size("alts").alias("_n"), F.posexplode_outer("alts").alias("_p", "alt"))
            .where(F.col("alt").isNotNull()).withColumn("_i", F.col("_p") + 1).drop("_p"))


def split_fields(v: DataFrame, header: VcfHeader, keys: list[str] | None = None,
                 keep: tuple[str, ...] = ("chrom", "pos", "ref")) -> DataFrame:
    """One row per ALT with every declared INFO key cut to it: columns ``info_<key>``.

    ``keys`` limits the INFO keys (default: all the header declares).
    """
    keys = [k for k in (header.info if keys is None else keys) if k in header.info]
    # Texts are found and cast once a record, below the explode; an allele's row only picks from the lists.
    parsed, texts = [], [P.info_flag(F.col("info_text"), k) if header.info[k].get("Type") == "Flag" and
                         header.info[k].get("Number") not in PER_ALLELE else P.info_value(F.col("info_text"), k) for k in keys]
    read = v.select(*keep, "alts", *[t.alias(f"_k{i}") for i, t in enumerate(texts)])
    for i, k in enumerate(keys):
        d, text = header.info[k], F.col(f"_k{i}")
        if d.get("Number") in PER_ALLELE:
            col = _typed(text, d)
        elif d.get("Type") == "Flag":
            col = text
        elif d.get("Number") == "1":
            col = F.get(_typed(P.missing_to_null(text), d), F.lit(0))
        else:
            col = _typed(text, d)
        parsed.append(col.alias(f"_k{i}"))
    rows = _exploded(read.select(*keep, "alts", *parsed), [*keep, *[f"_k{i}" for i in range(len(keys))]])
    cols = [allele_values(F.col(f"_k{i}"), header.info[k]["Number"], F.col("_i"), F.col("_n"))
            if header.info[k].get("Number") in PER_ALLELE else F.col(f"_k{i}") for i, k in enumerate(keys)]
    return rows.select(*keep, "alt", F.col("_i").alias("allele_idx"), *[c.alias(f"info_{k}") for c, k in zip(cols, keys)])


def split_genotype(gt: Column, idx: Column) -> Column:
    """A call on the row of ALT ``idx``: REF stays 0, the allele becomes 1, another ALT ``.`` (it has its own row)."""
    def one(a: Column) -> Column:
        return F.when(a == idx.cast("string"), F.lit("1")).when(a == "0", F.lit("0")).otherwise(F.lit("."))

    parts = F.split(gt, "[/|]")
    sep = F.when(F.instr(gt, "|") > 0, F.lit("|")).otherwise(F.lit("/"))
    two = F.concat(one(F.get(parts, F.lit(0))), sep, one(F.get(parts, F.lit(1))))
    more = F.array_join(F.transform(parts, one), "/")  # three and more sets: rare, phases are not told apart
    return F.when(gt.isNull(), None).when(F.size(parts) == 1, one(F.get(parts, F.lit(0)))) \
        .when(F.size(parts) == 2, two).otherwise(more)


def split_sample_fields(v: DataFrame, header: VcfHeader, keys: list[str] | None = None,
                        keep: tuple[str, ...] = ("chrom", "pos", "ref")) -> DataFrame:
    """One row per (ALT, sample): ``gt`` told from this ALT, and a column ``fmt_<key>`` for every other FORMAT key.

    Per-allele lists (PL and the like) are cut as INFO's are; FORMAT positions
    are found once a record.
    """
    keys = [k for k in (header.format if keys is None else keys) if k in header.format and k != "GT"]
    fk = F.split(F.get(F.col("_f"), F.lit(8)), ":")
    base = v.select(*keep, "alts", P.all_fields("value").alias("_f"))
    base = base.select(*keep, "alts", P.format_index(fk, "GT").alias("_gt"),
                       *[P.format_index(fk, k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       F.slice(F.col("_f"), 10, F.greatest(F.size("_f") - 9, F.lit(0))).alias("_s"))
    places = ["_gt", *[f"_k{i}" for i in range(len(keys))]]
    rows = _exploded(base, [*keep, *places, "_s"])
    rows = rows.select(*keep, "alt", "_i", "_n", *places, F.posexplode("_s").alias("sample_idx", "_t"))
    parts = F.split(F.col("_t"), ":")
    cols = [split_genotype(P.sample_value(parts, F.col("_gt")), F.col("_i")).alias("gt")]
    for i, k in enumerate(keys):
        d, text = header.format[k], P.sample_value(parts, F.col(f"_k{i}"))
        if d.get("Number") in PER_ALLELE:
            col = allele_values(_typed(text, d), d["Number"], F.col("_i"), F.col("_n"))
        else:
            col = F.get(_typed(text, d), F.lit(0)) if d.get("Number") == "1" else _typed(text, d)
        cols.append(col.alias(f"fmt_{k}"))
    out = rows.select(*keep, "alt", F.col("_i").alias("allele_idx"), "sample_idx", *cols)
    return out.withColumn("sample", F.get(F.lit(list(header.samples)), F.col("sample_idx")))


def decompose_substitutions(alleles: DataFrame) -> DataFrame:
    """Alleles of equal length over one base become a row for each base that differs.

    Adds ``event_id`` (chrom:pos:ref:alt of the allele, null for all other
    alleles, which pass unchanged), ``event_offset`` from its first base and
    ``event_parts``, the number of its rows.  An allele equal to REF has no
    differing base and passes unchanged.
    """
    sub = (F.length("ref") > 1) & (F.length("ref") == F.length("alt")) & (F.col("ref") != F.col("alt")) & ~is_symbolic("alt")
    offsets = F.filter(F.sequence(F.lit(0), F.length("ref") - 1),
                       lambda i: F.substr("ref", i + 1, F.lit(1)) != F.substr("alt", i + 1, F.lit(1)))
    x = alleles.withColumn("_o", F.when(sub, offsets).otherwise(F.array(F.lit(-1))))
    x = x.select("*", F.size("_o").alias("event_parts"), F.explode("_o").alias("event_offset")).drop("_o")
    part = F.col("event_offset") >= 0
    key = F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt")
    x = x.withColumn("event_id", F.when(part, key))
    base = lambda c: F.when(part, F.substr(c, F.col("event_offset") + 1, F.lit(1))).otherwise(F.col(c))
    return (x.withColumn("_ref", base("ref")).withColumn("_alt", base("alt"))
            .withColumn("pos", F.col("pos") + F.greatest("event_offset", F.lit(0)))
            .withColumn("ref", F.col("_ref")).withColumn("alt", F.col("_alt"))
            .withColumn("event_parts", F.when(part, F.col("event_parts")))
            .withColumn("event_offset", F.when(part, F.col("event_offset"))).drop("_ref", "_alt"))


def recompose_substitutions(parts: DataFrame, row: tuple[str, ...]) -> DataFrame:
    """The alleles that ``decompose_substitutions`` took apart; ``row`` names the columns that identify a record's allele.

    An event's rows (at most its length) meet under their record and event;
    the bases that do not differ come from the event's own name.
    """
    whole = parts.where("event_id IS NULL").drop("event_id", "event_offset", "event_parts")
    named = F.split("event_id", ":")
    at = lambda i: F.element_at(named, F.lit(i))
    events = (parts.where("event_id IS NOT NULL").groupBy(*row, "event_id")
              .agg(F.array_sort(F.collect_list(F.struct("event_offset", "alt"))).alias("_p"),
                   *[F.first(c).alias(c) for c in whole.columns if c not in (*row, "pos", "ref", "alt")]))
    ref = at(-2)
    base = F.transform(F.sequence(F.lit(0), F.length(ref) - 1), lambda i: F.coalesce(
        F.get(F.filter(F.col("_p"), lambda p: p["event_offset"] == i), F.lit(0))["alt"], F.substr(ref, i + 1, F.lit(1))))
    events = (events.withColumn("pos", at(-3).cast("long")).withColumn("ref", ref).withColumn("alt", F.array_join(base, "")))
    return whole.unionByName(events.select(*whole.columns))
