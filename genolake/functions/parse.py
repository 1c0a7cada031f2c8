"""VCF record parsing as Spark column expressions (no UDF).

All expressions take the record line in column ``value``.  Fixed fields
(CHROM..INFO) are cut from the first eight tab-separated fields only
(``substring_index`` before ``split``), so queries that never touch
genotypes never split the per-sample fields.  Casts are ``try_cast`` so a bad
value becomes null and is listed in ``_bad`` instead of failing the job
(ANSI mode is on by default in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "."


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_fields(value: Column | str = "value") -> Column:
    """Array of the first eight fields (CHROM..INFO)."""
    return F.split(F.substring_index(_c(value), "\t", 8), "\t")


def all_fields(value: Column | str = "value") -> Column:
    return F.split(_c(value), "\t")


def sample_count(value: Column | str = "value") -> Column:
    """Number of sample columns of a record line (tabs beyond the eighth);
    no split, no per-sample work."""
    v = _c(value)
    return F.greatest(F.length(v) - F.length(F.replace(v, F.lit("\t"), F.lit(""))) - 8, F.lit(0)).cast("int")


def missing_to_null(c: Column) -> Column:
    return F.when(c != MISSING, c)


def list_field(c: Column, sep: str = ",") -> Column:
    """``.`` or null -> empty array, else the split list."""
    return F.when(c.isNull() | (c == MISSING), F.array().cast("array<string>")).otherwise(F.split(c, sep))


def _after_eq(item: Column) -> Column:
    """Value part of ``KEY=VALUE``; null for a flag (no ``=``)."""
    return F.when(F.instr(item, "=") > 0, F.regexp_extract(item, r"^[^=]*=(.*)$", 1))


def field_at(value: Column | str, i: int) -> Column:
    """The i-th (0-based) tab-separated field, cut with ``substring_index``
    (no array is built; cheapest for CHROM and POS)."""
    v = _c(value)
    return F.substring_index(F.substring_index(v, "\t", i + 1), "\t", -1) if i else F.substring_index(v, "\t", 1)


def info_keys(info: Column) -> Column:
    """Keys of an INFO text in order (values cut out, then split; no lambda)."""
    return F.split(F.regexp_replace(info, "=[^;]*", ""), ";")


def info_value(info: Column, key: str) -> Column:
    """Value text of one INFO key (first occurrence); null if the key is
    absent or a flag.  Read straight from the text, no map is built."""
    text, named = F.concat(F.lit(";"), info), f";{key}="
    at = F.instr(text, named)
    return F.when(at > 0, F.substring_index(F.substr(text, at + len(named), F.lit(1 << 30)), ";", 1))


def info_map(info: Column) -> Column:
    """INFO text -> map<string,string>; flags map to null, ``.`` -> empty map.

    ``str_to_map`` throws on a repeated key, so only records that repeat a
    key take the first-wins path (lambda based, quadratic in that record's
    keys); the test for repeats is lambda-free.
    """
    items = F.split(info, ";")
    keys = info_keys(info)
    dkeys = F.array_distinct(keys)
    first_wins = F.map_from_arrays(
        dkeys,
        F.transform(dkeys, lambda k: _after_eq(
            F.get(F.filter(items, lambda x: F.substring_index(x, "=", 1) == k), 0))))
    return (F.when(info.isNull() | (info == MISSING) | (info == ""),
                   F.create_map().cast("map<string,string>"))
            .when(F.size(dkeys) < F.size(keys), first_wins)
            .otherwise(F.str_to_map(info, F.lit(";"), F.lit("="))))


# Fixed forms of numbers in a VCF (the specification's grammar, a trailing point allowed as C readers allow it).
FLOAT_TEXT = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$|^[-+]?(?i:inf|infinity|nan)$"
INTEGER_TEXT = r"^[-+]?[0-9]+$"
#: What a cast would take beyond them: Java's suffixes and hexadecimals, and blanks around a number.
_FOREIGN = r"[dDfFxX\s]"


def number(text: Column, sql_type: str) -> Column:
    """A number as a VCF writes it; anything else (``1d``, ``0.1f``, blanks around it) is null."""
    if sql_type not in ("double", "float", "int", "bigint", "long"):
        return text.try_cast(sql_type)
    form = FLOAT_TEXT if sql_type in ("double", "float") else INTEGER_TEXT
    return F.when(text.rlike(form), text.try_cast(sql_type))


def typed_list(text: Column, sql_type: str) -> Column:
    """Comma list -> array of ``sql_type``; ``.`` (or bad) items become null;
    null stays null.  Element-wise array ``try_cast`` (codegen, no lambda); only
    a list with letters that a cast would take but a VCF does not know is
    looked at item by item."""
    items = F.split(text, ",")
    cast = items.try_cast(f"array<{sql_type}>")
    if sql_type == "string":
        return cast
    return F.when(text.rlike(_FOREIGN), F.transform(items, lambda x: number(x, sql_type))).otherwise(cast)


def bad_list_items(text: Column, sql_type: str) -> Column:
    """True if some non-missing item of a comma list does not cast."""
    return F.coalesce(F.size(F.array_remove(F.split(text, ","), MISSING))
                      != F.size(F.array_compact(typed_list(text, sql_type))), F.lit(False))


def format_index(fkeys: Column, key: str) -> Column:
    """0-based position of ``key`` in the FORMAT keys, -1 if absent."""
    return F.array_position(fkeys, key).cast("int") - 1


def sample_value(parts: Column, idx: Column) -> Column:
    """Subfield ``idx`` of one sample's ``:``-split parts; ``.``/absent -> null."""
    return missing_to_null(F.get(parts, idx))


def genotype_structs(sample_parts: Column, gt_i: Column, gq_i: Column, pl_i: Column) -> Column:
    """Per-sample parts (array of ``split(sample, ':')``) -> array<struct<
    sample_idx, gt, gq, pl, bad>>.  Indices come from this record's FORMAT
    (any key order); trailing keys dropped by a sample give null."""
    def one(p, i):
        gq = sample_value(p, gq_i)
        pl = sample_value(p, pl_i)
        return F.struct(
            i.alias("sample_idx"),
            sample_value(p, gt_i).alias("gt"),
            number(gq, "int").alias("gq"),
            typed_list(pl, "int").alias("pl"),
            ((gq.isNotNull() & number(gq, "int").isNull())
             | (pl.isNotNull() & bad_list_items(pl, "int"))).alias("bad"))

    return F.transform(sample_parts, one)


# VCF header Type -> Spark type (fixed mapping of the VCF specification's types).
INFO_TYPES = {"Integer": "int", "Float": "double", "Flag": "boolean", "String": "string", "Character": "string"}


def info_flag(info: Column, key: str) -> Column:
    """True when the key is present (as a flag or with a value)."""
    text = F.concat(F.lit(";"), info, F.lit(";"))
    return F.coalesce(F.contains(text, F.lit(f";{key};")) | F.contains(text, F.lit(f";{key}=")), F.lit(False))


def typed_info(info: Column, definitions: dict[str, dict[str, str]]) -> Column:
    """struct with one typed field per declared INFO key: Flag -> boolean,
    Number=1 -> scalar, any other Number (A, R, G, ., n>1) -> array; values
    that do not parse are null (``_bad`` / ``info_violations`` report them).
    Each field is read straight from the text, no map is built."""
    fields = []
    for key, d in definitions.items():
        t = INFO_TYPES.get(d.get("Type", "String"), "string")
        if t == "boolean":
            col = info_flag(info, key)
        elif d.get("Number") == "1":
            col = number(missing_to_null(info_value(info, key)), t)
        else:
            col = typed_list(info_value(info, key), t)
        fields.append(col.alias(key))
    return F.struct(*fields) if fields else F.lit(None).cast("struct<>")
