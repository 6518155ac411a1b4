"""Projection and renaming of record fields: Columns over ``map<tag, array<map<subfield, text>>>``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.functions.columns import last_of_each

Hook = Callable[[Column], Column]

_OCC = "map<string,string>"


def occurrences(record: Column | str, tag: str) -> Column:
    """All occurrences of a tag, given as ``v10``, ``v010`` or ``10``; null if it is absent."""
    record = F.col(record) if isinstance(record, str) else record
    number = tag.removeprefix("v")
    return F.coalesce(F.try_element_at(record, F.lit("v" + number.zfill(3))), F.try_element_at(record, F.lit("v" + number.lstrip("0"))))


def renamed(occ: Column, names: Mapping[str, str] | None) -> Column:
    """One occurrence with its subfields named; codes without a name stay, of equal names the last wins."""
    if not names:
        return occ
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    entries = F.transform(F.map_entries(occ), lambda e: F.struct(F.coalesce(F.try_element_at(table, e["key"]), e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(last_of_each(entries, lambda e: e["key"]))


def field(
    record: Column | str,
    tag: str,
    subfields: Mapping[str, str] | None = None,
    single: bool = False,
    simple: bool = False,
    multi_val_tags: frozenset[str] | set[str] = frozenset(),
) -> Column:
    """Content of a tag in one of four shapes.

    single and simple: the first occurrence's own text; single: the first occurrence as a (renamed) map, empty if
    absent; simple: the texts of all, none at all if one lacks its own text; neither: all as maps. Tags in
    ``multi_val_tags`` are never single, and with ``subfields`` nothing is simple.
    """
    single = single and tag not in multi_val_tags
    simple = simple and not subfields
    occs = occurrences(record, tag)
    if single and simple:
        return F.try_element_at(F.try_element_at(occs, F.lit(1)), F.lit("_"))
    if single:
        return F.coalesce(renamed(F.try_element_at(occs, F.lit(1)), subfields), F.create_map().cast(_OCC))
    if simple:
        texts = F.transform(occs, lambda o: F.try_element_at(o, F.lit("_")))
        return F.when(F.exists(texts, lambda t: t.isNull()), F.array().cast("array<string>")).otherwise(F.coalesce(texts, F.array().cast("array<string>")))
    return F.coalesce(F.transform(occs, lambda o: renamed(o, subfields)), F.array().cast(f"array<{_OCC}>"))


def raw_field(record: Column | str, tag: str, subfields: Mapping[str, str] | None = None, single: bool = False, fix: Hook | None = None) -> Column:
    """As field(), but without names (or with ``_`` alone) each occurrence is its first subfield's value; ``fix`` cleans every value."""
    occs = occurrences(record, tag)
    clean = fix or (lambda v: v)
    if not subfields or set(subfields) == {"_"}:
        values = F.transform(occs, lambda o: clean(F.map_values(o)[0]))
        return F.try_element_at(values, F.lit(1)) if single else F.coalesce(values, F.array().cast("array<string>"))
    values = F.transform(occs, lambda o: F.transform_values(renamed(o, subfields), lambda k, v: clean(v)))
    return F.try_element_at(values, F.lit(1)) if single else F.coalesce(values, F.array().cast(f"array<{_OCC}>"))


def named_field(record: Column | str, tag: str, name: str | None = None, **how) -> Column:
    return field(record, tag, **how).alias(name or tag)


def record_type(record: Column | str) -> Column:
    return field(record, "v706", single=True, simple=True)


def full_record(record: Column | str, dictionary: Mapping[str, Mapping] | None = None) -> Column:
    """(name, content as JSON) of every tag present: dictionary fields by name and shape, others as lists of maps by tag."""
    record = F.col(record) if isinstance(record, str) else record
    known = {d["tag"]: (name, d) for name, d in (dictionary or {}).items()}
    out = F.transform(
        F.array_sort(F.map_keys(record)),
        lambda tag: F.struct(_name_of(tag, {t: n for t, (n, _) in known.items()}).alias("name"), F.to_json(F.try_element_at(record, tag)).alias("content")),
    )
    return out


def _name_of(tag: Column, names: Mapping[str, str]) -> Column:
    if not names:
        return tag
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), tag), tag)


def projection(record: Column | str, dictionary: Mapping[str, Mapping]) -> list[Column]:
    """One Column for each field of a data dictionary; ``v000`` stands for no tag at all."""
    if not dictionary:
        raise ValueError("the data dictionary has no fields")
    out = []
    for name, d in dictionary.items():
        if d["tag"] == "v000":
            out.append(F.lit(None).cast("string").alias(name))
        else:
            out.append(field(record, d["tag"], d.get("subfields"), single=not d.get("is_multi_val"), simple=not d.get("is_composite")).alias(name))
    return out
