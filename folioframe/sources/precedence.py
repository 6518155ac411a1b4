"""Which source of an issue's documents counts, for all issues of a site in one plan.

An issue's documents may lie in dumps of its own, in its part of the journal's dump, in its database's dump, or in the journal's dump under
its pid. Sources are rows of a table (issue, rank, dump, scope), the groups of all dumps are rows of another (of ``dump_index``, without their records),
and for each issue the groups of the lowest rank that has any count. Two equi-joins and a minimum by issue: no source is
tried in a loop, and a journal's dump is not compared with each of its issues.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.sources.scratch import stored

#: Sources in their order of preference, and the other order that is in use: what of the dump belongs to the issue is all of it, what has the issue's folder, or what has its pid.
RANKS = (("xml", "all"), ("journal", "folder"), ("base", "all"), ("journal", "pid"))
FILES_RANKS = (("xml", "all"), ("journal", "pid"), ("base", "all"), ("journal", "folder"))


def site_dump(path: Column) -> Column:
    """The dump that a file of a site belongs to, as ``xml/acronym/folder``, ``base/acronym/folder`` or ``journal/acronym``; null if to none.

    The site's layout: ``serial/<acronym>/<folder>/base_xml/id/*.id``, ``serial/<acronym>/<folder>/base/<folder>.id`` and ``bases-work/<acronym>/<acronym>.id``.
    """
    part = lambda pattern: F.regexp_extract_all(path, F.lit(pattern), F.lit(0))
    names = F.split(path, "/")
    at = lambda n: F.try_element_at(names, F.lit(n))  # noqa: E731  from the end
    xml = F.when(F.size(part(r"/base_xml/id/[^/]+\.id$")) > 0, F.concat_ws("/", F.lit("xml"), at(-5), at(-4)))
    base = F.when((at(-2) == "base") & (at(-1) == F.concat(at(-3), F.lit(".id"))), F.concat_ws("/", F.lit("base"), at(-4), at(-3)))
    journal = F.when(at(-1) == F.concat(at(-2), F.lit(".id")), F.concat_ws("/", F.lit("journal"), at(-2)))
    return F.coalesce(xml, base, journal)


def issue_sources(issues: DataFrame, ranks: Sequence[tuple[str, str]] = RANKS) -> DataFrame:
    """(acronym, folder, issue_pid, rank, dump, scope) of the issues (acronym, folder, issue_pid): where each one's documents may be."""
    rows = []
    for rank, (kind, scope) in enumerate(ranks):
        dump = F.concat_ws("/", F.lit(kind), "acronym", *([] if kind == "journal" else ["folder"]))
        key = {"all": F.lit("all"), "folder": F.concat(F.lit("folder "), "folder"), "pid": F.concat(F.lit("pid "), "issue_pid")}[scope]
        rows.append(F.struct(F.lit(rank).alias("rank"), dump.alias("dump"), key.alias("scope")))
    # an issue without a folder or a pid has no such scope
    return issues.select("acronym", "folder", "issue_pid", F.inline(F.array(*rows))).filter("dump IS NOT NULL AND scope IS NOT NULL")


def first_sources(groups: DataFrame, sources: DataFrame, issue: Sequence[str] = ("acronym", "folder", "issue_pid")) -> DataFrame:
    """The groups that count, with the issue's columns and the rank of their source.

    ``groups``: record groups with the columns dump, pid and folder, and any others; ``sources``: as of ``issue_sources``. A group of several
    issues comes out for each. An issue that no source has any group of is left out; nulls in dump match nothing, a group without a pid or a folder is in no such scope.
    Issues with equal names are one. Only keys are joined to find the ranks; the groups themselves are joined once, to the sources that won.
    """
    issue_of = F.when(F.length("pid") == 23, F.substring("pid", 2, 17)).otherwise(F.col("pid"))
    scopes = F.filter(F.array(F.lit("all"), F.concat(F.lit("folder "), F.col("folder")), F.concat(F.lit("pid "), issue_of)), lambda s: s.isNotNull())
    there = groups.filter("dump IS NOT NULL").select("dump", F.explode(scopes).alias("scope")).distinct()
    sources = stored(sources)
    best = sources.join(there, ["dump", "scope"], "left_semi").groupBy(*issue).agg(F.min("rank").alias("rank"))
    same = sources.alias("s").join(best.alias("b"), [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*issue, "rank"]], "left_semi")
    won = same.select(*issue, "rank", F.col("dump").alias("_dump"), "scope").distinct()
    taken = [c for c in groups.columns if c in won.columns]
    renamed = groups.withColumnsRenamed({c: f"group_{c}" for c in taken})
    scopes = F.filter(
        F.array(F.lit("all"), F.concat(F.lit("folder "), F.col("group_folder" if "folder" in taken else "folder")), F.concat(F.lit("pid "), issue_of)), lambda s: s.isNotNull()
    )
    out = renamed.select("*", F.explode(scopes).alias("_scope")).join(won, (F.col("dump") == F.col("_dump")) & (F.col("_scope") == F.col("scope")))
    return out.drop("_dump", "_scope", "scope")


def documents_by_issue(index, sources: DataFrame, dump: Column) -> DataFrame:
    """(path, grp, pid, records, issue columns, rank): documents of all issues, each from its first source, of an index (``dump_index.DumpIndex``); only their bytes are read.

    ``dump`` tells of an index row's path which dump it belongs to (``site_dump``).
    """
    rows = index.by("pid").withColumn("dump", dump)
    found = stored(first_sources(rows, sources).filter("kind = 'doc'").select("path", "grp", "start", "stop", "acronym", "folder", "issue_pid", "rank"))
    groups = index.groups(found.select("path", "grp", "start", "stop"))
    return groups.join(found.drop("start", "stop"), ["path", "grp"])
