"""The file tree of a site: scans of translations, PDF, assets and XML of an issue, as tables of file items.

Every scan gives (type, path, name, key, extension, lang, part, relative_path, modified, size, content); a folder that
is missing gives an error row. Scans are unions of Spark's file reader, so a store that only Spark can read will do.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import text as tx

_COLUMNS = "type string, path string, name string, key string, extension string, lang string, part string, relative_path string, modified timestamp, size long, content binary, error string"


def scan(spark: SparkSession, paths: str | Sequence[str], kind: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Files of the folders, each path once, with their names taken apart."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = [_scan_one(spark, p, kind, glob, recursive) for p in paths]
    found = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _COLUMNS)
    return found.dropDuplicates(["path", "error"])


def _scan_one(spark: SparkSession, path: str, kind: str, glob: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    null = lambda t="string": F.lit(None).cast(t)
    try:
        files = reader.load(path)
    except AnalysisException as e:
        row = spark.range(1)
        return row.select(F.lit(kind).alias("type"), F.lit(path).alias("path"), *[null(t).alias(c) for c, t in (x.split() for x in _COLUMNS.split(", ")[2:-1])], F.lit(e.getCondition() or "error").alias("error"))
    name = tx.base_name(F.col("path"))
    return files.select(
        F.lit(kind).alias("type"),
        "path",
        name.alias("name"),
        tx.stem(F.col("path")).alias("key"),
        tx.extension(F.col("path")).alias("extension"),
        null().alias("lang"),
        null().alias("part"),
        tx.relative_path(F.col("path"), keep_root=True, roots=("bases-work", "bases", "htdocs")).alias("relative_path"),
        F.col("modificationTime").cast("timestamp").alias("modified"),
        F.col("length").cast("long").alias("size"),
        "content",
        null().alias("error"),
    )


def _language(name: Column) -> Column:
    """``xx`` of ``xx_name``."""
    return F.when(F.substring(name, 3, 1) == "_", F.substring(name, 1, 2))


def translations(spark: SparkSession, folder: str) -> DataFrame:
    """``xx_name`` holds what stands before the references in language xx, ``xx_bname`` what stands after; contents are decoded and repaired."""
    rows = scan(spark, folder, "html", "*.htm*")
    rest = F.substr("key", F.lit(4))
    after = rest.startswith("b")
    rows = rows.withColumn("lang", _language(F.col("name"))).withColumn("part", F.when(F.col("lang").isNotNull(), F.when(after, "after").otherwise("before")))
    rows = rows.withColumn("key", F.when(F.col("lang").isNull(), F.col("key")).when(after, F.substr("key", F.lit(5))).otherwise(rest))
    return rows.withColumn("html", tx.repair(decoded(F.col("content"))))


def decoded(content: Column) -> Column:
    """UTF-8 if the bytes are that, else ISO-8859-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def pdfs(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(spark, folder, "pdf", "*.pdf")
    return rows.withColumn("lang", _language(F.col("name"))).withColumn("key", F.when(F.col("lang").isNotNull(), F.substr("key", F.lit(4))).otherwise(F.col("key")))


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """The folder and its subfolders, HTML pages marked as such."""
    rows = scan(spark, folder, "asset", recursive=True)
    return rows.withColumn("type", F.when(F.lower("extension").isin(".html", ".htm"), "html").otherwise(F.col("type")))


def xmls(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "xml", "*.xml")


class IssueFolder:
    """All files of an issue: (acronym, issue folder) below the site's roots."""

    def __init__(self, spark: SparkSession, bases: str, htdocs: str, acronym: str, folder: str):
        self.spark, self.bases, self.htdocs, self.where = spark, bases, htdocs, f"{acronym}/{folder}"

    def translations(self) -> DataFrame:
        return translations(self.spark, f"{self.bases}/translation/{self.where}")

    def pdfs(self) -> DataFrame:
        return pdfs(self.spark, f"{self.bases}/pdf/{self.where}")

    def assets(self) -> DataFrame:
        return assets(self.spark, f"{self.htdocs}/img/revistas/{self.where}")

    def xmls(self) -> DataFrame:
        return xmls(self.spark, f"{self.bases}/xml/{self.where}")

    def files(self) -> DataFrame:
        parts = [self.translations().drop("html"), self.pdfs(), self.assets(), self.xmls()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class SitePaths:
    """Where a site keeps its databases, and the sources of a journal's documents in their order of preference."""

    def __init__(self, bases: str, bases_work: str, serial: str):
        self.bases, self.bases_work, self.serial = bases, bases_work, serial

    def document_sources(self, acronym: str, issue_folder: str | None = None, whole_journal: bool = True, order: Sequence[str] | None = None) -> list[str]:
        """Path patterns, the first that has rows counts: of an issue, its own dumps, its part of the journal's, its database; then the journal's.

        ``order`` names the sources otherwise, such as ``FILES_ORDER``. Databases themselves are not decoded: their text dumps stand beside them.
        """
        issue, work = f"{self.serial}/{acronym}/{issue_folder}", f"{self.bases_work}/{acronym}"
        patterns = {
            "xml": [f"{issue}/base_xml/id/i.id", f"{issue}/base_xml/id/*.id"],
            "subset": [f"{work}/{acronym}_{issue_folder}.id"],
            "base": [f"{issue}/base/{issue_folder}.id"],
            "journal": [f"{work}/{acronym}.id"],
        }
        names = order or ["xml", "subset", "base", "journal"]
        own = {"xml", "subset", "base"} if issue_folder else set()
        return [p for name in names if name in own or name == "journal" and whole_journal for p in patterns[name]]

    def paragraphs(self, pid: str) -> list[str]:
        """The dump of a document's paragraphs, in the work area first."""
        if len(pid) != 23:
            raise ValueError(f"a pid has 23 characters: {pid!r}")
        path = f"artigo/p/{pid[1:10]}/{pid[10:14]}/{pid[14:18]}/{pid[-5:]}.id"
        return [f"{self.bases_work}/{path}", f"{self.bases}/{path}"]


#: The other order of preference: the journal's dump before the issue's database.
FILES_ORDER = ("xml", "journal", "base", "subset")


def read_first(spark: SparkSession, patterns: Sequence[str], kind: str = "artigo") -> DataFrame:
    """Groups of the first source that has any; none gives an empty table."""
    from folioframe.sources.isis import read_isis

    for pattern in patterns:
        try:
            found = read_isis(spark, pattern, kind)
        except AnalysisException:
            continue
        if not found.isEmpty():
            return found
    return read_isis(spark, None, kind)


def alternative_assets(spark: SparkSession, root: str, acronym: str, folder: str) -> DataFrame:
    """Assets of an issue anywhere below a folder ``fbpe`` under the root; a root without any gives none."""
    found = assets(spark, root).filter("error IS NULL")
    return found.filter(F.col("path").rlike(rf"/fbpe/(?:.*/)?\Q{acronym}\E/\Q{folder}\E/"))


def documents_of_issue(groups: DataFrame, issue_pid: str) -> DataFrame:
    return groups.filter(F.col("pid").contains(issue_pid))


def link_fixes(html: DataFrame, files: DataFrame) -> DataFrame:
    """(path, old, new): links of pages that name a file of the scan, and the file's path below its root."""
    found = html.select("path", F.explode(tx.links(F.col("html"))).alias("l")).select("path", F.col("l.link").alias("old")).filter("old NOT LIKE '%:%' AND old <> ''").distinct()
    named = files.filter("path IS NOT NULL AND error IS NULL").select("name", F.col("relative_path").alias("new")).dropDuplicates(["name"])
    return found.withColumn("name", tx.base_name(F.regexp_replace("old", "[?#].*$", ""))).join(named, "name").select("path", "old", "new")


def embedding_closure(pages: DataFrame) -> DataFrame:
    """(page, embedded, depth): local pages that each page reaches by links (page, linked), with the fewest links between them; cycles end where they close.

    A round joins the pairs found last to the links and keeps those that are new, so it ends after the longest of the shortest ways.
    """
    links = _cut(pages.select("page", "linked").filter("page IS NOT NULL AND linked IS NOT NULL").distinct())
    found = links.select("page", F.col("linked").alias("embedded"), F.lit(1).alias("depth"))
    last, depth = found, 1
    while True:
        depth += 1
        ahead = last.select("page", F.col("embedded").alias("via")).join(links.select(F.col("page").alias("via"), F.col("linked").alias("embedded")), "via")
        new = ahead.filter("page <> embedded").select("page", "embedded").distinct().join(found, ["page", "embedded"], "left_anti")
        last = _cut(new.withColumn("depth", F.lit(depth)))
        if last.isEmpty():
            return found
        found = _cut(found.unionByName(last))


def _cut(df: DataFrame) -> DataFrame:
    """The same rows from the checkpoint folder that the executors share."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="folioframe-"))
    return df.checkpoint()


@F.udtf(returnType="member: string, size: bigint")
class ZipMembers:
    """Names and sizes of a zip archive's members, from its bytes."""

    def eval(self, content: bytes):
        import io
        import zipfile

        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    yield info.filename, info.file_size
        except zipfile.BadZipFile:
            return


@F.udtf(returnType="member: string, content: binary")
class ZipContents:
    """Contents of a zip archive's members, from its bytes; all, or those of one name. One that can't be read is null."""

    def eval(self, content: bytes, name: str = None):
        import io
        import zipfile

        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.namelist():
                    if name is None or member == name:
                        try:
                            yield member, archive.read(member)
                        except (zipfile.BadZipFile, NotImplementedError, RuntimeError):
                            yield member, None
        except zipfile.BadZipFile:
            return
