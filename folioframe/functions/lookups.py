"""Code tables: article types, contributor roles, countries, and code pairs from files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Article types by code; codes whose type is the code itself need no entry.
ARTICLE_TYPES = {
    "ab": "abstract",
    "an": "announcement",
    "co": "article-commentary",
    "cr": "case-report",
    "ed": "editorial",
    "er": "correction",
    "in": "interview",
    "le": "letter",
    "oa": "research-article",
    "pr": "in-brief",
    "ra": "review-article",
    "rc": "book-review",
    "re": "retraction",
    "rn": "brief-report",
    "sc": "rapid-communication",
    "zz": "other",
}

# Contributor types by role; an unknown role is an author.
CONTRIB_TYPES = {
    "nd": "author",
    "ed": "editor",
    "ND": "author",
    "ED": "editor",
    "assignee": "assignee",
    "compiler": "compiler",
    "director": "director",
    "guest-editor": "guest-editor",
    "inventor": "inventor",
    "tr": "translator",
    "TR": "translator",
}


def literal_map(table: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def article_type(code: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(ARTICLE_TYPES), code), code)


def contrib_type(role: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(CONTRIB_TYPES), role), F.lit("author"))


def with_country(df: DataFrame, countries: DataFrame, code: str, lang: str | None = None) -> DataFrame:
    """Adds ``country_name`` and ``country_code`` by a table (alpha_2_code, short_name_en, short_name_pt, short_name_es).

    The table may be looked up by alpha-2 code or by any short name; without a language, the first of the English,
    Portuguese and Spanish names that there is.
    """
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    name = filled(f"short_name_{lang}") if lang else F.coalesce(filled("short_name_en"), filled("short_name_pt"), filled("short_name_es"))
    keys = countries.select(
        F.explode(F.array_distinct(F.array("alpha_2_code", "short_name_en", "short_name_pt", "short_name_es"))).alias("_key"),
        name.alias("country_name"),
        F.col("alpha_2_code").alias("country_code"),
    ).filter("_key <> ''").dropDuplicates(["_key"])
    return df.join(keys, df[code] == keys["_key"], "left").drop("_key")


def attribute_value(attribute: str, code: Column) -> Column:
    """By the attribute's name: article-type or contrib-type."""
    return {"article-type": article_type, "contrib-type": contrib_type}[attribute](code)


class CodePairs:
    """A table of (isis, sps) codes looked up either way; of equal codes the last row wins on the way back."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("isis", "sps")

    @classmethod
    def read_csv(cls, spark: SparkSession, path: str) -> CodePairs:
        return cls(spark.read.csv(path, header=True))

    @classmethod
    def read_json(cls, spark: SparkSession, path: str) -> CodePairs:
        """A JSON object {sps: isis}."""
        text = spark.read.text(path, wholetext=True)
        pairs = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("sps", "isis"))
        return cls(pairs)

    def write_csv(self, path: str) -> None:
        self.rows.write.mode("overwrite").csv(path, header=True)

    def sps(self, df: DataFrame, isis: str, out: str = "sps_value") -> DataFrame:
        return self._look(df, isis, "isis", "sps", out)

    def isis(self, df: DataFrame, sps: str, out: str = "isis_value") -> DataFrame:
        return self._look(df, sps, "sps", "isis", out)

    def _look(self, df: DataFrame, column: str, key: str, value: str, out: str) -> DataFrame:
        numbered = self.rows.withColumn("_n", F.monotonically_increasing_id())
        table = numbered.groupBy(F.col(key).alias("_key")).agg(F.max_by(value, "_n").alias(out))
        return df.join(table, df[column] == table["_key"], "left").drop("_key")
