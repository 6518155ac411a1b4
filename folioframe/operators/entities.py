"""Journals, issues, documents, citations and paragraphs as typed views of records, and what derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions import text as tx
from folioframe.functions.columns import last_of_each, let
from folioframe.functions.fields import field, raw_field, record_type
from folioframe.operators import catalogue_fields as catalogue
from folioframe.sources.isis import RECORD_TYPE, issue_order

_MAPS = "array<map<string,string>>"


def _columns(listed: str, record: Column | str, read=field) -> list[Column]:
    out = []
    for line in listed.split("\n"):
        if not line:
            continue
        name, tag, how, *codes = line.split()
        names = dict(pair.split("=") for pair in codes[0].split(",")) if codes else None
        if read is raw_field:
            out.append(raw_field(record, f"v{tag}", names, single=how == "1").alias(name))
        else:
            out.append(field(record, f"v{tag}", names, single=how == "1", simple=not names).alias(name))
    return out


def filled(c: Column | str) -> Column:
    """Null for empty text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def _get(c: Column | str, key: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(c, F.lit(key))


def last_by(items: Column, key: str, value: str) -> Column:
    """A map from key to value of maps that have both; the last of equal keys wins."""
    ok = F.filter(items, lambda x: (F.coalesce(_get(x, key), F.lit("")) != "") & (F.coalesce(_get(x, value), F.lit("")) != ""))
    last = last_of_each(ok, lambda x: _get(x, key))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(_get(x, key).alias("key"), _get(x, value).alias("value"))))


# ---- grouping and typing -----------------------------------------------------------------------

TYPES = ("o", "h", "f", "l", "c", "p")


def typed_records(groups: DataFrame) -> DataFrame:
    """(path, grp, pid, n, rec_type, record): the known records of each group, in order; others are dropped."""
    each = groups.select("path", "grp", "pid", F.posexplode("records").alias("n", "record"))
    return each.withColumn("rec_type", record_type("record")).filter(F.col("rec_type").isin(*TYPES))


def record_stats(typed: DataFrame) -> DataFrame:
    return typed.groupBy("path", "grp", "pid", "rec_type").agg(F.count("*").alias("n"))


def of_type(records: Column, kind: str) -> Column:
    return F.filter(records, lambda r: record_type(r) == kind)


# ---- journals ----------------------------------------------------------------------------------


def journals(records: DataFrame, record: str = "record") -> DataFrame:
    """One row for each journal record with its fields and what derives from them."""
    rows = records.select("*", *_columns(catalogue.JOURNAL, record))
    by_type = lambda kind: _get(F.try_element_at(F.filter("issns", lambda x: _get(x, "type") == kind), F.lit(1)), "value")
    pair = F.array(F.create_map(F.lit("value"), F.col("current_issn"), F.lit("type"), F.col("issn_type")))
    rows = rows.withColumn("issns", F.when(F.size("typed_issns") > 0, F.col("typed_issns")).when(F.col("current_issn").isNotNull(), pair).otherwise(F.array().cast(_MAPS)))
    history = status_history("status_history")
    rows = rows.withColumn("print_issn", by_type("PRINT")).withColumn("electronic_issn", by_type("ONLIN")).withColumn("status_events", history)
    return (
        rows.withColumn("unpublish_reason", unpublish_reason(F.col("status_events")))
        .withColumn("publisher_names", F.array_join("publisher_name", "; "))
        .withColumn("publisher_loc", F.concat_ws(", ", filled("publisher_city"), filled("publisher_state")))
        .withColumn("mission", mission(F.col("mission_lines")))
    )


def status_history(items: Column | str) -> Column:
    """(date, status) of entries and of exits, without empty ones."""
    items = F.col(items) if isinstance(items, str) else items
    event = lambda x, way: F.struct(_get(x, f"{way}_date").alias("date"), _get(x, f"{way}_status").alias("status"))
    both = F.flatten(F.transform(items, lambda x: F.array(event(x, "in"), event(x, "out"))))
    return F.filter(both, lambda e: e["date"].isNotNull() & e["status"].isNotNull())


def unpublish_reason(events: Column) -> Column:
    """Status of the latest event, unless it is current."""
    last = F.element_at(F.array_sort(events), -1)
    return F.when(F.size(events) > 0, F.nullif(last["status"], F.lit("C")))


def mission(lines: Column) -> Column:
    """Text by language: lines up to the one that names a language are one text; lines after the last name go with it."""
    zero = F.struct(F.array().cast("array<struct<key:string,value:string>>").alias("done"), F.array().cast("array<string>").alias("open"))

    def step(acc: Column, x: Column) -> Column:
        lines_ = F.concat(acc["open"], F.array(F.coalesce(_get(x, "text"), F.lit(""))))
        named = F.concat(acc["done"], F.array(F.struct(_get(x, "language").alias("key"), F.array_join(lines_, "\n").alias("value"))))
        return F.when(_get(x, "language").isNotNull(), F.struct(named.alias("done"), F.array().cast("array<string>").alias("open"))).otherwise(F.struct(acc["done"].alias("done"), lines_.alias("open")))

    folded = F.aggregate(F.coalesce(lines, F.array().cast(_MAPS)), zero, step)

    def finish(f: Column) -> Column:
        last = F.element_at(f["done"], -1)
        more = F.concat(F.slice(f["done"], 1, F.greatest(F.size(f["done"]) - 1, F.lit(0))), F.array(F.struct(last["key"].alias("key"), F.concat_ws("\n", last["value"], F.array_join(f["open"], "\n")).alias("value"))))
        entries = F.when((F.size(f["open"]) > 0) & (F.size(f["done"]) > 0), more).otherwise(f["done"])
        return last_of_each(entries, lambda e: e["key"])

    return F.map_from_entries(let(folded, finish))


# ---- issues ------------------------------------------------------------------------------------


def issue_label(volume: Column, number: Column, suppl_volume: Column, suppl_number: Column, press: Column, year: Column) -> Column:
    """``v1n2s3pr``; issues called ahead or review are year, ``n``, their name and ``pr``."""
    pr = F.when(F.coalesce(press, F.lit("")) != "", "pr").otherwise("")
    part = lambda letter, c: F.concat(F.lit(letter), filled(c))
    plain = F.concat(F.concat_ws("", part("v", volume), part("n", number), part("s", F.coalesce(filled(suppl_volume), suppl_number))), pr)
    return F.when(number.isin("ahead", "review"), F.concat(F.coalesce(year, F.lit("")), F.lit("n"), number, pr)).otherwise(plain)


def issues(records: DataFrame, record: str = "record") -> DataFrame:
    rows = records.select("*", *_columns(catalogue.ISSUE, record))
    months = F.transform("bibliographic_strip", lambda x: _get(x, "months"))
    first = F.try_element_at(months, F.lit(1))
    year = F.substring("publication_date", 1, 4)
    return (
        rows.withColumn("publication_year", year)
        .withColumn("supplement", F.coalesce(filled("supplement_volume"), filled("supplement_number")))
        .withColumn("issue_order", issue_order(F.col("order")))
        .withColumn("pid", F.concat("journal", issue_order(F.col("order"))))
        .withColumn("issue_label", issue_label(F.col("volume"), F.col("number"), F.col("supplement_volume"), F.col("supplement_number"), F.col("is_press_release"), year))
        .withColumn("start_month_text", F.split(first, "/")[0])
        .withColumn("end_month_text", F.element_at(F.split(first, "/"), -1))
        .withColumn("license_by_language", last_by(F.col("license_texts"), "language", "html"))
    )


def issue_sections(issue_rows: DataFrame) -> DataFrame:
    """(pid, code, language, text): the sections of all issues."""
    each = issue_rows.select("pid", F.explode("sections").alias("s"))
    return each.select("pid", _get("s", "code").alias("code"), _get("s", "language").alias("language"), _get("s", "text").alias("text")).filter("code IS NOT NULL")


def sections_by_code(sections: DataFrame) -> DataFrame:
    return sections.groupBy("pid", "code").agg(F.map_from_entries(F.collect_list(F.struct("language", "text"))).alias("titles"))


# ---- documents ---------------------------------------------------------------------------------


def documents(groups: DataFrame) -> DataFrame:
    """One row for each document group: fields of its first ``f`` record, and its citations and paragraphs.

    ``groups`` has (path, grp, pid, records); its identity and order are kept.
    """
    empty = F.create_map().cast(RECORD_TYPE)
    base = groups.select(
        "path",
        "grp",
        "pid",
        F.coalesce(F.try_element_at(of_type(F.col("records"), "f"), F.lit(1)), empty).alias("h_record"),
        F.try_element_at(of_type(F.col("records"), "o"), F.lit(1)).alias("o_record"),
        of_type(F.col("records"), "c").alias("citations"),
        of_type(F.col("records"), "p").alias("p_records"),
    )
    rows = base.select("*", *_columns(catalogue.DOCUMENT, "h_record"))
    path = tx.windows_path(F.col("file_code"))
    titles, abstracts = F.col("article_titles"), F.col("abstracts")
    rest = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    return (
        rows.withColumn("processing_date", field("o_record", "v091", single=True, simple=True))
        .withColumn("supplement", F.coalesce(filled("vol_suppl"), filled("num_suppl")))
        .withColumn("pid_v1", F.when(F.length("pid_v1_raw") == 23, F.col("pid_v1_raw")))
        .withColumn("original_title", _get(F.try_element_at(titles, F.lit(1)), "text"))
        .withColumn("translated_titles", rest(titles))
        .withColumn("title_by_language", last_by(rest(titles), "language", "text"))
        .withColumn("original_abstract", _get(F.try_element_at(abstracts, F.lit(1)), "text"))
        .withColumn("translated_abstracts", rest(abstracts))
        .withColumn("abstract_by_language", last_by(rest(abstracts), "language", "text"))
        .withColumn("keyword_groups", keyword_groups(F.col("keywords")))
        .withColumn("issue_folder", issue_label(F.col("volume"), F.col("issue_number"), F.col("vol_suppl"), F.col("num_suppl"), F.col("is_press_release"), F.substring("issue_publication_date", 1, 4)))
        .withColumn("file_path", path)
        .withColumn("filename", tx.base_name(path))
        .withColumn("file_type", F.when(tx.extension(path) == ".xml", "xml").otherwise("html"))
        .withColumn("filename_without_extension", tx.stem(path))
        .withColumn("start_page", filled(_get("page", "start")))
        .withColumn("end_page", filled(_get("page", "end")))
        .withColumn("start_page_sequence", filled(_get("page", "sequence")))
        .withColumn("elocation", filled(_get("page", "elocation")))
        .withColumn("complete_publication_date", tx.complete_date([F.col("document_publication_date"), F.col("creation_date"), F.col("update_date"), F.col("issue_publication_date")]))
    )


def keyword_groups(keywords: Column) -> Column:
    """Keywords (with their subkeys) by language, in order; those without a language are dropped."""
    ok = F.filter(keywords, lambda k: F.coalesce(_get(k, "language"), F.lit("")) != "")

    def grouped(words: Column) -> Column:
        texts = lambda lang: F.transform(F.filter(words, lambda k: _get(k, "language") == lang), lambda k: F.concat_ws(", ", filled(_get(k, "text")), filled(_get(k, "subkey"))))
        return let(F.array_distinct(F.transform(words, lambda k: _get(k, "language"))), lambda langs: F.map_from_arrays(langs, F.transform(langs, texts)))

    return let(ok, grouped)


def authors_with_affiliations(docs: DataFrame) -> DataFrame:
    """(pid, n, author, affiliation): authors with the affiliations of their document that they refer to; nothing moves for it."""
    authors = docs.select("pid", "affiliations", F.posexplode("authors").alias("n", "author"))
    rids = F.filter(F.split(F.coalesce(_get("author", "xref"), F.lit("")), " "), lambda r: r != "")
    met = F.flatten(F.transform(rids, lambda r: F.filter("affiliations", lambda a: _get(a, "id") == r)))
    return authors.select("pid", "n", "author", F.explode(met).alias("affiliation"))


def with_section_titles(docs: DataFrame, by_code: DataFrame) -> DataFrame:
    """Adds ``section_titles`` (by language) of the document's section in its issue."""
    codes = by_code.withColumnRenamed("pid", "_issue").withColumnRenamed("titles", "section_titles")
    return docs.join(codes, (F.substring(docs["pid"], 2, 17) == codes["_issue"]) & (docs["section_code"] == codes["code"]), "left").drop("_issue", "code")


def license_texts(docs: DataFrame, issue_rows: DataFrame) -> DataFrame:
    """(pid, language, url, text): a document's licenses, or its issue's; with a code alone, one for each of en, es, pt."""
    url = lambda html: filled(F.regexp_extract(html, r'href="([^"]*)"', 1))
    own = docs.select("pid", F.explode("license_html").alias("l")).select("pid", _get("l", "language").alias("language"), url(_get("l", "html")).alias("url"), tx.collapse_space(F.regexp_replace(_get("l", "html"), "<[^>]*>", "")).alias("text"))
    coded = docs.filter("license_code IS NOT NULL AND size(license_html) = 0").select(
        "pid", F.explode(F.array(*[F.lit(x) for x in ("en", "es", "pt")])).alias("language"), F.concat(F.lit("https://creativecommons.org/licenses/"), F.lower("license_code"), F.lit("/4.0/")).alias("url"), F.lit(None).cast("string").alias("text")
    )
    article = own.filter("url IS NOT NULL").unionByName(coded)
    lacking = docs.select("pid", F.substring("pid", 2, 17).alias("issue_pid")).join(article.select("pid").distinct(), "pid", "left_anti")
    from_issue = issue_rows.filter("license_code IS NOT NULL").select(F.col("pid").alias("issue_pid"), "license_code", F.explode("license_by_language").alias("language", "html"))
    inherited = lacking.join(from_issue, "issue_pid").select("pid", "language", F.concat(F.lit("https://creativecommons.org/licenses/"), F.lower("license_code")).alias("url"), tx.collapse_space(F.regexp_replace("html", "<[^>]*>", "")).alias("text"))
    return article.unionByName(inherited)


def paragraphs(docs: DataFrame) -> DataFrame:
    """(pid, pos, text, reference_index) of all paragraph records."""
    each = docs.select("path", "grp", "pid", F.posexplode("p_records").alias("pos", "r"))
    f = lambda tag: field("r", tag, single=True, simple=True)
    return each.select("pid", "pos", f("v704").alias("text"), f("v888").alias("reference_index"))


# ---- citations ---------------------------------------------------------------------------------


def _formatted(x: Column) -> Column:
    return F.concat_ws(", ", filled(_get(x, "name")), filled(_get(x, "division")))


def _location(place: str, country: str) -> Column:
    return filled(F.concat_ws(", ", filled(_get(place, "city")), filled(_get(place, "state")), filled(country)))


def citations(docs: DataFrame) -> DataFrame:
    """One row for each citation record of each document, in source order, with fields and derived attributes."""
    each = docs.select("path", "grp", "pid", F.posexplode("citations").alias("n", "c_record"))
    return citation_attributes(each.select("*", *_columns(catalogue.CITATION, "c_record", raw_field)))


def citation_attributes(rows: DataFrame) -> DataFrame:
    has = lambda c: F.size(F.coalesce(F.col(c), F.create_map().cast("map<string,string>"))) > 0
    kind = F.coalesce(
        filled("publication_type_raw"),
        F.when(has("patent"), "patent").when(F.size("conferences") > 0, "confproc").when(filled("thesis_degree").isNotNull(), "thesis").when(has("monographic_title"), "book").when(has("article_title"), "journal").when(filled("ext_link").isNotNull(), "webpage"),
    )
    title = _get("article_title", "text")
    pages = F.try_element_at(F.col("pages"), F.lit(1))
    span = F.split(_get("pages_range", "range"), "-")
    date = F.coalesce(filled("publication_date_iso"), filled("conference_date_iso"), filled("thesis_date_iso"), filled(_get("patent", "date_iso")), filled("access_date_iso"))
    groups = lambda kind_: F.struct(F.col(f"{kind_}_person_authors").alias("person"), F.col(f"{kind_}_corporative_authors").alias("institution"))
    rows = rows.withColumn("publication_type", kind)
    rows = (
        rows.withColumn("source", F.coalesce(filled(_get("journal_title", "text")), filled(_get("monographic_title", "text"))))
        .withColumn("article_title_text", F.when(~F.col("publication_type").eqNullSafe(F.lit("book")), filled(title)))
        .withColumn("chapter_title", F.when(F.col("publication_type") == "book", filled(title)))
        .withColumn("data_title", F.when(F.col("publication_type") == "data", filled(title)))
        .withColumn("publication_date", date)
        .withColumn("start_page", F.coalesce(filled(_get(pages, "first")), filled(F.try_element_at(span, F.lit(1)))))
        .withColumn("end_page", F.coalesce(filled(_get(pages, "last")), F.when(F.size(span) > 1, filled(F.element_at(span, -1)))))
        .withColumn("elocation", F.coalesce(filled(_get("pages_range", "elocation")), filled(_get(pages, "elocation"))))
        .withColumn("page_range", F.coalesce(filled(_get("pages_range", "range")), filled(_get(pages, "range"))))
        .withColumn("issue_number", filled(_get("issue", "number")))
        .withColumn("supplement", filled(_get("issue", "suppl")))
        .withColumn("volume_text", F.coalesce(filled("volume"), filled("colvolid"), filled("tome")))
        .withColumn("serie", filled("coltitle"))
        .withColumn("comment", filled(F.array_join("notes", " | ")))
        .withColumn("patent_country", F.nullif(filled(_get("patent", "country")), F.lit("nd")))
        .withColumn("patent_id", filled(_get("patent", "id")))
        .withColumn("patent_organization", filled(_get("patent", "organization")))
        .withColumn("patent_application_date", filled(_get("patent", "date")))
        .withColumn("patent_application_date_iso", filled(_get("patent", "date_iso")))
        .withColumn("conference_name", filled(F.array_join(F.transform("conferences", lambda c: F.concat_ws(" ", filled(_get(c, "number")), filled(_get(c, "name")))), "; ")))
        .withColumn("conference_sponsor", F.when(F.col("publication_type") == "confproc", filled(_formatted(F.col("conference_organization")))))
        .withColumn("thesis_institution", filled(_formatted(F.col("thesis_organization"))))
        .withColumn("sponsor", filled(_formatted(F.col("project_sponsor"))))
        .withColumn("publisher_address", _location("publisher_location", "publisher_country"))
        .withColumn("analytic_institutions", F.transform("analytic_corporative_authors", _formatted))
        .withColumn("monographic_institutions", F.transform("monographic_corporative_authors", _formatted))
        .withColumn("editors", F.transform("serial_corporative_authors", _formatted))
        .withColumn("authors_groups", F.struct(groups("analytic").alias("analytic"), groups("monographic").alias("monographic")))
        .withColumn("ref_id", F.concat(F.lit("B"), F.col("index_number")))
    )
    own = F.concat(F.col("analytic_institutions"), F.col("monographic_institutions"), F.array(F.col("sponsor"), F.col("thesis_institution"), F.col("conference_sponsor")))
    first = F.coalesce(*[F.to_json(F.try_element_at(F.col(c), F.lit(1))) for c in ("analytic_person_authors", "monographic_person_authors", "analytic_corporative_authors", "monographic_corporative_authors")])
    return (
        rows.withColumn("institutions", F.filter(own, lambda x: F.coalesce(x, F.lit("")) != ""))
        .withColumn("first_author", first)
        .withColumn("authors", F.concat("analytic_person_authors", "monographic_person_authors"))
        .withColumn("iso_date", tx.iso_date(F.col("publication_date")))
    )


def merge_citations(cited: DataFrame, refs: DataFrame) -> DataFrame:
    """Citations whose reference (pid, ref_id) is in the document."""
    return cited.join(refs.select("pid", "ref_id").distinct(), ["pid", "ref_id"], "left_semi")


def first_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of equal keys: repeated ids, names and paths keep their first place."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("_k = 1").drop("_k")
