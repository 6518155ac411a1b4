"""Plans: what must be pushed down, and what must not shuffle."""

import re

from folioframe.plans import catalogue


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_pruned(spark, sf):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(catalogue.queries()["page_count"](spark, sf)))
    assert read and set(read[0].replace(":", ",").split(",")) >= {"l_orderkey", "l_linenumber"} and "l_comment" not in read[0] and "l_quantity" not in read[0]


def test_filters_reach_the_scan(spark, sf):
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)" in plan(catalogue.queries()["semi_ref_merge"](spark, sf))


def test_row_work_does_not_shuffle(spark, sf):
    for name in ("id_line_parse", "subfield_parse", "record_routing", "issue_id_build", "date_coalesce", "iso_dates", "dim_lookup_default", "strip_comments", "link_extract", "link_classify", "element_counts", "heading_titles", "rel_path"):
        text = plan(catalogue.queries()[name](spark, sf))
        assert "Exchange" not in text and "Python" not in text and "Arrow" not in text, name


def test_aggregates_combine_before_the_shuffle(spark, sf):
    for name in ("last_wins_map", "record_stats", "status_unpivot", "page_count"):
        assert "partial_" in plan(catalogue.queries()[name](spark, sf)), name
