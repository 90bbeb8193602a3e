"""Plans that must hold at any size: columns that are read, filters that reach the scan, joins and top-k."""

from jobsieve.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_light_scan_reads_no_text(spark):
    assert "text" not in plan(catalogue.listing_scan(spark, FOLDER)).split("ReadSchema")[1]


def test_filter_reaches_the_scan(spark):
    assert "LessThan(n_chars,10)" in plan(catalogue.listing_scan(spark, FOLDER).where("n_chars < 10"))


def test_gate_of_catalogue_is_an_anti_join(spark):
    text = catalogue.detail_fetch(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in text and "LeftSemi" in text


def test_top_k_sorts_no_table(spark):
    assert "WindowGroupLimit" in plan(catalogue.top_per_source(spark, FOLDER))


def test_no_python_in_the_catalogue(spark):
    for query in catalogue.QUERIES.values():
        assert not any(x in plan(query(spark, FOLDER)) for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_rules_are_evaluated_once(spark):
    """What is behind a classification reads it from where it was written."""
    for name in ("exclusion_filter", "rank_by_fit", "duplicate_jobs", "classified"):
        text = plan(catalogue.QUERIES[name](spark, FOLDER))
        assert not any(x in text for x in ("RLIKE", "regexp_extract", "regexp_replace")), name
