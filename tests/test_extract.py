import pytest
from pyspark.sql import functions as F

from sitegrain.functions.text import strip
from sitegrain.plans.extract import extract_pages, listed, split_parts
from sitegrain.plans.ingest import drop_repeated_pages, process_pages
from sitegrain.rules import SiteRules
from sitegrain.sources.pages import page_table
from tests.fixtures.site import HOST, page_snapshot

RULES = SiteRules(grape_pairs=3)


@pytest.fixture(scope="module")
def pages(spark):
    rows = extract_pages(page_snapshot(spark), RULES).collect()
    return {r.page_id: r for r in rows}


def test_language_routing(pages):
    assert pages[1].links == [HOST + "/en"]
    assert pages[2].links == [] and pages[3].links == []
    assert pages[4].links == [HOST + "/en/a"]
    assert pages[5].links == [HOST + "/uk"]
    assert all(pages[i].routed and not pages[i].products for i in range(1, 6))


def test_page_classes(pages):
    expected = {10: "winery", 12: "winery", 20: "history", 22: "family_spirit", 30: "catalog", 40: "product"}
    assert {i: pages[i].page_class for i in expected} == expected
    assert 31 not in pages


def test_grapes_of_all_pairs(spark):
    rows = extract_pages(page_snapshot(spark).where("page_id = 40"), SiteRules()).collect()
    assert rows[0].products[0].grape_chardonnay_percent == 99.0


def test_product_fields(pages):
    p = pages[40].products[0].asDict(True)
    assert p == {
        "name": "Cuvee A Brut", "product_url": HOST + "/en/champagnes-et-cuvees/a", "source_page_url": HOST + "/en/champagnes-et-cuvees/a/?u=1",
        "description": "one two bold", "dosage_g_per_l": 7.0, "aging": "3 years", "operating_temperature": "8-10", "crus_assembles": "10 crus",
        "millennium": "2012", "grape_chardonnay_percent": 35.0, "grape_pinot_noir_percent": 44.5, "grape_meunier_percent": 20.0,
        "awards_and_ratings": [{"title": "Guide", "value": "92"}, {"title": "Bare", "value": ""}], "data_sheet_url": HOST + "/f/sheet.pdf",
    }


def test_product_without_a_name_fails_as_a_whole(pages):
    p = pages[41]
    assert (p.error, p.products, p.media, p.links) == ("product page without a name", [], [], [])


def test_media_forms(pages):
    got = [(m.media_type, m.url.removeprefix(HOST)) for m in pages[42].media]
    here = "/en/champagnes-et-cuvees"
    assert got == [
        ("image", "/b.jpg"), ("image", "/e.jpg"), ("image", here + "/f.png?v=1"), ("video", here + "/v1b.mp4"), ("video", "/v2.mp4"),
        ("video", "/v3.mp4"), ("image", "/q.webp"), ("image", "/bg1.jpg"), ("image", "/en/bg2.jpg"), ("image", "/f.png?v=1"),
    ]


def test_page_link_rule(pages):
    assert set(pages[43].links) == {
        "https://other.org/en/x", "https://elsewhere.org", HOST + "/en/b", "mailto:me@example.com",
    }


def test_strict_hosts_drops_foreign_links(spark):
    got = extract_pages(page_snapshot(spark).where("page_id = 43"), RULES.with_(strict_hosts=True)).first()
    assert set(got.links) == {HOST + "/en/b", "mailto:me@example.com"}


def test_listing(pages):
    c = pages[30]
    assert [(p.name, p.product_url, p.description) for p in c.products] == [("Zed", HOST + "/en/champagnes-cuvees/z", "sum")]
    assert [m.url for m in c.media] == [HOST + "/z.jpg"]
    assert set(c.links) == {
        HOST + "/en/maison", HOST + "/en/champagnes-cuvees/z", HOST + "/en/champagnes-cuvees/untitled", HOST + "/en/champagnes/page.html",
    }


def test_history(pages):
    assert [tuple(m) for m in pages[20].winery.history_timeline] == [
        ("1825 - Start", "Began small"), ("1900 - Silent", "Began small"), ("2000", "plain"),
    ]
    assert [tuple(m) for m in pages[21].winery.history_timeline] == [("1850 - Label here - more", "Label here - more")]


def test_family(pages):
    assert pages[22].winery.family_spirit == {"Jean-claude Foo": "a\nb", "B": "last"}
    assert pages[22].winery.description is None and pages[22].winery.history_timeline == []


def test_home_description(pages):
    assert pages[10].winery.description == "Some text note and more"


def test_root_is_home_flag(spark):
    page = spark.createDataFrame([(1, HOST + "/", None, "<p>x")], "page_id long, url string, final_url string, html string")
    from sitegrain.sources.pages import page_table

    assert extract_pages(page_table(page), RULES).count() == 0
    assert extract_pages(page_table(page), RULES.with_(root_is_home=True)).first().page_class == "winery"


def test_repeated_final_urls_yield_one_page(spark):
    kept = {r.page_id for r in drop_repeated_pages(page_snapshot(spark), RULES).select("page_id").collect()}
    assert 10 in kept and not kept & {11, 12}


def test_parts_are_narrow_tables(spark):
    parts = process_pages(page_snapshot(spark), RULES).parts
    assert {r.page_id for r in parts.winery.collect()} == {10, 20, 21, 22}
    assert [(r.page_id, r.stage) for r in parts.errors.collect()] == [(41, "product")]
    assert split_parts(extract_pages(page_snapshot(spark), RULES)).product.count() == 4


def test_python_rules(spark):
    """Typed data, media and links of a rule; a later rule overrides; a failing one is an error row and nothing else."""
    from sitegrain import rules as R
    from sitegrain.operators.html import Result
    from sitegrain.operators.product import product_rules_of
    from sitegrain.operators.registry import PythonRule, extraction_report

    def good(url, headings):
        return Result({"dosage_g_per_l": 1.5, "aging": "by hand", "other": 1}, [("image", "https://h/x.png")], [url + "#l"])

    def bad(url, headings):
        return Result({"aging": 1 // (len(headings) - len(headings))})

    def strange(url, headings):
        return Result({"aging": object()})

    need = ((R.PRODUCT_HEADINGS,),)
    rules = [
        PythonRule("good", {"dosage_g_per_l": "double", "aging": "string"}, need, good), PythonRule("bad", {"aging": "string"}, need, bad),
        PythonRule("strange", {"aging": "string"}, need, strange), PythonRule("absent", {"aging": "string"}, ((R.FAMILY_NAME,),), bad),
    ]
    snapshot = page_snapshot(spark)
    row = extract_pages(snapshot, RULES, [*product_rules_of(RULES), *rules]).where("page_id = 40").first()
    plain = extract_pages(snapshot, RULES).where("page_id = 40").first()
    assert row.error is None and (row.products[0].dosage_g_per_l, row.products[0].aging) == (1.5, "by hand")
    assert row.products[0].name == plain.products[0].name
    assert [m.url for m in row.media] == ["https://h/x.png", *[m.url for m in plain.media]]
    assert set(row.links) == {*plain.links, row.final_url + "#l"}
    assert [e.rule for e in row.rule_errors] == ["bad", "strange"] and row.rule_errors[0].message.startswith("ZeroDivisionError")
    report = {r.rule: r for r in extraction_report(snapshot.where("page_id = 40"), rules).collect()}
    assert (report["good"].filled, report["good"].media, report["good"].links, report["bad"].failed, report["absent"].applies) == (1, 1, 1, 1, 0)


def test_a_rule_runs_once_for_all_kinds_of_its_results(spark):
    """Fields, media and links of one extraction are read from what was written, not parsed again."""
    from checks import queries as Q

    for name in ("custom_rule", "rule_errors"):
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan


def test_a_batch_of_few_files_is_dealt_to_all_cores(spark, tmp_path):
    from sitegrain.streaming.ingest import on_all_cores

    spark.range(100).selectExpr("id as page_id", "'x' as html").coalesce(1).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    cores = spark.sparkContext.defaultParallelism
    assert pages.rdd.getNumPartitions() < cores <= on_all_cores(pages).rdd.getNumPartitions()
    assert on_all_cores(pages).distinct().count() == 100
    many = pages.repartition(3 * cores)
    assert on_all_cores(many) is many


@pytest.mark.parametrize("part", ["product", "media", "links", "errors"])
def test_no_part_is_worked_out_twice(spark, part):
    """Spark must not test a list for being empty before it lists it: that would read the page again."""
    pages = spark.createDataFrame([(1, "https://www.example.com/en/champagnes-et-cuvees/a", "<p>x")], "page_id long, url string, html string")
    parts = split_parts(extract_pages(page_table(pages), SiteRules()))
    plan = getattr(parts, part)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert "Generate" in above
    assert "Filter" not in above[above.index("Generate"):]


def test_lists_give_a_row_for_each_item(spark):
    """Also for a null item; none for an empty or null list."""
    rows = spark.createDataFrame([(1, ["a", None, "b"]), (2, []), (3, None)], "id long, items array<string>")
    got = [tuple(r) for r in listed(rows, ["id"], "items", "item").orderBy("pos").collect()]
    assert got == [(1, 0, "a"), (1, 1, None), (1, 2, "b")]


def test_strip_drops_what_python_drops(spark):
    texts = [chr(i) + "x" + chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    rows = spark.createDataFrame([(t,) for t in [*texts, "", " \t", "a  b"]], "t string")
    assert all(r[1] == r[0].strip() for r in rows.select("t", strip(F.col("t"))).collect())
