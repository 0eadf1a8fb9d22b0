"""A crawl from landing pages to published rows, its stored tables, and configuration from files."""

import json

import pytest
from pyspark.sql import functions as F
from test_jobs import AS_OF, cells, folder  # noqa: F401

from holdsift import rules as R
from holdsift.operators.links import discover
from holdsift.plans import crawl, ingest
from holdsift.sources import registry, stored

CONFIG = {"sources": [
    {"source_key": "sbi_mf", "amc_name": "SBI Mutual Fund", "base_url": "https://www.sbimf.com", "strategy": "link_extraction"},
    {"source_key": "hdfc_mf", "amc_name": "HDFC Mutual Fund", "base_url": "https://hdfc.example", "strategy": "network_intercept", "source_id": 7},
    {"source_key": "off_mf", "amc_name": "Off Mutual Fund", "base_url": "https://off.example", "enabled": False}]}


@pytest.fixture()
def sources(spark, folder):  # noqa: F811
    with open(f"{folder}/sources.json", "w") as f:
        json.dump(CONFIG, f, indent=1)
    return registry.read_sources(spark, f"{folder}/sources.json")


def inputs(spark, tag="div", n=4):
    link = "<p>SBI Liquid Fund <a href='/portfolio/2026/june/SBI Liquid Fund June 2026 {}.xlsx'>Monthly Portfolio June 2026</a></p>"
    html = f"<body><{tag}>" + "".join(link.format(i) for i in range(n)) + f"</{tag}></body>"
    pages = spark.createDataFrame(
        [("sbi_mf", "https://www.sbimf.com/p", html), ("hdfc_mf", "https://hdfc.example/p", "<body></body>"), ("off_mf", "https://off.example/p", html)],
        "source_key string, url string, html string")
    responses = spark.createDataFrame([("off_mf", 1, "https://off.example/a.xlsx", "application/vnd.ms-excel")],
                                      "source_key string, seq long, url string, content_type string")
    # the last document did not land, the one before has the bytes of another
    url = "https://www.sbimf.com/portfolio/2026/june/SBI Liquid Fund June 2026 {}.xlsx"
    landed = spark.createDataFrame([(url.format(i), f"doc{min(i, n - 3)}", 10) for i in range(n - 1)],
                                   "url string, file_hash_sha256 string, file_size_bytes long")
    head = "SBI Mutual Fund monthly portfolio as on 30 June 2026 SBI Liquid Fund"
    grid = cells(spark, n).withColumn("cells", F.when(F.col("row_idx") == 0, F.array(F.lit(head))).otherwise(F.col("cells")))
    return pages, responses, landed, grid.withColumnRenamed("doc_id", "file_hash_sha256")


def test_from_pages_to_published_rows(spark, folder, sources):  # noqa: F811
    first = {r.source_id: r for r in crawl.run(spark, folder, 1, *inputs(spark), sources, AS_OF).collect()}
    assert set(first) == {1, 7}
    assert (first[1].documents_discovered, first[1].documents_novel, first[7].documents_discovered) == (4, 4, 0)
    state = {r.filename[-6:-5]: (r.status, r.last_error) for r in stored.read_table(spark, folder, "discovered_document").collect()}
    assert state == {"0": ("PUBLISHED", None), "1": ("PUBLISHED", None), "2": ("PUBLISHED", None), "3": ("FAILED", "download failed")}
    got = sorted((r.isin or "", r.version) for r in ingest.refresh_published(spark, folder).collect())
    assert got == [("", 2), ("INE000", 1), ("INE001", 1)]
    assert first[1].documents_classified == 2 and first[1].documents_published == 2
    assert stored.read_table(spark, folder, "classified_document").count() == 2
    assert stored.read_table(spark, folder, "audit_log").count() == 4
    assert stored.read_table(spark, folder, "drift_detection").filter("detection_type = 'page_structure'").isEmpty()
    known = {r.source_key: r for r in stored.read_table(spark, folder, "source_config").collect()}
    assert known["sbi_mf"].page_structure_hash and str(known["sbi_mf"].last_success_at)[:10] == AS_OF
    assert known["hdfc_mf"].last_crawled_at and known["hdfc_mf"].last_success_at is None and known["off_mf"].last_crawled_at is None
    assert crawl.state_problems(spark, folder).filter("problem = 'UNKNOWN_STATUS'").isEmpty()

    # pages of another structure, the same files: an event, no new rows, only the failed document is tried again
    second = {r.source_id: r for r in crawl.run(spark, folder, 2, *inputs(spark, "main"), sources, AS_OF).collect()}
    assert second[1].documents_discovered == 4 and second[1].documents_novel == 1 and second[1].documents_published == 0
    events = stored.read_table(spark, folder, "drift_detection").filter("run = 2 and detection_type = 'page_structure'").collect()
    assert [e.source_id for e in events] == [1] and events[0].previous_signature == known["sbi_mf"].page_structure_hash
    assert sorted((r.isin or "", r.version) for r in ingest.refresh_published(spark, folder).collect()) == got
    flags = {(r.run_id, r.source_id): r for r in crawl.alerts(spark, folder).collect()}
    assert flags["run-1", 7].alert_no_documents and not flags["run-1", 1].alert_nothing_published
    assert flags["run-2", 1].alert_nothing_published


def test_stored_tables_are_checked(spark, folder):  # noqa: F811
    with pytest.raises(FileNotFoundError):
        stored.read_table(spark, folder, "validated_data")
    good = spark.createDataFrame([("d", 1, True, "more")], "doc_id string, table_id int, business_rules_passed boolean, note string")
    with pytest.raises(stored.SchemaError, match="table_id is bigint, not int"):
        stored.write_table(good.withColumn("table_id", F.col("table_id").cast("long")), folder, "validated_data", 1)
    with pytest.raises(stored.SchemaError, match="doc_id is missing"):
        stored.write_table(good.drop("doc_id"), folder, "validated_data", 1)
    for n in (1, 2, 2):
        stored.write_table(good, folder, "validated_data", n)
    assert sorted((r.run, r.note) for r in stored.read_table(spark, folder, "validated_data").collect()) == [(1, "more"), (2, "more")]
    assert stored.read_table(spark, folder, "validated_data", before=2, newest=True).first().run == 1
    good.withColumn("table_id", F.lit("x")).write.parquet(f"{folder}/other/tables/validated_data/run=1")
    with pytest.raises(stored.SchemaError):
        stored.read_table(spark, f"{folder}/other", "validated_data")


def test_configuration_files(spark, folder, sources):  # noqa: F811
    rows = {r.source_key: r for r in sources.collect()}
    assert [rows[k].source_id for k in ("sbi_mf", "hdfc_mf", "off_mf")] == [1, 7, 3]
    assert rows["sbi_mf"].file_types == ["xlsx", "pdf"] and rows["sbi_mf"].page_type == "JS_SPA" and not rows["off_mf"].enabled

    def read(content):
        with open(f"{folder}/c.json", "w") as f:
            f.write(content if isinstance(content, str) else json.dumps(content))
        return registry.read_sources(spark, f"{folder}/c.json")

    with pytest.raises(FileNotFoundError):
        registry.read_sources(spark, f"{folder}/none.json")
    one = CONFIG["sources"][0]
    with pytest.raises(Exception, match="(?i)malformed|cannot|parse"):
        read({"sources": [{**one, "enabled": "perhaps"}]})
    for bad in ([one, one], [{**one, "base_url": None}], [{**one, "source_id": 2}, CONFIG["sources"][2]]):
        with pytest.raises(ValueError):
            read({"sources": bad})
    assert read({"other": 1}).count() == 0
    master = {"amcs": {}}
    for s in R.SCHEME_MASTER:
        amc = master["amcs"].setdefault(s.amc_key, {"name": s.amc_name, "schemes": []})
        amc["schemes"].append({"name": s.scheme_name, "category": s.category, "aliases": list(s.aliases)})
    with open(f"{folder}/m.json", "w") as f:
        json.dump(master, f)
    assert registry.read_scheme_master(spark, f"{folder}/m.json") == list(R.SCHEME_MASTER)
    assert registry.read_scheme_master(spark, f"{folder}/none.json") == []


def test_pages_are_not_shuffled_for_a_small_registry(spark, sources):
    pages, responses, _, _ = inputs(spark)
    plan = discover(pages, responses, sources)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in plan and shuffled
    tree = plan.splitlines()
    for i, line in enumerate(tree):
        if "ArrowEvalPython" in line:  # what is below: the scan, and the join with the registry
            depth = line.index("ArrowEvalPython")
            below = [x for x in tree[i + 1: i + 6] if len(x) - len(x.lstrip(" :+-")) > depth]
            assert not any("Exchange hashpartitioning" in x and "html" in x for x in below)
