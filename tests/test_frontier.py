import hashlib

from pyspark.sql import functions as F

from sitegrain.operators import frontier as FR
from sitegrain.operators.frontier import expand_frontier, frontier_accounting
from sitegrain.rules import SiteRules
from sitegrain.sources.pages import seed_urls

SITE = "https://www.example.com"
# Page id, URL, final URL, links. A cycle, a hub every page links to, two names of one page, a page without snapshot.
GRAPH = [
    (0, "/en", None, ["/en/a", "/en/b", "/en/hub", "/fr/x"]),
    (1, "/en/a", None, ["/en", "/en/c", "/en/hub"]),
    (2, "/en/b", None, ["/en/missing", "/en/c", "/en/hub"]),
    (3, "/en/c", "/en/a", ["/en/never", "/en/hub"]),
    (4, "/en/hub", None, ["/en/d", "/en/hub"]),
    (5, "/en/d", None, []),
    (6, "/en/never", None, ["/en/e"]),
    (7, "/en/b?again=1", None, ["/en/e"]),
]


def _tables(spark):
    full = lambda u: None if u is None else SITE + u
    rows = [(i, full(u), full(f) or full(u), i) for i, u, f, _ in GRAPH]
    links = [(i, full(t)) for i, _, _, targets in GRAPH for t in targets]
    return spark.createDataFrame(rows, "page_id long, url string, final_url string, seq long"), spark.createDataFrame(links, "page_id long, url string")


def test_closure_ends_and_does_not_depend_on_the_wave_budget(spark):
    pages, links = _tables(spark)
    seeds = seed_urls(spark, [SITE + "/en/", SITE + "/en"])
    results = []
    for budget in (None, 1, 3):
        closure = expand_frontier(spark, pages, links, seeds, SiteRules(), budget)
        results.append((
            {r.page_id for r in closure.done.collect()}, {r.key.removeprefix(SITE) for r in closure.found.collect()},
            tuple(frontier_accounting(closure).first()),
        ))
        if budget is None:
            waves = {r.key.removeprefix(SITE): r.wave for r in closure.done.collect()}
    assert results[0] == results[1] == results[2]
    done, found, accounting = results[0]
    assert done == {0, 1, 2, 4, 5}
    assert found == {"/en", "/en/a", "/en/b", "/en/hub", "/en/c", "/en/missing", "/en/d"}
    # Two seeds, then 3 + 3 + 3 + 2 in-scope links of processed pages.
    assert accounting == (13, 7, 6)
    assert waves == {"/en": 0, "/en/a": 1, "/en/b": 1, "/en/hub": 1, "/en/d": 2}


def test_seeds_pass_without_scope(spark):
    pages, links = _tables(spark)
    closure = expand_frontier(spark, pages, links, seed_urls(spark, [SITE + "/other", ""]), SiteRules())
    assert closure.found.count() == 1 and closure.done.count() == 0
    assert closure.links.where(F.col("key").contains("/fr/")).count() == 0


def test_first_in_line(spark, monkeypatch):
    """The cut is found by counting prefixes of the hash; every budget gives the head of the line."""
    monkeypatch.setattr(FR, "FEW", 3)
    rows = [(w, f"u{w}-{i}") for w in (0, 2, 5) for i in range(300)]
    line = sorted(rows, key=lambda r: (r[0], hashlib.md5(r[1].encode()).hexdigest(), r[1]))
    waiting = spark.createDataFrame(rows, "wave int, key string")
    for budget in (1, 299, 300, 301, 640, 899, 900, 5000):
        assert sorted(tuple(r) for r in FR.first_in_line(waiting, budget).collect()) == sorted(line[:budget])
    assert "TakeOrdered" not in FR.first_in_line(waiting, 640)._jdf.queryExecution().executedPlan().toString()


def test_buckets_join_without_exchange(spark, tmp_path):
    tables = FR.Buckets(spark, str(tmp_path), 4)
    tables.write("index", spark.range(1000).select(F.col("id").cast("string").alias("key"), "id"), "key")
    for wave in (0, 1):
        assert tables.write("found", spark.range(500).select((F.col("id") * 2 + wave).cast("string").alias("key")), "key", wave) == 500
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (
            tables.read("found", 1).select("key").join(tables.read("index"), "key"),
            tables.read("index").join(tables.read("found").select("key"), "key", "left_anti"),
        ):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.close()


def test_a_budget_needs_few_steps_and_gives_the_waves_of_a_plain_queue(spark, monkeypatch):
    """Waves filled by those waiting are done in one step: taken, found and done are those of a queue taken wave by wave."""
    size, budget = 400, 7
    pages = spark.range(size).select(
        "id", F.concat(F.lit(SITE + "/en/"), "id").alias("url"), F.concat(F.lit(SITE + "/en/"), F.floor(F.col("id") / 2) * 2).alias("final_url")
    ).selectExpr("id as page_id", "url", "final_url", "id as seq")
    targets = {i: [(i * 7 + n) % size for n in (1, 2, 3)] for i in range(size)}
    links = spark.createDataFrame([(i, f"{SITE}/en/{t}") for i, ts in targets.items() for t in ts], "page_id long, url string")
    found, taken, done, wave = {f"{SITE}/en/0": 0}, {}, {}, 0
    while len(taken) < len(found):
        line = sorted((k for k in found if k not in taken), key=lambda k: (found[k], hashlib.md5(k.encode()).hexdigest(), k))[:budget]
        taken |= dict.fromkeys(line, wave)
        for i in sorted(int(k.rsplit("/", 1)[1]) for k in line):
            if i // 2 not in done:
                done[i // 2] = (i, wave)
                for t in targets[i]:
                    found.setdefault(f"{SITE}/en/{t}", wave + 1)
        wave += 1
    steps = []
    write = FR.Buckets.write
    monkeypatch.setattr(FR.Buckets, "write", lambda self, name, *a: steps.append(name) or write(self, name, *a))
    closure = expand_frontier(spark, pages, links, seed_urls(spark, [SITE + "/en/0"]), SiteRules(), budget)
    assert {r.key: r.wave for r in closure.taken.collect()} == taken
    assert {r.key: r.wave for r in closure.found.collect()} == found
    assert {(r.page_id, r.wave) for r in closure.done.collect()} == set(done.values())
    assert steps.count("taken") < wave / 2
