"""The folds against a plain loop over the same records in the same order."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrain.operators import merge as G

FIELDS = (
    "seq long, page_id long, pos int, name string, website_url string, source_page_url string, description string, "
    "family_spirit map<string,string>, history_timeline array<struct<year:string,event:string>>"
)


def _fold(records):
    """What one record after another gives."""
    first = records[0]
    out = dict(first, family_spirit=dict(first["family_spirit"] or {}), history_timeline=list(first["history_timeline"] or []))
    for r in records[1:]:
        for c in ("website_url", "source_page_url", "description"):
            if r[c] not in (None, ""):
                out[c] = r[c]
        for k, v in (r["family_spirit"] or {}).items():
            if v not in (None, ""):
                out["family_spirit"][k] = v
        seen, kept = set(), []
        for item in out["history_timeline"] + (r["history_timeline"] or []):
            key = tuple((x or "").strip() for x in item)
            if key not in seen:
                seen.add(key)
                kept.append(item)
        out["history_timeline"] = kept
    return out


def _records(rng, n):
    text = lambda: rng.choice([None, "", "a", "b", "c"])
    rows = []
    for i in range(n):
        # A third of all records belong to one name, in several spellings.
        name = rng.choice(["Hot", " hot", "HOT "]) if i % 3 == 0 else f"n{rng.randrange(30)}"
        spirit = {k: text() for k in rng.sample("xyz", rng.randrange(3))}
        timeline = [(rng.choice([None, "1", " 1", "2"]), rng.choice(["e", "f"])) for _ in range(rng.randrange(4))]
        rows.append((i, i, 0, name, rng.choice(["w", "v"]), f"s{i}", text(), spirit, timeline))
    return rows


def test_group_wineries_equals_the_fold_whatever_the_partitioning(spark):
    rng = random.Random(7)
    rows = _records(rng, 300)
    names = T.DataType.fromDDL(FIELDS).fieldNames()
    groups = {}
    for r in rows:
        groups.setdefault(r[3].strip().lower(), []).append(dict(zip(names, r)))
    expected = {k: _fold(v) for k, v in groups.items()}
    shuffled = rows[:]
    rng.shuffle(shuffled)
    for parts in (1, 7):
        df = spark.createDataFrame(shuffled, FIELDS).repartition(parts)
        got = {r.name_key: r for r in G.group_wineries(df).collect()}
        assert got.keys() == expected.keys()
        for k, e in expected.items():
            r = got[k]
            assert (r.name, r.website_url, r.source_page_url, r.description) == (e["name"], e["website_url"], e["source_page_url"], e["description"])
            assert r.family_spirit == e["family_spirit"], k
            assert [tuple(i) for i in r.history_timeline] == e["history_timeline"], k


def test_two_sided_merges(spark):
    t = "array<struct<year:string,event:string>>"
    rows = [
        ({"a": "1", "b": ""}, {"a": "", "b": "2", "c": "", "d": "4"}, [("1", "x"), ("1", "x")], [(" 1", "x "), ("2", None), ("2", "")]),
        (None, {"a": ""}, None, [("9", "z"), ("9", "z")]),
        ({"a": "1"}, None, [("9", "z")], None),
    ]
    df = spark.createDataFrame(rows, f"m map<string,string>, n map<string,string>, x {t}, y {t}")
    c = F.col
    got = df.select(G.merge_map(c("m"), c("n")).alias("m"), G.merge_list(c("x"), c("y")).alias("l")).collect()
    assert [r.m for r in got] == [{"a": "1", "b": "2", "d": "4"}, {}, {"a": "1"}]
    assert [[tuple(i) for i in r.l] for r in got] == [[("1", "x"), ("2", None)], [("9", "z")], [("9", "z")]]


def test_merge_value_follows_the_type_and_zero_is_a_value(spark):
    df = spark.createDataFrame([(5, 0, "old", "", {"k": "1"}, {"k": "2"})], "a int, b int, s string, t string, m map<string,string>, n map<string,string>")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    c = F.col
    r = df.select(
        G.merge_value(c("a"), c("b"), kinds["a"]).alias("i"), G.merge_value(c("s"), c("t"), kinds["s"]).alias("s"),
        G.merge_value(c("m"), c("n"), kinds["m"]).alias("m"),
    ).first()
    assert (r.i, r.s, r.m) == (0, "old", {"k": "2"})


def test_all_empty_keeps_the_first_value(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "")], "o int, v string")
    assert df.agg(G.last_non_empty(F.col("v"), F.col("o")).alias("v")).first().v == ""


def test_records_are_dealt_narrow_and_those_of_a_frequent_key_to_many_tasks(spark):
    rows = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 500).cast("string").alias("k"), F.col("id").alias("o"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.array(F.struct((F.col("id") % 4).cast("string").alias("title"), F.lit("v").alias("value"))).alias("a"),
    )
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        merged = G.merge_records(rows, "k", F.col("o"), scalars=["text"], lists={"a": G.AWARD_KEY})
        got = {r["k"]: (r["text"], r["n_records"], [x["title"] for x in r["a"]]) for r in merged.collect()}
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = {}
    for r in rows.collect():
        _, n, titles = want.get(r["k"], (None, 0, []))
        title = r["a"][0]["title"]
        want[r["k"]] = (r["text"], n + 1, titles if title in titles else [*titles, title])
    assert got == want
    final = plan.split("== Initial Plan ==")[0]
    assert final.rindex("Generate") < final.rindex("REBALANCE_PARTITIONS_BY_COL")
    assert "skewed" in final
