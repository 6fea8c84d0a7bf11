"""Personal data, secrets, licenses and quality against plain counterparts."""

import pytest
from pyspark.sql import functions as F

import duckdb
from sitegrain.llm import licenses, pii, quality, secret_scan, spans
from sitegrain.llm.oracle import ORACLE
from tests.llm import brute
from tests.llm.conftest import ODD, rows_of


def key(row):
    return (row["doc_id"] is None, row["doc_id"] or 0)


def check_spans(rows, plain, kinds):
    assert len(rows) == len(ODD)
    for row, (_, text, _) in zip(sorted(rows, key=key), sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        want = plain(text)
        assert row["base_sha256"] == brute.digest(want), (row, want)
        assert [row[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in want) for k in kinds]
        spans = [s for s in row["spans"].split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(spans)
        places = sorted(tuple(map(int, s.split(":")[1:])) for s in spans if s.split(":")[0] not in kinds)
        assert all(b <= c for (_, b), (c, _) in zip(places, places[1:], strict=False))


def test_pii(spark, odd, none):
    check_spans(pii.scan_pii(spark, odd).collect(), brute.personal, ("email", "ip", "card", "phone"))
    assert pii.scan_pii(spark, none).count() == 0


def test_addresses_without_at_sign_are_proposed(spark):
    """Every separator of the pattern passes the gate, also where the text holds no '@' and no spelled-out dot."""
    values = ["jane.doe (at) example.com", "jane [at] example.com", "jane at example.com", "jane(AT)example.com", "jane at example dot com"]
    docs = rows_of(spark, [(i, f"write: {v}", "a") for i, v in enumerate(values)])
    rows = spans.located(docs, pii.all_matches()).where("kind = 4").collect()
    assert sorted((r["doc_id"], r["value"], r["start"]) for r in rows) == [(i, v, 7) for i, v in enumerate(values)]


def test_luhn_and_octets(spark):
    values = spark.createDataFrame([(v,) for v in ("4111111111111111", "4111111111111112", "378282246310005", "0000000000000")], "v string")
    assert [r[0] for r in values.select(pii.luhn(F.col("v"))).collect()] == [True, False, True, True]
    ips = spark.createDataFrame([("255.0.0.1",), ("256.1.1.1",), ("0000255.1.1.1",)], "v string")
    assert [r[0] for r in ips.select(pii.confirmed(F.lit(1), F.col("v"))).collect()] == [True, False, True]


def test_trees_add_what_is_written_otherwise(spark):
    """Confirmed numbers are common enough to learn from; the same number without its sign is then added."""
    rows = [(i, f"some words before call +1 (555) {100 + i}-{2000 + i} and {i} others after, about {i * 37} of them", "a") for i in range(300)]
    rows += [(1000, "some words before call 1 (555) 123-4567 and more after", "a")]
    found = {r["doc_id"]: r["spans"] for r in pii.scan_pii(spark, rows_of(spark, rows), precision=0.9).collect()}
    assert found[1000].startswith("number_like:")
    assert found[5].count(":") == 2


def test_trees_and_thresholds_count_every_candidate(spark):
    """However many candidates there are, each is counted once for every way to write it, in the fitting or the held-out part."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("sum "), F.col("id") + 1_000_000, F.lit(" or mail a@b.cd")).alias("text"))
    rows = spans.located(docs, pii.all_matches()).withColumn("base", F.coalesce(pii.confirmed(F.col("kind"), F.col("value")), F.lit(False)))
    labelled = pii.labelled_candidates(spans.apart_from(rows.repartition("uid"), F.col("base"))).cache()
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.sum("rows").alias("n")).collect()}
    assert counts == {0: 30_000, 1: 3 * 30_000}
    assert labelled.count() < 1_000
    weights = pii.weighted(labelled, counts).groupBy("label").agg(F.sum("weight")).collect()
    assert sorted((r[0], round(r[1])) for r in weights) == [(0, 60_000), (1, 60_000)]
    held = labelled.where("held_out").withColumn("score", F.when(F.col("label") == 1, 0.75).otherwise(0.25))
    assert pii.calibrated(held, 0.9) == {4: 0.75, 5: 2.0}


def test_secrets(spark, odd, none):
    check_spans(secret_scan.scan_secrets(spark, odd).collect(), brute.secrets, ("assign", "access", "hex"))
    assert secret_scan.scan_secrets(spark, none).count() == 0


def test_markov_models_tell_random_from_words(spark):
    parts = "or di na ry wo rd ab out no th ing spe ci al at so me pla ce in tho ught ful sen ten ces".split()
    words = ["".join(parts[(i * k + k * k) % len(parts)] for k in range(1, 3 + i % 5)) for i in range(400)]
    rows = [(i, f"{' '.join(words[i::20])} {'_'.join(words[i:i + 3])} {'/'.join(words[i:i + 2])}", "a") for i in range(20)]
    rows += [(100, "see Zk9xQ2v7LmP4tR8wYb3nJ6hGd1 and thoughtful_sentences_about_places", "a")]
    found = {r["doc_id"]: r["spans"] for r in secret_scan.scan_secrets(spark, rows_of(spark, rows)).collect()}
    assert found[100] == "random:4:30"
    assert not any(v for k, v in found.items() if k < 100)


def sql_rows(sql, frame):
    con = duckdb.connect()
    con.register("frame", frame)
    con.execute("create view documents as select cast(doc_id as bigint) as doc_id, text from frame")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]


@pytest.mark.parametrize("name, run", [("op9_licenses", licenses.scan_licenses), ("op3_quality", lambda _, d: quality.quality(d))])
def test_against_sql(spark, odd, none, name, run):
    """Rows with an id of their own; the SQL joins by it."""
    some = odd.where("doc_id <> 5")
    names, want = sql_rows(ORACLE[name], some.select("doc_id", "text").toPandas())
    got = [r.asDict() for r in run(spark, some).select(*names).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert run(spark, odd).count() == len(ODD)
    assert run(spark, none).count() == 0


def test_license_join_finds_every_block(spark):
    """A notice is found wherever it stands, however its lines are cut, unless too many words are missing."""
    notice = licenses.TEMPLATES[1][1]
    filler = [f"w{i}" for i in range(40)]
    rows = [(k, " ".join(filler[:k % 40] * 3) + "\n" + notice.replace(" ", "\n" if k % 2 else "  "), "a") for k in range(1, 80)]
    rows += [(100, " ".join(notice.split()[:15]), "a"), (101, "permission is granted", "a")]
    found = {r["doc_id"]: (r["labels"], r["base_labels"], r["score"]) for r in licenses.scan_licenses(spark, rows_of(spark, rows)).collect()}
    assert all(found[k] == ("mit", "", 1.0) for k in range(1, 80))
    assert found[100] == found[101] == ("", "", 0.0)


@pytest.mark.parametrize("size", [64, 65, 300])
def test_license_templates_of_any_length(spark, size):
    """A notice of ``size`` words is found with a tenth of them missing, across any block border, and not with more."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(size)]
    templates = (*licenses.TEMPLATES[:2], ("own", " ".join(words)))
    few = [w for i, w in enumerate(words) if i % 11]
    rows = [(k, "x " * (k * 37) + " ".join(few if k % 2 else words), "a") for k in range(12)]
    rows += [(50, " ".join(w for i, w in enumerate(words) if i % 5), "a"), (51, " ".join(words[:size // 2]), "a")]
    found = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(spark, rows_of(spark, rows), templates=templates).collect()}
    assert found == {**dict.fromkeys(range(12), "own"), 50: "", 51: ""}


def test_quality_policies_and_ablation(spark, odd):
    rows = quality.ledger(odd).cache()
    kept = rows.where(quality.passes("v1")).count()
    for r in quality.ablation(rows).collect():
        without = tuple(n for n in quality.POLICIES["v1"] if n != r["rule"])
        mask = F.lit(quality.mask(without))
        assert r["kept_without"] == rows.where(F.col("failures").bitwiseAND(mask) == 0).count()
        assert r["rejected_alone"] == r["kept_without"] - kept
        assert r["failed"] == rows.where(F.expr(next(x.fails for x in quality.RULES if x.name == r["rule"]))).count()


def test_repeated_words_are_counted_once():
    words = "a b c d e".split()
    m = dict(zip(quality.MEASURES, quality.measure(" ".join(words + words + ["x"])), strict=True))
    assert (m["n_words"], m["n_repeat_words"]) == (11, 10)
    m = dict(zip(quality.MEASURES, quality.measure("a " * 7), strict=True))
    assert m["n_repeat_words"] == 7


def test_secret_models_are_fitted_on_all_strings(spark):
    """Every confirmed value and every word counts, however many there are; the threshold is counted exactly."""
    texts = [f"token={i:05d}xYq{i * 7919 % 99991:05d} word{'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10 % 10] * 3} plainly" for i in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = spans.located(docs, secret_scan.base_matches())
    strings = secret_scan.labelled_strings(spark, docs, rows, 300)
    assert strings.where("random = 0").count() == 101
    assert strings.where("random = 1").count() == 3000 + 300
    weights = secret_scan.markov_weights(strings)
    ratio = secret_scan.likelihood_ratio(F.col("value"), weights)
    held = strings.where("held_out and random = 0 and length(value) >= 12").select(ratio.alias("r"))
    limit = secret_scan.calibrated(strings, weights, 0.1)
    assert held.where(F.col("r") > limit).count() <= 0.1 * held.count()
