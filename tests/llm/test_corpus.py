"""Dedup, mixing, packing, token counts, toxicity and the pipeline against plain counterparts."""

import hashlib
import math
import random
from functools import reduce
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from sitegrain.llm import common, components, exact_dedup, mixing, packing, simhash, tokencount, toxicity
from sitegrain.llm.oracle import ORACLE
from sitegrain.llm.queries import QUERIES
from tests.llm.conftest import DOCS, ODD, rows_of

SF = "/root/testdata/sf0.001"
SENTENCE_A, SENTENCE_B = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op3_quality", "op4_mixing", "op9_licenses", "op10_exact_dedup"])
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, QUERIES[name], ORACLE[name]) == ""


# Exact dedup


def classes(rows):
    by_text = {}
    for i, text, _ in rows:
        by_text.setdefault(text or "", []).append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by_text.items()}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, odd, none, weak):
    """With a digest of one hexadecimal digit every decision rests on the bytes; batches of one file use the state."""
    key = (lambda sha: F.substring(F.hex(sha), 1, 1)) if weak else exact_dedup.sha_key
    got = exact_dedup.exact_dedup(spark, odd, key=key, files_per_batch=1).collect()
    want = classes(ODD)
    assert len(got) == len(ODD)
    ids = {i: t or "" for i, t, _ in ODD}
    for r in got:
        keep, size = want[ids[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, size, r["doc_id"] == keep)
    assert exact_dedup.exact_dedup(spark, none).count() == 0


def test_the_state_decides(spark, odd, monkeypatch):
    """The row that stays and the size of a group are those of the stream's state."""
    real = exact_dedup.digest_state

    def other(*args, **kwargs):
        state = real(*args, **kwargs)
        keeper = F.col("keeper").withField("doc_id", F.lit(-7).cast("long"))
        return state.withColumn("keeper", keeper).withColumn("rows", F.when(F.col("rows") > 1, F.col("rows") + 100).otherwise(F.col("rows")))

    monkeypatch.setattr(exact_dedup, "digest_state", other)
    want = classes(ODD)
    for r in exact_dedup.exact_dedup(spark, odd).collect():
        size = next(n for t, (_, n) in want.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert (r["keep_id"], r["group_size"]) == ((-7, size + 100) if size > 1 else (r["doc_id"], 1))


def test_state_goes_on(spark, odd, tmp_path):
    """A second run over the same checkpoint takes new files only, and remembers the old ones."""
    source, held = str(tmp_path / "rows"), str(tmp_path / "state")
    rows = exact_dedup.narrow_rows(odd, F.lit("f"))
    rows.write.parquet(source)
    first = exact_dedup.digest_state(spark, source, rows.schema, held).count()
    rows.withColumn("doc_id", F.col("doc_id") + 100).write.mode("append").parquet(source)
    state = exact_dedup.digest_state(spark, source, rows.schema, held)
    assert state.count() == first == len(classes(ODD))
    assert state.agg(F.sum("rows")).first()[0] == 2 * len(ODD)
    assert state.agg(F.max("keeper.doc_id")).first()[0] == 113


def test_drop_copies_keeps_columns(spark, odd):
    out = exact_dedup.drop_copies(spark, odd)
    assert out.columns == odd.columns
    assert sorted(r["text"] or "" for r in out.collect()) == sorted(classes(ODD))


def test_drop_copies_with_null_and_shared_ids(spark):
    for i in (None, 5):
        rows = [(i, "x", "a"), (i, "y", "a"), (8, "x", "a"), (9, None, "a"), (9, "", "a")]
        out = exact_dedup.drop_copies(spark, rows_of(spark, rows)).collect()
        assert sorted((str(r["doc_id"]), r["text"] or "") for r in out) == sorted([(str(i), "y"), ("8", "x"), ("9", "")])


# SimHash


def plain_fingerprint(text):
    words = (text or "").translate(str.maketrans(common.UPPER, common.LOWER)).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates(spark, odd, none):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [*ODD[:9], *ODD[10:]]
    for i in range(60):
        base = [rng.choice(words) for _ in range(150)]
        for k in range(3):
            rows.append((100 + 3 * i + k, " ".join(base[:140 + 5 * k]), "a"))
    got = simhash.near_duplicates(spark, rows_of(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = {i: plain_fingerprint(t) for i, t, _ in rows}
    names = sorted(set(fps.values()))
    root = plain_components([(a, b) for a in names for b in names if a < b and (a ^ b).bit_count() <= 4], names)
    smallest = {}
    for i, f in fps.items():
        if i is not None:
            smallest[root[f]] = min(i, smallest.get(root[f], i))
    for r in got:
        f = fps[r["doc_id"]]
        assert (r["fingerprint"], r["component_id"]) == (f"{f:016x}", smallest.get(root[f]))
    assert simhash.near_duplicates(spark, none).count() == 0


@pytest.mark.parametrize("nodes", [100, 10**7, 10**10])
def test_bands_lose_no_pair(spark, nodes):
    """However many bands are chosen, fingerprints within the radius share a key."""
    count, agree = simhash.bands(nodes)
    rng = random.Random(nodes)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    keys = [F.array(*simhash._band_keys(F.col(c), count, agree)) for c in "ab"]
    same = F.exists(F.arrays_zip(keys[0].alias("x"), keys[1].alias("y")), lambda z: z["x"] == z["y"])
    assert df.where(same).count() == 300


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = np.unique(np.array([base[i % 5] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, i % 9, replace=False))) for i in range(700)], np.uint64))
    for radius in range(5):
        marks, block = simhash.within(fps[:50], simhash.planes(fps), np.arange(64), radius)
        for q in range(50):
            near = {int(b) * 64 + k for w, b in zip(marks[q], block, strict=True) for k in range(64) if int(w) >> k & 1}
            assert {n for n in near if n < len(fps)} == set(np.flatnonzero(np.bitwise_count(fps ^ fps[q]) <= radius))


def test_hot_bucket_is_split(spark, monkeypatch):
    """Small groups make every bucket hot; the links stay the same."""
    rng = random.Random(5)
    fps = {rng.getrandbits(20) for _ in range(400)}
    monkeypatch.setattr(simhash, "BLOCK", 16)
    nodes = common.stored(spark, spark.createDataFrame([(f,) for f in fps], "fp long"), "test")
    got = {r["node"]: r["root"] for r in components.components(spark, simhash.links(spark, nodes)).collect()}
    want = plain_components([(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4], fps)
    assert {n: got.get(n, n) for n in fps} == want


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200 - i, 200) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark, spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 151 for i in range(152, 201)}}


# Dropping near duplicates


def test_drop_near_duplicates(spark, odd, none):
    """One row of each component; null, shared and repeated ids, and rows repeated whole."""
    rows = [*ODD, (None, SENTENCE_A, "a"), (None, SENTENCE_A, "a"), (5, SENTENCE_B, "a"), (6, SENTENCE_B, "a"), (6, SENTENCE_B, "a"), (2, SENTENCE_B, "z")]
    fps = [plain_fingerprint(t or "") for _, t, _ in rows]
    root = plain_components([(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4], set(fps))
    best = {}
    for (i, _, _), f in zip(rows, fps, strict=True):
        best.setdefault(root[f], []).append((i is None, i or 0))
    docs = rows_of(spark, rows)
    out = simhash.drop_near_duplicates(spark, docs)
    assert out.columns == docs.columns
    got = [(root[plain_fingerprint(r["text"] or "")], (r["doc_id"] is None, r["doc_id"] or 0)) for r in out.collect()]
    assert sorted(got) == sorted((k, min(v)) for k, v in best.items())
    assert simhash.drop_near_duplicates(spark, none).count() == 0


# Mixing


def test_mixing(spark, odd, none):
    got = mixing.mix_sources(spark, odd).collect()
    assert len(got) == len(ODD)
    sizes = {}
    for _, text, source in ODD:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    total = sum(sizes.values())
    assert math.isclose(sum({r["source_size"]: r["target"] for r in got}.values()), total)  # sizes differ here
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] <= 3 * r["source_size"]
    again = mixing.mix_sources(spark, odd.repartition(5)).drop("uid")
    assert sorted(map(str, again.collect())) == sorted(str(r) for r in mixing.mix_sources(spark, odd).drop("uid").collect())
    assert mixing.mix_sources(spark, none).count() == 0
    mixed = mixing.apply_mix(spark, odd)
    assert mixed.columns == odd.columns
    words = sum(len((r["text"] or "").encode().split()) for r in mixed.collect())
    assert words == sum(r["taken"] for r in got)


def test_every_prefix_of_the_schedule_is_near_the_targets(spark):
    rows = [(i, "w " * (20 + i % 50), f"s{i % 7}") for i in range(2000)]
    sized = common.stored(spark, mixing.sized(rows_of(spark, rows)), "test")
    targets = common.stored(spark, mixing.source_targets(sized), "test")
    share = {r["source"]: r["words"] for r in targets.collect()}
    total = sum(share.values())
    seen = dict.fromkeys(share, 0)
    for n, r in enumerate(mixing.schedule(spark, targets).orderBy("slot").collect(), 1):
        seen[r["source"]] += 1
        if n % 500 == 0 and n * mixing.block_words(targets)[0] < 0.9 * total:
            assert all(abs(seen[s] - n * share[s] / total) < 8 for s in share)


# Packing


def check_packed(rows, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    ids = [(i, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t, _ in texts]
    want = sorted((str(i), len(a)) for i, a in ids)
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0) == want
    by_id = {}
    for i, a in ids:
        by_id.setdefault(i, a)
    for r in rows:
        a = by_id[r["doc_id"]]
        assert crc32(a[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in rows) == sum(n for _, n in want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))]
        length = sum(n for _, n in s)
        assert length <= 2048 and length & (length - 1) == 0


def test_packing_encodes_parts_of_words_once_and_as_the_library_does():
    with open(BYTES, encoding="utf-8") as f:
        content = f.read()
    encoder = packing.Encoder(content, 1000, packing.cuts_as_gpt2(content))
    library, asked = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return library.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    encoder.tokenizer = Counting()
    texts = ["one and.\nand one, and! one", "two and, one and."]
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder(texts) == want
    assert sum(t.split().count("and") for t in asked) == 2  # with a blank and without, however they stand
    encoder.tokenizer = library
    signs = [" ", " ", "  ", "\n", " \n", "\t", "a", "bc", "é", "ß", "漢", "3", ".", ",!", "'s", "'", "\x1c", "\xa0", "\u3000", "<|endoftext|>", "<"]
    draw = np.random.default_rng(5)
    odd = ["".join(draw.choice(signs, draw.integers(0, 30))) for _ in range(5000)]
    plain = packing.Encoder(content, 1000, False)
    assert [encoder(odd[k:k + 100]) for k in range(0, 5000, 100)] == [plain(odd[k:k + 100]) for k in range(0, 5000, 100)]


def test_packing(spark, odd, none):
    check_packed(packing.pack(spark, odd, BYTES).collect(), ODD)
    assert packing.pack(spark, none, BYTES).count() == 0


def test_special_strings_and_blanks(spark):
    texts = [(1, "a<|endoftext|>b  c \n d  e", "a"), (2, "  \t x  ", "b"), (3, "\x1c y \x85 z", "b")]
    check_packed(packing.pack(spark, rows_of(spark, texts), BYTES).collect(), texts)


@pytest.mark.parametrize("totals", [[100_000, 3000, 1, 255, 257, 40_000], [5], [256, 512]])
def test_rounds_are_a_deficit_round_robin(totals):
    """The closed form serves what queues with deficits serve, window by window."""
    rounds = packing.Rounds(np.array(totals), window=2048, granule=256)
    owed, served, place = [0] * len(totals), [0] * len(totals), 0
    for w in range(rounds.windows):
        for q, total in enumerate(totals):
            owed[q] += total
            take = min(owed[q] // rounds.unit * 256, total - served[q]) if w + 1 < rounds.windows else total - served[q]
            owed[q] -= take // 256 * rounds.unit
            at = np.arange(served[q], served[q] + take)
            assert (rounds.place(np.full(take, q), at) == place + np.arange(take)).all()
            served[q] += take
            place += take
    assert served == totals


# Token counts


def test_transducer_counts_what_the_library_counts():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    transducer = tokencount.compile_vocabulary(PIECES)
    rng = random.Random(7)
    pool = [*"abcdefghijklmnopqrstuvwxyzthein aeiou  \n\t▁é日①\0<s>!!##0123", "the ", "ing", "tion", "  ", "Hello"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))
        whole = tokencount.normalised(text)
        size = rng.randint(1, 6)
        maps = [transducer.chunk_map(whole[i:i + size]) for i in range(0, len(whole), size)]
        left = transducer.total(reduce(transducer.compose, maps)) if maps else 0
        right = transducer.total(reduce(lambda a, b: transducer.compose(b, a), maps[::-1])) if maps else 0
        assert {transducer.count(whole), transducer.run(whole), left, right} == {len(sp.encode(text))}, text


@pytest.mark.parametrize("chunk", [tokencount.CHUNK, 100])
def test_token_counts(spark, odd, none, chunk):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(str, tokencount.count_tokens(spark, odd, PIECES, chunk=chunk).collect()))
    want = [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t, _ in ODD]
    assert got == sorted(f"Row(doc_id={i}, n_bytes={b}, n_tokens={n}, over_limit={n > 4096})" for i, b, n in want)
    assert tokencount.count_tokens(spark, none, PIECES, chunk=chunk).count() == 0


# Toxicity


def test_toxicity(spark, odd, none):
    rows = [(i, f"text number {i % 13} about {'an awful fool' if i % 4 == 0 else 'a fine thing'} and more of it", "a") for i in range(600)]
    docs = rows_of(spark, [*rows, (1000, "", "a"), (1001, None, "a")])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _, _ in rows] + [(None, 1), (3, None), (4, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == 602
    for i, r in got.items():
        assert r["held_out"] == (crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5) == int(i < 600 and i % 4 == 0)
    out = toxicity.drop_toxic(docs, labels)
    assert out.columns == docs.columns and out.count() == 452
    assert toxicity.score_toxicity(odd, labels).count() == len(ODD)
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert toxicity.drop_toxic(odd, labels.where("false")).count() == len(ODD)


def test_held_out_toxic_texts_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01


# Pipeline


def test_pipeline_stages(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(2, 0), (3, 0)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(spark, stage(spark, docs, str(tmp_path)), "test")
            if name != "packing":
                assert docs.columns == odd.columns
    assert docs.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()


def test_pipeline_drops_what_its_stages_find(spark):
    """Each stage's rows against the plain decision on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    after = common.stored(spark, stages["exact_dedup"](spark, docs, SF), "test")
    texts = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(k for k, _ in classes(texts).values())
    near = {r["doc_id"] for r in stages["near_dedup"](spark, after, SF).collect()}
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in after.collect()}
    names = set(fps.values())
    root = plain_components([(a, b) for a in names for b in names if a < b and (a ^ b).bit_count() <= 4], names)
    best = {}
    for i, f in fps.items():
        best[root[f]] = min(i, best.get(root[f], i))
    assert near == set(best.values())
    check_packed(stages["packing"](spark, docs, SF).collect(), texts)


def test_schema_of_fixture(odd):
    assert len(odd.columns) == len(DOCS.split(","))
