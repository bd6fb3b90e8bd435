import hashlib

import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from casewise.llm import pfair, queries, simhash
from tests.llm.conftest import DOC_SCHEMA, SF
from tests.llm.test_pfair import brute
from tests.llm.test_simhash import closure, slow_fingerprint


DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["language_id", "toxicity", "near_duplicates", "mix_sources", "bpe_tokens"]
    # planted: no letters, and copies of which the smallest id stays
    extra = spark.createDataFrame([(10**6, "123 456 !!", "en", "s", 10), (10**6 + 1, None, None, None, None)], DOC_SCHEMA).select(docs.columns)
    copies = docs.filter("doc_id % 7 = 0").selectExpr("doc_id + 2000000 as doc_id", "text", "lang", "source", "n_chars").select(docs.columns)
    now = docs.unionByName(extra).unionByName(copies)
    frames = []
    for name, stage in C.STAGES:
        now = C.stored(stage(spark, now, SF), name)
        frames.append(now.toPandas())
    language, toxic, near, mixed, tokens = frames
    assert all(list(f.columns) == docs.columns for f in frames[:4])
    assert not set(language.doc_id) & {10**6, 10**6 + 1} and len(language) >= 0.97 * (docs.count() + copies.count())
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").toxic
    clean = [i for i in language.doc_id if labels.get(i) == 0]
    assert len(set(clean) & set(toxic.doc_id)) >= 0.97 * len(clean)
    comp = closure([slow_fingerprint(t) for t in toxic.text], 2)
    least = {}
    for i, c in zip(toxic.doc_id, comp, strict=True):
        least[c] = min(i, least.get(c, i))
    assert sorted(near.doc_id) == sorted(least.values())
    assert sorted(mixed.doc_id) == sorted(near.doc_id)
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, t in zip(mixed.doc_id, mixed.text, strict=True):
        ids = lib.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(t))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokens.itertuples()} == want


def test_run_and_registration(spark):
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n in queries.QUERIES} == set(range(1, 14))
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
    assert simhash.FAN > 1


def test_result_carries_the_mix(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = docs.groupBy(F.coalesce("source", F.lit(pfair.NONE)).alias("src")).agg(F.count("*").alias("docs"))
    a = {r.src: r.a for r in pfair.sources(counts).collect()}
    want = sorted((slot, place, i) for i, _, slot, place in brute([tuple(r) for r in docs.select(*DOC_COLUMNS).collect()], a, 64))
    monkeypatch.setattr(C, "STAGES", C.STAGES[3:])
    out = C.run(spark, SF)
    assert out.columns == C.RESULT and [r.doc_id for r in out.collect()] == [i for _, _, i in want]
    tokens = C.bpe_tokens(spark, C.stored(docs.repartition(7, "n_chars"), "mixed"), SF)
    assert sorted((r.slot, r.place, r.doc_id) for r in tokens.collect()) == want


def test_mix_of_repeated_ids_is_the_mixing_stages(spark):
    rows = [(i % 5 if i % 6 else None, f"text {i % 17}", "en", ["a", "b", None][i % 3], 6) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    sha = F.sha2("text", 256).alias("sha")
    stage = sorted(map(tuple, pfair.mix(docs).select("slot", "place", "doc_id", sha).collect()), key=str)
    tokens = C.bpe_tokens(spark, C.stored(docs, "repeated"), SF).select("slot", "place", "doc_id", "decoded_sha256")
    assert sorted(map(tuple, tokens.collect()), key=str) == stage


def test_stages_keep_clashing_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["pipeline_lang", "Pipeline_Score", "block", "slot", "place", "row_hash", "h", "a.b"]
    odd = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in names])
    odd = odd.unionByName(odd.filter("doc_id % 9 = 0"))  # repeated rows
    empty = odd.limit(0)
    for name, stage in C.STAGES:
        odd, empty = C.stored(stage(spark, odd, SF), name), C.stored(stage(spark, empty, SF), f"{name}-empty")
        assert empty.count() == 0 and empty.columns == odd.columns
        if name != "bpe_tokens":
            assert odd.columns == [*docs.columns, *names]
            assert all(r[n] == f"{n}:{r.doc_id}" for r in odd.collect() for n in names)
    ids = [r.doc_id for r in odd.collect()]
    assert len(ids) == len(set(ids)) > 100
