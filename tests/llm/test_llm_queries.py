"""The registered queries: DuckDB statements, and the pipeline against its stages done by brute force."""

import hashlib

import duckdb
import pytest
from tests_llm_support import SF, table

import corpus_pipeline
from ledgerline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(queries.ORACLES[name])
    names = list(rel.columns)
    want = sorted(map(repr, rel.fetchall()))
    got = sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, SF).select(*names).collect())
    assert got == want


def test_pipeline(spark):
    """Every stage's decision, from its own input, by brute force or by the operator's score."""
    from test_llm_operators import brute_components, brute_decontamination, brute_secrets, sha

    from ledgerline.llm import secret_scan, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scan", "bpe"]
    score = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    one = stages["toxicity"](spark, docs, SF).cache()
    assert {r.doc_id for r in one.collect()} == {d for d, p in score.items() if not p}
    two = stages["near_dedup"](spark, one, SF).cache()
    texts = {r.doc_id: r.text for r in one.collect()}
    assert {r.doc_id for r in two.collect()} == {d for d, (_, c) in brute_components(texts, 5).items() if d == c}
    three = stages["decontamination"](spark, two, SF).cache()
    bench = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    bad = {k[0] for k in brute_decontamination([(r.doc_id, r.text) for r in two.collect()], bench) if k[-1]}
    assert bad and {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - bad
    four = stages["secret_scan"](spark, three, SF).cache()
    masked = {r.doc_id: r.text for r in four.collect()}
    before = {r.doc_id: r.text for r in three.collect()}
    assert masked.keys() == before.keys() and four.columns == docs.columns
    for d, t in before.items():
        for _, a, b in brute_secrets(t):
            assert t[a:b] not in masked[d]
        if not secret_scan.candidate_spans(t) and not brute_secrets(t):
            assert masked[d] == t
    five = stages["bpe"](spark, four, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in five} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in masked.items()}
    assert sha(b"") and all(r.n_tokens > 0 for r in five)


def test_pipeline_stages_on_awkward_rows(spark, docs, tmp_path):
    """Nulls in any column, empty and very long texts, repeated ids and rows, extra columns with the operators' own names, labels
    and items that repeat or are null: every stage keeps all columns, and judges each row by its text."""
    from collections import Counter

    from test_llm_operators import brute_decontamination, brute_secrets, clashing

    from ledgerline.llm import secret_scan, toxicity

    long = "quite a long line of words " * 20000
    given = clashing(docs.unionByName(spark.createDataFrame([(900, long, None, None, None), (901, long + "end", "en", "a", 1)], docs.schema)))
    ids = [i for (i,) in given.select("doc_id").collect() if i is not None]
    spark.createDataFrame([(i, i % 2) for i in ids] + [(None, 1), (4, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    passage = max((t for (t,) in docs.select("text").collect() if t and len(t) < 4000), key=len)
    items = [(1, " ".join(passage.split()[:30])), (1, " ".join(passage.split()[:30])), (2, None), (None, "two words"), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    every = lambda df: Counter(repr(tuple(r)) for r in df.collect())
    sf, stages = str(tmp_path), dict(corpus_pipeline.STAGES)

    model = toxicity.train(given, spark.read.parquet(f"{sf}/labels.parquet"))
    clean = Counter(repr(tuple(r)) for r in given.collect() if not model or model.score((r.text or "").encode()) < 0.5)
    one = stages["toxicity"](spark, given, sf)
    assert one.columns == given.columns and every(one) == clean

    two = stages["near_dedup"](spark, given, sf).cache()
    assert two.columns == given.columns and not every(two) - every(given)
    assert {r.doc_id for r in two.collect()} >= {900} and 901 not in {r.doc_id for r in two.collect()}

    bad = {k[0] for k in brute_decontamination([(r.text, r.text) for r in given.collect()], [i for i in items]) if k[-1]}
    three = stages["decontamination"](spark, given, sf)
    assert bad and three.columns == given.columns
    assert every(three) == Counter(repr(tuple(r)) for r in given.collect() if r.text not in bad)

    four = stages["secret_scan"](spark, given, sf).cache()
    assert four.columns == given.columns and four.count() == given.count()
    others = [c for c in given.columns if c != "text"]
    assert every(four.select(others)) == every(given.select(others))
    quiet = Counter(repr((r.doc_id, r.text)) for r in given.collect() if not secret_scan.candidate_spans(r.text or "") and not brute_secrets(r.text))
    assert not quiet - every(four.select("doc_id", "text"))
    hidden = {t[a:b] for (t,) in given.select("text").collect() if t for _, a, b in brute_secrets(t)}
    assert hidden and not any(h in t for (t,) in four.select("text").collect() if t for h in hidden)

    five = stages["bpe"](spark, given, sf)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert every(five.select("doc_id", "decoded_sha256")) == Counter(repr((r.doc_id, digest(r.text))) for r in given.collect())


def test_pipeline_stages_on_empty_tables(spark, docs, empty, tmp_path):
    """No rows in, none out, columns kept; without labels nothing is toxic, without items nothing is contaminated."""
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "bpe" or out.columns == empty.columns)
        if name in ("toxicity", "decontamination"):
            assert stage(spark, docs, str(tmp_path)).count() == docs.count()
