import importlib.util
import random

import corpus_pipeline
import pandas as pd
from farelens.llm import bpe, toxicity
from farelens.llm.common import words
from pyspark.sql import functions as F

from .helpers import documents
from .test_jaccard_join import brute as near_groups
from .test_suffix_match import brute as contaminated

ITEMS = [(1, " ".join(f"q{k}" for k in range(14))), (2, "one short item")]


def made():
    rng = random.Random(12)
    vocab = [f"w{k}" for k in range(2000)]
    text = lambda n: rng.choices(vocab, k=n)
    rows, toxic = [], {}
    for k in range(160):
        w = text(rng.randint(30, 120))
        toxic[k] = k % 4 == 0
        if toxic[k]:
            for at in rng.sample(range(len(w)), 6):
                w[at] = rng.choice(["vilest", "grubber"])
        rows.append((k, " ".join(w)))
    clean = [t for k, t in rows if not toxic[k]]
    rows += [(200 + k, clean[k]) for k in range(5)] + [(300 + k, clean[10 + k].replace(" ", "\n") + " end") for k in range(5)]
    rows += [(400 + k, clean[20 + k] + " " + ITEMS[0][1][k * 3 :] + " " + " ".join(text(9))) for k in range(5)]
    return rows + [(500, None), (501, ""), (502, "one SHORT item")], toxic


def test_run_against_brute_force(spark, tmp_path):
    rows, toxic = made()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, int(v)) for k, v in toxic.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    model = toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), allowed=F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    score = toxicity.Scorer(model).score([words((t or "").encode()) for _, t in rows])
    kept = [r for r, s in zip(rows, score, strict=True) if s < toxicity.THRESHOLD]
    assert sum(toxic.get(i, False) for i, _ in kept) < 25 and len(kept) > 120
    last = {}
    for i, t in kept:
        last[t or ""] = max(i, last.get(t or "", i))
    kept = [(i, t) for i, t in kept if last[t or ""] == i]
    kept = [(i, t) for (i, t) in kept if i in {c for _, c, _ in near_groups(kept)}]
    bad = {r[0] for r in contaminated(kept, ITEMS) if r[5]}
    codec = bpe.Codec(bpe.load_automaton(bpe.default_path()))
    want = {i: len(codec.encode(t or "")) // 4 for i, t in kept if i not in bad}
    assert got == want and bad


def test_run_over_odd_rows(spark, tmp_path):
    """NULL ids and texts, repeated rows, a very long text, columns with clashing
    names, then no documents at all."""
    long = " ".join(f"w{k}" for k in range(120_000))
    rows = [(None, "no id here"), (None, None), (1, None), (2, ""), (3, "twice"), (3, "twice"), (4, long), (5, f"{long} and one more"), (6, "left alone by all stages")]
    for name, some in (("odd", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        documents(spark, some, clash=True).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(k, 1, None if k == 9 else k % 2) for k in range(10)], "doc_id long, quality int, toxic int").where(f"'{name}' = 'none'").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None), (None, "not in any document")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert sorted((r.doc_id for r in got if r.doc_id is not None)) == [2, 3, 4, 6]  # 1 is empty like 2, 5 a near copy of 4
    assert sum(r.doc_id is None for r in got) == 1 and {r.n_tokens > 100_000 for r in got if r.doc_id == 4} == {True}
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_keep_the_columns(spark, tmp_path):
    docs = documents(spark, [(1, "a"), (2, "a")])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_entry_has_every_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_exact_dedup_equals_its_sql(spark):
    import duckdb
    from farelens.llm import queries

    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op10_exact_dedup"](spark, folder).toPandas()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = db.execute(queries.ORACLES["op10_exact_dedup"]).df()
    order = lambda d: d[sorted(d.columns)].sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
    assert importlib.util.find_spec("public_tokenizers")
