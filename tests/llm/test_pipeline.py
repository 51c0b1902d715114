"""The pipeline, stage by stage, on a small fixture against brute force."""

import hashlib

import corpus_pipeline
import __spark_entry__ as entry
from ledgerline.llm.common import stage

from .edge import documents, rows_of, texts, words
from .test_text_operators import brute_hits, brute_near


def write(spark, folder):
    foul = [(k, " ".join(words(k, 30) + (["nastyword"] if k % 2 else []) + words(k + 900, 30))) for k in range(200, 260)]
    rows = [r for r in texts() if r[0] != 14] + foul + [(500, 'token = "abcdefgh12345"'), (501, "text " + " ".join(words(71, 20)))]
    items = [(1, " ".join(words(71, 20)[3:15])), (2, None)]
    tables = {"documents": documents(spark, rows),
              "labels": spark.createDataFrame([(k, 1, k % 2) for k, _ in foul], "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame(items, "item_id long, text string")}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return rows, items


def test_every_stage_matches_brute_force(spark, tmp_path):
    rows, items = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, now = docs.columns, rows
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), f"test-{name}")
        if name == "toxicity":
            now = [(i, t) for i, t in now if "nastyword" not in (t or "")]
        elif name == "near_duplicates":
            gone = {x[0] for x in brute_near(now, 5, 80, 100) if not x[3]}
            assert gone >= {2, 3, 13}
            now = [(i, t) for i, t in now if i not in gone and (i is not None or t != texts()[0][1])]
        elif name == "decontamination":
            now = [r for r in now if not brute_hits([r], items)[0][5]]
            assert 501 not in dict(now)
        elif name == "secrets":
            now = [(i, 'token = "[SECRET]"' if i == 500 else t) for i, t in now]
        if name != "mixing":
            assert docs.columns == columns
            assert sorted(map(repr, now)) == sorted(repr((r.doc_id, r.text)) for r in docs.collect())
    got = docs.collect()
    assert {r.doc_id for r in got} <= {i for i, _ in now} and docs.columns == columns + ["mix_copy", "mix_key"]
    assert [r.mix_key for r in got] == sorted(r.mix_key for r in got)
    assert len(hashlib.sha256(repr(got).encode()).hexdigest()) == 64


def test_run_equals_the_stages_and_is_repeatable(spark, tmp_path):
    write(spark, tmp_path)
    assert rows_of(corpus_pipeline.run(spark, str(tmp_path))) == rows_of(corpus_pipeline.run(spark, str(tmp_path)))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    write(spark, tmp_path / "full")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
