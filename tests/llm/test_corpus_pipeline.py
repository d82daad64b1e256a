"""The pipeline stage by stage against plain versions, and as a whole."""

import corpus_pipeline as cp
from helpers import SF_MID, documents, save
from test_secrets import plain as plain_secrets
from test_simhash import plain_components, plain_fingerprint
from test_tokens import check_packing


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_in_order_on_the_whole_table(spark, tmp_path):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality", "near_duplicates", "secrets", "packing"]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    seen = []
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_MID)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs)
    all_docs = texts(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    mild, good, single, masked = (texts(d) for d in seen[:4])
    known = [i for i in all_docs if i in labels]
    clean = [i for i in known if not labels[i].toxic]
    assert sum(i in mild for i in clean) / len(clean) > 0.98
    assert sum(i in mild for i in known if labels[i].toxic) / sum(labels[i].toxic for i in known) < 0.35
    fine = [i for i in known if i in mild and labels[i].quality == 1]
    assert sum(i in good for i in fine) / len(fine) > 0.99
    prints = {i: plain_fingerprint(t) for i, t in good.items()}
    group, least = plain_components(prints.values()), {}
    for i in sorted(prints):
        least.setdefault(group[prints[i]], i)
    assert single == {i: good[i] for i in least.values()}
    assert masked.keys() == single.keys()
    for i, t in single.items():
        assert (masked[i] == t) == (plain_secrets(t)[4] == "")
    check_packing(seen[4].collect(), masked)
    whole = sorted(map(tuple, cp.run(spark, SF_MID).select("doc_id", "start", "length", "ids_crc32").collect()))
    assert whole == sorted(map(tuple, seen[4].select("doc_id", "start", "length", "ids_crc32").collect()))


def test_nulls_repeats_clashes_and_empty_tables(spark, tmp_path):
    rows = ["a plain text of some words here", "a plain text of some words here", None, "", "token = abcdefgh and more"] * 2
    docs = documents(spark, rows, [1, 2, 3, None, 4, 1, None, None, 5, 6])
    clash = ("score", "predicted", "fp", "kind", "group", "__nth", "__judged", "__predicted", "__score", "__held_out", "__votes",
             "__posterior", "__toxic", "__id")
    for c in clash:
        docs = docs.withColumn(c, docs.lang)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, data in (("some", docs), ("none", docs.limit(0))):
        folder = save(data, tmp_path / name)
        save(labels, tmp_path / name, "labels")
        now = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, run in cp.STAGES:
            then = run(spark, now, folder)
            if stage != "packing":
                assert then.columns == now.columns
                assert all(r[c] == "en" for r in then.collect() for c in clash)
            then.write.parquet(f"{tmp_path}/{name}-{stage}")
            now = spark.read.parquet(f"{tmp_path}/{name}-{stage}")
        assert (now.count() > 0) == (name == "some")
    kept = spark.read.parquet(f"{tmp_path}/some-near_duplicates").collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids
