"""Small fixtures shared by the tests of the operators."""

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    """A documents table of the given texts; ids count from 0 unless given."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOC_SCHEMA)


def save(df, tmp_path, name="documents"):
    """Write ``df`` as a table folder and return the data folder."""
    df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
