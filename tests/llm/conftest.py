import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark, tmp_path):
    """Makes a documents table from (doc_id, text[, lang]); sets the shared folder where it is unset."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1]) if r[1] else 0) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:  # names that an operator might use itself
            from pyspark.sql import functions as F

            df = df.select("*", F.lit(1).alias("score"), F.lit("x").alias("spans"), F.lit(2).alias("fp"), F.lit("y").alias("_c0"))
        return df

    return make
