import corpus_pipeline
import numpy as np

from tidewell.llm import quality_classifier as qc
from tidewell.llm import queries


def test_all_of_the_bounded_sample_is_fitted_on(spark, tmp_path, monkeypatch):
    rows = spark.range(10_300).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    rows.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    fitted = []

    def fit(rows, columns, values, grades, levels, width):
        fitted.append(len(grades))
        return np.zeros(width), np.full(levels - 1, -35.0)

    monkeypatch.setattr(qc, "fit_ordinal", fit)
    queries.op5_quality_classifier(spark, str(tmp_path))
    corpus_pipeline.keep_good(spark, rows, str(tmp_path))
    assert fitted == [8000, 8000]
