from tidewell.llm import multi_index


def test_a_short_vector_in_front_does_not_set_the_dimension(spark):
    rows = [(0, [1.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.25, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = multi_index.search(vectors, vectors.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(20, 1, 1, 0.5), (20, 2, 2, 0.25)]
