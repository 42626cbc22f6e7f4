import numpy as np

from traceloom.operators import clustering as K


def test_kmeans_with_tasks_without_rows(spark):
    rows = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [9.0, 9.0])], "id int, v array<double>").repartition(7)
    centroids, labelled = K.kmeans(rows, "v", np.array([[0.0, 0.0], [8.0, 8.0]]), most_rounds=5)
    assert centroids.tolist() == [[0.5, 0.0], [9.0, 9.0]]
    assert {r.id: r.cluster for r in labelled.collect()} == {0: 0, 1: 0, 2: 1}
