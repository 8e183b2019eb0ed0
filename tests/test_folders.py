"""Tables that are folders of files."""

import pytest

from recallset.registry import fixtures as fx
from recallset.registry import queries as registered


@pytest.mark.parametrize("files", [1, 3])
def test_stream_reads_a_folder_of_files(spark, folder, files):
    for name in ("embeddings", "documents", "supplier", "region"):
        spark.createDataFrame([], fx.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet", mode="overwrite")
    vectors = [(n, [float(n + i) for i in range(fx.DIMENSIONS)], n % 10) for n in range(7)]
    rows = spark.createDataFrame(vectors, fx.SCHEMAS["embeddings"]).repartition(files)
    rows.write.parquet(f"{folder}/embeddings.parquet", mode="overwrite")
    got = {r["id"]: (r["v1"], r["content"]) for r in registered.stream_ingest(spark, folder).collect()}
    assert got == {str(n): (float(n + fx.DIMENSIONS - 1), f"label {n % 10}") for n in range(7)}
