"""Long texts reach Python a few megabytes at a time."""

from pyspark.sql import functions as F

from locuslens.session import BATCH_BYTES, table


def test_batches_of_long_texts_are_bounded(spark, tmp_path):
    spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 160).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for b in batches:
            import pyarrow as pa

            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["bytes", "rows"])

    seen = table(spark, str(tmp_path), "documents", deal=False).coalesce(1).mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r.rows for r in seen) == 3000 and max(r.bytes for r in seen) < 2 * BATCH_BYTES
