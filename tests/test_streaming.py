"""Row-wise operators on a file stream equal the same operators in batch."""

import os
import tempfile

from shelfwise.config import PipelineConfig
from shelfwise.streaming import rowwise as RW
from tests.conftest import rows


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="shelfwise-stream-src-")
    data = [("The A: 1", 15.0, 3, "Default", "yes", 4), ("B (2)", 45.0, 5, "Poetry", "no", 20),
            ("C", 99.0, 9, None, None, None)]
    schema = "title string, price double, rating int, category string, availability string, stock int"
    for i, r in enumerate(data):   # three files -> several micro-batches
        spark.createDataFrame([r], schema).write.mode("overwrite").parquet(os.path.join(src, f"part{i}"))
    batch = RW.row_features(spark.read.parquet(f"{src}/part*"), PipelineConfig())
    stream = RW.file_stream(spark, f"{src}/part*", spark.read.parquet(f"{src}/part*").schema,
                            max_files_per_trigger=1)
    out = RW.run_available_now(stream, lambda df: RW.row_features(df, PipelineConfig()), name="test")
    streamed = spark.read.parquet(out)
    assert sorted(rows(streamed), key=str) == sorted(rows(batch.select(*streamed.columns)), key=str)
    got = {r["title"]: r for r in streamed.collect()}
    assert got["The A: 1"]["category"] == "Outros" and got["The A: 1"]["availability"] == 1
    assert got["C"]["rating_category"] is None and got["C"]["stock_level"] == "Alto"


def test_single_file_glob():
    assert RW.single_file_glob("/d/events.parquet") == "/d/events.parque[t]"


def test_stream_features_to_table(spark):
    src = tempfile.mkdtemp(prefix="shelfwise-stream-src2-")
    spark.createDataFrame([("A (1)", 19.0)], "title string, price double").write.parquet(f"{src}/p0")
    out = RW.stream_features_to_table(spark, f"{src}/p*", spark.read.parquet(f"{src}/p0").schema)
    r = out.first()
    assert (r["price_range"], r["has_series"], r["has_numbers"]) == ("Baixo", True, True)
