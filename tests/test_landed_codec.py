"""How landed files are compressed."""

from pathlib import Path

import pytest

from cartstream.schemas import ITEMS, TOPICS
from cartstream.sources import Lake, TextTopic, read_table
from cartstream.streaming import AVAILABLE_NOW, ingest
from cartstream.streaming.ingest import start_items, start_landing

LINE = (
    '{"transaction_id":"T%d","timestamp":"2025-01-01 10:00:00","products":'
    '[{"product_id":"P%d","quantity":2,"unit_price":1.5,"product_category":"c"}]}'
)


@pytest.mark.parametrize("own", [None, "gzip"])
def test_landed_files_take_little_space(spark, folder, own):
    topic, lake = TextTopic(f"{folder}/topic"), Lake(f"{folder}/lake")
    topic.publish(spark.createDataFrame([(LINE % (n, n),) for n in range(50)], "value string"))
    if own:
        spark.conf.set(ingest.CODEC_SETTING, own)
    try:
        start_landing(spark, TOPICS["transactions"], topic, lake, AVAILABLE_NOW).awaitTermination()
        start_items(spark, lake, AVAILABLE_NOW).awaitTermination()
    finally:
        spark.conf.unset(ingest.CODEC_SETTING)
    for table in ("transactions", ITEMS):
        files = [path.name for path in Path(lake.table(table)).rglob("part-*.parquet")]
        suffix = {None: ".zstd.parquet", "gzip": ".gz.parquet"}[own]
        assert files and all(name.endswith(suffix) for name in files)
        rows = read_table(spark, lake, table).select("transaction_id").collect()
        assert sorted(int(row[0][1:]) for row in rows) == [*range(50)]
