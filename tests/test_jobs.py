"""The jobs from the command line's side, with folders of text as topics."""

import json
import os

import pytest

from cartstream.jobs import main
from cartstream.schemas import ITEMS, TABLE_SCHEMAS
from cartstream.sources import KafkaTopic, Lake, read_quarantine, read_table
from cartstream.streaming import read_live

USER = {"user_id": "u1", "name": "A B", "email": "a@x", "location": "Pune, MH"}
MESSAGES = {
    "users": [{**USER, "registered_at": "2025-01-02 10:00:00"}, "junk"],
    "clickstream": [
        {"user_id": "u1", "session_id": "s1", "timestamp": "2025-01-02 10:00:01", "page": page}
        for page in ("/home", "/cart", "/home")
    ],
    "transactions": [
        {
            "user_id": "u1",
            "session_id": "s1",
            "transaction_id": "t1",
            "timestamp": "2025-01-02 10:05:00",
            "transaction_amount": 250000.0,
            "payment_status": "successful",
            "products": [
                {"product_id": "p", "quantity": 2, "unit_price": 125000.0, "product_category": "Toys"}
            ],
        }
    ],
}


@pytest.fixture()
def shop(spark, folder):
    """Lines published to topics, then one pass of the ingest job."""
    for topic, messages in MESSAGES.items():
        lines = f"{folder}/lines-{topic}.txt"
        with open(lines, "w") as file:
            for message in messages:
                file.write((message if isinstance(message, str) else json.dumps(message)) + "\n")
        main(["publish", topic, lines, "--text", f"{folder}/topics"], spark)
    run = ["ingest", "--lake", f"{folder}/lake", "--text", f"{folder}/topics", "--live"]
    main(run, spark)
    main(run, spark)
    return folder


def test_ingest_and_ask(spark, shop, capsys):
    lake = Lake(f"{shop}/lake")
    counts = {table: read_table(spark, lake, table).count() for table in TABLE_SCHEMAS}
    assert counts == {"users": 1, "clickstream": 3, "transactions": 1, ITEMS: 1}
    assert read_quarantine(spark, lake, "users").first().message == "junk"
    assert sorted(map(tuple, read_live(spark, lake, "top_pages").collect())) == [
        ("/cart", 1),
        ("/home", 2),
    ]
    assert read_live(spark, lake, "new_users_today").first()[0] == 0
    assert read_live(spark, lake, "revenue_by_category").first()[:] == ("Toys", 2.5)

    capsys.readouterr()
    main(["journey", "--lake", lake.root], spark)
    text = capsys.readouterr().out
    assert "3 journeys" in text and "txn_timestamp" in text and "250000.0" in text

    main(["panel", "revenue_today", "--lake", lake.root, "--as-of", "2025-01-02"], spark)
    assert "|2.5" in capsys.readouterr().out
    main(["panel", "revenue_today", "--lake", lake.root], spark)
    assert "|0.0" in capsys.readouterr().out

    main(["read-topic", "users", "--text", f"{shop}/topics", "--rows", "5"], spark)
    assert "junk" in capsys.readouterr().out
    main(["read-topic", "users", "--text", f"{shop}/topics", "--target", f"{shop}/all"], spark)
    assert spark.read.text(f"{shop}/all").count() == 2

    target = f"{shop}/compact"
    main(["compact", "users", "--lake", lake.root, "--target", target, "--target-period", "month"], spark)
    assert read_table(spark, Lake(target, "month"), "users").count() == 1
    assert os.path.isdir(f"{target}/tables/users/status=ok/event_month=2025-01-01")


def test_kafka_options():
    """What would be asked of a broker; none is started here."""
    from unittest.mock import MagicMock

    topic = KafkaTopic("b:9092", "users", options={"minPartitions": "64"})
    spark = MagicMock()
    topic.stream(spark)
    topic.read(spark)
    for reader, starting in ((spark.readStream, "latest"), (spark.read, "earliest")):
        names = [call for call in reader.mock_calls if ".option(" in str(call)]
        assert f"'startingOffsets', '{starting}'" in str(names)
        assert "'subscribe', 'users'" in str(names) and "minPartitions='64'" in str(names)


def test_a_panel_may_read_the_database(spark, folder, capsys):
    """The table a database would give is a Spark frame like any other."""
    from unittest.mock import MagicMock

    with open(f"{folder}/jdbc.json", "w") as file:
        json.dump({"url": "jdbc:x", "user": "u", "password": "p", "driver": "d"}, file)
    session = MagicMock()
    reader = session.read.jdbc
    reader.return_value = spark.createDataFrame([("/a",), ("/a",), ("/b",)], "page string")
    main(["panel", "top_pages", "--jdbc-options", f"{folder}/jdbc.json"], session)
    assert reader.call_args.args == ("jdbc:x", "clickstream")
    assert "|/a  |2     |" in capsys.readouterr().out


def test_a_source_must_be_named(spark):
    with pytest.raises(SystemExit):
        main(["ingest", "--lake", "x"], spark)
