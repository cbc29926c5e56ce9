import hashlib
import json

import pytest
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.plans.jobs import land
from broadsheet.plans.lake import Lake
from broadsheet.sources import envelope as E
from broadsheet.sources import feeds

AS_OF = "2024-03-01 10:00:00"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


RSS = """<?xml version="1.0"?><rss><channel><title>Feed</title>
<item><title>Cats &amp; dogs</title><link>http://x/1</link>
<description>&lt;b&gt;Bold&lt;/b&gt; news</description><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item>
<item><title>No summary</title><link>http://x/2</link></item>
</channel></rss>"""


@pytest.fixture
def rss_dir(tmp_path):
    (tmp_path / "alpha.xml").write_text(RSS)
    (tmp_path / "beta.xml").write_text(RSS.replace("Cats", "Birds"))
    return str(tmp_path)


def test_rss(spark, rss_dir):
    names = spark.createDataFrame([("alpha.xml", "Alpha")], "feed STRING, source STRING")
    items = feeds.name_feeds(feeds.read_rss(spark, rss_dir), names)
    rows = {(r.source, r.url): r for r in feeds.rss_items(items, AS_OF).collect()}
    assert len(rows) == 4
    first = rows["Alpha", "http://x/1"]
    assert first.title == "Cats & dogs"
    assert first.content == "<b>Bold</b> news"
    assert first.id == md5("Cats & dogs<b>Bold</b> news")
    assert first.source_type == "rss" and first.author is None and first.label is None
    assert first.published_date == "Mon, 01 Jan 2024 10:00:00 GMT"
    assert str(first.ingestion_timestamp) == AS_OF
    assert json.loads(first.raw_data)["title"] == "Cats & dogs"
    second = rows["Alpha", "http://x/2"]
    assert second.content == "" and second.published_date == "" and second.id == md5("No summary")
    assert ("unknown", "http://x/1") in rows


def test_rss_as_a_stream(spark, rss_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("rss"))
    items = feeds.read_rss(spark, rss_dir, streaming=True).withColumn("source", F.lit("s"))
    q = (
        feeds.rss_items(items, AS_OF)
        .writeStream.format("parquet")
        .option("checkpointLocation", out + "/c")
        .trigger(availableNow=True)
        .start(out + "/t")
    )
    q.awaitTermination(60)
    assert spark.read.parquet(out + "/t").count() == 4


def test_news_api(spark, tmp_path):
    articles = [
        {"source": {"name": "Wire"}, "title": "T1", "description": "D1", "content": "C1", "url": "u1",
         "publishedAt": "2024-01-01T00:00:00Z", "author": "A", "urlToImage": "i"},
        {"source": {}, "title": "T2", "description": "D2", "content": None, "url": "u2"},
        {"title": "T3", "description": None, "url": "u3"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"articles": articles}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"articles": []}))
    rows = {r.url: r for r in feeds.api_articles(
        feeds.read_news_api(spark, str(tmp_path), multi_line=True), AS_OF).collect()}
    assert len(rows) == 3
    assert rows["u1"].id == md5("T1D1") and rows["u1"].content == "C1" and rows["u1"].source == "Wire"
    assert rows["u1"].image_url == "i" and rows["u1"].author == "A"
    assert rows["u2"].content == "D2" and rows["u2"].source == "unknown" and rows["u2"].author == ""
    assert rows["u3"].content == "" and rows["u3"].id == md5("T3") and rows["u3"].source == "unknown"
    assert rows["u3"].published_date == "" and rows["u3"].image_url == ""


def test_social(spark, tmp_path):
    posts = [
        {"id": "1", "text": "hello", "author": "ann", "likes": 3},
        {"id": "2", "body": "from body", "user": {"username": "bob"}, "title": "t", "created_at": "now"},
        {"id": "3"},
    ]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(p) for p in posts))
    rows = {r.id: r for r in feeds.social_posts(feeds.read_social(spark, str(tmp_path)), "forum").collect()}
    one, two, three = (rows[md5(f"forum{i}")] for i in (1, 2, 3))
    assert one.content == "hello" and one.author == "ann" and one.engagement.likes == 3
    assert one.engagement.shares == 0 and one.source == "forum"
    assert two.content == "from body" and two.author == "bob" and two.title == "t"
    assert three.content == "" and three.author == "" and three.engagement.comments == 0
    assert one.ingestion_timestamp is not None


def test_labelled_csv(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('title,text,verdict\n"A, b","line one\nline ""two""",fake\nB,,real\n')
    rows = {r.title: r for r in feeds.labelled_articles(
        feeds.read_labelled_csv(spark, str(path), multi_line=True), "verdict", AS_OF).collect()}
    assert rows["A, b"].content == 'line one\nline "two"' and rows["A, b"].label == "fake"
    assert rows["A, b"].id == md5('A, bline one\nline "two"')
    assert rows["B"].content == "" and rows["B"].id == md5("B") and rows["B"].label == "real"
    assert rows["B"].source == "training_dataset" and rows["B"].source_type == "labeled_data"


def test_labelled_csv_with_content_column(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("title,content,label\nA,body,real\n")
    row = feeds.labelled_articles(feeds.read_labelled_csv(spark, str(path))).first()
    assert row.content == "body" and row.id == md5("A")


def test_union_publish_and_read_back(spark, tmp_path):
    a = E.to_envelope(spark.createDataFrame([("1", "x", "news_api")], "id STRING, source STRING, source_type STRING"), AS_OF)
    b = spark.createDataFrame([("2", "y")], "id STRING, source STRING")
    both = E.union_sources(a, b)
    assert both.count() == 2 and both.columns == S.ENVELOPE.names
    E.publish(both, path=str(tmp_path / "topic"))
    messages = spark.read.json(str(tmp_path / "topic")).collect()
    assert {m.key for m in messages} == {"1", "2"}
    assert json.loads(next(m.value for m in messages if m.key == "1"))["source"] == "x"
    counts = {(r.source, r.source_type): r.n for r in E.ingest_counts(both).collect()}
    assert counts == {("x", "news_api"): 1, ("y", None): 1}


def test_broken_records_go_to_quarantine_and_whole_ones_keep_their_text(spark, tmp_path):
    whole = '{"id": "1", "text": "hello", "reach": {"views": 7}}'
    (tmp_path / "posts.json").write_text(whole + '\n{"id": "2", "te\n\n')
    lake = Lake(str(tmp_path / "lake"))
    posts = feeds.read_social(spark, str(tmp_path / "posts.json"))
    land(posts, lambda p: feeds.social_posts(p, "forum", AS_OF), lake, "forum", 0, AS_OF)
    (row,) = lake.read(spark, "bronze").collect()
    assert row.raw_data == whole and row.id == md5("forum1")
    assert [r.value for r in lake.read(spark, "quarantine").collect()] == ['{"id": "2", "te']


def test_articles_keep_fields_without_a_column(spark, tmp_path):
    article = {"title": "T", "description": "D", "section": {"name": "World"}}
    (tmp_path / "a.json").write_text(json.dumps({"articles": [article]}) + "\nnot json\n")
    read = feeds.read_news_api(spark, str(tmp_path))
    (row,) = feeds.api_articles(read, AS_OF).collect()
    assert json.loads(row.raw_data) == article
    assert [r.value for r in E.broken(read.cache()).collect()] == ["not json"]


def test_rss_keeps_elements_without_a_column(spark, tmp_path):
    extra = RSS.replace("<link>http://x/2</link>", "<link>http://x/2</link><guid>g-2</guid>")
    (tmp_path / "f.xml").write_text(extra)
    items = feeds.read_rss(spark, str(tmp_path)).withColumn("source", F.lit("s"))
    rows = {r.url: r.raw_data for r in feeds.rss_items(items, AS_OF).collect()}
    assert "g-2" in rows["http://x/2"] and "g-2" not in rows["http://x/1"]


def test_a_batch_without_good_records_leaves_a_readable_table(spark, tmp_path):
    (tmp_path / "posts.json").write_text("broken\n")
    lake = Lake(str(tmp_path / "lake"))
    posts = feeds.read_social(spark, str(tmp_path / "posts.json"))
    land(posts, lambda p: feeds.social_posts(p, "forum", AS_OF), lake, "forum", 0, AS_OF)
    assert lake.read(spark, "bronze").count() == 0
