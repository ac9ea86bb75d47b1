"""Document parsers and file sources on inline fixtures."""

import os

from pyspark.sql import functions as F

from rivulet.sources import documents as DOC
from rivulet.sources import files as FS
from tests.conftest import rows

# The verb addresses of the activity schema.
VERB = "http://activitystrea.ms/schema/1.0/"


def _entry(ident, when, verb, *, title=None, labels=(), link=None, content="text"):
    """An invented feed entry."""
    parts = [f"<verb>{verb}</verb>", f"<id>{ident}</id>",
             f"<object><content>{content}</content></object>", f"<published>{when}</published>"]
    parts += [f"<title>{title}</title>"] if title else []
    parts += [f'<category term="{t}"{x}/>' for t, x in labels]
    parts += [f'<link rel="alternate" href="{link}"/>'] if link else []
    return f"<entry>{''.join(parts)}</entry>"


SHARED = _entry("a-1", "2021-03-04T05:06:07+00:00", VERB + "post", title="a kite was shared",
                labels=[("K", ' label="Kite"'), ("S", ' label="Shared"')],
                link="http://kites.example/1", content="red &amp; blue")
REMOVED = _entry("a-2", "2021-03-04T05:06:08Z", VERB + "delete", title="a kite was removed",
                 labels=[("KiteDeleted", ' label="Kite Deleted"')])
NO_LINK = _entry("a-3", "2021-03-04T05:06:09.500Z", "post", labels=[("NoLabel", "")], content="y")
BROKEN = SHARED[:60]
START = 1614834367000  # 2021-03-04T05:06:07Z


def test_xml_entries(spark):
    df = spark.createDataFrame([(d,) for d in [SHARED, REMOVED, NO_LINK, BROKEN]], "str string")
    got = rows(DOC.parse_xml_entries(df), "id", "category", "content", "published")
    assert got == [("a-1", "Kite", "red & blue", START), ("a-3", None, "y", START + 2500)]
    feed = rows(DOC.xml_feed_events(df), "id", "message")
    assert feed == [("a-1", "a kite was shared ---> http://kites.example/1"),
                    ("a-2", "a kite was removed ---> ???"), ("a-3", "null ---> ???")]


def test_feed_documents_have_many_entries(spark):
    root = f'<results refreshURL="http://next.example/7">{SHARED}{NO_LINK}</results>'
    df = spark.createDataFrame([(root,), ("<results refreshURL='x'></results>",), (root[:90],)],
                               "str string")
    got = rows(DOC.xml_feed_documents(df), "refresh_url", "id", "message")
    assert got == [("http://next.example/7", "a-1", "a kite was shared ---> http://kites.example/1"),
                   ("http://next.example/7", "a-3", "null ---> ???")]


def test_feed_to_bus_is_configured(spark):
    from rivulet.sinks.files import feed_to_bus

    class Recorder:
        def __init__(self):
            self.made = {}

        def format(self, name):
            self.made["format"] = name
            return self

        def option(self, key, value):
            self.made[key] = value
            return self

    import rivulet.sinks.files as SK

    made = Recorder()
    frame = type("Frame", (), {"isStreaming": True, "writeStream": made,
                               "select": lambda self, *c: self})()
    SK.bus_sink(frame, "host:9092", "feed", "message", "/ck")
    assert made.made == {"format": "kafka", "kafka.bootstrap.servers": "host:9092",
                         "topic": "feed", "checkpointLocation": "/ck"}
    docs = spark.createDataFrame([("<results></results>",)], "str string")
    assert type(feed_to_bus(docs, "host:9092", "feed")).__name__ == "DataFrameWriter"


def test_json_entries(spark):
    docs = ['{"id": "1", "postedTime": "2021-03-04T05:06:07.000Z", "object": {"summary": "quake!"}}',
            '{"id": "2", "postedTime": "2021-03-04T05:06:07+00:00", "object": {"summary": "hi"}}',
            '{"id": "3", "postedTime": "not a time", "object": {"summary": "bad time"}}',
            '{"id": "4", "object": {}}',
            '{"id": "5", "postedTime": "2021-03-04T05:06:07Z", "object": {"summary": "cut',
            'null']
    df = spark.createDataFrame([(d,) for d in docs], "str string")
    assert rows(DOC.parse_json_entries(df)) == [("1", "quake!", START), ("2", "hi", START)]


def test_rss_items(spark):
    doc = ("<rss><channel><title>x</title>"
           "<item><title>flat $ 900</title><link>http://l/1</link></item>"
           "<item><title>room $1200 400 sqft</title><link>http://l/2</link></item>"
           "</channel></rss>")
    one = "<rss><channel><item><title>solo</title><link>http://l/3</link></item></channel></rss>"
    df = spark.createDataFrame([("boston", doc), ("nyc", one)], "city string, xml string")
    assert rows(DOC.rss_items(df)) == [
        ("boston", "flat $ 900", "http://l/1", "boston"),
        ("boston", "room $1200 400 sqft", "http://l/2", "boston"),
        ("nyc", "solo", "http://l/3", "nyc")]


def test_line_scan_and_order(spark, tmp_dir):
    p = os.path.join(tmp_dir, "lines.txt")
    with open(p, "w") as f:
        f.write("first\n\nthird line\n")
    assert [r["line"] for r in FS.line_scan(spark, p).collect()] == ["first", "", "third line"]
    ordered = FS.with_line_order(spark.read.text(p)).orderBy("_pos").collect()
    assert [r["value"] for r in ordered] == ["first", "", "third line"]


def test_records_of_the_wrong_width_go_to_their_place(spark, tmp_dir):
    p = os.path.join(tmp_dir, "w.csv")
    with open(p, "w") as f:
        f.write('a;b\n1;2;3\n"";x\nonly\n;\n"q;1";"say ""hi"""\n1;2;3;4\n')
    # Empty fields are empty strings, a doubled quote is one.
    assert rows(FS.csv_scan(spark, p, ";", header=True)) == [("", ""), ("", "x"), ("q;1", 'say "hi"')]
    place = os.path.join(tmp_dir, "rejects")
    got = FS.csv_scan(spark, p, ";", header=True, rejects=place)
    assert got.columns == ["a", "b"] and got.count() == 3  # whatever columns are read
    assert rows(got.select("b")) == [("",), ('say "hi"',), ("x",)]
    assert rows(FS.csv_rejects(spark, p, ";", header=True), "line") == [("1;2;3",), ("1;2;3;4",), ("only",)]
    assert rows(spark.read.parquet(place).select("line", F.col("fields")[0].alias("f"))) == [
        ("1;2;3", "1"), ("1;2;3;4", "1"), ("only", "only")]
    plain = FS.csv_scan(spark, p, ";")
    assert plain.columns == ["field_0", "field_1"] and plain.count() == 4  # the header is a row
    assert FS.csv_scan(spark, p, ";", fields=["x", "y", "z"]).columns == ["x", "y", "z"]
    assert rows(FS.csv_scan(spark, p, ";", fields=3)) == [("1", "2", "3")]


def _read_in_file_order(path):
    out = []
    for name in sorted(n for n in os.listdir(path) if n.startswith("part-")):
        with open(os.path.join(path, name)) as f:
            out.append(f.read())
    return "".join(out)


def test_reports_read_in_file_order_equal_a_plain_one(spark, tmp_dir):
    from rivulet.sinks import reports as RP

    ranked = [(f"city{c:02d}", r, 100 * r + c, f"flat {c}-{r}", f"http://l/{c}/{r}")
              for c in range(40) for r in range(1, 1 + c % 4 + 1)]
    df = spark.createDataFrame(ranked, "city string, rank int, price int, title string, link string")
    path = os.path.join(tmp_dir, "top")
    RP.write_report(RP.topn_report(df.repartition(7), "ByPrice"), ["city", "rank", "part"], path)
    want = ""
    for city in sorted({r[0] for r in ranked}):
        want += f"\n**************************\n [{city}] for ByPrice\n"
        for c, _, price, title, link in (r for r in ranked if r[0] == city):
            want += f"[{c}], ByPrice: [{price}]  with title [{title}] and link [{link}].\n"
    assert _read_in_file_order(path) == want
    assert [r["line"] for r in FS.numbered_lines(spark, path).orderBy("line_no").collect()] == (
        want.splitlines())
    counts = [(f"k{k}", f"hello {k}", k % 3) for k in range(60)]
    df = spark.createDataFrame(counts, "key string, hello string, count int").repartition(5)
    path = os.path.join(tmp_dir, "counts")
    RP.write_report(RP.count_report(df, "key", "hello"), ["key"], path)
    assert _read_in_file_order(path) == "".join(
        f'[{n:3d}] people said "[{h}]" (Hello!) in [{k}].\n' for k, h, n in sorted(counts))


def test_lines_are_numbered_across_blocks(spark, tmp_dir):
    want = []
    for k in range(3):
        lines = [f"file {k} line {n}" + "x" * (n % 50) for n in range(400)]
        with open(os.path.join(tmp_dir, f"part-{k}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
        want += lines
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = FS.numbered_lines(spark, tmp_dir).orderBy("line_no").collect()
        assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["line"] for r in got] == want and got[-1]["line_no"] == len(want)


def test_bus_source_is_configured():
    from rivulet.streaming.sources import bus_stream

    class Reader:
        made = {}

        def format(self, name):
            self.made["format"] = name
            return self

        def option(self, key, value):
            self.made[key] = value
            return self

        def load(self):
            return self

        def select(self, *cols):
            self.made["columns"] = len(cols)
            return self

    reader = Reader()
    bus_stream(type("Session", (), {"readStream": reader})(), "host:9092", "prices")
    assert reader.made == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "columns": 4,
                           "subscribe": "prices", "startingOffsets": "earliest"}


def test_landed_feed_files_and_the_console(spark, tmp_dir):
    from rivulet.sinks.files import console_sink
    from rivulet.streaming import operators as SO
    from rivulet.streaming import sources as SS

    land = os.path.join(tmp_dir, "feed")
    os.makedirs(land)
    with open(os.path.join(land, "1.xml"), "w") as f:
        f.write(f"<results>{SHARED}{NO_LINK}</results>")
    stream = SS.xml_entry_stream(spark, land, "id string, published string")
    out = os.path.join(tmp_dir, "out")
    SO.run_available(stream.writeStream.format("parquet").option("path", out)
                     .option("checkpointLocation", os.path.join(tmp_dir, "ck")))
    assert rows(spark.read.schema("id string, published string").parquet(out), "id") == [
        ("a-1",), ("a-3",)]
    query = SO.run_available(console_sink(stream).option("checkpointLocation",
                                                         os.path.join(tmp_dir, "ck2")))
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
