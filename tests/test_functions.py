from conftest import rows
from docloom.functions import filters, metadata, text
from docloom.schemas import EXPORT_FIELDS, EXPORT_RENAMES, EXPORT_SCHEMA, ISO_PATTERN, METADATA
from docloom.sources import readers
from docloom.staging import scratch_path
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one(spark, column, *values, types=None):
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types or ["string"] * len(values)))
    return spark.createDataFrame([values], schema).select(column).first()[0]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], T.StructType([T.StructField(n, T.IntegerType()) for n in (
        "doc_control_unit__c.name__v", "id", "name__v", "x__v__v")]))
    assert metadata.normalise_names(df).columns == ["doc_control_unit__c_name", "id", "name", "x__v"]


def test_every_rename_has_an_export_field():
    normal = {f.replace(".", "_").removesuffix("__v") for f in EXPORT_FIELDS}
    derived = {"dst_path", "batch_id"}
    # The nested product name keeps its inner suffix.
    assert set(EXPORT_RENAMES) - derived <= normal
    assert set(EXPORT_RENAMES.values()) <= set(METADATA.names)


def test_paths(spark):
    for path, wanted in (("/a/b.c.pdf", "pdf"), ("/a/b", "/a/b"), ("x.", "")):
        assert one(spark, metadata.extension(F.col("c0")), path) == wanted
    assert one(spark, metadata.composite_path(F.col("c0"), F.col("c1")), "5", None) is None
    at = F.lit("2024-02-03 04:05:06").cast("timestamp")
    assert one(spark, metadata.landing_prefix(at), "x") == "landing/2024_02_03_04_05_06"


def test_batches_are_stable_and_complete(spark):
    ids = spark.range(2000).withColumn("b", metadata.batch_number(F.col("id"), 20))
    first = rows(ids)
    assert first == rows(ids.repartition(5)) and {b for _, b in first} == set(range(20))


def test_iso_timestamps(spark):
    read = metadata.iso_timestamp(F.col("c0"), ISO_PATTERN)
    assert str(one(spark, read, "2024-01-02T03:04:05.678Z")) == "2024-01-02 03:04:05.678000"
    assert one(spark, read, "2024-01-02") is None and one(spark, read, None) is None


def test_align(spark):
    df = spark.createDataFrame([("x", "7", "true"), ("y", "seven", None)], "extra string, size string, is_latest_version string")
    out = metadata.align(df, METADATA, reject="bad")
    assert out.columns == ["size", "is_latest_version", "bad"]
    assert rows(out) == [(None, None, True), (7, True, False)]


META = "document_number string, doc_control_name string, document_type string, document_subtype string, status string"


def test_filters(spark):
    df = spark.createDataFrame([
        ("1", "O'Brien", "Memo", "A", "Approved"), ("2", "O'Brien", "Memo", "B", "Draft"),
        ("3", "Ünit", "Plan", "A", "Approved"), ("4", "Other", "Plan", "C", "Effective"),
    ], META)

    def kept(spec):
        return [r[0] for r in rows(df.filter(spec.predicate()), "document_number")]

    rule = filters.TypeRule
    assert kept(filters.FlatFilter()) == ["1", "2", "3", "4"]
    assert kept(filters.FlatFilter(numbers=())) == []
    assert kept(filters.FlatFilter(units=("O'Brien",), statuses=("Approved",))) == ["1"]
    assert kept(filters.FlatFilter(types=(rule("Memo"), rule("Plan", ("B", "C"))))) == ["1", "2", "4"]
    nested = filters.UnitFilter({"O'Brien": [rule("Memo", ("A", "B"))], "Ünit": [rule("Plan", ("A",))]}, ("Approved",))
    assert kept(nested) == ["1", "3"]
    assert kept(filters.UnitFilter({}, ("Approved",))) == []
    for spec, wanted in (({"status": "Draft"}, ["2"]), ({"status": ["Draft", "Effective"], "doc_control_name": "Other"}, ["4"]),
                         ({}, ["1", "2", "3", "4"])):
        assert [r[0] for r in rows(df.filter(filters.search_filter(spec)), "document_number")] == wanted


def test_pages_rejoin_to_the_text(spark):
    for value in ("a" * 5000, "é😀\n" * 1500, "x", "line\r\n" * 900, "y" * 2000):
        pages = one(spark, text.page_array(F.col("c0")), value)
        assert "".join(p.page_text for p in pages) == value
        assert [p.page_number for p in pages] == list(range(1, len(pages) + 1))
        assert {p.total_pages for p in pages} == {len(pages)} and len(pages) == -(-len(value) // 2000)
    assert one(spark, text.page_array(F.col("c0")), "") is None
    assert one(spark, text.page_array(F.col("c0")), None) is None


def test_html(spark):
    html = ("<html><head><title>T &amp; U</title><STYLE>p{}</STYLE></head><body><!-- a\nb --><p>One  <b>two</b></p>"
            "<script>x='</p>'</script><div>3 &lt; 4 &amp;lt;</div></body></html>")
    assert one(spark, text.html_to_text(F.col("c0")), html) == "T & U\nOne two\n3 < 4 &lt;"


def test_tokens(spark):
    assert one(spark, text.tokens(F.col("c0")), "Ünï 12-ab, CO2!") == ["ünï", "12", "ab", "co2"]
    assert one(spark, text.tokens(F.col("c0")), "...") == []


def test_keywords(spark):
    tags = text.keyword_tags(F.col("c0"), ("SOP", "TM-", "KG", "GMP"))
    assert one(spark, tags, "GMP and SOP per TM-9, sop, SOP") == ["GMP", "SOP", "TM-"]
    assert one(spark, tags, "none") == []


def test_uri_parts(spark):
    for uri, wanted in (("s3://b/k/x.pdf", ("b", "k/x.pdf")), ("s3a://b/k", ("b", "k")), ("s3n://b/k", ("b", "k")),
                        ("b/k/y", ("b", "k/y"))):
        parts = readers.uri_parts(F.lit(uri))
        assert tuple(spark.range(1).select(*parts.values()).first()) == wanted


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "SELECT 1", user="u", password="p", driver="d")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain and plain["user"] == "u"
    split = readers.jdbc_options("jdbc:x", "SELECT id FROM t", partition=("id", 0, 100, 4))
    assert "query" not in split and split["numPartitions"] == "4" and split["dbtable"] == "(SELECT id FROM t) pushed"


def test_export_csv(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text('a,b\n1,"x ""q"" y"\n2,z,extra\n')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    read = readers.read_export_csv(spark, str(path), schema).cache()
    assert rows(read, "a", "b") == [("1", 'x "q" y'), ("2", "z")]
    assert rows(read.filter("_corrupt_record IS NOT NULL"), "a") == [("2",)]
    bare = tmp_path / "bare.csv"
    bare.write_text("a,b\n")
    empty = readers.read_export_csv(spark, str(bare), schema)
    assert empty.count() == 0 and empty.columns == ["a", "b", "_corrupt_record"]
    assert len(EXPORT_SCHEMA) == 28 and scratch_path(spark, "x") != scratch_path(spark, "x")
