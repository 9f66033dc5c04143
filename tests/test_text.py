from conftest import rows
from pyspark.sql import functions as F

from deskmill.functions import text


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "v string").select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_names(spark):
    v = F.col("v")
    assert one(spark, "ann@b@c.com", text.login_prefix(v)) == ("ann",)
    assert one(spark, "no at", text.login_prefix(v)) == ("no at",)
    assert one(spark, "A.b C/d\x01\x7f\n", text.safe_name(v)) == ("a_b_c_d",)
    assert one(spark, "x" * 300, F.length(text.safe_name(v))) == (255,)
    assert one(spark, "a.b.c", text.flat_key(v), text.name_parts(v)) == ("a_b_c", ["a", "b", "c"])
    assert one(spark, "main__sales__f_x", text.function_name(v)) == ("main.sales.f_x",)
    assert one(spark, "red fox", text.spaced_name(v, "-")) == ("red-fox",)
    assert one(spark, "http://a.b/c/d.pdf?x=1", text.file_name(v), text.host(v)) == ("d.pdf?x=1", "a.b")
    assert one(spark, "plain", text.file_name(v)) == ("plain",)


def test_tagged_document_round_trip(spark):
    fields = ("Cat <x>", "Sub\nline", "N </product_name> x", "doc </product_doc> <a>\nend\n")
    df = spark.createDataFrame([fields], "a string, b string, c string, d string")
    built = df.select(text.indexed_doc(*[F.col(c) for c in "abcd"]).alias("t"))
    assert built.first().t.startswith("<product_category>Cat <x></product_category>\n<product_sub_category>")
    parsed = built.select(*[c.alias(n) for n, c in text.parse_indexed_doc(F.col("t")).items()])
    assert tuple(parsed.first()) == fields


def test_chunks(spark):
    lines = "\n".join(str(i) for i in range(9))
    assert one(spark, lines, text.line_chunks(F.col("v"))) == (["0\n1\n2\n3", "4\n5\n6\n7", "8"],)
    assert one(spark, "", text.line_chunks(F.col("v"))) == ([""],)
    markdown = "intro\n# A\nx\n## B\ny #c\n####### no\n# C"
    assert one(spark, markdown, text.heading_chunks(F.col("v"))) == (["intro\n", "# A\nx\n", "## B\ny #c\n####### no\n", "# C"],)


def test_base64_on_one_line(spark):
    assert "\n" not in one(spark, "x" * 500, text.plain_base64(F.col("v").cast("binary")))[0]


def test_let_binds_once(spark):
    df = spark.range(3).select(text.let(F.col("id") + 1, lambda x: x * x).alias("y"))
    assert rows(df) == [(1,), (4,), (9,)]


def test_sections_name_the_headings_above_them(spark):
    texts = [
        (1, "before\n# A\na\n## B\n### C<b>x\nc\n## D\nd\n# E\n### F\nf\n## G\n"),
        (2, "no heading # here"),
        (3, ""),
        (4, None),
        (5, "## deep first\n# top"),
        (6, "# same\n# same\n####### seven\n#none"),
    ]
    df = spark.createDataFrame(texts, "id int, t string").select("id", F.explode(text.section_chunks(F.col("t"))).alias("s"))
    got = [(r["id"], r["s"]["level"], r["s"]["path"]) for r in df.collect()]
    assert got == [
        (1, 0, ""), (1, 1, "A"), (1, 2, "A > B"), (1, 3, "A > B > C"), (1, 2, "A > D"), (1, 1, "E"), (1, 3, "E > F"), (1, 2, "E > G"),
        (2, 0, ""), (5, 2, "deep first"), (5, 1, "top"), (6, 1, "same"), (6, 1, "same"),
    ]
    whole = df.groupBy("id").agg(F.array_join(F.collect_list("s.chunk"), "").alias("t")).filter("id = 1").first()["t"]
    assert whole == texts[0][1]
