from pyspark.sql import functions as F

from lodestar.functions import text as TX
from lodestar.functions import tickets as TK
from lodestar.operators.evaluation import strict_json_value


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).collect()[0].o


def test_file_stem(spark):
    assert one(spark, TX.file_stem("v"), "a.b.c.txt") == "a.b.c"
    assert one(spark, TX.file_stem("v"), "dir/image001.json") == "image001"


def test_image_id(spark):
    assert one(spark, TK.image_id(F.col("v")), "http://h/p/811702d688c348f8.jpg?x=1") == "811702d688c3"


def test_strict_json(spark):
    assert one(spark, TK.strict_json_object(F.col("v")), '{"a":1}{"a":2}') is False
    assert one(spark, TK.strict_json_object(F.col("v")), '{"a":1} junk') is False
    assert one(spark, TK.strict_json_object(F.col("v")), '1,2') is False
    assert one(spark, TK.strict_json_object(F.col("v")), '{"a":"}{"}') is True
    assert one(spark, strict_json_value(F.col("v")), 'null') is False
    assert one(spark, strict_json_value(F.col("v")), '[1, 2]') is True


def test_strip_removes_newlines_and_ideographic_space(spark):
    assert one(spark, TX.strip("v"), "\n　 x y \t\n") == "x y"


def test_prefix_and_keyword_null_false(spark):
    assert one(spark, TX.prefix_match("v", ["250", "E10"]), None) is False
    assert one(spark, TX.prefix_match("v", ["250", "E10"]), "e101") is True
    assert one(spark, TX.keyword_match("v", ["glucose"]), None) is False
    assert one(spark, TX.keyword_match("v", ["glucose"]), "Glucose, Urine") is True


def test_section_parse_golden(spark):
    text = "1. 责任主体：城市管家\n2. 决策理由：\n- 甲\n\n- 乙\n3. 操作"
    row = one(spark, TK.sections(F.col("v")), text)
    assert row.target == "城市管家"
    assert row.reason == "- 甲\n- 乙\n3. 操作"


def test_think_split(spark):
    r = "<think>x</think>\n\n answer "
    assert one(spark, TK.answer_after_think(F.col("v")), r) == "answer"
    assert one(spark, TK.think_before(F.col("v")), r) == "<think>x"
    assert one(spark, TK.think_before(F.col("v")), "plain") == ""
    assert one(spark, TK.think_block(F.col("v")), r) == "x"


def test_verdict_string_false(spark):
    v = one(spark, TK.verdict(F.col("v"), F.lit("已完成清洗"), ["完成"]), '{"completed":"false"}')
    assert v.completed is False and v.parse_status == "json" and v.reason == TK.DEFAULT_REASON


def test_verdict_fallbacks(spark):
    v = one(spark, TK.verdict(F.col("v"), F.lit("已完成清洗"), ["完成"]), '{"completed": true}{"x": 1}')
    assert v.parse_status == "bad_json" and v.completed is True
    v = one(spark, TK.verdict(F.col("v"), F.lit(""), ["完成"]), "处理已完成")
    assert v.parse_status == "no_json" and v.completed is True and v.reason.endswith(TK.DONE_TEXT)


def test_yes_no_quirk(spark):
    assert one(spark, TK.yes_answer(F.col("v")), "不是的") is True
    assert one(spark, TK.negated_answer(F.col("v")), "不是的") is True
    assert one(spark, TK.yes_answer(F.col("v")), "否") is False


def test_failed_caption(spark):
    assert one(spark, TK.failed_caption(F.col("v")), "[a: ok] [image_2: 图片处理失败: timeout]") is True
    assert one(spark, TK.failed_caption(F.col("v")), "[a: ok]") is False


def test_html_link_is_the_title_s_own(spark):
    from lodestar.operators import htmlrecords as H
    page = ('<article><a href="x.pdf">[PDF]</a><h1><a href="paper.html">Title</a></h1><p>s</p></article>'
            '<article><a href="only.html">l</a><h1>Bare</h1></article><article></article>')
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    got = [tuple(r)[2:] for r in H.extract_records(df).orderBy("pos").collect()]
    assert got == [("Title", "paper.html", "s", "x.pdf"), ("Bare", "only.html", H.NO_SNIPPET, H.NO_PDF),
                   (H.NO_TITLE, H.NO_LINK, H.NO_SNIPPET, H.NO_PDF)]
    shaped = '<div class="r"><h3><a href="t">T</a></h3></div>'
    row = H.extract_records(spark.createDataFrame([(1, shaped)], "page_id long, html string"),
                            block_re='(?s)<div class="r">(.*?)</div>', title_re="(?s)<h3>(.*?)</h3>").first()
    assert (row.title, row.link) == ("T", "t")
