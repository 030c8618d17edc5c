import pytest
from pyspark.sql import functions as F

from lexmill.functions import text as T


def one(spark, column, **values):
    names = list(values) or ["x"]
    df = spark.createDataFrame([tuple(values.values()) or ("",)], ", ".join(f"{n} string" for n in names))
    return df.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("<p>a</p><p>b</p>", "a\nb"),
        ("<!-- x\n --><SCRIPT a=1>y</script>z", "z"),
        ("a<BR/>b<br>c", "a\nb\nc"),
        ("a</P>b", "a b"),  # closing tags count in lower case only
        ("x&nbsp;&amp;lt; \t y", "x &lt; y"),
        ("<div>\n\n\n</div>", ""),
    ],
)
def test_html_to_text(spark, markup, text):
    assert one(spark, T.html_to_text(F.col("x")), x=markup) == text


def test_unescape_knows_all_entities(spark):
    assert one(spark, T.unescape(F.col("x")), x="&eacute;&#x41;&amp") == "éA&"


def test_page_lines_and_white_space(spark):
    assert one(spark, T.clean_page_lines(F.col("x")), x=" a\n 12 \n\n\n\n12345\n7") == "a\n\n12345"


def test_nav_prefix(spark):
    long = "Это достаточно длинная строка текста статьи"
    assert one(spark, T.drop_nav_prefix(F.col("x")), x=f"выпуски\n1999\nянварь 1999 года и еще слова подряд\na@b\n{long}\n/\nend") == f"{long}\n/\nend"
    assert one(spark, T.drop_nav_prefix(F.col("x")), x="short\n/") == "short\n/"


def test_title(spark):
    f = T.extract_title(F.col("p"), F.col("m"))
    assert one(spark, f, p="1999\nшорт\nДлинный заголовок статьи", m="") == "Длинный заголовок статьи"
    assert one(spark, f, p="x", m="<b>Bold title &amp; more</b>") == "Bold title & more"
    assert one(spark, f, p="x", m="<b>short</b>") == T.UNTITLED


def test_section_and_authors(spark):
    assert one(spark, T.extract_section(F.col("x")), x="<b>ИСТОРИЯ ФИЗИКИ</b>") == "ИСТОРИЯ ФИЗИКИ"
    assert one(spark, T.extract_section(F.col("x")), x="none") is None
    assert one(spark, T.extract_authors(F.col("x")), x="<b>Иван А. Б. Петров</b><b>Иван А. Б. Петров</b><b>Анна Орлова</b>") == ["Иван А. Б. Петров"]
    assert one(spark, T.extract_authors(F.col("x")), x="<b>Анна Орлова</b>") == ["Анна Орлова"]


def test_script_ratio(spark):
    assert one(spark, T.script_ratio(F.col("x")), x="аб1҂cd") == 0.5
    assert one(spark, T.script_ratio(F.col("x")), x="123") == 0.0
    assert one(spark, T.is_readable(F.col("x")), x="я" * 200) is True
    assert one(spark, T.is_readable(F.col("x")), x="я" * 199) is False


def test_urls(spark):
    assert one(spark, T.file_name(F.col("x")), x="http://h/a/x.PDF/") == "x.PDF"
    assert one(spark, T.file_name(F.col("x")), x="http://h/x.pdf?y") == "x.pdf?y.pdf"
    assert one(spark, T.host(F.col("x")), x="https://u@h:80/p") == "u@h:80"
    assert one(spark, T.host(F.col("x")), x="no url") == "no url"
    assert one(spark, T.resolve_url(F.col("x"), "https://b"), x="/p") == "https://b/p"
    assert one(spark, T.article_pdf_url(F.col("x")), x="/ru/articles/1999/8/c/") == "https://ufn.ru/ufn99/ufn99_8/Russian/r998c.pdf"
    assert one(spark, T.article_pdf_url(F.col("x"), parity=True), x="/ru/articles/1999/8/c/") is None
    assert one(spark, T.normalize_doi(F.col("x")), x=" https://doi.org/10.1/AbC?x=1") == "10.1/abc"
    assert one(spark, T.grnti_class(F.col("x")), x="29.19.04") == "C3"


def test_uniform_draw_ignores_partitioning(spark):
    df = spark.range(100).select("id", T.uniform(7, F.col("id")).alias("u"))
    got = {r["id"]: r["u"] for r in df.collect()}
    again = {r["id"]: r["u"] for r in spark.range(100).repartition(7).select("id", T.uniform(7, F.col("id")).alias("u")).collect()}
    assert got == again and all(0 <= u < 1 for u in got.values())


def test_word_edits_and_nfc(spark):
    df = spark.createDataFrame([("a b c", "a x c d"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(T.word_edits("a", "b")).collect()] == [2, None]
    assert one(spark, T.nfc(F.col("x")), x="é") == "é"
