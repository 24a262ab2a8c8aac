"""Column functions against small cases."""

from pyspark.sql import functions as F

from saltmarsh.functions import text as X


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("c"))).collect()]


def test_doi(spark):
    assert column(spark, ["https://doi.org/10.1/A", " HTTP://doi.org/10.1/a ", "doi:10.1/a", "", None, "  "], X.normal_doi) == ["10.1/a", "10.1/a", "10.1/a", None, None, None]


def test_title(spark):
    got = column(spark, ["Étude  of\tOils – part 2", "short", None, "ﬁne ½ oil of Ⅳ", "0123456789", "01234567890"], X.normal_title)
    assert got == ["etude ofoils part 2", None, None, "fine 12 oil of iv", None, "01234567890"]


def test_clean(spark):
    assert column(spark, ["a\r\n\r\n\r\nb  c\xa0d ", None, ""], X.clean) == ["a\n\nb c d", "", ""]


def test_language(spark):
    english = "the oil of the engine and the oxidation of it is in the " * 5
    assert column(spark, [english, "short", "12345 " * 50, None], X.language) == ["en", "unknown", "unknown", "unknown"]
    assert column(spark, ["слово " * 60 + "a b c d e f g h i j " * 4 + "k l m n"], X.language) == ["non-en"]


def test_label_limits(spark):
    df = spark.createDataFrame([("t", "a" * a, "x" * n) for a, n in ((0, 4000), (0, 3999), (0, 1200), (120, 1199), (119, 0))] + [("N/A", "", "")], "title string, abstract string, full_text string")
    got = [r[0] for r in df.coalesce(1).select(X.raw_label("title", "abstract", "full_text")).collect()]
    assert got == ["complete_full_text", "partial_full_text", "partial_full_text", "abstract_only", "title_only", "metadata_only"]


def test_file_names(spark):
    assert column(spark, ["2020_10.1000__abc", "unknown_x", "10.1__a__b"], X.filename_doi) == ["10.1000/abc", "x", "10.1/a__b"]
    assert column(spark, ["2020_10.1000__abc", "unknown_x", "x"], X.filename_year) == ["2020", None, None]
    assert column(spark, ["10.1000/A b", "--x--"], X.slug) == ["10_1000_a_b", "x"]


def test_names(spark):
    assert column(spark, [" α-Tocopherol ", "N,N′-di", None], X.clean_name) == ["alpha-Tocopherol", "N,N-di", ""]
    assert column(spark, ["BHT", "bhta", None], X.risky_name) == [True, False, True]
    assert column(spark, ["N,N′-Diphenyl–p", "α-NPA"], X.curation_name) == ["n,n'-diphenyl-p", "alpha-npa"]


def test_sentinels(spark):
    assert column(spark, [" x ", "", None], X.or_not_found) == ["x", "NOT FOUND", "NOT FOUND"]
    assert column(spark, ["a\x00b\x07\n"], X.without_control) == ["ab\n"]
    assert column(spark, [59.0, 120.0, 7200.0, 172800.0], X.duration, "double") == ["59.0s", "2.0m", "2.0h", "2.0d"]
