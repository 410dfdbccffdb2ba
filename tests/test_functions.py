import pytest
from pyspark.sql import functions as F

from lumbre.functions import dates, numbers, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("f", "value", "wanted"), [
    (numbers.u_value, "1,9 [W/m2K]", 1.9), (numbers.u_value, "% máximo = 25%", 25.0), (numbers.u_value, "% máximo = ,6%", 0.6), (numbers.u_value, "sin exigencia", None),
    (numbers.chilean, "1.234,5", 1234.5), (numbers.chilean, "1.5", 15.0), (numbers.chilean, "85%", 85.0), (numbers.chilean, "", None), (numbers.chilean, "G", None), (numbers.chilean, "12d", None), (numbers.chilean, "nan", None), (numbers.chilean, None, None),
    (numbers.clean_numeric, "1.234,5", 1234.5), (numbers.clean_numeric, "1.5", 1.5), (numbers.clean_numeric, "1,5", 1.5), (numbers.clean_numeric, "sin dato", None), (numbers.clean_numeric, "-", None),
    (numbers.number_tokens, "1,9 [W/m2K] -0,3 1.234,5 25% ,6 1.5", ["1,9", "-0,3", "1.234,5", "25%", "6", "1", "5"]),
    (text.status_from_name, "x_precalificadas_ver_informe.pdf", "precalificada"), (text.status_from_name, "x_calificadas_ver_informe.pdf", "calificada"), (text.status_from_name, "x.pdf", None),
    (text.clean_category, " Sin  Información ", None), (text.clean_category, "Casa  A", "casa a"),
    (text.zone, "Zona D", "D"), (text.zone, " g ", "G"), (text.zone, "S/I", "I"), (text.zone_is_doubtful, "S/I", True),
    (text.status, "Pre-Calificación", "precalificada"), (text.status, "Calificación", "calificada"), (text.status, "otro", "otro"),
    (text.property_type, "casa pareada", "casa_pareada"), (text.property_type, "casa", "casa_aislada"), (text.property_type, "casa pareada condominio", "depto"), (text.property_type, "torrente", "depto"), (text.property_type, "sitio", None),
    (text.fold, " Año 2º  Ñandú/x ", "ano 2o nandu x"), (text.after_colon, "Comuna: Talca: a", "Talca: a"), (text.after_colon, "Talca", "Talca"), (text.safe_name, "..a b..", "a_b"), (text.safe_name, None, "sin_nombre"),
    (text.is_pager, "1 2 3 ...", True), (dates.from_excel, "45000", "2023-03-15"), (dates.from_excel, "", ""), (dates.from_excel, "texto", "texto"), (dates.date_or_text, "el 1-2-2020 x", "1-2-2020"), (dates.date_or_text, "nada", "nada"),
])
def test_vectors(spark, f, value, wanted):
    assert one(spark, value, f) == wanted


def test_rows_and_savings(spark):
    row = spark.createDataFrame([("0,7 -0,3 0,3 x 0 0",)], "x string").select(*numbers.row_numbers(F.col("x"))).first()
    assert list(row) == [0.7, -0.3, 0.3, 0.0, 0.0]
    got = spark.createDataFrame([(["AHORRO", "70%", "B"],), (["nada", "a", "5x"],)], "x array<string>").select(numbers.saving_and_label(F.col("x")).alias("s")).collect()
    assert tuple(got[0]["s"]) == (70.0, "B") and got[1]["s"]["label"] is None


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("la casa de dos pisos 12",), ("x",)], "x string").select(text.tokens(F.col("x")).alias("w"))
    rows = df.select("w", text.ngrams(F.col("w"), 2).alias("b")).collect()
    assert rows[0]["w"] == ["casa", "dos", "pisos"] and rows[0]["b"] == ["casa dos", "dos pisos"] and rows[1]["b"] == []


def test_dates_and_rounding(spark):
    assert str(one(spark, "3/4/2021", dates.to_date)) == "2021-04-03"
    assert one(spark, "31-31-2021", dates.to_date) is None
    assert spark.range(1).select(numbers.half_even(F.lit(2398.5)).alias("y")).first()["y"] == 2398
    assert numbers.excel_column("AB") == 27
