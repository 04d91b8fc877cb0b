"""Truth tables of the scalar cleaners."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions import codes, encoding, keys, lists, person, text
from rollcall.labels import RIGHTS, RIGHTS_PREFIX

c = F.col


def outcomes(spark, column, *rows):
    """Values of ``column`` over rows of text cells named a, b, d."""
    names = ["a", "b", "d"][: len(rows[0])]
    schema = ", ".join(f"{n} string" for n in names) + ", place int"
    cells = [(*map(lambda v: None if v is None else str(v), row), i) for i, row in enumerate(rows)]
    df = spark.createDataFrame(cells, schema)
    return [r.out for r in df.select(column.alias("out"), "place").orderBy("place").collect()]


def singles(spark, column, *values):
    return outcomes(spark, column, *[(v,) for v in values])


def test_clean_int(spark):
    values = ['"12"', " 12 ", "+7", "-3", "0005", "12.5", "", "x", None, "3000000000", "1_000", "9" * 30]
    assert singles(spark, text.clean_int(c("a")), *values) == [12, 12, 7, -3, 5] + [None] * 7
    longs = ["3000000000", '"1"', "1000000000000000000", "9223372036854775807", "9223372036854775808"]
    assert singles(spark, text.clean_long(c("a")), *longs) == [3000000000, 1, 10**18, 2**63 - 1, None]


def test_age(spark):
    rows = [
        ("19900115", 2010, 1), ("19900101", 2010, 1), ('"19900101"', 2010, 1), ("20200101", 2010, 1),
        ("20200615", 2010, 1), ("20200115", 2010, 6), ("20000229", 2001, 2), ("20000229", 2001, 3),
        ("19900230", 2010, 1), ("19900101", 2010, 0), ("19900101", 2010, None), ("1990101", 2010, 1),
        ("19901301", 2010, 1), ("00000101", 2010, 1), (None, 2010, 1), ("19900101", 0, 1),
    ]
    age = person.age_at_month(person.birth_number(c("a")), c("b").cast("int"), c("d").cast("int"))
    assert outcomes(spark, age, *rows) == [19, 20, 20, -10, -11, -10, 0, 1] + [None] * 8


def test_age_band_and_names(spark):
    ages = [-10, 11, 12, 18, 19, 29, 30, 60, 61, None]
    assert singles(spark, person.age_band(c("a").cast("int")), *ages) == [
        "Infante", "Infante", "Adolescente", "Adolescente", "Joven", "Joven", "Adulto", "Adulto",
        "Adulto Mayor", None,
    ]
    masked = person.mask_minor_name(F.lit("Ana"), c("a").cast("int"))
    assert singles(spark, masked, 17, 18, None) == [None, "Ana", "Ana"]


def test_place_codes(spark):
    muni = codes.muni_code(c("a"), c("b"))
    rows = [(1, 9), (998, "09"), (999, 9), (0, 9), ("x", 9), (1, 33), ('"7"', 9), (1, None)]
    assert outcomes(spark, muni, *rows) == ["09001", "09998", None, None, None, None, "09007", None]
    assert singles(spark, codes.loc_code(c("a")), 9998, 9999, 0, 7, "-7", "00012", 12345) == [
        "9998", None, None, "0007", None, "0012", None,
    ]
    assert singles(spark, codes.state_code(c("a")), 1, 32, 33, 0, None, " +5 ", "x", 10, 100) == [
        "01", "32", None, None, None, "05", None, "10", None,
    ]


def test_gender_and_origin(spark):
    assert singles(spark, codes.gender_code(c("a")), "H", "M", "MH", "h", None) == ["H", "M", "H", None, None]
    values = ["FEDERAL", "ESTATAL", "FE", "X", None]
    assert singles(spark, codes.origin_code(c("a")), *values) == ["F", "E", "F", None, "F"]
    assert singles(spark, codes.origin_code(c("a"), None), *values) == ["F", "E", "F", None, None]


def test_months(spark):
    pay = codes.pay_month(c("a"), c("b").cast("int"))
    rows = [(5, 3), (55, 3), (-1, 3), ("9" * 30, 3), (0, 3), ("x", 3), (5, None), (5, 0), ("000", 3)]
    assert outcomes(spark, pay, *rows) == [3, 3, 3, 3] + [None] * 5
    periods = ["170", "179", "17a", "17B", "17c", '1"7c', "17X", None, "", "17", "17 "]
    assert singles(spark, codes.period_month(c("a")), *periods) == [0, 9, 10, 11, 12, 12] + [None] * 5
    assert singles(spark, codes.pay_month_own(c("a")), 1, 12, 13, 0, "x") == [1, 12, None, None, None]


def test_benefits(spark):
    values = [1, 2, 3, 4, 5, 6, '"1"', "06", 0, 7, -1, "3000000000", "x", None, ""]
    assert singles(spark, codes.benefit_name(c("a")), *values) == [
        "monetario", "especie", "servicio", "mixto", "subsidiado", "indirecto", "monetario",
        "indirecto", "otro", "otro", "otro", "otro", "no_disponible", "no_disponible", "no_disponible",
    ]
    assert singles(spark, codes.benefit_name(c("a"), None, None), 1, 7, "x") == ["monetario", None, None]


def test_keys(spark):
    key = keys.program_type_key(c("a"), c("b"), c("d"))
    rows = [("S1", "2", "otro"), (None, "2", ""), ("S1", None, None)]
    assert outcomes(spark, key, *rows) == ["S1_2_otro", "None_2_no_disponible", "S1_None_no_disponible"]
    uid = keys.unified_id(c("a"), c("b"), F.lit("S1"), F.lit("9"), c("d"))
    assert outcomes(spark, uid, ("F", "3", 2011), (None, None, None)) == ["F-3-S1-9-2011", "None-None-S1-9-None"]
    assert singles(spark, keys.abbreviate_states(c("a")), "JALISCO1", "x", None) == ["JAL1", "x", None]


def test_text(spark):
    values = ["  a ", " b\n", "", None]
    assert singles(spark, text.trim_text(c("a")), *values) == ["a", "b", "", ""]
    assert singles(spark, text.scrub_text(c("a")), 'a""b c', None) == ["ab c", None]
    assert singles(spark, text.number_text(c("a")), "2017.0", "12", "-3.9", "x", None) == [
        "2017", "12", "-3", None, None,
    ]
    assert singles(spark, text.pad_state(c("a")), "3.0", 12, 123, 0, None, -5) == [
        "03", "12", "123", "null", "null", "-5",
    ]
    assert singles(spark, text.keyword_field(c("a")), "ñ" * 256, "ñ" * 257) == ["ñ" * 256, None]


def test_encodings(spark):
    chars = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ ñ"
    misread = chars.encode("cp1252").decode("latin-1")
    assert singles(spark, encoding.cp1252_fix(c("a")), misread) == [chars]
    assert singles(spark, encoding.strip_non_ascii(c("a")), "añb€") == ["ab"]


def test_lists(spark):
    assert singles(spark, lists.parse_list(c("a")), None, '["a","","b"]', "['x']", '["q\\"q"]') == [
        [], ["a", "b"], ["x"], ['q"q'],
    ]
    codes_in = c("a").cast("int")
    assert singles(spark, lists.focus_group(codes_in), 36, 33, 44, 99, 1757, 145) == [
        "adultos mayores", "pobreza", "otro grupo vulnerable", "", "adultos mayores", "marginacion",
    ]


def test_dummies(spark):
    rows = spark.createDataFrame(
        [(0, 1, None), (2, 0, 0)], "der_social_alim int, der_social_edu int, der_social_viv int"
    )
    rights = lists.dummies_to_array(rows.columns, RIGHTS_PREFIX, RIGHTS)
    assert [r[0] for r in rows.select(rights).collect()] == [["Educación", "Vivienda"], ["Alimentación"]]


@pytest.mark.parametrize("level,expected", [(1, "FEDERAL"), (3, "MUNICIPAL"), (7, "7"), (None, None)])
def test_gov_level(spark, level, expected):
    row = spark.createDataFrame([(level,)], "x int").select(codes.gov_level(c("x")))
    assert row.first()[0] == expected
