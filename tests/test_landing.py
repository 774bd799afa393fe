"""Readers and cleaners of landed texts, case by case."""

from pyspark.sql import functions as F

from spanweave.functions import scalars as S
from spanweave.sources import landed

_ADDRESSES = [
    ("https://docs.google.com/spreadsheets/d/AbC-1_x/edit#gid=7", "https://docs.google.com/spreadsheets/d/AbC-1_x/export?format=csv&gid=7"),
    ("https://docs.google.com/spreadsheets/u/0/d/AbC/edit?usp=x&gid=12#gid=7", "https://docs.google.com/spreadsheets/d/AbC/export?format=csv&gid=12"),
    (" https://docs.google.com/spreadsheets/d/AbC/edit ", "https://docs.google.com/spreadsheets/d/AbC/export?format=csv"),
    ("https://docs.google.com/spreadsheets/d/AbC/export?format=csv&gid=3", "https://docs.google.com/spreadsheets/d/AbC/export?format=csv&gid=3"),
    ("https://docs.google.com/spreadsheets/d/e/2PACX/pub?output=csv", "https://docs.google.com/spreadsheets/d/e/2PACX/pub?output=csv"),
    ("https://docs.google.com/spreadsheets/d/e/2PACX/pubhtml?gid=3", "https://docs.google.com/spreadsheets/d/e/2PACX/pub?output=csv"),
    ("https://drive.google.com/open?id=XyZ_9-", "https://docs.google.com/spreadsheets/d/XyZ_9-/export?format=csv"),
    ("https://drive.google.com/file/d/XyZ/view", "https://docs.google.com/spreadsheets/d/XyZ/export?format=csv"),
    ("https://docs.google.com/spreadsheets/d/AbC/pub?output=html&gid=4", "https://docs.google.com/spreadsheets/d/AbC/export?format=csv&gid=4"),
    ("https://else.org/x?output=html", "https://else.org/x?output=csv"),
    ("https://else.org/a.csv", "https://else.org/a.csv"),
    ("", ""),
    (None, None),
]
_SOURCES = [("u?output=html", "u/pub?output=csv&gid=4", "u/pub?output=csv&gid=4|u/pub?output=csv|u?output=csv"), ("a", "a", "a"), ("b?output=html", "b?output=csv", "b?output=csv")]
_SHEET = [("Smith, Ken", "$1,234,567"), ("Lee, Ann B.", "(2,000)"), ("Total 2019", "5"), ("Roe Jane", "7"), (None, "8"), ("Diaz, Al*", "12 players"), ("Poe, Edgar  A.", "$3.5"), ("Ray, O. B. C.", None), ("One, Two, Three", "-4")]
_CLEANED = [("Ken Smith", 1234567), ("Ann Lee", -2000), ("Al Diaz", None), ("Edgar Poe", 3), ("O. B. C. Ray", None), ("Three Two One", -4)]
_MONEY = [("$1,234", 1234), ("(1,234)", -1234), ("$(5)", -5), (" 7 ", 7), ("12 players", None), ("-", None), ("", None), ("1.9", 1), ("--5", None), ("5d", None), (None, None)]
_NAMES = [
    ("Øyvind Łukasz Groß", "Oyvind Lukasz Gross"), ("José Núñez", "Jose Nunez"), ("Þór Ægir Œuvre", "Thor AEgir OEuvre"), ("Đặng Ħaż", "Dang Haz"), ("O’Neil – “x”…", "O'Neil - \"x\"..."),
    ("ﬁn 漢 ok", "n  ok"), ("plain", "plain"), (None, None),
]
_PLAYERS = [
    ('Ken "The Kid" Griffey Jr.', "ken griffey jr", 'Ken "The Kid" Griffey Jr.'), ("Jr. Al O'Hara (2 yrs)", "al o'hara jr", "Jr. Al O'Hara (2 yrs)"), ("Hyun-Jin  Ryu", "hyun jin ryu", "Hyun-Jin  Ryu"),
    ("John Q. Public", "john q public", "John Public"), ("A. J. B. Roe", "a j b roe", "A. J. B. Roe"), ("José Muñoz", "jose munoz", "José Muñoz"), (None, None, None),
]
_HTML = [
    (1, '<table><tr><td>x</td></tr></table><TABLE id="b"><tr><th>Team</th><th> Pay </th></tr><tr><td><a href="/payroll/a">A <b>2019</b></a></td><td>1<br>2</td></tr></TABLE><a href=\'/payroll/b\'>2019 again</a><a href="/payroll/c">20 2021</a><a href="/news">2022</a>', "Team,Pay;A 2019,12", "2019=/payroll/a;2021=/payroll/c"),
    (2, "<p>none</p>", "", ""),
    (3, None, None, ""),
]


def told(spark, values, change):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r.out for r in rows.select("i", change(F.col("c")).alias("out")).orderBy("i").collect()]


def test_sheet_addresses(spark):
    assert told(spark, [u for u, _ in _ADDRESSES], landed.csv_export_url) == [x for _, x in _ADDRESSES]


def test_candidate_addresses(spark):
    rows = spark.createDataFrame(_SOURCES, "source string, export string, x string")
    assert all(r.t == r.x for r in rows.select("x", F.array_join(landed.candidate_urls(F.col("source"), F.col("export")), "|").alias("t")).collect())


def test_payroll_sheets_of_either_layout(spark):
    for season, place in ((2019, 5), (2020, 12)):
        rows = [(p, *("x" if i != place else s for i in range(1, 13))) for p, s in _SHEET]
        out = landed.payroll_rows(spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(13))), season, "A")
        assert [tuple(r) for r in out.collect()] == [(p, s, season, "A") for p, s in _CLEANED]


def test_money_and_names(spark):
    assert told(spark, [m for m, _ in _MONEY], S.money) == [x for _, x in _MONEY]
    assert told(spark, [n for n, _ in _NAMES], S.ascii_letters) == [x for _, x in _NAMES]
    assert told(spark, [p[0] for p in _PLAYERS], S.plain_name) == [p[1] for p in _PLAYERS]
    assert told(spark, [p[0] for p in _PLAYERS], S.without_initial) == [p[2] for p in _PLAYERS]


def test_tables_and_links_of_pages(spark):
    cells = told(spark, [h[1] for h in _HTML], lambda c: F.when(c.isNotNull(), F.array_join(F.transform(landed.table_rows(c, 2), lambda r: F.array_join(r, ",")), ";")))
    assert cells == [h[2] for h in _HTML]
    rows = spark.createDataFrame([(p, h) for p, h, _, _ in _HTML], "page int, html string")
    assert sorted(map(tuple, landed.yearly_links(rows, "html", "payroll").collect())) == [(1, 2019, "/payroll/a"), (1, 2021, "/payroll/c")]
