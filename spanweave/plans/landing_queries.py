"""Readers and cleaners of landed files, on shared tables read as feeds, and on texts that are made of their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.functions import scalars as S
from spanweave.operators.schemas import align, apply_types, infer_types
from spanweave.operators.tables import first_ingest, recompute_window
from spanweave.plans.catalog import register, table
from spanweave.sources import landed

def _pick(values: tuple, number: str):
    """The value at a number modulo their count."""
    return F.get(F.array(*map(F.lit, values)), F.expr(f"CAST({number} % {len(values)} AS INT)"))


def _sql_pick(values: tuple, number: str) -> str:
    """The same as SQL."""
    one = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"([{', '.join(one)}])[{number} % {len(values)} + 1]"


#: Addresses of sheets as people paste them; @ stands for the sheet's name, ~ for a number.
_SHEETS = (
    "https://docs.google.com/spreadsheets/d/@/edit#gid=~", "https://docs.google.com/spreadsheets/u/0/d/@/edit?usp=x&gid=~", " https://docs.google.com/spreadsheets/d/@/edit ", "https://docs.google.com/spreadsheets/d/@/export?format=csv&gid=~",
    "https://docs.google.com/spreadsheets/d/e/@/pub?output=csv", "https://docs.google.com/spreadsheets/d/e/@/pubhtml?gid=~", "https://drive.google.com/open?id=@", "https://drive.google.com/file/d/@/view", "https://docs.google.com/spreadsheets/d/@/pub?output=html&gid=~", "", None,
)
#: A page's address comes between these.
_SHEET_SQL = f"""
    p AS (SELECT page_id, url AS page, replace(replace({_sql_pick(_SHEETS, "page_id")}, '@', 'K-' || substr(md5(url), 1, 9) || '_'), '~', CAST(page_id AS VARCHAR)) AS url FROM pages),
    u AS (SELECT page_id, page, url, trim(url) AS t, regexp_extract(url, 'drive\\.google\\.com/(?:open\\?id=|file/d/)([A-Za-z0-9_-]+)', 1) AS drive FROM p),
    f AS (SELECT *, CASE WHEN drive <> '' THEN 'https://docs.google.com/spreadsheets/d/' || drive || '/edit' ELSE t END AS found FROM u),
    g AS (SELECT *, replace(found, 'output=html', 'output=csv') AS shown, regexp_extract(found, '/spreadsheets/(?:u/\\d+/)?d/([A-Za-z0-9_-]+)', 1) AS sheet,
        coalesce(nullif(regexp_extract(found, '\\?(?:[^#]*&)?gid=([^&#]+)', 1), ''), nullif(regexp_extract(found, '#.*?gid=(\\d+)', 1), '')) AS gid FROM f),
    x AS (SELECT *, CASE WHEN contains(t, '/export?format=csv') OR contains(t, '/pub?output=csv') THEN t WHEN contains(found, '/pubhtml') THEN split_part(replace(found, '/pubhtml', '/pub'), '?', 1) || '?output=csv'
        WHEN sheet <> '' THEN 'https://docs.google.com/spreadsheets/d/' || sheet || '/export?format=csv' || CASE WHEN gid IS NOT NULL THEN '&gid=' || gid ELSE '' END ELSE shown END AS csv_url FROM g)"""


def _sheet_pages(spark, sf_dir):
    """Each page's id and address, and the address of a sheet named after it."""
    name, number = F.concat(F.lit("K-"), F.substring(F.md5("url"), 1, 9), F.lit("_")), F.col("page_id").cast("string")
    shown = F.replace(F.replace(_pick(_SHEETS, "page_id"), F.lit("@"), name), F.lit("~"), number)
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page"), shown.alias("url"))


@register("sheet_addresses", f"WITH {_SHEET_SQL} SELECT page_id, url, csv_url FROM x")
def sheet_addresses(spark, sf_dir):
    return _sheet_pages(spark, sf_dir).select("page_id", "url", landed.csv_export_url(F.col("url")).alias("csv_url"))


@register(
    "candidate_addresses",
    f"""
    WITH {_SHEET_SQL}, c AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN page || '/sheet?output=html' ELSE csv_url END AS source, CASE page_id % 3 WHEN 0 THEN csv_url WHEN 1 THEN page || '/pub?output=csv&gid=' || page_id ELSE replace(page || '/sheet?output=html', 'html', 'csv') END AS export FROM x),
    l AS (SELECT page_id, export, CASE WHEN contains(export, '/pub?output=csv&gid=') THEN split_part(export, '&gid=', 1) END AS plain, CASE WHEN contains(source, 'output=html') THEN replace(source, 'output=html', 'output=csv') END AS shown FROM c)
    SELECT page_id, concat_ws('|', export, CASE WHEN plain IS DISTINCT FROM export THEN plain END, CASE WHEN shown IS DISTINCT FROM export AND shown IS DISTINCT FROM plain THEN shown END) AS tried FROM l
    """,
)
def candidate_addresses(spark, sf_dir):
    """What to try for a page's sheet, in turn."""
    shown, number = F.concat(F.col("page"), F.lit("/sheet?output=html")), F.col("page_id")
    rows = _sheet_pages(spark, sf_dir).withColumn("csv", landed.csv_export_url(F.col("url")))
    source = F.when(number % 2 == 0, shown).otherwise(F.col("csv"))
    export = F.when(number % 3 == 0, F.col("csv")).when(number % 3 == 1, F.concat(F.col("page"), F.lit("/pub?output=csv&gid="), number.cast("string"))).otherwise(F.replace(shown, F.lit("html"), F.lit("csv")))
    return rows.select("page_id", F.array_join(landed.candidate_urls(source, export), "|").alias("tried"))


_LAST, _FIRST = ("Smith", "Núñez", "O'Hara", "Poe", "Ray Jr.", "Total", "Lee"), ("Ken", "Hyun-Jin", "Ann B.", "Edgar  A.", 'Al "The Kid"', "José (2 yrs)", "A. J. B.", "Óscar Q. de", "Jr. Bo", "Zoë L.", "Max*")
_SHOWN = ("$#", "(#)", "# players", "-", "", " # ", "--#", "$#.75", "$(#)", "#d", None)
_MONEY_SQL = "CAST(trunc(CAST(nullif(regexp_extract(trim(regexp_replace(replace(replace({c}, '(', '-'), ')', ''), '[$,]', '', 'g')), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$'), '') AS DOUBLE)) AS BIGINT)"


def _shown(amount, number: str):
    """An amount as people write it."""
    return F.replace(_pick(_SHOWN, number), F.lit("#"), F.format_number(amount, 0))


_SHOWN_SQL = f"replace({_sql_pick(_SHOWN, 'o_orderkey')}, '#', format('{{:,}}', CAST(o_custkey * 977 + o_orderkey AS BIGINT)))"
_PLAYER_SQL = f"({_sql_pick(_LAST, 'o_orderkey')} || CASE WHEN o_orderkey % 9 = 0 THEN ' ' WHEN o_orderkey % 31 = 0 THEN ' 2019, ' ELSE ', ' END || {_sql_pick(_FIRST, 'o_orderkey')})"
_SHORT_SQL = "CASE WHEN regexp_matches({c}, '^[^ \\t\\r\\n]+ .[.] [^ \\t\\r\\n]+$') THEN regexp_replace({c}, ' .[.] ', ' ') ELSE {c} END"


def _pay(spark, sf_dir):
    """Orders as rows of a payroll sheet: a player, last name first, and a salary."""
    number = F.col("o_orderkey")
    between = F.when(number % 9 == 0, " ").when(number % 31 == 0, " 2019, ").otherwise(", ")
    player = F.concat(_pick(_LAST, "o_orderkey"), between, _pick(_FIRST, "o_orderkey"))
    return table(spark, sf_dir, "orders").select(number, F.year("o_orderdate").alias("y"), player.alias("player"), _shown(F.col("o_custkey") * 977 + number, "o_orderkey").alias("shown"))


@register(
    "payroll_cleaned",
    f"""
    WITH s AS (SELECT o_orderkey, CAST(year(o_orderdate) + 21 AS INTEGER) AS season, {_PLAYER_SQL} AS p, {_SHOWN_SQL} AS shown FROM orders),
    t AS (SELECT *, string_split(replace(p, '*', ''), ', ') AS l FROM s WHERE NOT regexp_matches(p, '[0-9]') AND contains(p, ',')),
    n AS (SELECT *, replace(array_to_string(list_reverse(l), ' '), '  ', ' ') AS turned FROM t)
    SELECT {_SHORT_SQL.format(c="turned")} AS player, {_MONEY_SQL.format(c="shown")} AS salary, season, 'A' AS team FROM n
    """,
)
def payroll_cleaned(spark, sf_dir):
    """Orders as payroll sheets of seven seasons, in the layout of either time; the other columns hold something else."""
    rows, out = _pay(spark, sf_dir), None
    for season in range(2016, 2023):
        place = 5 if season <= 2019 else 12
        cells = [F.col("player"), *(F.col("shown") if i == place else F.lit("x") for i in range(1, 13))]
        own = landed.payroll_rows(rows.where(F.col("y") == season - 21).select(*(c.alias(f"c{i}") for i, c in enumerate(cells))), season, "A")
        out = own if out is None else out.unionByName(own)
    return out


@register("money_forms", f"SELECT o_orderkey, shown, {_MONEY_SQL.format(c='shown')} AS amount FROM (SELECT o_orderkey, {_SHOWN_SQL} AS shown FROM orders)")
def money_forms(spark, sf_dir):
    return _pay(spark, sf_dir).select("o_orderkey", "shown", S.money(F.col("shown")).alias("amount"))


_ASCII_SQL = "{c}"
for _a, _b in S.LETTERS.items():
    _ASCII_SQL = f"replace({_ASCII_SQL}, '{_a.replace(chr(39), chr(39) * 2)}', '{_b.replace(chr(39), chr(39) * 2)}')"
_ASCII_SQL = "regexp_replace(strip_accents(" + _ASCII_SQL + r"), '[^\x00-\x7F]', '', 'g')"


@register("ascii_names", f"SELECT doc_id, md5({_ASCII_SQL.format(c='text')}) AS plain, CAST(length({_ASCII_SQL.format(c='text')}) AS INTEGER) AS n FROM documents")
def ascii_names(spark, sf_dir):
    """Whole texts of four languages without their accents."""
    plain = S.ascii_letters(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(plain).alias("plain"), F.length(plain).alias("n"))


@register(
    "player_name_forms",
    f"""
    WITH s AS (SELECT o_orderkey, {_PLAYER_SQL} AS player FROM orders),
    a AS (SELECT *, trim(regexp_replace(lower(player), '"[^"]*"|\\([^)]*\\)', '', 'g')) AS q FROM s),
    b AS (SELECT *, string_split(replace(trim(regexp_replace({_ASCII_SQL.format(c="regexp_replace(q, ' +', ' ', 'g')")}, ' +', ' ', 'g')), '.', ''), ' ') AS parts FROM a),
    c AS (SELECT *, array_to_string(list_filter(parts, lambda w: w <> 'jr'), ' ') || CASE WHEN list_contains(parts, 'jr') THEN ' jr' ELSE '' END AS moved FROM b)
    SELECT o_orderkey, player, trim(regexp_replace(replace(moved, '-', ' '), ' +', ' ', 'g')) AS plain, {_SHORT_SQL.format(c="player")} AS short FROM c
    """,
)
def player_name_forms(spark, sf_dir):
    rows = _pay(spark, sf_dir)
    return rows.select("o_orderkey", "player", S.plain_name(F.col("player")).alias("plain"), S.without_initial(F.col("player")).alias("short"))


_HTML_SQL = """h AS (SELECT page_id, CASE WHEN page_id % 7 <> 6 THEN html || '<table><tr><td>x</td></tr></table>' || CASE WHEN page_id % 5 <> 4 THEN '<TABLE id="b"><tr><th>Page</th><th> Pay </th></tr>' || repeat('<tr><td><a href="/payroll/' || page_id || '">A <b>' || url || '</b></a></td><td>1<br>' || length(html) || '</td></tr>', CAST(page_id % 4 AS INTEGER)) || '</TABLE>' ELSE '' END
    || '<a class="y" href=''/Payroll/' || page_id || '/a''>Pay of ' || (2010 + page_id % 12) || '</a><a href="/payroll/b">' || (2010 + page_id % 12) || ' again</a><a href="/payroll/c">19 <i>' || (2020 + page_id % 80) || '</i> 1</a><a href="/news">2022</a>' END AS html FROM pages)"""


def _tabled(spark, sf_dir):
    """Pages with tables and links added that are made of their own ids, addresses and lengths; some without."""
    number = F.col("page_id")

    def joined(*parts):
        return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))

    row = joined('<tr><td><a href="/payroll/', number, '">A <b>', F.col("url"), "</b></a></td><td>1<br>", F.length("html"), "</td></tr>")
    second = F.when(number % 5 != 4, joined('<TABLE id="b"><tr><th>Page</th><th> Pay </th></tr>', F.expr("repeat(_row, CAST(page_id % 4 AS INT))"), "</TABLE>")).otherwise("")
    more = joined("<a class=\"y\" href='/Payroll/", number, "/a'>Pay of ", 2010 + number % 12, '</a><a href="/payroll/b">', 2010 + number % 12, ' again</a><a href="/payroll/c">19 <i>', 2020 + number % 80, '</i> 1</a><a href="/news">2022</a>')
    rows = table(spark, sf_dir, "pages").withColumn("_row", row)
    return rows.select("page_id", F.when(number % 7 != 6, joined(F.col("html"), "<table><tr><td>x</td></tr></table>", second, more)).alias("html"))


@register(
    "table_cells",
    f"""
    WITH {_HTML_SQL}, t AS (SELECT page_id, html, regexp_extract_all(coalesce(regexp_extract_all(html, '(?is)(<table\\b.*?</table>)', 1)[2], ''), '(?is)(<tr\\b.*?</tr>)', 1) AS r FROM h)
    SELECT page_id, CASE WHEN html IS NOT NULL THEN array_to_string(list_transform(r, lambda x: array_to_string(list_transform(regexp_extract_all(x, '(?is)<t[dh]\\b[^>]*>(.*?)</t[dh]>', 1), lambda c: trim(regexp_replace(c, '<[^>]*>', '', 'g'))), ',')), ';') END AS cells FROM t
    """,
)
def table_cells(spark, sf_dir):
    cells = F.transform(landed.table_rows(F.col("html"), 2), lambda r: F.array_join(r, ","))
    return _tabled(spark, sf_dir).select("page_id", F.when(F.col("html").isNotNull(), F.array_join(cells, ";")).alias("cells"))


@register(
    "yearly_payroll_links",
    f"""
    WITH {_HTML_SQL}, a AS (SELECT page_id, unnest(l) AS x, unnest(range(len(l))) AS place FROM (SELECT page_id, regexp_extract_all(html, '(?is)(<a\\s[^>]*href\\s*=\\s*["''][^"'']*["''][^>]*>.*?</a>)', 1) AS l FROM h)),
    y AS (SELECT page_id, place, regexp_extract(x, '(?is)href\\s*=\\s*["'']([^"'']*)["'']', 1) AS href, regexp_extract(regexp_replace(x, '<[^>]*>', '', 'g'), '20\\d\\d') AS year FROM a)
    SELECT page_id, CAST(year AS INTEGER) AS year, arg_min(href, place) AS href FROM y WHERE year <> '' AND contains(lower(href), 'payroll') GROUP BY 1, 2
    """,
)
def yearly_payroll_links(spark, sf_dir):
    return landed.yearly_links(_tabled(spark, sf_dir), "html", "payroll")


@register(
    "feed_last_landed",
    "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def feed_last_landed(spark, sf_dir):
    """Events as a feed with names in capitals and an empty column."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("USER_ID"), F.col("event_type").alias("Event_Type"), "event_id", "ts", "value", F.lit(None).cast("string").alias("Nothing"))
    return landed.feed(rows, ["user_id", "event_type"], F.struct("ts", "event_id")).drop("ts")


@register(
    "roster_entry_rows",
    """
    SELECT c_custkey AS person_id, CASE WHEN k < 3 THEN c_custkey % 7 + k END AS team_id, DATE '2021-01-01' + CAST(c_custkey % 50 + k AS INTEGER) AS start_date, k = 1 AS is_active, CASE k WHEN 2 THEN 'RA' ELSE 'A' END AS status_code
    FROM customer, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE k = 2 OR k = 3 OR c_custkey % 7 + k <= 4
    """,
)
def roster_entry_rows(spark, sf_dir):
    """Four entries of each customer: two of some team, one with status RA, one without a team."""
    number = F.col("c_custkey")

    def entry(k: int):
        team = F.struct(F.when(F.lit(k < 3), number % 7 + k).alias("id"), F.lit(None).cast("long").alias("parentOrgId"))
        day = F.date_add(F.lit("2021-01-01").cast("date"), (number % 50 + k).cast("int")).cast("string")
        status = F.struct(F.lit("RA" if k == 2 else "A").alias("code"), F.lit("x").alias("description"))
        return F.struct(team.alias("team"), day.alias("startDate"), day.alias("statusDate"), F.lit(None).cast("string").alias("endDate"), F.lit(k == 1).alias("isActive"), status.alias("status"))

    people = table(spark, sf_dir, "customer").select(number.alias("id"), F.array(*(entry(k) for k in range(4))).alias("rosterEntries"))
    return landed.roster_entries(people, spark.range(0, 5)).select("person_id", "team_id", "start_date", "is_active", "status_code")


@register(
    "two_shapes_union",
    "SELECT s_suppkey AS id, s_acctbal AS war, CAST(s_nationkey AS DOUBLE) AS pa, 'batter' AS position FROM supplier UNION ALL SELECT c_custkey, c_acctbal, NULL, 'pitcher' FROM customer",
)
def two_shapes_union(spark, sf_dir):
    first = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("Id"), F.col("s_acctbal").alias("WAR"), F.col("s_nationkey").cast("double").alias("PA"))
    second = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"), F.col("c_acctbal").alias("war"))
    return landed.two_shapes(first, second, ["id", "war", "pa"], "position", ("batter", "pitcher"), ["id"])


@register("seasons_stamped", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, CASE WHEN year(o_orderdate) >= 1996 THEN o_orderpriority END AS extra FROM orders")
def seasons_stamped(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")

    def read(season):
        rows = orders.where(F.year("o_orderdate") == season)
        return rows.select("o_orderkey", F.col("o_orderpriority").alias("extra")) if season >= 1996 else rows.select("o_orderkey")

    return landed.per_season(read, range(1995, 2002))


@register("changed_people", "SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 10 FROM events WHERE event_type = 'purchase' AND user_id = 1)")
def changed_people(spark, sf_dir):
    log = table(spark, sf_dir, "events")
    return landed.changed_entities(log, "user_id", "ts", log.where("event_type = 'purchase' AND user_id = 1"), "ts", log, 10)


@register("first_ingest_stamps", "SELECT n_nationkey, TIMESTAMP '2024-01-02 03:04:05' AS first_ingested_at, TIMESTAMP '2024-01-02 03:04:05' AS last_ingested_at FROM nation")
def first_ingest_stamps(spark, sf_dir):
    return first_ingest(table(spark, sf_dir, "nation").select("n_nationkey"), F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))


@register(
    "schema_infer_align",
    "SELECT n_nationkey, n_name, n_regionkey, DATE '2024-01-02' AS landed, true AS seen FROM nation",
)
def schema_infer_align(spark, sf_dir):
    """Types found in landed text, then brought into the stored columns and the new ones that have values."""
    nation = table(spark, sf_dir, "nation")
    text = nation.select(*(F.col(c).cast("string") for c in nation.columns), F.lit("2024-01-02").alias("landed"), F.lit("yes").alias("seen"), F.lit(None).cast("string").alias("nothing"))
    typed = apply_types(text, infer_types(text))
    stored = align(typed, nation.schema)
    return stored.select(*nation.columns, *(F.col(c) for c in ("landed", "seen") if c in stored.columns))


@register(
    "half_inning_teams",
    "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'away' WHEN 1 THEN 'home' END AS batter_team, CASE l_linenumber % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'away' END AS pitcher_team FROM lineitem",
)
def half_inning_teams(spark, sf_dir):
    half = F.get(F.array(F.lit("Top"), F.lit("B"), F.lit("Mid")), F.col("l_linenumber") % 3)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", S.side_of(half, F.lit("away"), F.lit("home")).alias("batter_team"), S.side_of(half, F.lit("home"), F.lit("away")).alias("pitcher_team")
    )


@register(
    "incremental_margin",
    """
    WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior, lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pd FROM events),
    m AS (SELECT max(d) - 3 AS last FROM e)
    SELECT event_id, d, CASE WHEN d < (SELECT last - 5 FROM m) OR pd >= (SELECT last - 10 FROM m) THEN prior END AS prior FROM e
    """,
)
def incremental_margin(spark, sf_dir):
    """A build up to three days before the end, then the days since five before that, with a margin of five more: a row whose
    predecessor lies outside the margin has none."""
    from pyspark.sql import Window

    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("d"), "ts", "value")

    def prior(rows):
        return rows.select("event_id", "d", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("prior"))

    last = events.agg(F.max("d").alias("m")).first().m
    old = prior(events.where(F.col("d") <= F.date_sub(F.lit(last), 3)))
    return recompute_window(events, old, "d", ["event_id"], 5, 5, prior)
