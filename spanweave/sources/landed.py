"""Readers of landed files. Fetching pages from a network is left to whatever lands them; what is here reads the pages with Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.scalars import money, without_initial
from spanweave.operators.schemas import drop_empty_columns, flatten


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))


def keep_last(df: DataFrame, keys: Sequence[str], sequence: Column) -> DataFrame:
    """The row of each key, which mustn't be null, that was landed last."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(sequence.desc_nulls_last(), F.xxhash64(*df.columns))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def feed(df: DataFrame, keys: Sequence[str], sequence: Column) -> DataFrame:
    """A tabular feed: lower-case names, no empty columns, the last row of each key."""
    return keep_last(drop_empty_columns(lower_names(df)), keys, sequence)


def nested_rows(pages: DataFrame, *arrays: str) -> DataFrame:
    """Elements of arrays within arrays (say dates, then games), flattened to columns."""
    rows = pages
    for name in arrays:
        rows = rows.select(F.explode(name).alias("_row")).select("_row.*")
    return flatten(rows)


def read_json_rows(spark: SparkSession, path: str, *arrays: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return nested_rows(reader.option("multiLine", True).json(path), *arrays)


def per_season(read: Callable[[int], DataFrame], seasons: Iterable[int]) -> DataFrame:
    """One landed file for each season, stamped with it, in one table; columns may differ."""
    out = None
    for season in seasons:
        own = read(season).withColumn("season", F.lit(season))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def roster_entries(people: DataFrame, known_teams: DataFrame) -> DataFrame:
    """A row for each roster entry of each person; entries without a team, of a known team or with status RA are kept."""
    rows = people.select(F.col("id").alias("person_id"), F.explode_outer("rosterEntries").alias("e"))
    out = rows.select(
        "person_id",
        F.col("e.team.id").cast("bigint").alias("team_id"),
        *(F.to_date(F.col(f"e.{a}").try_cast("timestamp")).alias(b) for a, b in (("startDate", "start_date"), ("statusDate", "status_date"), ("endDate", "end_date"))),
        F.col("e.isActive").alias("is_active"),
        F.col("e.status.code").alias("status_code"),
        F.col("e.status.description").alias("status_desc"),
        F.col("e.team.parentOrgId").cast("bigint").alias("parent_org_id"),
    )
    known = known_teams.select(F.col("id").alias("_team")).distinct()
    hit = out.join(known, F.col("team_id") == F.col("_team"), "left")
    return hit.where(F.col("_team").isNotNull() | (F.col("status_code") == "RA") | F.col("team_id").isNull()).drop("_team")


def two_shapes(first: DataFrame, second: DataFrame, columns: Sequence[str], position: str, labels: tuple[str, str], keys: Sequence[str]) -> DataFrame:
    """Two tables of unlike shape in their common columns, each with its label; rows without keys go."""

    def shaped(df: DataFrame, label: str) -> DataFrame:
        return lower_names(df).select(*(F.col(c) if c in lower_names(df).columns else F.lit(None).alias(c) for c in columns), F.lit(label).alias(position))

    return shaped(first, labels[0]).unionByName(shaped(second, labels[1])).dropna(subset=list(keys))


def by_ordinal(df: DataFrame, ordinals: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Columns of a sheet by their place."""
    return df.select(*(F.col(f"`{df.columns[i]}`").alias(n) for i, n in zip(ordinals, names, strict=True)))


def payroll_sheet(df: DataFrame, season: int) -> DataFrame:
    """Player and salary of a payroll sheet, whose layout changed after 2019."""
    return by_ordinal(df, (0, 5) if season <= 2019 else (0, 12), ("player", "salary")).withColumn("season", F.lit(season))


def payroll_rows(df: DataFrame, season: int, team: str) -> DataFrame:
    """A team's payroll sheet as player, salary, season and team: rows of 'Last, First' without digits, names turned, salaries as whole dollars."""
    rows = payroll_sheet(df, season).where(F.col("player").isNotNull() & ~F.col("player").rlike("[0-9]") & F.col("player").contains(","))
    turned = F.array_join(F.reverse(F.split(F.replace(F.col("player"), F.lit("*"), F.lit("")), ", ")), " ")
    name = without_initial(F.replace(turned, F.lit("  "), F.lit(" ")))
    return rows.select(name.alias("player"), money(F.col("salary")).alias("salary"), "season", F.lit(team).alias("team"))


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A small CSV of fixed rows with a header, typed by a schema; a value that doesn't fit is an error."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def links(html: Column) -> Column:
    """href and text of every link of a page, as an array of structs."""
    whole = F.regexp_extract_all(html, F.lit(r"(?is)(<a\s[^>]*href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>)"), F.lit(1))
    return F.transform(
        whole,
        lambda a: F.struct(
            F.regexp_extract(a, r"(?is)href\s*=\s*[\"']([^\"']*)[\"']", 1).alias("href"),
            F.trim(F.regexp_replace(F.regexp_extract(a, r"(?is)<a\s[^>]*>(.*?)</a>", 1), r"<[^>]*>", "")).alias("text"),
        ),
    )


def table_rows(html: Column, number: int) -> Column:
    """Cells of the rows of a page's n-th table (from 1), as an array of arrays of texts."""
    tables = F.regexp_extract_all(html, F.lit(r"(?is)(<table\b.*?</table>)"), F.lit(1))
    rows = F.regexp_extract_all(F.coalesce(F.try_element_at(tables, F.lit(number)), F.lit("")), F.lit(r"(?is)(<tr\b.*?</tr>)"), F.lit(1))
    cells = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)))
    return F.transform(cells, lambda r: F.transform(r, lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", ""))))


def yearly_links(pages: DataFrame, html: str, keyword: str) -> DataFrame:
    """Links whose address has a keyword, one for each page and year (the first 20xx of the text)."""
    rows = pages.select("*", F.posexplode(links(F.col(html))).alias("_at", "_a")).where(F.lower("_a.href").contains(keyword))
    rows = rows.withColumn("year", F.regexp_extract("_a.text", r"(20\d\d)", 1).try_cast("int")).where("year IS NOT NULL")
    keys = [c for c in pages.columns if c != html]
    w = Window.partitionBy(*keys, "year").orderBy("_at")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*keys, "year", F.col("_a.href").alias("href"))


def csv_export_url(url: Column, gid_of_page: Column | None = None) -> Column:
    """The CSV export of a shared sheet's address; other addresses stay.

    A published page needs the number of its sheet, which stands in the page itself: ``gid_of_page``, if known.
    """
    url = F.trim(url)
    drive = F.regexp_extract(url, r"drive\.google\.com/(?:open\?id=|file/d/)([A-Za-z0-9_-]+)", 1)
    found = F.when(drive != "", F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), drive, F.lit("/edit"))).otherwise(url)
    published = F.concat(F.split_part(F.replace(found, F.lit("/pubhtml"), F.lit("/pub")), F.lit("?"), F.lit(1)), F.lit("?output=csv"))
    if gid_of_page is not None:
        published = F.concat(published, F.coalesce(F.concat(F.lit("&gid="), gid_of_page.cast("string")), F.lit("")))
    shown = F.replace(found, F.lit("output=html"), F.lit("output=csv"))
    sheet = F.regexp_extract(shown, r"/spreadsheets/(?:u/\d+/)?d/([A-Za-z0-9_-]+)", 1)
    query, fragment = F.regexp_extract(shown, r"\?(?:[^#]*&)?gid=([^&#]+)", 1), F.regexp_extract(shown, r"#.*?gid=(\d+)", 1)
    gid = F.when(query != "", query).otherwise(fragment)
    export = F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), sheet, F.lit("/export?format=csv"), F.when(gid != "", F.concat(F.lit("&gid="), gid)).otherwise(""))
    done = url.contains("/export?format=csv") | url.contains("/pub?output=csv")
    return F.when(done, url).when(found.contains("/pubhtml"), published).when(sheet != "", export).otherwise(shown)


def candidate_urls(source: Column, export: Column) -> Column:
    """Addresses to try in turn: the export, the same without its sheet number, and the source as CSV; each once."""
    plain = F.when(export.contains("/pub?output=csv&gid="), F.split_part(export, F.lit("&gid="), F.lit(1)))
    shown = F.when(source.contains("output=html"), F.replace(source, F.lit("output=html"), F.lit("output=csv")))
    return F.array_distinct(F.array_compact(F.array(export, plain, shown)))


def first_readable(spark: SparkSession, paths: Iterable[str], read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The first of several places that can be read; the last error if none can."""
    error: Exception = ValueError("no place to read from")
    for path in dict.fromkeys(paths):
        try:
            return read(spark, path)
        except Exception as e:  # noqa: BLE001  whatever a reader raises, the next place is tried
            error = e
    raise error


def date_chunks(spark: SparkSession, start: str, end: str, days: int, clamp: tuple[str, str] | None = None) -> DataFrame:
    """(chunk_start, chunk_end), both inclusive; ``clamp`` cuts each year to a range of month-days such as ('02-01', '11-30')."""
    span = spark.sql("SELECT CAST(:a AS DATE) AS a, CAST(:b AS DATE) AS b", args={"a": start, "b": end})
    if clamp:
        years = span.select("a", "b", F.explode(F.sequence(F.year("a"), F.year("b"))).alias("y"))
        low, high = (F.to_date(F.concat_ws("-", F.col("y").cast("string"), F.lit(c))) for c in clamp)
        span = years.select(F.greatest("a", low).alias("a"), F.least("b", high).alias("b"))
    chunks = span.where("a <= b").select("b", F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {int(days)} DAYS"))).alias("chunk_start"))
    return chunks.select("chunk_start", F.least(F.date_add("chunk_start", days - 1), F.col("b")).alias("chunk_end"))


def missing_dates(expected: DataFrame, found: DataFrame, key: str, date: str) -> DataFrame:
    """Dates on which an expected key was never found."""
    return expected.join(found.select(key).distinct(), key, "left_anti").select(F.col(date).cast("date").alias("date")).distinct().orderBy("date")


def changed_entities(log: DataFrame, entity: str, date: str, known: DataFrame, known_date: str, everything: DataFrame, days: int = 7) -> DataFrame:
    """Entities with a log entry since shortly before the latest known one; all of them before the first load."""
    latest = known.agg(F.max(known_date).alias("m")).first()["m"]
    if latest is None:
        return everything.select(entity).distinct()
    return log.where(F.col(date).cast("date") >= F.date_sub(F.lit(latest).cast("date"), days)).select(entity).distinct()
