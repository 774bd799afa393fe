"""The chain of spans of absence, step by step, on orders read as transactions; each step calls the functions of ``spans``."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.functions import extraction as X
from spanweave.plans import spans as P
from spanweave.plans.catalog import register, table

_AS_OF = "2001-06-01"
_TEXTS = ("Placed X on the 10-day injured list.", "activated x from the injured list.", "Placed X on the 60-day injured list.", "recalled x.", None)
_PARTS = ("elbow", "knee", "ucl", None, "undisclosed")
_GROUPS = ("elbow", "knee", "elbow", None, "undisclosed")
_KINDS = ("strain", "Tear", "soreness", "surgery", None, "undisclosed")


def _pick(values: tuple, number: str):
    """The value at a number modulo their count."""
    return F.get(F.array(*map(F.lit, values)), F.expr(f"CAST({number} % {len(values)} AS INT)"))


def _sql_pick(values: tuple, number: str) -> str:
    return f"([{', '.join('NULL' if v is None else repr(v) for v in values)}])[{number} % {len(values)} + 1]"


def _transactions(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trans_id"), F.col("o_custkey").alias("person_id"), day.alias("date"), day.alias("effectivedate"),
        _pick(_TEXTS, "o_orderkey").alias("description"), F.lit("SC").alias("typecode"), (F.col("o_orderkey") % 7).alias("toteam_id"),
    )


def _calendar(spark):
    """Seasons of five teams from April to September, the last one under way."""
    days = spark.range(1995, 2002).select(F.col("id").alias("season"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("team_id"))
    first, last = (F.make_date(F.col("season").cast("int"), F.lit(m), F.lit(d)) for m, d in ((4, 1), (9, 30)))
    return days.select("team_id", "season", first.alias("first_game"), F.when(F.col("season") < 2001, last).alias("last_game"))


def _teams(spark):
    return spark.range(1, 6)


def told(rows):
    """Placements with an injury told by their number."""
    number = "il_place_trans_id"
    return rows.withColumns(
        {"raw_injury": F.concat(F.lit("raw "), F.col(number).cast("string")), "side": F.lit("left"), "body_part": _pick(_PARTS, number), "injury_type": _pick(_KINDS, number), "body_part_group": _pick(_GROUPS, number)}
    )


def _appearances(spark, sf_dir):
    """Line items are games that a customer was seen in."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("person_id"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("game_date"), (F.col("l_suppkey") % 5 + 1).alias("team_id"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("person_id", "game_date", "team_id")


_T = f"""t AS (SELECT o_orderkey AS trans_id, o_custkey AS person_id, CAST(o_orderdate AS DATE) AS d, {_sql_pick(_TEXTS, "o_orderkey")} AS description, o_orderkey % 7 AS toteam_id FROM orders)"""
_PLACED = f"""{_T},
    marked AS (SELECT *, regexp_matches(lower(description), 'injured list|disabled list') AND NOT regexp_matches(lower(description), 'activated|reinstated|returned|transferred|recalled') AS is_p FROM t WHERE description IS NOT NULL),
    ahead AS (SELECT *, lead(is_p, 1, false) OVER (PARTITION BY person_id ORDER BY d, trans_id) AS next_p FROM marked),
    placed AS (SELECT trans_id AS il_place_trans_id, person_id, d AS il_place_date, lower(description) AS il_place_description, toteam_id AS il_place_team
        FROM ahead WHERE is_p AND NOT next_p QUALIFY row_number() OVER (PARTITION BY person_id, d ORDER BY trans_id) = 1)"""
_RETURNED = f"""{_PLACED},
    calendar AS (SELECT y AS season, x AS team_id, make_date(y, 4, 1) AS first_game, CASE WHEN y < 2001 THEN make_date(y, 9, 30) END AS last_game FROM range(1995, 2002) a(y), range(1, 6) b(x)),
    away AS (SELECT person_id, d AS return_date, trans_id AS return_trans_id, toteam_id AS return_team_id FROM t
        WHERE regexp_matches(lower(description), 'activated|reinstated|recalled|returned|status changed')),
    nearest AS (SELECT p.*, a.return_date, a.return_trans_id, a.return_team_id FROM placed p LEFT JOIN away a ON p.person_id = a.person_id AND a.return_date > p.il_place_date
        QUALIFY row_number() OVER (PARTITION BY il_place_trans_id ORDER BY return_date NULLS LAST, return_trans_id) = 1),
    late AS (SELECT n.*, last + 7 AS cap, coalesce(return_date > last + 7 OR (return_date IS NULL AND last IS NOT NULL), false) AS is_late
        FROM nearest n JOIN (SELECT season, max(last_game) AS last FROM calendar GROUP BY 1) e ON year(il_place_date) = e.season),
    capped AS (SELECT * EXCLUDE (return_date, return_team_id), CASE WHEN is_late THEN il_place_team ELSE return_team_id END AS return_team_id, CASE WHEN is_late THEN cap ELSE return_date END AS end_date FROM late),
    returned AS (SELECT * EXCLUDE (end_date, cap, is_late), CASE WHEN end_date IS NOT NULL AND count(*) OVER w > 1 AND il_place_date = min(il_place_date) OVER w THEN NULL ELSE end_date END AS return_date
        FROM capped WINDOW w AS (PARTITION BY person_id, end_date))"""
_OVERRIDDEN = f"""{_RETURNED},
    seen AS (SELECT o_custkey AS person_id, CAST(l_shipdate AS DATE) AS game, l_suppkey % 5 + 1 AS team FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    with_game AS (SELECT r.*, s.game, s.team FROM returned r LEFT JOIN seen s ON r.person_id = s.person_id AND s.game > r.il_place_date
        QUALIFY row_number() OVER (PARTITION BY il_place_trans_id ORDER BY game NULLS LAST, team) = 1),
    overridden AS (SELECT il_place_trans_id, person_id, il_place_date, il_place_team, CASE WHEN early THEN team ELSE return_team_id END AS return_team_id,
        CASE WHEN NOT early THEN return_trans_id END AS return_trans_id, CASE WHEN early THEN game ELSE return_date END AS return_date
        FROM (SELECT *, coalesce(game < return_date, false) AS early FROM with_game))"""
_N = "il_place_trans_id"
_CHAIN = f"""{_OVERRIDDEN},
    told AS (SELECT *, 'raw ' || {_N} AS raw, {_sql_pick(_PARTS, _N)} AS part, {_sql_pick(_KINDS, _N)} AS kind, {_sql_pick(_GROUPS, _N)} AS grp FROM overridden),
    following AS (SELECT *, lead(il_place_date) OVER w AS nxt, lead(il_place_team) OVER w AS nxt_team, lead(grp) OVER w AS nxt_grp,
        last_value(CASE WHEN grp <> 'undisclosed' THEN grp END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prior
        FROM told WINDOW w AS (PARTITION BY person_id ORDER BY il_place_date, {_N})),
    seasons AS (SELECT f.*, a.last_game AS last, b.first_game AS first, grp IS NULL OR grp = 'undisclosed' AS now, nxt_grp IS NULL OR nxt_grp = 'undisclosed' AS later
        FROM following f LEFT JOIN calendar a ON a.season = year(il_place_date) AND a.team_id = return_team_id LEFT JOIN calendar b ON b.season = year(il_place_date) + 1 AND b.team_id = nxt_team),
    edges AS (SELECT *, coalesce(((return_date IS NULL AND nxt IS NOT NULL) OR (coalesce(return_date BETWEEN last AND make_date(year(last), 12, 31), false) AND coalesce(nxt <= first AND year(nxt) = year(first), false)))
        AND coalesce(grp = nxt_grp OR (NOT now AND later) OR (now AND NOT later AND prior = nxt_grp) OR (now AND later), false), false) AS bridge FROM seasons),
    cuts AS (SELECT *, lag(bridge, 1, false) OVER (PARTITION BY person_id ORDER BY il_place_date, {_N}) AS joined FROM edges),
    chains AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY person_id ORDER BY il_place_date, {_N} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chain FROM cuts),
    folded AS (SELECT person_id, chain, bool_or(bridge) AS chained, arg_min({{'id': {_N}, 'd': il_place_date, 'team': il_place_team, 'raw': raw, 'part': part, 'kind': kind, 'grp': grp, 'tid': return_trans_id, 'rd': return_date, 'rteam': return_team_id}}, il_place_date) AS a,
        arg_max({{'raw': raw, 'part': part, 'kind': kind, 'grp': grp, 'tid': return_trans_id, 'rd': return_date}}, il_place_date) AS z,
        arg_max({{'raw': raw, 'part': part, 'kind': kind}}, il_place_date) FILTER (coalesce(regexp_matches(lower(kind), 'surgery|tear'), false)) AS worst FROM chains GROUP BY 1, 2),
    bridged AS (SELECT a.id AS il_place_trans_id, a.d AS il_place_date, person_id, a.team AS il_place_team, a.raw AS raw_injury, a.part AS body_part, a.kind AS injury_type, coalesce(a.grp, z.grp) AS body_part_group,
        CASE WHEN chained THEN coalesce(worst.raw, z.raw) END AS second_raw_injury, CASE WHEN chained THEN coalesce(worst.part, z.part) END AS second_body_part, CASE WHEN chained THEN coalesce(worst.kind, z.kind) END AS second_injury_type,
        CASE WHEN chained THEN z.tid ELSE a.tid END AS return_trans_id, CASE WHEN chained THEN z.rd ELSE a.rd END AS open_date, a.rteam AS return_team FROM folded),
    chain_spans AS (SELECT * EXCLUDE (open_date), coalesce(open_date, lead(il_place_date) OVER (PARTITION BY person_id ORDER BY il_place_date, il_place_trans_id)) AS return_date FROM bridged)"""


@register("placement_runs", f"WITH {_PLACED} SELECT * FROM placed")
def placement_runs(spark, sf_dir):
    return P.placements(_transactions(spark, sf_dir))


@register("placement_returns", f"WITH {_RETURNED} SELECT il_place_trans_id, person_id, il_place_date, return_date, return_team_id, return_trans_id FROM returned")
def placement_returns(spark, sf_dir):
    rows = P.activations(P.placements(_transactions(spark, sf_dir)), _transactions(spark, sf_dir), _calendar(spark), _teams(spark))
    return rows.select("il_place_trans_id", "person_id", "il_place_date", "return_date", "return_team_id", "return_trans_id")


@register("appearance_returns", f"WITH {_OVERRIDDEN} SELECT il_place_trans_id, return_date, return_team_id, return_trans_id FROM overridden")
def appearance_returns(spark, sf_dir):
    rows = P.activations(P.placements(_transactions(spark, sf_dir)), _transactions(spark, sf_dir), _calendar(spark), _teams(spark))
    return P.appearance_override(rows, _appearances(spark, sf_dir)).select("il_place_trans_id", "return_date", "return_team_id", "return_trans_id")


def _spans(spark, sf_dir):
    return P.build_spans(told(P.placements(_transactions(spark, sf_dir))), _transactions(spark, sf_dir), _calendar(spark), _teams(spark), _appearances(spark, sf_dir), F.lit(_AS_OF).cast("date"))


@register(
    "span_chain",
    f"WITH {_CHAIN} SELECT *, CAST(coalesce(return_date, DATE '{_AS_OF}') - il_place_date AS BIGINT) AS injury_length, return_date IS NULL AS currently_injured FROM chain_spans",
)
def span_chain(spark, sf_dir):
    return _spans(spark, sf_dir).drop("side")


@register(
    "severe_first_swap",
    f"""
    WITH {_CHAIN}, s AS (SELECT *, coalesce(second_injury_type IN ('tear', 'surgery'), false) AS swap FROM chain_spans)
    SELECT il_place_trans_id, CASE WHEN swap THEN second_raw_injury ELSE raw_injury END AS raw_injury, CASE WHEN swap THEN raw_injury ELSE second_raw_injury END AS second_raw_injury,
           CASE WHEN swap THEN second_injury_type ELSE injury_type END AS injury_type, CASE WHEN swap THEN injury_type ELSE second_injury_type END AS second_injury_type FROM s
    """,
)
def severe_first_swap(spark, sf_dir):
    return P.severe_first(_spans(spark, sf_dir)).select("il_place_trans_id", "raw_injury", "second_raw_injury", "injury_type", "second_injury_type")


@register(
    "roster_attribution",
    f"""
    WITH {_CHAIN}, r AS (SELECT o_custkey AS person_id, o_orderkey % 6 AS team_id, o_orderkey AS roster_sk, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) + 400 ELSE DATE '{_AS_OF}' END AS b,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS status_date FROM orders WHERE o_orderstatus <> 'P'),
    s AS (SELECT *, coalesce(return_date, DATE '{_AS_OF}') AS e FROM chain_spans),
    j AS (SELECT s.il_place_trans_id, s.person_id, coalesce(r.team_id, il_place_team) AS team_id, greatest(il_place_date, a) AS start_date, least(e, b) AS end_date, status_date, roster_sk
        FROM s LEFT JOIN r ON s.person_id = r.person_id AND il_place_date < b AND e >= a)
    SELECT il_place_trans_id, person_id, team_id, start_date, end_date FROM j QUALIFY row_number() OVER (PARTITION BY il_place_trans_id, team_id, start_date, end_date ORDER BY status_date DESC NULLS LAST, roster_sk DESC NULLS LAST) = 1
    """,
)
def roster_attribution(spark, sf_dir):
    day = F.to_date("o_orderdate")
    rosters = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), (F.col("o_orderkey") % 6).alias("team_id"), F.col("o_orderkey").alias("roster_sk"), day.alias("start_date"),
        F.when(F.col("o_orderkey") % 11 > 0, F.date_add(day, 400)).alias("end_date"), F.expr("date_add(to_date(o_orderdate), CAST(o_orderkey % 3 AS INT))").alias("status_date"),
        F.when(F.col("o_orderstatus") == "P", "RA").otherwise("A").alias("status_code"),
    )
    rows = P.by_team(P.with_span_key(_spans(spark, sf_dir)), rosters, F.lit(_AS_OF).cast("date"))
    return rows.select("il_place_trans_id", "person_id", "team_id", "start_date", "end_date")


@register(
    "span_values",
    """
    WITH g AS (SELECT o_custkey AS person_id, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(count(*) * 37 AS BIGINT) AS games_missed FROM orders GROUP BY ALL),
    pay AS (SELECT o_custkey AS person_id, CAST(year(o_orderdate) AS INTEGER) AS season, sum(CAST(round(o_totalprice) AS BIGINT)) AS salary FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
    floors AS (SELECT CAST(y AS INTEGER) AS season, CAST(109000 + (y - 1995) * 10000 AS INTEGER) AS min_salary FROM range(1995, 2002) r(y)),
    paid AS (SELECT person_id, season, CASE WHEN salary < min_salary THEN min_salary ELSE salary END AS salary FROM pay LEFT JOIN floors USING (season)),
    war AS (SELECT c_custkey AS person_id, s.season, CAST(c_custkey % 90 AS DOUBLE) / 16 AS w FROM customer, floors s WHERE c_custkey % 2 = 0),
    j AS (SELECT g.*, CAST(greatest(coalesce(salary, 0), min_salary) AS DOUBLE) AS p, coalesce(w, 0.5) AS w FROM g LEFT JOIN paid USING (person_id, season) LEFT JOIN floors USING (season) LEFT JOIN war USING (person_id, season))
    SELECT person_id, season, games_missed, CAST(round(CASE WHEN games_missed > 162 THEN p ELSE p * games_missed / 162 END / 1000000, 2) AS DOUBLE) AS injured_salary, round(w * games_missed / 162, 1) AS war_missed FROM j
    """,
)
def span_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("season"), "o_orderstatus", F.round("o_totalprice").cast("long").alias("salary"))
    missed = orders.groupBy("person_id", "season").agg((F.count("*") * 37).alias("games_missed"))
    floors = spark.range(1995, 2002).select(F.col("id").cast("int").alias("season"), (109000 + (F.col("id") - 1995) * 10000).cast("int").alias("min_salary"))
    paid = P.salary_by_season(orders.where("o_orderstatus = 'F'"), floors)
    war = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("person_id"), F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("season"), ((F.col("c_custkey") % 90).cast("double") / 16).alias("war_per_162"))
    return P.valued(missed, paid, floors, war).select("person_id", "season", "games_missed", F.col("injured_salary").cast("double"), F.col("war_missed").cast("double"))


@register(
    "projected_value",
    """
    WITH pro AS (SELECT c_custkey AS person_id, CAST(2000 + c_custkey % 2 AS INTEGER) AS season, CASE WHEN c_custkey % 3 = 0 THEN 'position player' ELSE 'pitcher' END AS position, CAST(c_custkey % 900 AS DOUBLE) AS pa0,
        CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 170 AS DOUBLE) END AS games0, CAST(CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 170 WHEN c_custkey % 4 = 1 THEN 0 ELSE c_custkey % 33 END AS DOUBLE) AS games_started, c_acctbal / 997 AS war FROM customer),
    players AS (SELECT c_custkey AS person_id, (['P', 'SS', 'TWP', 'P', 'P'])[c_custkey % 5 + 1] AS abbr FROM customer),
    cleaned AS (SELECT *, CASE WHEN pa0 > 700 THEN 700 ELSE pa0 END AS pa, coalesce(games0, round(pa0 / 4.4, 0)) AS games FROM pro),
    fs AS (SELECT *, CASE WHEN games > 162 THEN 162 WHEN position = 'position player' THEN 162 WHEN position = 'pitcher' AND games_started = games AND games_started < 33 THEN 33
        WHEN position = 'pitcher' AND games_started = 0 AND games < 65 THEN 65 WHEN position = 'pitcher' AND games_started > 1 THEN round(33 * (games_started / games) + 65 * (1 - games_started / games), 0) ELSE games END AS full_games
        FROM cleaned JOIN players USING (person_id) WHERE (abbr = 'P' AND position = 'pitcher') OR (abbr <> 'P' AND position = 'position player') OR abbr = 'TWP')
    SELECT person_id, season, max(position) AS position, sum(pa) AS pa, sum(games) AS games, sum(games_started) AS games_started, round(sum(CASE WHEN games > 0 THEN war / games END), 6) AS war_per_g,
           sum(full_games) AS full_season_games, round(sum(CASE WHEN games > 0 THEN war / games END * full_games), 6) AS war_per_162 FROM fs GROUP BY 1, 2
    """,
)
def projected_value(spark, sf_dir):
    number = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer")
    started = F.when(number % 4 == 0, number % 170).when(number % 4 == 1, 0).otherwise(number % 33)
    projections = rows.select(
        number.alias("person_id"), (2000 + number % 2).cast("int").alias("season"), F.when(number % 3 == 0, "position player").otherwise("pitcher").alias("position"), (number % 900).cast("double").alias("pa"),
        F.when(number % 10 != 0, (number % 170).cast("double")).alias("games"), started.cast("double").alias("games_started"), (F.col("c_acctbal") / 997).alias("war"),
    )
    players = rows.select(number.alias("person_id"), _pick(("P", "SS", "TWP", "P", "P"), "c_custkey").alias("primaryposition_abbreviation"))
    out = P.projected_value(projections, players)
    return out.select("person_id", "season", "position", "pa", "games", "games_started", F.round("war_per_g", 6).alias("war_per_g"), "full_season_games", F.round("war_per_162", 6).alias("war_per_162"))


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _sql_term(term: str) -> str:
    """A term whose separators may have more spaces around them."""
    return "".join(f" *{c} *" if not c.isalnum() else c for c in term)


_BODY, _INJURY = X.BODY_TERMS, X.INJURY_TERMS
_ALL = sorted(dict.fromkeys([*X.SIDES, *_BODY, *_INJURY]), key=lambda t: (-len(t), t))


def _classes(terms: dict) -> str:
    names, kinds = _sql_list(terms), _sql_list(terms.values())
    return f"list_transform(list_filter(found, lambda t: list_contains({names}, t)), lambda t: list_extract({kinds}, list_position({names}, t)))"


@register(
    "injury_parse",
    rf"""
    WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'placed x on the 10-day injured list. ' || (['left ', 'right ', ''])[l_linenumber % 3 + 1] || ({_sql_list(_BODY)})[l_partkey % {len(_BODY)} + 1] || ' ' || ({_sql_list(_INJURY)})[(l_orderkey + l_suppkey) % {len(_INJURY)} + 1] AS text FROM lineitem),
    f AS (SELECT *, list_transform(regexp_extract_all(regexp_replace(text, '([^a-z0-9]+)', ' \1 ', 'g'), '(?:^|[^a-z0-9])({"|".join(map(_sql_term, _ALL))})(?:$|[^a-z0-9])', 1), lambda x: regexp_replace(regexp_replace(x, ' *([^a-z0-9 ]) *', '\1', 'g'), ' +', ' ', 'g')) AS found FROM d),
    c AS (SELECT *, {_classes(_BODY)} AS parts, {_classes(_INJURY)} AS kinds, regexp_matches(text, '\btommy john\b') AS john FROM f),
    j AS (SELECT * REPLACE (CASE WHEN john THEN list_append(parts, 'ucl') ELSE parts END AS parts, CASE WHEN john THEN list_append(kinds, 'tear') ELSE kinds END AS kinds) FROM c),
    o AS (SELECT * REPLACE (CASE WHEN list_contains(parts, 'elbow') AND list_contains(kinds, 'surgery') THEN list_append(parts, 'ucl') ELSE parts END AS parts,
          CASE WHEN list_contains(parts, 'elbow') AND list_contains(kinds, 'surgery') THEN list_append(kinds, 'tear') ELSE kinds END AS kinds) FROM j),
    h AS (SELECT * REPLACE (list_concat(parts, CASE WHEN list_contains(kinds, 'concussion') THEN ['head'] ELSE [] END, CASE WHEN list_contains(kinds, 'thoracic outlet syndrome') THEN ['shoulder'] ELSE [] END,
          CASE WHEN list_contains(kinds, 'plantar fasciitis') THEN ['foot'] ELSE [] END) AS parts) FROM o),
    s AS (SELECT * REPLACE (CASE WHEN list_contains(parts, 'oblique') AND len(kinds) = 0 THEN list_append(kinds, 'strain') ELSE kinds END AS kinds) FROM h),
    r AS (SELECT *, list_filter(found, lambda t: t IN ('left', 'right'))[-1] AS side, list_filter({_sql_list(X.BODY_ORDER)}, lambda t: list_contains(parts, t))[1] AS body_part,
          list_filter({_sql_list(X.INJURY_ORDER)}, lambda t: list_contains(kinds, t))[1] AS injury_type FROM s)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, side, body_part, injury_type,
           CASE {" ".join(f"WHEN list_contains({_sql_list(parts)}, body_part) THEN '{name}'" for name, parts in X.BODY_GROUPS.items())} END AS body_part_group,
           CASE WHEN side IS NULL AND l_linenumber > 3 AND list_contains({_sql_list(X.THROWING_PARTS)}, body_part) THEN 'right' WHEN side IS NULL AND l_linenumber > 3 AND body_part = 'oblique' THEN 'left' ELSE side END AS assumed FROM r
    """,
)
def injury_parse(spark, sf_dir):
    """Every term of the dictionaries with every other, over all line items; pitchers who throw right from line 4 on."""
    text = F.concat(F.lit("placed x on the 10-day injured list. "), _pick(("left ", "right ", ""), "l_linenumber"), _pick(tuple(_BODY), "l_partkey"), F.lit(" "), _pick(tuple(_INJURY), "(l_orderkey + l_suppkey)"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.parse_injury(text).alias("p"))
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p.*")
    position, throws = F.when(F.col("l_linenumber") > 3, "1").otherwise("6"), F.lit("R")
    return rows.withColumns({"body_part_group": X.body_group(F.col("body_part")), "assumed": X.assumed_side(F.col("side"), F.col("body_part"), position, throws)})
