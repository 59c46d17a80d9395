"""Routing and answering of question tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.operators import metrics as M
from dockline.operators import questions as O
from dockline.operators import stations as ST
from dockline.plans.registry import ALL_STATIONS, INFO, QUESTIONS, STATUS, query, with_tables
from dockline.sources import tables as T

SYSTEM_NAME = "The city"
TOOL = """CASE WHEN contains(lower(question), 'how many bikes') THEN 'get_total_bikes'
    WHEN contains(lower(question), 'find') OR contains(lower(question), 'station') THEN 'find_station'
    ELSE 'get_system_status' END"""
WORD = r"""regexp_extract(question, '(\S+)\s*$', 1)"""


@query("routed_questions", with_tables(QUESTIONS) + f"""
    SELECT *, {TOOL} AS tool_used,
           CASE WHEN {TOOL} = 'find_station' THEN CASE WHEN {WORD} = '' THEN 'Berri' ELSE {WORD} END END AS station_param
    FROM questions""")
def routed_questions(spark, folder):
    return O.routed(T.questions(spark, folder))


def _rules_sql(rules, default):
    """CASE text of a rule list."""
    tests = []
    for rule in rules:
        groups = [" OR ".join(f"contains(lower(question), '{k}')" for k in g) for g in rule.groups]
        tests.append(f"WHEN {' AND '.join(f'({g})' for g in groups)} THEN '{rule.tool}'")
    return f"CASE {' '.join(tests)} ELSE '{default}' END"


@query("routed_questions_other_rules", with_tables(QUESTIONS) + f"""
    SELECT conv_id, turn, {_rules_sql(O.STRICT_RULES, O.DEFAULT_TOOL)} AS strict_tool,
           {_rules_sql(O.QUERY_RULES, O.QUERY_DEFAULT_TOOL)} AS query_tool FROM questions""")
def routed_questions_other_rules(spark, folder):
    question = F.col("question")
    return T.questions(spark, folder).select(
        "conv_id", "turn",
        O.route(question, O.STRICT_RULES).alias("strict_tool"),
        O.route(question, O.QUERY_RULES, O.QUERY_DEFAULT_TOOL).alias("query_tool"))


MADE_WORDS = ["How many BIKES are there", "Find the station", "system status please", "where is Berri", "How many stations",
              "utilization now", "find a bike", "station list", "find Berri station", "hello"]


@query("routed_made_questions", """
    WITH made AS (SELECT event_id, CASE event_id % 10
        WHEN 0 THEN 'How many BIKES are there' WHEN 1 THEN 'Find the station' WHEN 2 THEN 'system status please'
        WHEN 3 THEN 'where is Berri' WHEN 4 THEN 'How many stations' WHEN 5 THEN 'utilization now' WHEN 6 THEN 'find a bike'
        WHEN 7 THEN 'station list' WHEN 8 THEN 'find Berri station' ELSE 'hello' END || ' ' || event_type AS question FROM events)
    SELECT event_id, question,
      CASE event_id % 10 WHEN 0 THEN 'get_total_bikes' WHEN 1 THEN 'find_station' WHEN 4 THEN 'find_station' WHEN 6 THEN 'find_station'
        WHEN 7 THEN 'find_station' WHEN 8 THEN 'find_station' ELSE 'get_system_status' END AS tool_used,
      CASE WHEN event_id % 10 IN (1, 4, 6, 7, 8) THEN regexp_extract(question, '([a-z_]+)$', 1) END AS station_param,
      CASE event_id % 10 WHEN 0 THEN 'get_total_bikes' WHEN 1 THEN 'find_station' WHEN 8 THEN 'find_station'
        ELSE 'get_system_status' END AS strict_tool,
      CASE event_id % 10 WHEN 0 THEN 'get_total_bikes' WHEN 2 THEN 'get_system_status' WHEN 3 THEN 'get_station_by_name'
        WHEN 4 THEN 'count_total_stations' WHEN 5 THEN 'get_system_utilization' WHEN 8 THEN 'get_station_by_name'
        ELSE 'top_stations' END AS query_tool
    FROM made""")
def routed_made_questions(spark, folder):
    """Questions put together from the events, so that every rule of all three lists is taken."""
    text = F.element_at(F.array(*[F.lit(w) for w in MADE_WORDS]), (F.pmod("event_id", F.lit(10)) + 1).cast("int"))
    made = T.table(spark, folder, "events").select("event_id", F.concat_ws(" ", text, F.col("event_type")).alias("question"))
    question = F.col("question")
    return O.routed(made).withColumns({
        "strict_tool": O.route(question, O.STRICT_RULES), "query_tool": O.route(question, O.QUERY_RULES, O.QUERY_DEFAULT_TOOL)})


def _figures(spark, folder):
    status, info = T.station_status(spark, folder), T.station_information(spark, folder)
    return M.feed_metrics(info, status), ST.merge_stations(status, info, how="left")


ANSWERS = with_tables(INFO, STATUS, ALL_STATIONS, "asked AS (SELECT {asked})", """figures AS (
  SELECT (SELECT count(*) FROM info) AS stations, (SELECT CAST(sum(num_bikes_available) AS BIGINT) FROM status) AS bikes,
         (SELECT CAST(sum(capacity) AS BIGINT) FROM info) AS capacity)""", f"""tooled AS (
  SELECT *, {TOOL} AS tool_used, CASE WHEN {WORD} = '' THEN 'Berri' ELSE {WORD} END AS word FROM asked)""") + """
    SELECT t.conv_id, t.turn, t.question, tool_used,
      CASE WHEN tool_used = 'get_total_bikes' THEN format('There are currently {:,} bikes available.', bikes)
           WHEN tool_used = 'find_station' AND n.name IS NOT NULL
             THEN printf('Station ''%s'' has %d bikes available.', n.name, coalesce(n.num_bikes_available, 0))
           WHEN tool_used = 'find_station' THEN printf('Station ''%s'' not found.', word)
           WHEN contains(lower(t.question), 'status')
             THEN format('The city has {:,} stations with {:,} bikes available ({}% utilization).', stations, bikes, pct)
           ELSE format('The city system: {:,} stations, {:,} bikes, {}% utilization', stations, bikes, pct) END AS answer
    FROM tooled t CROSS JOIN (SELECT *, CAST(floor(1000 * CAST(bikes AS DOUBLE) / capacity + 0.5) / 10 AS VARCHAR) AS pct FROM figures)
    LEFT JOIN (SELECT w.word AS looked, arg_min(e.name, e.position) AS name,
                      arg_min(e.num_bikes_available, e.position) AS num_bikes_available
               FROM (SELECT DISTINCT word FROM tooled WHERE tool_used = 'find_station') w
               JOIN everything e ON contains(lower(e.name), lower(w.word)) GROUP BY 1) n ON n.looked = t.word
"""


@query("answered_questions", ANSWERS.replace("{asked}", "conv_id, turn, text AS question FROM conversations WHERE role = 'user'"))
def answered_questions(spark, folder):
    metrics, stations = _figures(spark, folder)
    return O.answers(T.questions(spark, folder), metrics, stations, SYSTEM_NAME)


# The invented prose never asks for a station, so part names are asked for by hand.
@query("answered_station_questions",
       ANSWERS.replace("{asked}", "p_partkey AS conv_id, 0 AS turn, 'Find ' || substr(p_name, 2) AS question FROM part"))
def answered_station_questions(spark, folder):
    """One question per part, about the end of its name."""
    asked = T.table(spark, folder, "part").select(
        F.col("p_partkey").alias("conv_id"), F.lit(0).alias("turn"),
        F.concat(F.lit("Find "), F.substring("p_name", 2, 1000)).alias("question"))
    metrics, stations = _figures(spark, folder)
    return O.answers(asked, metrics, stations, SYSTEM_NAME)
