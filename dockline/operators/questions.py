"""Tables of user questions: routing to a tool, parameters, answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.functions import columns as C
from dockline.operators.trips import spread_key


@dataclass(frozen=True)
class Rule:
    """A tool, and keyword groups of which every one must be met by some keyword."""

    tool: str
    groups: tuple[tuple[str, ...], ...]


# --- fixed values: rule order, keywords, default tools, answer formats -----
ASSISTANT_RULES = (
    Rule("get_total_bikes", (("how many bikes",),)),
    Rule("find_station", (("find", "station"),)),
    Rule("get_system_status", (("status",),)),
)
STRICT_RULES = (
    Rule("get_total_bikes", (("how many bikes",),)),
    Rule("find_station", (("station",), ("find", "berri"))),
    Rule("get_system_status", (("status",),)),
)
QUERY_RULES = (
    Rule("get_station_by_name", (("berri",),)),
    Rule("get_total_bikes", (("how many bikes",),)),
    Rule("count_total_stations", (("how many stations",),)),
    Rule("get_system_utilization", (("utilization",),)),
    Rule("get_system_status", (("system status",),)),
)
DEFAULT_TOOL = "get_system_status"
QUERY_DEFAULT_TOOL = "top_stations"
DEFAULT_STATION = "Berri"
BIKES_ANSWER = "There are currently %s bikes available."
STATION_ANSWER = "Station '%s' has %d bikes available."
MISSING_ANSWER = "Station '%s' not found."
STATUS_ANSWER = "%s has %s stations with %s bikes available (%s%% utilization)."
OTHER_ANSWER = "%s system: %s stations, %s bikes, %s%% utilization"
# --------------------------------------------------------------------------


def route(question: Column, rules: tuple[Rule, ...] = ASSISTANT_RULES, default: str = DEFAULT_TOOL) -> Column:
    """Tool of the first rule whose keywords occur in the question."""
    text, column = F.lower(question), None
    for rule in rules:
        test = F.lit(True)
        for group in rule.groups:
            anyone = F.lit(False)
            for keyword in group:
                anyone = anyone | F.contains(text, F.lit(keyword))
            test = test & anyone
        column = F.when(test, F.lit(rule.tool)) if column is None else column.when(test, F.lit(rule.tool))
    return column.otherwise(F.lit(default))


def last_word(question: Column) -> Column:
    """Last word of the question, or the default station for a blank one."""
    word = F.regexp_extract(question, r"(\S+)\s*$", 1)
    return F.when(word == "", F.lit(DEFAULT_STATION)).otherwise(word)


def routed(questions: DataFrame, **kwargs) -> DataFrame:
    tool = route(F.col("question"), **kwargs)
    return questions.withColumn("tool_used", tool).withColumn(
        "station_param", F.when(F.col("tool_used") == "find_station", last_word(F.col("question"))))


def first_station_per_text(words: DataFrame, stations: DataFrame) -> DataFrame:
    """For each word, the first station in feed order whose name contains it.

    Matching words against names pairwise would be a nested loop. A word holds
    no blank, so it lies inside one token of a name: names are folded to their
    distinct tokens (first station each), and tokens to their substrings of
    lengths that the words have, so that a long token gives a few short strings
    per character. Substrings that are no word are left out before they are
    grouped, and each word gets at most one match.
    """
    asked = words.select(F.lower("word").alias("piece")).distinct()
    lengths = asked.agg(F.array_sort(F.collect_set(F.length("piece"))).alias("n"))
    tokens = (
        stations.select("position", "station_id", "name", "num_bikes_available",
                        F.explode(F.split(F.lower("name"), r"\s+")).alias("token"))
        .groupBy("token")
        .agg(F.min(F.struct("position", "station_id", "name", "num_bikes_available")).alias("station"))
    )
    pieces = (
        # One row of lengths, as many as the words have, beside every token.
        tokens.withColumn("all", lengths.scalar()).select("station", "token", F.explode("all").alias("n"))
        .where((F.col("n") > 0) & (F.col("n") <= F.length("token")))
        .select("station", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - F.col("n") + 1),
                                                 lambda at: F.substring(F.col("token"), at, F.col("n")))).alias("piece"))
        .join(asked, "piece", "left_semi")
        .groupBy("piece").agg(F.min("station").alias("station"))
    )
    return (
        words.join(pieces, F.lower("word") == F.col("piece"))
        .select("word", "station.station_id", "station.name", "station.num_bikes_available")
    )


def answers(questions: DataFrame, metrics: DataFrame, stations: DataFrame, system_name: str) -> DataFrame:
    """Question, tool and answer text, naming the system as told.

    ``metrics`` is the one-row frame of system metrics and enters as a scalar.
    Only distinct station words are looked up, and the answers are joined back.
    """
    asked = routed(questions)
    words = asked.select(F.col("station_param").alias("word")).filter(F.col("word").isNotNull()).distinct()
    found = first_station_per_text(words, stations).select(
        F.col("word").alias("station_param"), "name", "num_bikes_available")
    figures = metrics.select(
        F.struct(
            F.format_number("total_stations", 0).alias("stations"),
            F.format_number("total_bikes", 0).alias("bikes"),
            C.percent(F.col("total_bikes"), F.col("capacity")).cast("string").alias("utilization"),
        ).alias("m")).scalar()
    system = [F.lit(system_name), figures["stations"], figures["bikes"], figures["utilization"]]
    answer = (
        F.when(F.col("tool_used") == "get_total_bikes", F.format_string(BIKES_ANSWER, figures["bikes"]))
        .when((F.col("tool_used") == "find_station") & F.col("name").isNotNull(),
              F.format_string(STATION_ANSWER, F.col("name"), C.count_of("num_bikes_available")))
        .when(F.col("tool_used") == "find_station", F.format_string(MISSING_ANSWER, F.col("station_param")))
        .when(F.contains(F.lower("question"), F.lit("status")), F.format_string(STATUS_ANSWER, *system))
        .otherwise(F.format_string(OTHER_ANSWER, *system))
    )
    # Questions without a station word are spread over the tasks; they match nothing.
    key = spread_key(F.col("station_param"), F.col("question"))
    known = found.withColumn("station_key", F.concat(F.lit("="), F.col("station_param"))).drop("station_param")
    return (
        asked.withColumn("station_key", key).join(known, "station_key", "left")
        .select(*questions.columns, "tool_used", answer.alias("answer"))
    )
