"""The registered queries on the star-schema tables, and an SQL form of each.

The SQL is written for DuckDB, independently of the operators: joins first, filters and
grouping as the definition of each report says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import plans
from tarmac.functions import aircraft_type, delay_minutes, model_label, seconds_of_day
from tarmac.model import AIRCRAFTS, AIRLINES, FLIGHTS, RELATIONS
from tarmac.operators import filters, frequent, joins, ranking
from tarmac.sinks import tuple_lines, write_flights_by_year, write_tuple_text
from tarmac.plans import totals
from tarmac.sources import Star, read_parquet, read_relation, read_star
from tarmac.sources.bucketed import join_in_buckets, read_in_buckets, write_dimension_in_buckets, write_flights_in_buckets
from tarmac.sources.scratch import scratch_folder, write_csv_lines

# The manufacturer, country and year the queries ask for.
MANUFACTURER = "ECONOMY"
COUNTRY = "NATION_1"
YEAR = "1998"

Query = Callable[[SparkSession, str], DataFrame]


def _on_star(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: build(read_star(spark, folder))


def _on_year(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: build(read_star(spark, folder, YEAR))


def _dims(s: Star) -> tuple[DataFrame, DataFrame, DataFrame]:
    return s.flights, s.aircrafts, s.airlines


def _delays(s: Star, minutes: str = "of_hour", known_aircraft: str = "inner", limit: int | None = None) -> DataFrame:
    return plans.departure_delay(*_dims(s), YEAR, COUNTRY, minutes, known_aircraft, limit)


def _listed_twice(s: Star) -> Star:
    return Star(s.flights, s.aircrafts.unionAll(s.aircrafts), s.airlines)


def _used(s: Star) -> DataFrame:
    """Airline and aircraft type of each flight."""
    facts = joins.with_airline(s.flights.select("carrier_code", "tail_number"), s.airlines)
    return joins.with_aircraft(facts, s.aircrafts).select("airline", "aircraft_type")


def _delay_total(column: str) -> Callable[[Star], DataFrame]:
    return lambda s: plans.delay_totals(s.flights, s.airlines).select("airline", column)


def _csv_scan(relation_name: str, header: bool = True) -> Query:
    """Write the relation as CSV with lines cut short and lines too long among them, and read it back."""
    relation = RELATIONS[relation_name]

    def build(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_folder(spark)
        write_csv_lines(getattr(read_star(spark, folder), relation_name), relation, path, header)
        return read_relation(spark, path, relation, header=header)

    return build


def _quoted_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all fields in quotes, and commas, quotes and line breaks in the countries."""
    path = scratch_folder(spark)
    airlines = read_star(spark, folder).airlines
    country = F.concat("country", F.lit(',\n"'), "name", F.lit('"\n'))
    write_csv_lines(airlines.withColumn("country", country), AIRLINES, path, header=False, quoted=True)
    return read_relation(spark, path, AIRLINES, quoted=True, header=False)


def _text_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark)
    write_tuple_text(_delays(read_star(spark, folder, YEAR)), path, single_file=True)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _partitioned_year(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark)
    write_flights_by_year(read_star(spark, folder).flights, path)
    return filters.by_year(read_parquet(spark, path, FLIGHTS), YEAR).select(*FLIGHTS.columns)


def _years_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """The table by year after one year came again without some of its flights."""
    path = scratch_folder(spark)
    flights = read_star(spark, folder).flights
    write_flights_by_year(flights, path)
    write_flights_by_year(filters.by_year(flights, YEAR).where("actual_departure <> ''"), path, replace="years")
    return read_parquet(spark, path, FLIGHTS).select(*FLIGHTS.columns)


def _in_buckets(key: str) -> Query:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        s = read_star(spark, folder)
        dimension = joins.aircraft_columns(s.aircrafts) if key == "tail_number" else joins.airline_columns(s.airlines)
        facts, dims = scratch_folder(spark), scratch_folder(spark)
        write_flights_in_buckets(s.flights, facts, key, buckets=16)
        write_dimension_in_buckets(dimension, dims, read_in_buckets(spark, facts))
        return join_in_buckets(read_in_buckets(spark, facts), read_in_buckets(spark, dims))

    return build


def _delay_of_states(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries of flights, one of them twice, and the report from their states."""
    path = scratch_folder(spark)
    s = read_star(spark, folder)
    third = F.pmod(F.xxhash64(*s.flights.columns), F.lit(3))
    for i in (0, 1, 2, 1):
        totals.add_flights(s.flights.where(third == i), path, f"delivery-{i}")
    return totals.departure_delay_of_states(totals.read_states(spark, path), s.aircrafts, s.airlines, YEAR, COUNTRY)


def queries() -> dict[str, Query]:
    on_star: dict[str, Callable[[Star], DataFrame]] = {
        # Reports
        "top_models": lambda s: plans.top_models(s.flights, s.aircrafts, MANUFACTURER),
        "popular_types_all": lambda s: plans.popular_types(*_dims(s)),
        "popular_types_country": lambda s: plans.popular_types(*_dims(s), COUNTRY),
        "popular_types_distinct_tails": lambda s: plans.popular_types(*_dims(s), measure="distinct_tails"),
        # The same without broadcasting, as with dimensions of any size
        "top_models_shuffled": lambda s: plans.top_models(s.flights, s.aircrafts, MANUFACTURER, limit=0),
        "popular_types_shuffled": lambda s: plans.popular_types(*_dims(s), limit=0),
        # Column expressions
        "model_labels": lambda s: s.aircrafts.select("tail_number", model_label(F.col("model")).alias("label")),
        "seconds_of_day": lambda s: s.flights.select(
            "scheduled_departure",
            "actual_departure",
            seconds_of_day(F.col("scheduled_departure")).alias("scheduled_seconds"),
            seconds_of_day(F.col("actual_departure")).alias("actual_seconds"),
        ),
        "delay_minutes": lambda s: s.flights.select(
            "scheduled_departure",
            "actual_departure",
            delay_minutes(F.col("scheduled_departure"), F.col("actual_departure")).alias("delay"),
            delay_minutes(F.col("scheduled_departure"), F.col("actual_departure"), "total").alias("total_delay"),
        ),
        # Filters
        "manufacturer_filter": lambda s: filters.by_manufacturer(s.aircrafts, MANUFACTURER),
        "country_filter": lambda s: filters.by_country(s.airlines, COUNTRY),
        "delayed_flights": lambda s: filters.delayed(s.flights),
        # Joins
        "flights_with_aircraft": lambda s: joins.with_aircraft(s.flights, s.aircrafts),
        "flights_with_airline": lambda s: joins.with_airline(s.flights, s.airlines),
        "flights_of_known_aircraft": lambda s: joins.with_aircraft(
            s.flights, filters.by_manufacturer(s.aircrafts, MANUFACTURER), how="left_semi"
        ),
        "flights_with_aircraft_shuffled": lambda s: joins.with_aircraft(s.flights, s.aircrafts, limit=0),
        "flights_with_airline_shuffled": lambda s: joins.with_airline(s.flights, s.airlines, limit=0),
        # Aggregates
        "flights_per_model": lambda s: plans.flights_per_model(s.flights, s.aircrafts, MANUFACTURER),
        "delay_count": _delay_total("delayed_flights"),
        "delay_sum": _delay_total("total_delay"),
        "delay_min": _delay_total("min_delay"),
        "delay_max": _delay_total("max_delay"),
        "delay_avg": _delay_total("avg_delay"),
        # Rankings and lists
        "type_counts": lambda s: plans.type_counts(*_dims(s)),
        "top_types_per_airline": lambda s: plans.top_types(*_dims(s)),
        "type_lists": lambda s: ranking.ordered_list(
            plans.top_types(*_dims(s), COUNTRY, n=3), "airline", "aircraft_type", "aircraft_types"
        ),
        # More than Spark cuts off in the tasks by itself
        "top_2000_types_per_airline": lambda s: plans.top_types(*_dims(s), n=2000),
        "top_n_global": lambda s: ranking.top_n(
            plans.type_counts(*_dims(s)), "n", ["aircraft_type", "airline"], 20
        ),
        "airlines_by_name": lambda s: s.airlines.orderBy("name", "carrier_code"),
        # Read twice with bounded memory, not grouped
        "approx_top_types": lambda s: frequent.approx_top_n(_used(s), "airline", "aircraft_type", 5).drop("sure"),
        # Text output
        "tuple_lines": lambda s: tuple_lines(plans.type_counts(*_dims(s))),
    }
    # Of one year, which is all that is read of the flights. Aircrafts listed twice double their flights in an inner join
    # and not in a semi join.
    on_year: dict[str, Callable[[Star], DataFrame]] = {
        "departure_delay": _delays,
        "departure_delay_total_minutes": lambda s: _delays(s, minutes="total"),
        "departure_delay_semi_join": lambda s: _delays(s, known_aircraft="left_semi"),
        "departure_delay_cancelled": lambda s: plans.departure_delay(*_dims(s), YEAR, COUNTRY, cancelled=True),
        "departure_delay_listed_twice": lambda s: _delays(_listed_twice(s)),
        "departure_delay_listed_twice_semi": lambda s: _delays(_listed_twice(s), known_aircraft="left_semi"),
        "departure_delay_shuffled": lambda s: _delays(s, limit=0),
        "year_filter": lambda s: filters.by_year(s.flights, YEAR),
    }
    return {n: _on_star(b) for n, b in on_star.items()} | {n: _on_year(b) for n, b in on_year.items()} | {
        "csv_scan": _csv_scan(FLIGHTS.name),
        "csv_scan_aircrafts": _csv_scan(AIRCRAFTS.name),
        "csv_scan_airlines": _csv_scan(AIRLINES.name),
        "csv_scan_no_header": _csv_scan(FLIGHTS.name, header=False),
        "csv_scan_quoted": _quoted_scan,
        "text_sink": _text_sink,
        "flights_by_year_table": _partitioned_year,
        "flights_by_year_replaced": _years_replaced,
        "flights_with_aircraft_bucketed": _in_buckets("tail_number"),
        "flights_with_airline_bucketed": _in_buckets("carrier_code"),
        "departure_delay_of_states": _delay_of_states,
    }


def _sql_clock(seconds: str) -> str:
    part = "lpad(cast({} as varchar), 2, '0')"
    parts = [f"({seconds}) // 3600", f"(({seconds}) // 60) % 60", f"({seconds}) % 60"]
    return " || ':' || ".join(part.format(p) for p in parts)


_SCHEDULED = "(l_orderkey * 61 + l_linenumber * 7919) % 86400"
_ACTUAL = "(l_orderkey * 61 + l_linenumber * 7919 + (cast(l_quantity as bigint) - 10) * 180 + 86400) % 86400"

RELATIONS_SQL = f"""
with airlines as (
  select 'S' || cast(s_suppkey as varchar) as carrier_code, s_name as name, n_name as country
  from supplier join nation on s_nationkey = n_nationkey
),
aircrafts as (
  select 'N' || cast(p_partkey as varchar) as tail_number, p_type as manufacturer,
         upper(substr(p_name, 1, 1)) || cast(100 + 10 * (p_size % 10) as varchar)
           || '-' || cast(p_size % 2 as varchar) as model
  from part
),
flights as (
  select 'S' || cast(l_suppkey as varchar) as carrier_code,
         strftime(l_shipdate, '%Y-%m-%d') as flight_date,
         'N' || cast(l_partkey as varchar) as tail_number,
         {_sql_clock(_SCHEDULED)} as scheduled_departure,
         case when l_returnflag = 'R' and l_linenumber = 1 then ''
              else {_sql_clock(_ACTUAL)} end as actual_departure
  from lineitem
)"""

_TIMED_SQL = RELATIONS_SQL + """,
split_times as (
  select *, string_split(scheduled_departure, ':') as s, string_split(actual_departure, ':') as a
  from flights
),
timed as (
  select * exclude (s, a),
         try_cast(s[1] as bigint) * 3600 + try_cast(s[2] as bigint) * 60 + try_cast(s[3] as bigint)
           as scheduled_seconds,
         try_cast(a[1] as bigint) * 3600 + try_cast(a[2] as bigint) * 60 + try_cast(a[3] as bigint)
           as actual_seconds
  from split_times
),
late as (
  select *, (actual_seconds - scheduled_seconds) // 60 as whole,
         ((actual_seconds - scheduled_seconds) // 60) % 60 as of_hour
  from timed where scheduled_seconds < actual_seconds
)"""

_USED_SQL = RELATIONS_SQL + """,
used as (
  select name as airline, country, manufacturer || ' ' || model as aircraft_type, tail_number
  from flights join aircrafts using (tail_number) join airlines using (carrier_code)
)"""

_LABEL_SQL = "'Cessna ' || substr(trim(regexp_replace(model, '[^0-9]+', ' ', 'g')), 1, 3)"

_DATED_SQL = "select carrier_code, flight_date, tail_number, scheduled_departure, actual_departure from flights"


def _top_models_sql(top: str) -> str:
    return RELATIONS_SQL + f"""
select {_LABEL_SQL} as model, count(*) as flights
from flights join aircrafts using (tail_number) where manufacturer = '{MANUFACTURER}'
group by 1 {top}"""


def _departure_delay_sql(minutes: str, aircrafts: str = "aircrafts") -> str:
    return _TIMED_SQL + f"""
select name as airline, count(*) as delayed_flights, cast(sum({minutes}) // count(*) as bigint) as avg_delay,
       min({minutes}) as min_delay, max({minutes}) as max_delay
from late join airlines using (carrier_code) join {aircrafts} using (tail_number)
where contains(country, '{COUNTRY}') and substr(flight_date, 1, 4) = '{YEAR}' and {minutes} > 0
group by name"""


_CANCELLED_SQL = f"""
select name as airline, count(*) as cancelled_flights
from timed join airlines using (carrier_code) join aircrafts using (tail_number)
where contains(country, '{COUNTRY}') and substr(flight_date, 1, 4) = '{YEAR}'
  and (scheduled_seconds is null or actual_seconds is null)
group by name"""


def _delay_and_cancelled_sql(join: str) -> str:
    return f"""
select airline, coalesce(delayed_flights, 0) as delayed_flights, avg_delay, min_delay, max_delay,
       coalesce(cancelled_flights, 0) as cancelled_flights
from ({_departure_delay_sql("of_hour")}) {join} join ({_TIMED_SQL}{_CANCELLED_SQL}) using (airline)"""


def _ranked_sql(where: str = "", count: str = "count(*)") -> str:
    return _USED_SQL + f""",
counted as (select airline, aircraft_type, {count} as n from used {where} group by airline, aircraft_type),
ranked as (
  select *, row_number() over (partition by airline order by n desc, aircraft_type) as rank from counted
)"""


def _popular_types_sql(where: str = "", count: str = "count(*)", n: int = 5) -> str:
    return _ranked_sql(where, count) + f"""
select airline, '[' || string_agg(aircraft_type, ', ' order by rank) || ']' as aircraft_types
from ranked where rank <= {n} group by airline"""


def _delay_aggregate_sql(aggregate: str, name: str) -> str:
    return _TIMED_SQL + f"""
select name as airline, cast({aggregate} as bigint) as {name}
from late join airlines using (carrier_code) where of_hour > 0 group by name"""


def oracle_sql() -> dict[str, str]:
    top_models = _top_models_sql("order by 2 desc, 1 limit 3")
    departure_delay = _departure_delay_sql("of_hour")
    in_country = f"where contains(country, '{COUNTRY}')"
    with_aircraft = RELATIONS_SQL + """
select carrier_code, flight_date, tail_number, scheduled_departure, actual_departure, manufacturer, model,
       manufacturer || ' ' || model as aircraft_type
from flights join aircrafts using (tail_number)"""
    with_airline = RELATIONS_SQL + """
select carrier_code, flight_date, tail_number, scheduled_departure, actual_departure, name as airline, country
from flights join airlines using (carrier_code)"""
    return {
        "top_models": top_models,
        "departure_delay": departure_delay,
        "departure_delay_total_minutes": _departure_delay_sql("whole"),
        "departure_delay_semi_join": departure_delay,
        "departure_delay_listed_twice": _departure_delay_sql(
            "of_hour", "(select * from aircrafts union all select * from aircrafts)"
        ),
        "departure_delay_listed_twice_semi": departure_delay,
        "departure_delay_cancelled": _delay_and_cancelled_sql("full"),
        "departure_delay_of_states": _delay_and_cancelled_sql("left"),
        "popular_types_all": _popular_types_sql(),
        "popular_types_country": _popular_types_sql(in_country),
        "popular_types_distinct_tails": _popular_types_sql(count="count(distinct tail_number)"),
        "top_models_shuffled": top_models,
        "departure_delay_shuffled": departure_delay,
        "popular_types_shuffled": _popular_types_sql(),
        "model_labels": RELATIONS_SQL + f"\nselect tail_number, {_LABEL_SQL} as label from aircrafts",
        "seconds_of_day": _TIMED_SQL + """
select scheduled_departure, actual_departure, scheduled_seconds, actual_seconds from timed""",
        "delay_minutes": _TIMED_SQL + """
select scheduled_departure, actual_departure,
       case when (actual_seconds - scheduled_seconds) // 60 % 60 > 0
            then (actual_seconds - scheduled_seconds) // 60 % 60 end as delay,
       case when (actual_seconds - scheduled_seconds) // 60 > 0
            then (actual_seconds - scheduled_seconds) // 60 end as total_delay
from timed""",
        "manufacturer_filter": RELATIONS_SQL + f"\nselect * from aircrafts where manufacturer = '{MANUFACTURER}'",
        "country_filter": RELATIONS_SQL + f"\nselect * from airlines {in_country}",
        "year_filter": RELATIONS_SQL + f"\n{_DATED_SQL} where substr(flight_date, 1, 4) = '{YEAR}'",
        "delayed_flights": _TIMED_SQL + """
select carrier_code, flight_date, tail_number, scheduled_departure, actual_departure, of_hour as delay
from late where of_hour > 0""",
        "flights_with_aircraft": with_aircraft,
        "flights_with_airline": with_airline,
        "flights_with_airline_shuffled": with_airline,
        "flights_of_known_aircraft": RELATIONS_SQL + f"""
{_DATED_SQL} where tail_number in (select tail_number from aircrafts where manufacturer = '{MANUFACTURER}')""",
        "flights_with_aircraft_shuffled": with_aircraft,
        "flights_per_model": _top_models_sql(""),
        "delay_count": _delay_aggregate_sql("count(*)", "delayed_flights"),
        "delay_sum": _delay_aggregate_sql("sum(of_hour)", "total_delay"),
        "delay_min": _delay_aggregate_sql("min(of_hour)", "min_delay"),
        "delay_max": _delay_aggregate_sql("max(of_hour)", "max_delay"),
        "delay_avg": _delay_aggregate_sql("sum(of_hour) // count(*)", "avg_delay"),
        "type_counts": _ranked_sql() + "\nselect airline, aircraft_type, n from counted",
        "top_types_per_airline": _ranked_sql() + "\nselect airline, aircraft_type, n, rank from ranked where rank <= 5",
        "top_2000_types_per_airline": _ranked_sql() + "\nselect airline, aircraft_type, n, rank from ranked where rank <= 2000",
        "type_lists": _popular_types_sql(in_country, n=3),
        "top_n_global": _ranked_sql() + """
select airline, aircraft_type, n from counted order by n desc, aircraft_type, airline limit 20""",
        "airlines_by_name": RELATIONS_SQL + "\nselect * from airlines order by name, carrier_code",
        "approx_top_types": _ranked_sql() + "\nselect airline, rank, aircraft_type, n as flights from ranked where rank <= 5",
        "tuple_lines": _ranked_sql() + """
select '(' || airline || ',' || aircraft_type || ',' || n || ')' as line from counted""",
        "csv_scan": RELATIONS_SQL + f"\n{_DATED_SQL}",
        "csv_scan_aircrafts": RELATIONS_SQL + "\nselect * from aircrafts",
        "csv_scan_airlines": RELATIONS_SQL + "\nselect * from airlines",
        "csv_scan_no_header": RELATIONS_SQL + f"\n{_DATED_SQL}",
        "csv_scan_quoted": RELATIONS_SQL + """
select carrier_code, name, country || ',' || chr(10) || '"' || name || '"' || chr(10) as country from airlines""",
        "text_sink": f"""
select '(' || airline || ',' || delayed_flights || ',' || avg_delay || ',' || min_delay || ',' || max_delay || ')'
         as line
from ({departure_delay})""",
        "flights_by_year_replaced": RELATIONS_SQL + f"""
{_DATED_SQL} where substr(flight_date, 1, 4) <> '{YEAR}' or actual_departure <> ''""",
        "flights_with_aircraft_bucketed": with_aircraft,
        "flights_with_airline_bucketed": with_airline,
        "flights_by_year_table": RELATIONS_SQL + f"\n{_DATED_SQL} where substr(flight_date, 1, 4) = '{YEAR}'",
    }
