"""The library's functions called from SQL."""

from __future__ import annotations

from catalog import queries_e, queries_f, views as V  # noqa: F401, the SQL of their queries is used
from catalog.base import ORACLES, query
from signalpost.functions import sql
from signalpost.operators import aggregates
from signalpost.plans import interest


def _run(spark, text, **tables):
    sql.register(spark)
    return spark.sql(text, **tables)


def _same_as(name):
    """A query whose result is that of the operator it calls from SQL."""
    def register(fn):
        ORACLES[f"{name}_from_sql"] = ORACLES[name]
        return query(f"{name}_from_sql", digits=4 if name in ("g01_interpolation", "g02_warping_distance") else 6)(fn)
    return register


@_same_as("g01_interpolation")
def g01(spark, sf):
    return _run(spark, """SELECT url, boosted(num_views, posted_at(upload_date, upload_time), upload_date, TIMESTAMP '2001-07-31 00:00:00', 48) AS num_views
      FROM {posts}""", posts=V.long_posts(spark, sf))


@_same_as("g02_warping_distance")
def g02(spark, sf):
    return _run(spark, """SELECT car_name, issue, trigger_date, warping_distance(
        transform(filter(series, p -> p.upload_date <= trigger_date), p -> p.norm_graph_score),
        transform(filter(series, p -> p.upload_date >= trigger_date), p -> p.norm_graph_score)) AS distance FROM {cases}""", cases=interest.past_cases(V.series(spark, sf)))


@query("g03_adjusted_dates_from_sql", """SELECT car_name, issue, CAST(trigger_date AS VARCHAR) AS trigger_date,
  CAST(upload_date + CAST(DATE '2024-01-31' - trigger_date AS INTEGER) AS VARCHAR) AS upload_date, round(score, 6) AS norm_graph_score FROM case_points""", "case_points")
def g03(spark, sf):
    return _run(spark, """SELECT car_name, issue, trigger_date, inline(moved) FROM (
        SELECT *, shifted_series(series, datediff(DATE '2024-01-31', trigger_date)) AS moved FROM {cases})""",
                cases=interest.past_cases(V.series(spark, sf)))


def _features(spark, posts, asof):
    """Daily features of each series as arrays in order of time."""
    daily = aggregates.daily_features_in_one_pass(interest.labelled_posts(posts, asof))
    return spark.sql("""SELECT car_name, issue, transform(p, x -> x.upload_date) AS days, transform(p, x -> x.avg_log_view) AS views, transform(p, x -> x.sum_log_like) AS likes
      FROM (SELECT car_name, issue, array_sort(collect_list(struct(upload_date, avg_log_view, sum_log_like))) AS p FROM {daily} GROUP BY car_name, issue)""", daily=daily)


@_same_as("g04_graph_score")
def g04(spark, sf):
    return _run(spark, """SELECT car_name, issue, inline(arrays_zip(days, zip_with(v, l, (a, b) -> a * b))) FROM (
        SELECT car_name, issue, days, moving_average(views, 0.05D) AS v, moving_average(likes, 0.02D) AS l FROM {features})""",
                features=_features(spark, V.long_posts(spark, sf), V.LONG_ASOF)).toDF("car_name", "issue", "upload_date", "score")


@_same_as("g05_trigger_points")
def g05(spark, sf):
    nested = aggregates.nest_series(V.series(spark, sf), interest.SERIES)
    found = _run(spark, """SELECT car_name, issue, inline(arrays_zip(days, flags)) FROM (
        SELECT car_name, issue, transform(series, p -> p.upload_date) AS days, trigger_flags(transform(series, p -> p.norm_graph_score), 7, 1.8D) AS flags FROM {nested})""", nested=nested).toDF("car_name", "issue", "trigger_date", "flag")
    return found.filter("flag").drop("flag")


@_same_as("g06_cleaned_rows")
def g06(spark, sf):
    raw = V.raw_posts(spark, sf).na.fill("")
    dictionary = ", ".join(f"named_struct('label', '{label}', 'keys', array({', '.join(repr(k) for k in keys)}))" for label, keys in V.POST_DICTIONARY)
    rules, aliases = (", ".join(f"'{k}', '{v}'" for k, v in x.items()) for x in (V.URL_RULES, V.ALIASES))
    return _run(spark, f"""SELECT event_id, regexp_extract(Date, r'(\\S+)', 1) AS day, clean_count(View) AS views, clean_count(Like) AS likes,
      to_json(tag_issues(concat(Title, Body), array({dictionary}))) AS issue, clean_url(Url, Community, map({rules})) AS url,
      coalesce(try_element_at(map({aliases}), CarName), CarName) AS car_name FROM {{raw}}""", raw=raw)


@_same_as("e18_split_range")
def e18(spark, sf):
    return _run(spark, """SELECT event_id, part, start_datetime, end_datetime FROM {events} AS e,
      LATERAL split_range(e.ts, CAST(24 + e.user_id % 30 AS INT), CAST(4 + e.user_id % 5 AS INT), 9)""", events=V.table(spark, sf, "events"))


@_same_as("e19_split_months")
def e19(spark, sf):
    return _run(spark, """SELECT custkey, start_datetime, end_datetime FROM (
        SELECT o_custkey AS custkey, timestamp_seconds(unix_timestamp(CAST(min(o_orderdate) AS TIMESTAMP)) + 36000) AS a,
          timestamp_seconds(unix_timestamp(CAST(max(o_orderdate) AS TIMESTAMP)) + 45000) AS b FROM {orders} GROUP BY o_custkey) AS s,
      LATERAL split_months(s.a, s.b)""", orders=V.table(spark, sf, "orders"))
