"""The answers once more as Spark SQL, for comparison with the DataFrame versions."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Each period code by its place among the known ones: 1 to 4 quarters, 5 annual, 0 unknown. A year's
#: method is chosen once; value and completeness follow from it.
STRICT_YEARS = """
    WITH placed AS (
        SELECT series_id, year, value, find_in_set(period, 'Q01,Q02,Q03,Q04,Q05') AS place FROM {obs}
    ), summed AS (
        SELECT series_id, year, min(place) > 0 AS all_known,
               bit_or(if(place BETWEEN 1 AND 4, shiftleft(1, place), 0)) AS quarters,
               sum(value) FILTER (WHERE place BETWEEN 1 AND 4) AS of_quarters,
               count_if(place = 5) AS annuals, max(value) FILTER (WHERE place = 5) AS of_year
        FROM placed GROUP BY series_id, year
    ), decided AS (
        SELECT *, CASE quarters WHEN 30 THEN 'sum_q01_q04' WHEN 0 THEN if(annuals = 1, 'annual_average_q05', NULL) END AS method
        FROM summed
    )
    SELECT series_id, year, if(method = 'sum_q01_q04', of_quarters, if(method IS NULL, NULL, of_year)) AS yearly_value,
           method AS value_method, all_known AS _recognized_periods_only,
           method IS NOT NULL AS _complete_quarters_or_annual_only
    FROM decided
"""

BEST_YEARS = """
    WITH ranked AS (
        SELECT series_id, year AS best_year, yearly_value, value_method,
               rank() OVER (PARTITION BY series_id ORDER BY yearly_value DESC) AS place
        FROM {yearly}
        WHERE yearly_value IS NOT NULL
    )
    SELECT series_id, best_year, yearly_value, value_method FROM ranked WHERE place = 1
"""

LABELS = """
    WITH texts AS (
        SELECT series_id, sector_name, measure_text, class_text, duration_text, seasonal_text,
               array(sector_name, measure_text, class_text, duration_text, seasonal_text) AS parts
        FROM {series} NATURAL LEFT JOIN (SELECT sector_code, sector_name FROM {sector})
            NATURAL LEFT JOIN (SELECT class_code, class_text FROM {class_})
            NATURAL LEFT JOIN (SELECT measure_code, measure_text FROM {measure})
            NATURAL LEFT JOIN (SELECT duration_code, duration_text FROM {duration})
            NATURAL LEFT JOIN (SELECT seasonal_code, seasonal_text FROM {seasonal})
    )
    SELECT * EXCEPT (parts), forall(parts, text -> text IS NOT NULL) AS _label_lookup_complete,
           array_join(parts, ' | ') AS human_readable_label
    FROM texts
"""

LABELLED_BEST_YEARS = "SELECT * FROM {best} LEFT JOIN {labels} USING (series_id)"

SERIES_PERIOD = """
    SELECT o.series_id, o.period, o.year, o.value, p.population
    FROM {obs} o LEFT JOIN {population} p ON p.year = o.year
    WHERE o.series_id = :series_id AND o.period = :period
"""

RANGE_STATS = """
    SELECT nation_id, nation,
           CAST(:first AS INT) AS start_year, CAST(:last AS INT) AS end_year,
           avg(population) AS mean_population,
           stddev(population) AS stddev_population,
           count(*) AS year_count
    FROM {population}
    WHERE %s
    GROUP BY nation_id, nation
"""


def strict_years_sql(obs: DataFrame) -> DataFrame:
    """Yearly values where a year with some quarters missing has none."""
    return obs.sparkSession.sql(STRICT_YEARS, obs=obs)


def best_years_sql(yearly: DataFrame) -> DataFrame:
    return yearly.sparkSession.sql(BEST_YEARS, yearly=yearly)


def labels_sql(series: DataFrame, sector: DataFrame, class_: DataFrame, measure: DataFrame, duration: DataFrame,
               seasonal: DataFrame) -> DataFrame:
    """Texts and readable label of every series; the lookups share the names of the code columns."""
    return series.sparkSession.sql(LABELS, series=series, sector=sector, class_=class_, measure=measure,
                                   duration=duration, seasonal=seasonal)


def labelled_best_years_sql(best: DataFrame, labels: DataFrame) -> DataFrame:
    return best.sparkSession.sql(LABELLED_BEST_YEARS, best=best, labels=labels)


def series_period_sql(obs: DataFrame, population: DataFrame, series_id: str, period: str) -> DataFrame:
    spark = obs.sparkSession
    return spark.sql(SERIES_PERIOD, args={"series_id": series_id, "period": period}, obs=obs, population=population)


def range_stats_sql(population: DataFrame, first: int, last: int, day: str | None = None) -> DataFrame:
    """Statistics per nation over years; on a stored ``day`` column as bounds of it, which a scan can use."""
    years = "year BETWEEN :first AND :last"
    if day:
        years = f"`{day}` >= make_date(:first, 1, 1) AND `{day}` < make_date(:last + 1, 1, 1)"
    return population.sparkSession.sql(RANGE_STATS % years, args={"first": first, "last": last}, population=population)
