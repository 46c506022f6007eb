"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

_WITH = """
fx_country AS (
    SELECT concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS country_code,
           n_name AS country_name, r_name AS region
    FROM nation JOIN region ON n_regionkey = r_regionkey),
fx_inflation AS (
    SELECT concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS country_code,
           n_name AS country_name, l_returnflag AS indicator_code,
           concat('indicator ', l_returnflag) AS indicator_name,
           CAST(year(o_orderdate) AS INT) AS year,
           round(avg(l_discount - l_tax) * 400, 6) + 0.0 AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_nationkey, n_name, l_returnflag, year(o_orderdate)),
fx_wage AS (
    SELECT country_code, year, indicator,
           CASE WHEN indicator = '4-NOT SPECIFIED' THEN value / 2500 ELSE value END AS value
    FROM (
        SELECT concat('N', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS country_code,
               CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS indicator,
               avg(o_totalprice) AS value
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY c_nationkey, year(o_orderdate), o_orderpriority)
    WHERE country_code <> 'N07'),
fx_commodity AS (
    SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
           p_type AS commodity, l_extendedprice / l_quantity AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey),
fx_rate_row AS (
    SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS year, l_returnflag AS category,
           round((l_discount - l_tax) * 400, 6) + 0.0 AS value
    FROM lineitem),
inflation AS (
    SELECT country_code, country_name, year,
           CASE WHEN value > 1 THEN value / 100.0 ELSE value END AS inflation_rate,
           indicator_name AS inflation_indicator
    FROM fx_inflation),
prices AS (
    SELECT year, commodity, avg(price) AS avg_annual_price FROM fx_commodity GROUP BY year, commodity),
wages AS (
    SELECT country_code, year,
           min(value) FILTER (indicator = '1-URGENT') AS avg_annual_wage,
           min(value) FILTER (indicator = '2-HIGH') AS unit_labour_cost,
           min(value) FILTER (indicator = '3-MEDIUM') AS hourly_earnings_growth,
           min(value) FILTER (indicator = '4-NOT SPECIFIED') AS real_wage_index,
           min(value) FILTER (indicator = '5-LOW') AS "5-LOW"
    FROM fx_wage GROUP BY country_code, year),
price_index AS (
    SELECT year, avg(avg_annual_price) AS commodity_price_index FROM prices
    WHERE commodity IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL') GROUP BY year),
merged AS (
    SELECT i.year, i.country_code, country_name, inflation_rate, inflation_indicator,
           avg_annual_wage, unit_labour_cost, hourly_earnings_growth, real_wage_index, "5-LOW",
           commodity_price_index,
           avg_annual_wage / nullif(1 + inflation_rate, 0) AS real_wage_adjusted,
           CASE WHEN inflation_rate < 0 THEN 'Deflation' WHEN inflation_rate <= 0.02 THEN 'Low'
                WHEN inflation_rate <= 0.05 THEN 'Moderate' WHEN inflation_rate <= 0.10 THEN 'High'
                ELSE 'Very High' END AS inflation_category,
           CAST(CASE WHEN inflation_rate BETWEEN 0.01 AND 0.03 AND real_wage_index > 100 THEN 5
                WHEN inflation_rate BETWEEN 0.01 AND 0.05 THEN 4
                WHEN inflation_rate BETWEEN -0.01 AND 0.01 THEN 3
                WHEN inflation_rate > 0.10 THEN 1 ELSE 2 END AS INT) AS economic_health_score
    FROM inflation i
    LEFT JOIN wages w ON i.country_code = w.country_code AND i.year = w.year
    LEFT JOIN price_index p ON i.year = p.year),
spelled AS (
    SELECT c_custkey, CASE c_custkey % 9
        WHEN 0 THEN n_name WHEN 1 THEN concat('  ', lower(n_name), ' ')
        WHEN 2 THEN concat(n_name, ' (north)') WHEN 3 THEN concat(lower(r_name), ' union')
        WHEN 4 THEN concat('q', chr(97 + n_nationkey)) WHEN 5 THEN lower(substr(c_mktsegment, 1, 3))
        WHEN 6 THEN 'uk' WHEN 7 THEN '--' ELSE concat('#', c_custkey) END AS raw
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
names AS (
    SELECT 2 * n_nationkey AS ord, upper(n_name) AS name,
           concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS iso3 FROM nation
    UNION ALL
    SELECT 2 * n_nationkey + 1, upper(concat('TERRITORY ', n_nationkey, ' OF ', r_name)),
           concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0'))
    FROM nation JOIN region ON n_regionkey = r_regionkey),
codes AS (
    SELECT raw, upper(trim(raw)) AS code,
           trim(regexp_replace(upper(trim(raw)), '[^\\w\\s]', '', 'g')) AS plain
    FROM (SELECT DISTINCT raw FROM spelled)),
loose AS (
    SELECT c.raw,
           min_by(iso3, ord) FILTER (contains(name, plain) OR contains(plain, name)) AS by_text,
           min_by(iso3, ord) FILTER (list_has_any(string_split(name, ' '), string_split(plain, ' '))) AS by_word
    FROM codes c CROSS JOIN names WHERE plain <> '' GROUP BY c.raw),
coded AS (
    SELECT c.raw, CASE
        WHEN regexp_matches(code, '^[A-Z]{3}$') THEN code
        WHEN code = 'UK' THEN 'GBR'
        WHEN regexp_matches(code, '^Q[A-Y]$') THEN concat('N', lpad(CAST(ascii(substr(code, 2)) - 65 AS VARCHAR), 2, '0'))
        WHEN n.iso3 IS NOT NULL THEN n.iso3
        ELSE coalesce(l.by_text, l.by_word) END AS iso3
    FROM codes c LEFT JOIN names n ON c.code = n.name LEFT JOIN loose l ON c.raw = l.raw),
remaining AS (SELECT * FROM fx_country WHERE region <> 'EUROPE'),
residents AS (
    SELECT c_custkey, concat('N', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS country_code, c_acctbal
    FROM customer)
"""


def _r(column: str, digits: int = 6, alias: str | None = None) -> str:
    return f"round({column} + 2e-8, {digits}) AS {alias or column}"


_MERGED = """year, country_code, country_name, inflation_indicator,
    round(inflation_rate + 2e-8, 6) AS inflation_rate, round(avg_annual_wage + 2e-8, 6) AS avg_annual_wage,
    round(unit_labour_cost + 2e-8, 6) AS unit_labour_cost,
    round(hourly_earnings_growth + 2e-8, 6) AS hourly_earnings_growth,
    round(real_wage_index + 2e-8, 6) AS real_wage_index, round("5-LOW" + 2e-8, 6) AS "5-LOW",
    round(commodity_price_index + 2e-8, 6) AS commodity_price_index,
    round(real_wage_adjusted + 2e-8, 6) AS real_wage_adjusted, inflation_category, economic_health_score"""

_LATEST = f"""country_code, country_name, year, {_r('inflation_rate')}, inflation_category,
    {_r('avg_annual_wage')}, {_r('real_wage_adjusted')}, economic_health_score,
    rank() OVER (PARTITION BY country_code ORDER BY year DESC) AS year_rank
    FROM merged WHERE year >= 1999"""

_CATEGORY = """CASE WHEN rate < 0 THEN 'Deflation' WHEN rate <= 0.02 THEN 'Low'
    WHEN rate <= 0.05 THEN 'Moderate' WHEN rate <= 0.10 THEN 'High' ELSE 'Very High' END"""

_WAGE_INFLATION = """merged WHERE inflation_rate IS NOT NULL AND avg_annual_wage IS NOT NULL
    AND real_wage_adjusted IS NOT NULL"""

_JOINED = """(SELECT r.country_code, r.year, r.inflation_rate, w.avg_annual_wage, country_name
    FROM (SELECT country_code, year, avg(inflation_rate) AS inflation_rate FROM inflation GROUP BY ALL) r
    JOIN (SELECT country_code, year, avg(avg_annual_wage) AS avg_annual_wage FROM wages GROUP BY ALL) w
      ON r.country_code = w.country_code AND r.year = w.year
    LEFT JOIN fx_country c ON r.country_code = c.country_code)"""

_SPREAD = """round_even(avg(inflation_rate), 4) AS mean, round_even(stddev_samp(inflation_rate), 4) AS std_dev,
    round_even(min(inflation_rate), 4) AS min, round_even(max(inflation_rate), 4) AS max"""


def _describe(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS count, {_r(f'avg({column})', 4, 'mean')},
        {_r(f'stddev_samp({column})', 4, 'stddev')}, {_r(f'min({column})', 4, 'min')},
        {_r(f'max({column})', 4, 'max')} FROM merged"""


def _decimal(column: str, scale: str) -> str:
    return f"CAST(round(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38, 20)), {scale.split(',')[1]}) AS DECIMAL({scale})) AS {column}"


def _percent(column: str) -> str:
    return f"concat(printf('%.2f', {column} * 100), '%')"


_SQL: dict[str, str] = {
    "merge_datasets": f"SELECT {_MERGED} FROM merged",
    "merge_one_indicator": f"SELECT {_MERGED} FROM merged WHERE inflation_indicator = 'indicator A'",
    "load_inflation": f"""SELECT country_code, country_name, year, inflation_rate, inflation_indicator
        FROM inflation WHERE year BETWEEN 1996 AND 2001""",
    "load_inflation_default_years": f"""SELECT country_code, country_name, year, inflation_rate,
        inflation_indicator FROM inflation WHERE year BETWEEN 2000 AND 2030""",
    "load_commodity": f"""SELECT year, commodity, {_r('avg_annual_price')} FROM prices
        WHERE year BETWEEN 1996 AND 2001""",
    "load_wage_pivot": f"""SELECT country_code, year, {_r('avg_annual_wage')}, {_r('unit_labour_cost')},
        {_r('hourly_earnings_growth')}, {_r('real_wage_index')}, {_r('"5-LOW"')}
        FROM wages WHERE year BETWEEN 1996 AND 2001""",
    "wide_to_long": f"""SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
        p_type AS commodity, {_r('avg(l_extendedprice / l_quantity)', 6, 'price')}
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "oecd_clean": f"""SELECT country_code, year, 'AWE' AS indicator, {_r('value')}
        FROM fx_wage WHERE indicator <> '5-LOW'""",
    "union_indicators": """SELECT * FROM (
        SELECT concat('S', l_suppkey) AS country_code, 'any' AS country_name, 'FP.CPI.TOTL.ZG' AS indicator_code,
               'Inflation, consumer prices (annual %)' AS indicator_name,
               CAST(year(l_shipdate) AS INT) AS year, l_discount + 0.0 AS value FROM lineitem
        UNION ALL
        SELECT concat('S', l_suppkey), NULL, 'TAX', NULL, CAST(year(l_shipdate) AS INT), l_tax + 0.0 FROM lineitem)
        WHERE year BETWEEN 1996 AND 2001""",
    "normalize_percentage_auto": f"""SELECT l_orderkey, l_linenumber, year, category,
        CASE WHEN abs(value) > 10 THEN value / 100.0 ELSE value END AS value FROM fx_rate_row""",
    "normalize_percentage_percentage": f"""SELECT l_orderkey, l_linenumber, year, category,
        value / 100.0 AS value FROM fx_rate_row""",
    "normalize_percentage_decimal": f"""SELECT l_orderkey, l_linenumber, year, category,
        value FROM fx_rate_row""",
    "normalize_columns": f"""SELECT l_orderkey, l_linenumber, year, category, v AS value,
        CASE WHEN l_linenumber <> 1 THEN v END AS reported
        FROM (SELECT *, CASE WHEN abs(value) > 10 THEN value / 100.0 ELSE value END AS v FROM fx_rate_row)""",
    "percent_rules_composed": f"""SELECT year, {_CATEGORY} AS inflation_category, count(*) AS rows FROM (
        SELECT year, CASE WHEN v > 1 THEN v / 100.0 ELSE v END AS rate FROM (
            SELECT year, CASE WHEN abs(value) > 10 THEN value / 100.0 ELSE value END AS v FROM fx_rate_row))
        GROUP BY ALL""",
    "standardize_country": """SELECT c_custkey, iso3 AS country_code
        FROM spelled JOIN coded ON spelled.raw = coded.raw WHERE iso3 IS NOT NULL""",
    "unmapped_codes": "SELECT raw AS country_code FROM coded WHERE iso3 IS NULL",
    "latest_economic_data": f"SELECT {_LATEST}",
    "latest_only": f"SELECT * FROM (SELECT {_LATEST}) WHERE year_rank = 1",
    "high_inflation": f"""SELECT country_code, country_name, year, {_r('inflation_rate')}, inflation_category
        FROM merged WHERE inflation_rate > 0.10 ORDER BY inflation_rate DESC""",
    "high_inflation_top10": f"""SELECT country_name, year, {_r('rate', 6, 'inflation_rate')} FROM (
        SELECT country_name, year, inflation_rate AS rate FROM merged WHERE inflation_rate > 0.02
        ORDER BY inflation_rate DESC, country_name, year LIMIT 10)""",
    "wage_inflation_relationship": f"""SELECT country_code, country_name, year, {_r('inflation_rate')},
        {_r('avg_annual_wage')}, {_r('real_wage_adjusted')},
        CASE WHEN real_wage_adjusted > avg_annual_wage THEN 'Wage Growth Outpacing Inflation'
             WHEN real_wage_adjusted < avg_annual_wage THEN 'Inflation Outpacing Wage Growth'
             ELSE 'Balanced' END AS wage_inflation_relationship FROM {_WAGE_INFLATION}""",
    "wage_inflation_by_country": f"""SELECT country_name, {_r('avg(inflation_rate)', 6, 'avg_inflation')},
        {_r('avg(real_wage_adjusted)', 6, 'avg_real_wage')} FROM {_WAGE_INFLATION} AND year >= 1997
        GROUP BY country_name ORDER BY 2 DESC""",
    "avg_and_max_by_country": f"""SELECT country_code, {_r('avg(inflation_rate)', 6, 'avg_inflation')},
        {_r('max(commodity_price_index)', 6, 'max_commodity_price')} FROM merged GROUP BY country_code""",
    "coverage": """SELECT country_code, count(DISTINCT year) AS years_covered, min(year) AS earliest_year,
        max(year) AS latest_year FROM merged GROUP BY country_code ORDER BY 2 DESC""",
    "anomalies": """SELECT category AS country_code, year, value AS inflation_rate FROM fx_rate_row
        WHERE value > 1.0 OR value < -0.5 ORDER BY abs(value) DESC""",
    "inflation_page": f"""SELECT country_code, c.country_name, year, {_r('rate', 6, 'inflation_rate')},
        inflation_indicator, {_CATEGORY} AS inflation_category
        FROM (SELECT *, inflation_rate AS rate FROM inflation) JOIN fx_country c USING (country_code)
        ORDER BY year DESC, country_code""",
    "sql_over_frames": """SELECT country_name, count(*) AS n, round(avg(inflation_rate) + 2e-8, 6) AS avg_inflation
        FROM inflation WHERE year >= 1998 GROUP BY country_name""",
    "summary": """SELECT count(*) AS total_records, count(DISTINCT country_code) + max((country_code IS NULL)::INT) AS countries,
        count(DISTINCT year) + max((year IS NULL)::INT) AS years, min(year) AS min_year, max(year) AS max_year
        FROM (SELECT nullif(country_code, 'N05') AS country_code, nullif(year, 1999) AS year FROM merged)""",
    "describe_numeric": " UNION ALL ".join(
        _describe(c) for c in ("inflation_rate", "avg_annual_wage", "commodity_price_index")),
    "table_counts": "WITH n AS (" + " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {source}" for name, source in {
            "countries": "fx_country", "inflation_rates": "fx_inflation", "wage_index": "wages",
            "commodity_prices": "fx_commodity", "economic_indicators": "merged"}.items()
    ) + " UNION ALL SELECT 'not_there', 0) SELECT * FROM n UNION ALL SELECT 'all', sum(rows)::BIGINT FROM n",
    "kpis": f"""SELECT {_r('m', 5, 'avg_inflation')},
        CASE WHEN m > 0.02 THEN round(m - 0.02 + 2e-8, 5) END AS inflation_delta,
        (SELECT round(avg(avg_annual_wage) + 2e-8, 5) FROM wages) AS avg_wage,
        CAST(25 AS INT) AS countries, CAST(7 AS INT) AS years
        FROM (SELECT avg(inflation_rate) AS m FROM inflation)""",
    "inflation_over_time": f"""SELECT year, country_code, country_name, {_r('avg(inflation_rate)', 6, 'inflation_rate')}
        FROM inflation WHERE year BETWEEN 1996 AND 2001 GROUP BY year, country_code, country_name""",
    "avg_by_country": f"""SELECT country_code, {_r('m', 6, 'inflation_rate')}, country_name
        FROM (SELECT country_code, avg(inflation_rate) AS m FROM inflation WHERE year BETWEEN 1996 AND 2001 GROUP BY 1)
        JOIN (SELECT DISTINCT country_code, country_name FROM inflation WHERE year BETWEEN 1996 AND 2001)
        USING (country_code)""",
    "inflation_wage_join": f"""SELECT country_code, year, {_r('inflation_rate')}, {_r('avg_annual_wage')},
        country_name FROM {_JOINED}""",
    "correlation": f"""SELECT round(r + 2e-8, 6) AS correlation, CASE WHEN abs(r) > 0.7 THEN 'Strong'
        WHEN abs(r) > 0.4 THEN 'Moderate' ELSE 'Weak' END AS strength
        FROM (SELECT corr(inflation_rate, avg_annual_wage) AS r FROM {_JOINED})""",
    "corr_matrix": f"""WITH r AS (SELECT round(corr(inflation_rate, avg_annual_wage) + 2e-8, 6) AS r FROM {_JOINED})
        SELECT 'inflation_rate' AS x, 'inflation_rate' AS y, 1.0::DOUBLE AS r
        UNION ALL SELECT 'avg_annual_wage', 'avg_annual_wage', 1.0
        UNION ALL SELECT 'inflation_rate', 'avg_annual_wage', r FROM r
        UNION ALL SELECT 'avg_annual_wage', 'inflation_rate', r FROM r""",
    "corr_matrix_rows": " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}) + 2e-8, 6) AS r FROM lineitem"
        for x in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        for y in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "trend_line": f"""WITH j AS (SELECT * FROM {_JOINED}),
        f AS (SELECT regr_slope(avg_annual_wage, inflation_rate) AS s,
                     regr_intercept(avg_annual_wage, inflation_rate) AS i FROM j)
        SELECT country_code, year, {_r('inflation_rate', 4)}, {_r('avg_annual_wage', 4)}, country_name,
               {_r('s * inflation_rate + i', 4, 'trend')} FROM j, f""",
    "commodity_trends": f"""WITH f AS (SELECT commodity, count(*) AS n, regr_slope(avg_annual_price, year) AS s,
            regr_intercept(avg_annual_price, year) AS i FROM prices GROUP BY commodity)
        SELECT year, commodity, {_r('avg_annual_price', 4)},
               CASE WHEN n > 1 THEN round(s * year + i + 2e-8, 4) END AS trend
        FROM prices JOIN f USING (commodity)""",
    "commodity_stats": f"""SELECT commodity, {_r('avg(avg_annual_price)', 6, 'avg_price')},
        {_r('min(avg_annual_price)', 6, 'min_price')}, {_r('max(avg_annual_price)', 6, 'max_price')},
        {_r('stddev_samp(avg_annual_price)', 6, 'volatility')},
        max_by(avg_annual_price, year) > min_by(avg_annual_price, year) AS rising
        FROM prices GROUP BY commodity""",
    "data_explorer": f"""SELECT country_code, country_name, year, {_r('inflation_rate')}, inflation_indicator
        FROM inflation WHERE year BETWEEN 1996 AND 2001""",
    "data_explorer_prices": """SELECT year, month, commodity, price FROM fx_commodity
        WHERE year BETWEEN 1996 AND 2001 AND commodity <> 'STANDARD'""",
    "filter_options": """SELECT 'country' AS kind, country_code AS value, country_name AS label,
               country_code IN (SELECT DISTINCT country_code FROM inflation ORDER BY 1 LIMIT 5) AS preselected
        FROM (SELECT DISTINCT country_code, country_name FROM inflation)
        UNION ALL SELECT 'commodity', commodity, commodity,
               commodity IN (SELECT DISTINCT commodity FROM prices ORDER BY 1 LIMIT 4)
        FROM (SELECT DISTINCT commodity FROM prices)
        UNION ALL SELECT 'indicator', inflation_indicator, inflation_indicator, inflation_indicator = 'indicator A'
        FROM (SELECT DISTINCT inflation_indicator FROM inflation)
        UNION ALL SELECT 'first_year', min(year)::VARCHAR, min(year)::VARCHAR, true FROM inflation
        UNION ALL SELECT 'last_year', max(year)::VARCHAR, max(year)::VARCHAR, true FROM inflation""",
    "heatmap": "SELECT country_name, " + ", ".join(
        f'round(avg(inflation_rate) FILTER (year = {y}) + 2e-8, 6) AS "{y}"' for y in range(1995, 2002)
    ) + " FROM inflation WHERE inflation_indicator = 'indicator A' GROUP BY country_name",
    "histogram": f"""WITH v AS (SELECT CASE WHEN value > 1 THEN value / 100.0 ELSE value END AS x FROM fx_rate_row),
        e AS (SELECT min(x) AS low, max(x) AS high FROM v),
        placed AS (SELECT CAST(least(floor((x - low) * 30 / (high - low)), 29) AS INT) AS bin, low, (high - low) / 30 AS w
               FROM v, e)
        SELECT bin, {_r('low + bin * w', 6, 'bin_start')}, {_r('low + (bin + 1) * w', 6, 'bin_end')},
               count(*) AS frequency FROM placed GROUP BY bin, low, w""",
    "box_stats": f"""WITH v AS (SELECT CASE WHEN value > 1 THEN value / 100.0 ELSE value END AS rate FROM fx_rate_row)
        SELECT {_CATEGORY} AS inflation_category, count(*) AS count, {_r('min(rate)', 6, 'min')},
               {_r('quantile_cont(rate, 0.25)', 6, 'q1')}, {_r('quantile_cont(rate, 0.5)', 6, 'median')},
               {_r('quantile_cont(rate, 0.75)', 6, 'q3')}, {_r('max(rate)', 6, 'max')}
        FROM v GROUP BY 1""",
    "price_quantiles": "SELECT l_returnflag, count(*) AS n, round(min(p) + 2e-8, 6) AS low, round(max(p) + 2e-8, 6) AS high, "
        + ", ".join(f"round(quantile_cont(p, {q}) + 2e-8, 6) AS q{i}" for i, q in enumerate((0.1, 0.25, 0.5, 0.75, 0.9), 1))
        + " FROM (SELECT l_returnflag, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY l_returnflag",
    "volatility": f"""SELECT country_code, country_name, {_SPREAD} FROM inflation
        WHERE year BETWEEN 1996 AND 2001 GROUP BY country_code, country_name""",
    "volatility_texts": f"""SELECT country_code, {_percent('mean')} AS mean_text, {_percent('std_dev')} AS std_dev_text,
        {_percent('min')} AS min_text, {_percent('max')} AS max_text FROM (
            SELECT country_code, {_SPREAD} FROM inflation WHERE year BETWEEN 1996 AND 2001 GROUP BY country_code)""",
    "comparison_series": f"""SELECT year, country_code, country_name, {_r('avg(inflation_rate)', 6, 'inflation_rate')}
        FROM inflation WHERE inflation_indicator = 'indicator R' GROUP BY year, country_code, country_name""",
    "comparison_stats": f"""SELECT country_name, count(inflation_rate) AS data_points, {_SPREAD} FROM inflation
        WHERE year BETWEEN 1996 AND 2001 GROUP BY country_name""",
    "comparison_display": f"""SELECT country_name AS "Country", data_points AS "Data Points",
        {_percent('mean')} AS "Average", {_percent('std_dev')} AS "Volatility", {_percent('min')} AS "Minimum",
        {_percent('max')} AS "Maximum" FROM (
            SELECT country_name, count(inflation_rate) AS data_points, {_SPREAD} FROM inflation
            WHERE year BETWEEN 1996 AND 2001 GROUP BY country_name)""",
    "commodity_stats_display": """SELECT commodity, format('${:,.2f}', avg(avg_annual_price)) AS avg_price,
        format('${:,.2f}', min(avg_annual_price)) AS min_price, format('${:,.2f}', max(avg_annual_price)) AS max_price,
        printf('%.2f', stddev_samp(avg_annual_price)) AS volatility,
        max_by(avg_annual_price, year) > min_by(avg_annual_price, year) AS rising
        FROM prices GROUP BY commodity""",
    "year_average": f"SELECT year, {_r('avg(value)', 6, 'avg_value')} FROM fx_inflation GROUP BY year ORDER BY year",
    "inflation_ranking": f"""SELECT country_code, {_r('avg(inflation_rate)', 6, 'avg_inflation')}
        FROM merged GROUP BY country_code ORDER BY 2 DESC""",
    "real_wage_change": """SELECT country_code,
        round((last(v ORDER BY year) / nullif(first(v ORDER BY year), 0) - 1) * 100 + 2e-8, 4) AS change_pct
        FROM (SELECT country_code, year, min(real_wage_adjusted) AS v FROM merged GROUP BY country_code, year)
        GROUP BY country_code""",
    "orphans": """SELECT r.* FROM residents r LEFT JOIN remaining c ON r.country_code = c.country_code
        WHERE c.country_code IS NULL""",
    "orphan_counts": """SELECT r.country_code, count(*) AS orphaned_rows FROM residents r
        LEFT JOIN remaining c ON r.country_code = c.country_code WHERE c.country_code IS NULL GROUP BY r.country_code""",
    "cascade_delete": "SELECT * FROM residents WHERE country_code IN (SELECT country_code FROM remaining)",
    "cascade_tables": """WITH gone AS (SELECT country_code FROM fx_country WHERE region = 'ASIA')
        SELECT 'countries' AS "table", country_code, count(*) AS rows FROM fx_country
            WHERE country_code NOT IN (FROM gone) GROUP BY country_code
        UNION ALL SELECT 'inflation_rates', country_code, count(*) FROM inflation WHERE country_code NOT IN (FROM gone) GROUP BY country_code
        UNION ALL SELECT 'wage_index', country_code, count(*) FROM wages WHERE country_code NOT IN (FROM gone) GROUP BY country_code""",
    "range_check": f"""SELECT {_r('lo', 6, 'min_rate')}, {_r('hi', 6, 'max_rate')}, lo >= -0.5 AND hi <= 5.0 AS passed
        FROM (SELECT min(v) AS lo, max(v) AS hi FROM (
            SELECT CASE WHEN abs(value) > 10 THEN value / 100.0 ELSE value END AS v FROM fx_rate_row))""",
    "recency_check": "SELECT count(*) AS recent_rows, count(*) > 0 AS passed FROM merged WHERE year >= 2000",
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "key_violations_merged": """SELECT country_code, year, count(*) AS occurrences FROM merged
        GROUP BY ALL HAVING count(*) > 1""",
    "null_violations": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_rows FROM merged"
        for c in ("country_code", "year", "avg_annual_wage", "commodity_price_index")),
    "length_violations": """SELECT 'country_code' AS "column", count(*) FILTER (length(raw) > 3) AS too_long_rows
        FROM spelled""",
    "code_violations": """SELECT raw AS country_code, count(*) AS rows FROM spelled
        WHERE NOT regexp_matches(raw, '^[a-zA-Z]{3}$') GROUP BY raw""",
    "integrity_report": """SELECT 'no_orphaned_inflation' AS "check",
            count(*) = 0 AS passed FROM inflation ANTI JOIN remaining USING (country_code)
        UNION ALL SELECT 'no_orphaned_wage', count(*) = 0 FROM wages ANTI JOIN remaining USING (country_code)
        UNION ALL SELECT 'reasonable_inflation_range', min(inflation_rate) >= -0.5 AND max(inflation_rate) <= 5.0
            FROM inflation
        UNION ALL SELECT 'has_recent_data', count(*) > 0 FROM merged WHERE year >= 2020""",
    "constraint_report": """SELECT 'unique' AS "constraint", 'country_code, year' AS subject, count(*) AS violations
            FROM (SELECT 1 FROM merged GROUP BY country_code, year HAVING count(*) > 1)
        UNION ALL SELECT 'not null', 'country_code', count(*) FILTER (country_code IS NULL) FROM merged
        UNION ALL SELECT 'not null', 'year', count(*) FILTER (year IS NULL) FROM merged
        UNION ALL SELECT 'length', 'country_code', count(*) FILTER (length(country_code) > 3) FROM merged
        UNION ALL SELECT 'length', 'country_name', count(*) FILTER (length(country_name) > 255) FROM merged
        UNION ALL SELECT 'length', 'inflation_category', count(*) FILTER (length(inflation_category) > 20) FROM merged""",
    "typed_load": f"""SELECT country_code, country_name, year, {_decimal('inflation_rate', '10,6')}, inflation_category,
        {_decimal('avg_annual_wage', '12,2')}, {_decimal('unit_labour_cost', '10,4')},
        {_decimal('real_wage_index', '10,4')}, {_decimal('real_wage_adjusted', '12,2')},
        {_decimal('commodity_price_index', '12,4')}, economic_health_score FROM merged""",
    "typed_load_prices": f"""SELECT year, month, commodity, {_decimal('price', '12,4')},
        CAST(NULL AS DECIMAL(12,4)) AS avg_annual_price, CAST(NULL AS VARCHAR) AS price_unit, 'IMF' AS data_source
        FROM fx_commodity""",
    "typed_load_rates": f"""SELECT country_code, year, {_decimal('inflation_rate', '10,6')}, inflation_indicator,
        inflation_category, 'World Bank' AS data_source FROM merged""",
    "typed_load_wages": f"""SELECT country_code, year, {_decimal('avg_annual_wage', '12,2')}, {_decimal('unit_labour_cost', '10,4')},
        {_decimal('hourly_earnings_growth', '8,4')}, {_decimal('real_wage_index', '10,4')},
        CAST(NULL AS DECIMAL(12,2)) AS real_wage_adjusted, 'OECD' AS data_source
        FROM (SELECT * REPLACE (hourly_earnings_growth / 100 AS hourly_earnings_growth) FROM wages)""",
    "rejected_rows": """SELECT 'countries' AS "table", rule, count(*) AS rows FROM (
        SELECT CASE WHEN c_custkey % 4 >= 2 THEN 'country_code is longer than 3'
                    WHEN c_custkey % 7 = 0 THEN 'country_name is null' END AS rule FROM customer)
        WHERE rule IS NOT NULL GROUP BY rule""",
    "country_rows": "SELECT DISTINCT country_code, country_name FROM inflation",
    "upsert": """WITH p AS (SELECT l_returnflag = 'R' AS flag, l_partkey AS commodity, CAST(year(l_shipdate) AS INT) AS year,
            min(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
        a AS (SELECT commodity, year, price, row_number() OVER (ORDER BY commodity, year) AS id FROM p WHERE NOT flag),
        r AS (SELECT commodity, year, price FROM p WHERE flag),
        n AS (SELECT commodity, year, (SELECT max(id) FROM a) + row_number() OVER (ORDER BY commodity, year) AS id
            FROM r ANTI JOIN a USING (commodity, year))
        SELECT coalesce(r.commodity, a.commodity) AS commodity, coalesce(r.year, a.year) AS year,
               coalesce(r.price, a.price) AS price, coalesce(a.id, n.id)::BIGINT AS id,
               CASE WHEN a.price IS NULL THEN 'second' ELSE 'first' END AS created_at,
               CASE WHEN r.price IS NULL THEN 'first' ELSE 'second' END AS updated_at
        FROM a FULL JOIN r ON a.commodity = r.commodity AND a.year = r.year
            LEFT JOIN n ON n.commodity = r.commodity AND n.year = r.year""",
    "dense_ids": """SELECT 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id, l_orderkey, l_linenumber
        FROM lineitem""",
    "serial_ids": "SELECT count(*) AS rows, count(*) AS ids, true AS ascending FROM lineitem",
    "csv_files_inflation": "SELECT country_code, country_name, indicator_code, indicator_name, year, value FROM fx_inflation",
    "csv_files_commodities": """SELECT year, month, concat('  ', commodity, '-*. ') AS commodity, round(price + 2e-8, 4) + 0.0 AS price
        FROM fx_commodity""",
    "csv_files_wages": "SELECT country_code, year, indicator, round(value + 2e-8, 4) + 0.0 AS value FROM fx_wage",
    "csv_files_wage_table": """SELECT country_code, year, '2-HIGH' AS indicator, round(value + 2e-8, 4) + 0.0 AS value
        FROM fx_wage WHERE indicator = '2-HIGH'""",
    "sheet_files": """WITH m AS (SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
            max(l_discount) AS one, max(l_tax) AS two FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL)
        SELECT year, month, 'Gold' AS commodity, one + 0.0 AS price FROM m UNION ALL SELECT year, month, 'Oil, crude', two + 0.0 FROM m
        UNION ALL SELECT year, month, 'Oil, crude', two + 0.0 FROM m UNION ALL SELECT year, month, 'Wheat', one + 0.0 FROM m""",
    "json_files": "SELECT country_code, country_name, indicator_code, indicator_name, year, value FROM fx_inflation",
    "parquet_by_year": """SELECT country_code, country_name, indicator_code, indicator_name, year, value FROM fx_inflation
        WHERE year BETWEEN 1996 AND 2001""",
    "exported_view": "SELECT country_code, year, round(avg_annual_wage + 2e-8, 2) AS wage FROM wages",
    "view_by_name": "SELECT country_code, count(*) AS years FROM wages GROUP BY country_code",
    "xml_files": """SELECT country_code, year, 'AWE' AS indicator, round(value + 2e-8, 2) AS value FROM fx_wage WHERE indicator = '1-URGENT'""",
    "damaged_documents": """SELECT 'inflation feed' AS "table", CASE l_linenumber WHEN 1 THEN 'not a JSON list' ELSE 'no list of records' END AS rule,
            count(*) AS rows FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY ALL
        UNION ALL SELECT 'commodity feed', CASE l_linenumber WHEN 1 THEN 'no header line' ELSE 'open quote in the header' END, count(*)
            FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY ALL
        UNION ALL SELECT 'wage feed', CASE l_linenumber WHEN 1 THEN 'elements that are not closed' WHEN 2 THEN 'no element'
            ELSE 'elements that are not closed' END, count(*) FROM lineitem WHERE l_linenumber IN (1, 2, 3) GROUP BY 2""",
    "refreshed_tables": f"""WITH v AS (SELECT country_code, year, indicator_name AS inflation_indicator,
            CASE WHEN abs(value) > 10 THEN value / 100.0 ELSE value END AS v FROM fx_inflation),
        r AS (SELECT country_code, year, inflation_indicator, CASE WHEN v > 1 THEN v / 100.0 ELSE v END AS inflation_rate FROM v)
        SELECT row_number() OVER (ORDER BY country_code, year, inflation_indicator) AS id, country_code, year,
               {_decimal('inflation_rate', '10,6')}, inflation_indicator, 'World Bank' AS data_source FROM r""",
    "parse_indicator_json": """SELECT concat('S', l_suppkey) AS country_code, l_linestatus AS country_name,
            'FP.CPI.TOTL.ZG' AS indicator_code, 'Inflation, consumer prices (annual %)' AS indicator_name,
            CAST(year(l_shipdate) AS INT) AS year, l_discount + 0.0 AS value FROM lineitem
        UNION ALL SELECT concat('S', l_suppkey), l_linestatus, 'TAX', 'name of TAX',
            CAST(year(l_shipdate) AS INT), l_tax + 0.0 FROM lineitem""",
    "parse_country_json": """SELECT CAST(c_custkey AS VARCHAR) AS country_code, n_name AS country_name, 'Q1' AS iso2_code,
        r_name AS region, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS income_level
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "parse_csv_feed": """SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
            'Gold' AS commodity, l_discount + 0.0 AS price FROM lineitem
        UNION ALL SELECT CAST(year(l_shipdate) AS INT), CAST(month(l_shipdate) AS INT), 'Oil, crude', l_tax + 0.0
            FROM lineitem""",
    "parse_observations": """SELECT concat('S', l_suppkey) AS country_code, CAST(year(l_shipdate) AS INT) AS year,
            'AWE' AS indicator, l_discount + 0.0 AS value FROM lineitem
        UNION ALL SELECT concat('S&', l_suppkey), CAST(year(l_shipdate) + 1 AS INT), 'AWE', l_tax + 0.0 FROM lineitem
        UNION ALL SELECT NULL, CAST(l_linenumber + 2000 AS INT), 'AWE', NULL FROM lineitem""",
    "parse_xml_feed": """SELECT concat('S', l_suppkey) AS country_code, CAST(year(l_shipdate) AS INT) AS year,
            'AWE' AS indicator, l_discount + 0.0 AS value FROM lineitem
        UNION ALL SELECT concat('S', l_suppkey), CAST(year(l_shipdate) + 1 AS INT), 'AWE', l_tax + 0.0 FROM lineitem""",
}


def oracle_sql() -> dict[str, str]:
    """Each query behind the shared derivations it names; unused ones cost nothing."""
    def complete(sql: str) -> str:
        if sql.lstrip().startswith("WITH "):
            return f"WITH {_WITH}, {sql.lstrip()[len('WITH '):]}"
        return f"WITH {_WITH} {sql}"
    return {name: complete(sql) for name, sql in _SQL.items()}
