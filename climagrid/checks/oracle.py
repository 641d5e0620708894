"""DuckDB SQL for the registered queries, over the same check tables.

Rounding goes through DECIMAL so that ties round half up as in Spark.
"""

from __future__ import annotations


def rnd(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def case(expr: str, bands: list[tuple[float, str]], default: str, op: str) -> str:
    tests = " ".join(f"WHEN {expr} {op} {bound} THEN '{label}'" for bound, label in bands)
    return f"CASE {tests} ELSE '{default}' END"


OBS = """
SELECT CAST(l_shipdate AS DATE) AS weather_date,
       CAST(n_nationkey AS INT) AS location_id,
       n_name AS city_name, r_name AS country,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity - n_nationkey END AS max_temp_c,
       CASE WHEN l_linenumber = 5 THEN NULL
            WHEN l_tax < 0.03 THEN CAST(0.0 AS DOUBLE)
            ELSE ROUND(l_tax * 100) * (n_nationkey % 5) * CAST(0.5 AS DOUBLE)
                 * (CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END) END AS precipitation_mm,
       CAST(n_nationkey * 100000 + 50000 AS INT) AS population,
       CAST(s_suppkey * 10 AS DOUBLE) AS elevation {more}
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
EXTENDED = OBS.format(
    more=""",
       CASE WHEN l_linenumber = 4 THEN NULL
            ELSE l_quantity - n_nationkey - 5
                 - ROUND(l_discount * 100) * CAST(0.5 AS DOUBLE) END AS min_temp_c,
       CASE WHEN l_linenumber = 3 THEN NULL
            ELSE 40 + ROUND(l_tax * 100) * 5
                 - ROUND(l_discount * 100) * CAST(1.5 AS DOUBLE) END AS humidity_percent,
       n_nationkey * CAST(0.5 AS DOUBLE) - 6
           + (s_suppkey % 3) * CAST(0.125 AS DOUBLE) AS location_latitude,
       r_regionkey * CAST(10.0 AS DOUBLE) - 70
           - (s_suppkey % 2) * CAST(0.125 AS DOUBLE) AS location_longitude
"""
)
DATED = """
SELECT *, CAST(YEAR(weather_date) AS INT) AS year, CAST(MONTH(weather_date) AS INT) AS month,
       CAST(DAYOFYEAR(weather_date) AS INT) AS day_of_year FROM obs
"""
# Raw documents and locations as derived from the tables: grid cells, offsets and three days.
DOCS = """
SELECT l_suppkey AS sup, l_linenumber AS line, l_quantity AS q, ROUND(l_tax * 100) AS tax,
       CAST(l_shipdate AS DATE) AS day,
       (l_suppkey % 1440) * CAST(0.125 AS DOUBLE) - 90
         + CASE WHEN l_linenumber = 1 THEN CAST(0.0625 AS DOUBLE)
                ELSE (l_linenumber - 4) * CAST(0.0125 AS DOUBLE) END AS raw_lat,
       FLOOR(l_suppkey / 1440) * CAST(0.125 AS DOUBLE) - 180
         - CASE WHEN l_linenumber = 1 THEN CAST(0.0625 AS DOUBLE)
                ELSE (l_linenumber - 4) * CAST(0.0125 AS DOUBLE) END AS raw_lon,
       l_linenumber = 7 OR (l_linenumber = 5 AND l_discount < 0.02) AS no_days
FROM lineitem
"""
SNAPPED = """
SELECT *, ROUND_EVEN(raw_lat / 0.125, 0) * CAST(0.125 AS DOUBLE) AS latitude,
       ROUND_EVEN(raw_lon / 0.125, 0) * CAST(0.125 AS DOUBLE) AS longitude FROM docs
"""
DAYS = """
SELECT latitude, longitude, CAST(day + CAST(i AS INT) AS DATE) AS weather_date,
       CASE WHEN i = 0 THEN q WHEN i = 2 THEN q - 2 WHEN line = 6 THEN NULL ELSE q + 1 END
         AS max_temp_c,
       CASE WHEN i = 0 THEN tax WHEN i = 1 THEN tax * CAST(0.5 AS DOUBLE) END
         AS precipitation_mm,
       sup, day AS first_day
FROM snapped CROSS JOIN RANGE(3) AS r(i) WHERE NOT no_days
"""
LOCATIONS = """
SELECT CAST(s_suppkey AS INT) AS location_id, n_name AS city_name, r_name AS country,
       (s_suppkey % 1440) * CAST(0.125 AS DOUBLE) - 90 AS location_latitude,
       FLOOR(s_suppkey / 1440) * CAST(0.125 AS DOUBLE) - 180 AS location_longitude,
       CASE WHEN s_suppkey % 10 = 3 THEN NULL
            ELSE CAST(s_suppkey * 1000 % 1000000 AS INT) END AS population,
       CAST(s_suppkey * 10 AS DOUBLE) AS elevation,
       CAST(s_suppkey % 100 * 500 AS VARCHAR) AS visits
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
TRUSTED = """
SELECT weather_date, location_id, city_name, country, max_temp_c, precipitation_mm, population,
       elevation
FROM days JOIN locations ON latitude = location_latitude AND longitude = location_longitude
"""

NAMED = {
    "obs": OBS.format(more=""),
    "dated": DATED,
    "docs": DOCS,
    "snapped": SNAPPED,
    "days": DAYS,
    "locations": LOCATIONS,
    "trusted": TRUSTED,
}


#: Relations that several others read: computed once, also where they come from unnested documents.
SHARED = {"trusted", "rows_both", "folded", "moments", "slopes", "net_rows", "scales", "gram"}


def cte(name: str, body: str) -> str:
    return f"{name} AS {'MATERIALIZED ' if name in SHARED else ''}({body})"


def over(*names: str, select: str, **ctes: str) -> str:
    """``select`` behind the named relations above and further ones given by keyword."""
    parts = {name: NAMED[name] for name in names} | ctes
    return "WITH RECURSIVE " + ",\n".join(cte(n, body) for n, body in parts.items()) + "\n" + select


def on_obs(select: str, **ctes: str) -> str:
    return over("obs", "dated", select=select, **ctes)


def on_extended(select: str, **ctes: str) -> str:
    return over(select=select, **({"obs": EXTENDED, "dated": DATED} | ctes))


def ratio(cond: str, scale: float = 1.0) -> str:
    return f"CAST({scale} AS DOUBLE) * COUNT(*) FILTER (WHERE {cond}) / COUNT(*)"


def safe_corr(x: str, y: str, digits: int = 3) -> str:
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    varies = f"STDDEV_POP({x}) {both} > 0 AND STDDEV_POP({y}) {both} > 0"
    return rnd(f"CASE WHEN {varies} THEN CORR({x}, {y}) END", digits)


T, P = "max_temp_c", "precipitation_mm"
WITH_TEMP = f"FROM dated WHERE {T} IS NOT NULL"

# Months and bounds of the published datasets, written out once more so that the
# queries are not checked against themselves.
DRY_WET = """CASE WHEN month IN (12, 1, 2, 3) THEN 'Época Seca'
    WHEN month IN (4, 5, 10, 11) THEN 'Época Lluviosa'
    WHEN month IN (6, 7, 8) THEN 'Época Semi-seca' ELSE 'Época Semi-lluviosa' END"""
TROPICAL = """CASE WHEN month IN (12, 1, 2, 3) THEN 'Verano (Seco)'
    WHEN month IN (4, 5) THEN 'Primera Lluvia'
    WHEN month IN (6, 7, 8) THEN 'Veranillo de San Juan'
    WHEN month IN (9, 10, 11) THEN 'Segunda Lluvia' END"""
TEMPERATE = """CASE WHEN month IN (12, 1, 2) THEN 'Invierno'
    WHEN month IN (3, 4, 5) THEN 'Primavera'
    WHEN month IN (6, 7, 8) THEN 'Verano' ELSE 'Otoño' END"""
LOCAL_BANDS = [(25, "Caliente"), (20, "Templado Cálido"), (15, "Templado"), (10, "Fresco")]
GLOBAL_BANDS = [(30, "Muy Caliente"), (20, "Caliente"), (10, "Templado"), (0, "Frío")]
RAIN_CLASSES = [(5, "Muy Lluvioso"), (2, "Lluvioso"), (0.5, "Moderado")]
WET_CLASSES = [(5, "Clima Muy Húmedo"), (3, "Clima Húmedo"), (1, "Clima Moderadamente Húmedo")]
CITY_CASE = """CASE city_name WHEN 'NATION_1' THEN 'first city'
    WHEN 'NATION_2' THEN 'second city' ELSE 'elsewhere' END"""


def extreme(bands: list[tuple[float, str]], default: str, rain: str) -> str:
    return on_obs(
        f"SELECT *, {case('avg_temp', bands, default, '>=')} AS climate_category FROM cities",
        cities=f"""SELECT city_name, country, {rnd(f'AVG({T})')} AS avg_temp,
            {rnd(f'MAX({T})')} AS max_temp_recorded, {rnd(f'MIN({T})')} AS min_temp_recorded,
            {rain} COUNT(*) AS total_records
            {WITH_TEMP} GROUP BY ALL HAVING COUNT(*) >= 30""",
    )


CORRELATIONS = f"""SELECT city_name, country, {safe_corr(T, P)} AS temp_precipitation_corr,
    {safe_corr(T, 'elevation')} AS temp_elevation_corr,
    {safe_corr(P, 'elevation')} AS precip_elevation_corr,
    {rnd(ratio(f'{P} > 0'), 3)} AS rainy_days_ratio, {rnd(f'AVG({T})')} AS avg_temperature,
    {rnd(f'AVG({P})')} AS avg_precipitation, {rnd('AVG(elevation)', 0)} AS avg_elevation,
    COUNT(*) AS total_records
    FROM obs WHERE {T} IS NOT NULL AND {P} IS NOT NULL AND elevation IS NOT NULL
    GROUP BY ALL HAVING COUNT(*) >= 30"""

FEATURES = f"""SELECT city_name, country, {rnd(f'AVG({T})')} AS avg_max_temp,
    {rnd(f'SUM({P})')} AS total_precipitation, {rnd(f'AVG({P})')} AS avg_precipitation,
    COUNT(*) AS data_points, {rnd(f'STDDEV_SAMP({T})')} AS temp_variability,
    {rnd(f'MAX({T})')} AS max_temp_recorded, {rnd(f'MIN({T})')} AS min_temp_recorded,
    {rnd('AVG(elevation)')} AS avg_elevation, {rnd('AVG(population)')} AS avg_population
    FROM obs GROUP BY city_name, country HAVING COUNT(*) >= 30"""

MONTHLY = f"""SELECT city_name, country, year, month, {rnd(f'AVG({T})')} AS avg_max_temp,
    {rnd(f'SUM({P})')} AS total_precipitation, {rnd(f'AVG({P})')} AS avg_precipitation,
    COUNT(*) AS days_with_data {WITH_TEMP} GROUP BY city_name, country, year, month"""

RAIN_PROFILE = f"""SELECT city_name, country, {rnd(f'AVG({T})')} AS temperatura_promedio,
    {rnd(f'SUM({P})')} AS precipitacion_total_anual,
    {rnd(f'AVG({P})')} AS precipitacion_promedio_diaria,
    COUNT(*) FILTER (WHERE {P} > 0) AS dias_con_lluvia,
    COUNT(*) FILTER (WHERE {P} > 10) AS dias_lluvia_fuerte,
    COUNT(*) FILTER (WHERE {P} > 20) AS dias_lluvia_intensa,
    {rnd(ratio(f'{P} > 0', 100), 1)} AS porcentaje_dias_lluvia,
    {rnd(f'MAX({P})')} AS precipitacion_maxima, COUNT(*) AS total_dias,
    {case(f'AVG({P})', WET_CLASSES, 'Clima Seco', '>')} AS clasificacion_humedad
    {WITH_TEMP} GROUP BY city_name, country"""

IN_TRAINING = """SUBSTR(MD5(CONCAT_WS('|', '42', city_name, CAST(location_id AS VARCHAR),
    CAST(weather_date AS VARCHAR))), 1, 8) < 'cccccccd'"""

# Least squares with two regressors in closed form.
REGRESSION = {
    "rows_both": f"""SELECT {T} AS x, month AS m, {P} AS y, city_name, year, {IN_TRAINING} AS training
        FROM dated WHERE {T} IS NOT NULL AND {P} IS NOT NULL""",
    "folded": """SELECT x, m, COUNT(*) AS w, SUM(y) AS sy FROM rows_both WHERE training GROUP BY x, m""",
    "moments": """SELECT ax, am, ay, SUM(w * (x - ax) * (x - ax)) AS vx, SUM(w * (m - am) * (m - am)) AS vm,
        SUM(w * (x - ax) * (m - am)) AS xm, SUM((x - ax) * (sy - w * ay)) AS xy,
        SUM((m - am) * (sy - w * ay)) AS my
        FROM folded CROSS JOIN (SELECT SUM(w * x) / SUM(w) AS ax, SUM(w * m) / SUM(w) AS am,
            SUM(sy) / SUM(w) AS ay FROM folded) GROUP BY ax, am, ay""",
    "slopes": """SELECT *, (xy * vm - my * xm) / (vx * vm - xm * xm) AS bx,
        (my * vx - xy * xm) / (vx * vm - xm * xm) AS bm FROM moments""",
    "predicted": """SELECT x AS temperature, y AS precipitation, city_name, m AS month, year,
        ay + bx * (x - ax) + bm * (m - am) AS prediction
        FROM rows_both CROSS JOIN slopes WHERE NOT training""",
}

# Elastic net by coordinate descent on standardised features, from their products alone. Strength 0.1,
# of which 0.8 on absolute values; the squares' part is relative to the label's deviation.
NET = ("location_latitude", "location_longitude", "humidity_percent", P, "month", "phase")
SWEEPS = 300


def _net() -> dict[str, str]:
    at = range(len(NET))
    z = [f"COALESCE((x{i} - m{i}) / NULLIF(s{i}, 0), 0)" for i in at]
    product = {(i, j): f"g{min(i, j)}{max(i, j)}" for i in at for j in at}

    def step(i: int) -> str:
        others = " - ".join(f"{product[i, j]} * {'n' if j < i else 'b'}{j}" for j in at if j != i)
        pull = f"(c{i} - {others})"
        return f"SIGN({pull}) * GREATEST(ABS({pull}) - 0.08, 0) / ({product[i, i]} + 0.02 / sy) AS n{i}"

    columns = ", ".join(f"{name} AS x{i}" for i, name in enumerate(NET))
    return {
        "net_rows": f"""SELECT city_name, weather_date, {T} AS y, {columns}, {IN_TRAINING} AS training
            FROM (SELECT *, (weather_date - DATE '1970-01-01') % 365 AS phase FROM dated)
            WHERE {T} IS NOT NULL AND humidity_percent IS NOT NULL AND {P} IS NOT NULL""",
        "scales": "SELECT AVG(y) AS my, STDDEV_POP(y) AS sy, "
        + ", ".join(f"AVG(x{i}) AS m{i}, STDDEV_POP(x{i}) AS s{i}" for i in at)
        + " FROM net_rows WHERE training",
        "gram": "SELECT ANY_VALUE(sy) AS sy, "
        + ", ".join(f"AVG({z[i]} * (y - my)) AS c{i}" for i in at)
        + ", "
        + ", ".join(f"GREATEST(AVG({z[i]} * {z[j]}), {'1e-9' if i == j else '-1'}) AS g{i}{j}" for i in at for j in at if i <= j)
        + " FROM net_rows CROSS JOIN scales WHERE training",
        "fit": f"SELECT 0 AS k, {', '.join(f'CAST(0 AS DOUBLE) AS b{i}' for i in at)} UNION ALL "
        f"SELECT k + 1, {', '.join(step(i) for i in at)} FROM fit CROSS JOIN gram WHERE k < {SWEEPS}",
        "net": "SELECT city_name, weather_date, y, my + "
        + " + ".join(f"b{i} * {z[i]}" for i in at)
        + f""" AS prediction FROM net_rows CROSS JOIN scales
            CROSS JOIN (SELECT * FROM fit WHERE k = {SWEEPS}) WHERE NOT training""",
    }


def profile(columns: dict[str, str]) -> str:
    rows = []
    for name, kind in columns.items():
        nan = f" OR ISNAN({name})" if kind == "double" else ""
        missing = f"COUNT(*) FILTER (WHERE {name} IS NULL{nan})"
        rows.append(
            f"""SELECT COUNT(*) AS total_rows, '{name}' AS column_name, '{kind}' AS column_type,
            {missing} AS null_count, {rnd(f'{missing} * 100.0 / COUNT(*)')} AS null_pct
            FROM obs"""
        )
    return on_obs("\nUNION ALL\n".join(rows))


def z(column: str) -> str:
    return f"({column} - mean_{column}) / NULLIF(std_{column}, 0)"


def standardized(column: str) -> str:
    return f"({column} - AVG({column}) OVER ()) / STDDEV_SAMP({column}) OVER ()"


STATS = f"""SELECT city_name, AVG({T}) AS mean_{T}, STDDEV_SAMP({T}) AS std_{T},
    AVG({P}) AS mean_{P}, STDDEV_SAMP({P}) AS std_{P} FROM obs GROUP BY city_name"""

LANDED = ("docs", "snapped", "days", "locations", "trusted")

ORACLE: dict[str, str] = {
    "monthly_analysis": on_obs(MONTHLY),
    "monthly_extended": on_extended(
        f"""SELECT city_name, country, year, month, {rnd(f'AVG({T})')} AS avg_max_temp,
        {rnd('AVG(min_temp_c)')} AS avg_min_temp, {rnd(f'SUM({P})')} AS total_precipitation,
        {rnd('AVG(humidity_percent)')} AS avg_humidity, COUNT(*) AS days_with_data,
        {rnd(f'STDDEV_SAMP({T})')} AS temp_variability
        {WITH_TEMP} GROUP BY city_name, country, year, month"""
    ),
    "extreme_cities": extreme(LOCAL_BANDS, "Frío", f"{rnd(f'AVG({P})')} AS avg_precipitation,"),
    "extreme_cities_global": extreme(GLOBAL_BANDS, "Muy Frío", ""),
    "seasonal_analysis": on_obs(
        f"""SELECT city_name, country, {DRY_WET} AS epoca, {rnd(f'AVG({T})')} AS avg_temp,
        {rnd(f'SUM({P})')} AS total_precipitation,
        {rnd(f'AVG({P})')} AS avg_daily_precipitation, COUNT(*) AS days_count,
        {rnd(ratio(f'{P} > 0'), 3)} AS rainy_days_ratio {WITH_TEMP} GROUP BY ALL"""
    ),
    "seasonal_temperate": on_obs(
        f"""SELECT city_name, country, {TEMPERATE} AS season, {rnd(f'AVG({T})')} AS avg_temp,
        {rnd(f'SUM({P})')} AS total_precipitation, COUNT(*) AS days_count
        {WITH_TEMP} GROUP BY ALL"""
    ),
    "tropical_analysis": on_obs(
        f"""SELECT *, {TROPICAL} AS periodo_climatico,
        {case('avg_daily_precip', RAIN_CLASSES, 'Seco', '>')} AS clasificacion_lluvia
        FROM months""",
        months=f"""SELECT city_name, country, month, {rnd(f'AVG({T})')} AS avg_temp,
        {rnd(f'SUM({P})')} AS total_precip, {rnd(f'AVG({P})')} AS avg_daily_precip,
        COUNT(*) AS days_count {WITH_TEMP} GROUP BY ALL""",
    ),
    "precipitation_patterns": on_obs(RAIN_PROFILE),
    "cities_comparison": on_obs(
        f"""SELECT city_name, country, {rnd(f'AVG({T})')} AS temp_promedio,
        {rnd(f'MIN({T})')} AS temp_minima, {rnd(f'MAX({T})')} AS temp_maxima,
        {rnd(f'STDDEV_SAMP({T})')} AS variabilidad_temp, {rnd(f'SUM({P})')} AS lluvia_total,
        {rnd(f'AVG({P})')} AS lluvia_promedio, COUNT(*) FILTER (WHERE {P} > 0) AS dias_lluvia,
        {rnd(ratio(f'{P} > 0', 100), 1)} AS pct_dias_lluvia,
        {CITY_CASE} AS caracteristicas_geograficas {WITH_TEMP} GROUP BY city_name, country"""
    ),
    "correlations": on_obs(CORRELATIONS),
    "humidity_correlations": on_extended(
        f"""SELECT city_name, country, {safe_corr(T, 'humidity_percent')} AS temp_humidity_corr,
        {safe_corr(T, P)} AS temp_precipitation_corr,
        {rnd(ratio(f'{P} > 0'), 3)} AS rainy_days_ratio
        FROM obs WHERE {T} IS NOT NULL AND humidity_percent IS NOT NULL
        GROUP BY city_name, country HAVING COUNT(*) >= 50"""
    ),
    "temporal_patterns": on_obs(
        f"""SELECT city_name, month, {rnd(f'AVG({T})')} AS avg_temp,
        {rnd(f'AVG({P})')} AS avg_precip, COUNT(*) AS days_count
        FROM dated WHERE {T} IS NOT NULL AND {P} IS NOT NULL GROUP BY city_name, month"""
    ),
    "city_features": on_obs(FEATURES),
    "city_features_geo": on_extended(
        f"""SELECT city_name, country, location_latitude, location_longitude,
        {rnd(f'AVG({T})')} AS avg_max_temp, {rnd('AVG(min_temp_c)')} AS avg_min_temp,
        {rnd(f'SUM({P})')} AS total_precipitation,
        {rnd('AVG(humidity_percent)')} AS avg_humidity, COUNT(*) AS data_points,
        {rnd(f'STDDEV_SAMP({T})')} AS temp_variability
        FROM obs GROUP BY city_name, country, location_latitude, location_longitude
        HAVING COUNT(*) >= 30"""
    ),
    "compare_cities": on_obs(
        "SELECT weather_date, "
        + ", ".join(
            f"""{rnd(f"AVG({T}) FILTER (WHERE city_name = '{city}')")} AS {side}_max_temp_c,
            {rnd(f"SUM({P}) FILTER (WHERE city_name = '{city}')")} AS {side}_precipitation_mm"""
            for side, city in (("first", "NATION_1"), ("second", "NATION_2"))
        )
        + """ FROM obs WHERE city_name IN ('NATION_1', 'NATION_2')
        AND weather_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY weather_date"""
    ),
    "column_stats": on_obs(
        f"""SELECT {rnd(f'MIN({T})')} AS min_value, {rnd(f'MAX({T})')} AS max_value,
        {rnd(f'AVG({T})')} AS avg_value, {rnd(f'STDDEV_SAMP({T})')} AS stddev_value FROM obs"""
    ),
    "date_range": on_obs(
        "SELECT MIN(weather_date) AS first_date, MAX(weather_date) AS last_date FROM obs"
    ),
    "distinct_cities": on_obs("SELECT COUNT(DISTINCT city_name) AS distinct_values FROM obs"),
    "row_distribution": on_obs(
        "SELECT city_name, country, COUNT(*) AS row_count FROM obs GROUP BY city_name, country"
    ),
    "null_profile": profile(
        {
            "weather_date": "date",
            "location_id": "int",
            "city_name": "string",
            "country": "string",
            "max_temp_c": "double",
            "precipitation_mm": "double",
            "population": "int",
            "elevation": "double",
        }
    ),
    "available_cities": on_obs("SELECT DISTINCT city_name FROM obs"),
    "sorted_observations": on_obs("SELECT * FROM obs"),
    "head_monthly": on_obs(
        "SELECT * FROM m ORDER BY city_name, year, month, country LIMIT 100", m=MONTHLY
    ),
    "select_series": on_obs(
        f"""SELECT weather_date, city_name, {T}, {P}, population, elevation FROM obs
        WHERE city_name IN ('NATION_1', 'NATION_2')
        AND weather_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"""
    ),
    "not_null_rows": on_obs(f"SELECT * FROM obs WHERE {T} IS NOT NULL AND {P} IS NOT NULL"),
    "drop_null_rows": on_extended(
        """SELECT city_name, COUNT(*) AS row_count FROM obs
        WHERE min_temp_c IS NOT NULL AND humidity_percent IS NOT NULL GROUP BY city_name"""
    ),
    "prediction_error": on_extended(
        f"SELECT weather_date, location_id, {rnd(f'{T} - min_temp_c')} AS error FROM obs"
    ),
    "calendar_features": on_obs(
        "SELECT year, month, day_of_year, COUNT(*) AS row_count FROM dated GROUP BY ALL"
    ),
    "epoch_phases": on_obs(
        """SELECT weather_date, CAST((weather_date - DATE '1970-01-01') % 365 AS INT) AS phase,
        COUNT(*) AS row_count FROM obs GROUP BY weather_date"""
    ),
    "threshold_classes": on_obs(
        f"""SELECT {case(T, LOCAL_BANDS, 'Frío', '>=')} AS temp_class,
        {case(P, RAIN_CLASSES, 'Seco', '>')} AS rain_class, COUNT(*) AS row_count
        FROM obs GROUP BY ALL"""
    ),
    "season_calendars": on_obs(
        f"""SELECT month, {DRY_WET} AS dry_wet, {TROPICAL} AS tropical, {TEMPERATE} AS temperate,
        COUNT(*) AS row_count FROM dated GROUP BY month"""
    ),
    "label_lookup": on_obs(
        f"SELECT {CITY_CASE} AS label, COUNT(*) AS row_count FROM obs GROUP BY ALL"
    ),
    "train_test_split": on_obs(
        f"""SELECT city_name, CASE WHEN {IN_TRAINING} THEN 'train' ELSE 'test' END AS side,
        COUNT(*) AS row_count FROM obs GROUP BY ALL"""
    ),
    "correlation_filter": on_obs(
        "SELECT * FROM c WHERE temp_precipitation_corr < 0", c=CORRELATIONS
    ),
    "countries_in_result": on_obs(
        "SELECT country, COUNT(*) AS row_count FROM c GROUP BY country", c=CORRELATIONS
    ),
    "projected_result": on_obs(
        "SELECT city_name AS city, temp_precipitation_corr AS temp_corr FROM c", c=CORRELATIONS
    ),
    "anomalies": on_obs(
        f"""SELECT weather_date, city_name, {T}, {P}, {rnd(z(T), 6)} AS temp_z_score,
        {rnd(z(P), 6)} AS precip_z_score FROM obs JOIN stats USING (city_name)
        WHERE ABS({z(T)}) > 2 OR ABS({z(P)}) > 2""",
        stats=STATS,
    ),
    "group_stats_rows": on_obs(
        f"""SELECT city_name, weather_date, {T}, {rnd(f'mean_{T}', 6)} AS mean_temp,
        {rnd(f'std_{T}', 6)} AS std_temp FROM obs JOIN stats USING (city_name)""",
        stats=STATS,
    ),
    "standardized_features": on_obs(
        "SELECT city_name, country, "
        + ", ".join(
            f"{rnd(standardized(c), 6)} AS z_{c}"
            for c in ("avg_max_temp", "total_precipitation", "temp_variability")
        )
        + """ FROM f WHERE avg_max_temp IS NOT NULL AND total_precipitation IS NOT NULL
        AND temp_variability IS NOT NULL""",
        f=FEATURES,
    ),
    "cluster_summary": on_obs(
        f"""SELECT CASE WHEN avg_max_temp >= 20 THEN 0 WHEN avg_max_temp >= 10 THEN 1
        ELSE 2 END AS prediction, COUNT(*) AS cities_count,
        {rnd('AVG(avg_max_temp)')} AS cluster_avg_temp,
        {rnd('AVG(total_precipitation)')} AS cluster_avg_precip,
        {rnd('AVG(temp_variability)')} AS cluster_temp_variability FROM f GROUP BY ALL""",
        f=FEATURES,
    ),
    "regression_results": on_obs(
        f"""SELECT temperature, precipitation, city_name, month, year,
        {rnd('prediction', 4)} AS prediction FROM predicted""",
        **REGRESSION,
    ),
    "regression_metrics": on_obs(
        f"""SELECT {rnd('SQRT(AVG(POW(precipitation - prediction, 2)))', 4)} AS rmse,
        {rnd('AVG(ABS(precipitation - prediction))', 4)} AS mae,
        {rnd('1 - AVG(POW(precipitation - prediction, 2)) / VAR_POP(precipitation)', 4)} AS r2
        FROM predicted""",
        **REGRESSION,
    ),
    "temperature_predictions": on_extended(
        f"""SELECT city_name, weather_date, y AS {T}, {rnd('prediction')} AS prediction,
        {rnd('y - prediction')} AS error FROM net""",
        **_net(),
    ),
    "grid_snap": over(
        "docs",
        "snapped",
        select="""SELECT latitude, longitude, COUNT(*) AS row_count FROM snapped
        GROUP BY latitude, longitude""",
    ),
    "explode_daily": over(
        "docs",
        "snapped",
        "days",
        select="SELECT latitude, longitude, weather_date, max_temp_c, precipitation_mm FROM days",
    ),
    "prepare_locations": over(
        "locations", select="SELECT * EXCLUDE (visits) FROM locations"
    ),
    "extracted_locations": over(
        "locations",
        select="""SELECT CAST(location_id AS VARCHAR) AS location_id, city_name, country,
        location_latitude AS latitude, location_longitude AS longitude,
        COALESCE(CAST(population AS VARCHAR), 'unknown') AS population,
        CAST(CAST(elevation AS BIGINT) AS VARCHAR) AS elevation,
        visits AS average_tourism_visits_per_year FROM locations""",
    ),
    "join_on_grid": over(
        "docs",
        "snapped",
        "locations",
        select="""SELECT location_id, city_name, latitude, longitude, COUNT(*) AS row_count
        FROM snapped JOIN locations ON latitude = location_latitude
        AND longitude = location_longitude GROUP BY ALL""",
    ),
    "trusted_observations": over(*LANDED, select="SELECT * FROM trusted"),
    "valid_documents": over(
        "docs",
        select="""SELECT CASE WHEN no_days THEN 'rejected' ELSE 'valid' END AS side,
        COUNT(*) AS row_count FROM docs GROUP BY ALL""",
    ),
    "weather_json_roundtrip": over(
        "docs",
        "snapped",
        "days",
        select="""SELECT latitude, longitude, -18000 AS utc_offset_seconds,
        'America/Bogota' AS timezone, '-05' AS timezone_abbreviation,
        CAST(sup * 10 AS DOUBLE) AS elevation, CAST(YEAR(first_day) AS INT) AS year,
        weather_date, max_temp_c, precipitation_mm FROM days""",
    ),
    "locations_csv_roundtrip": over(
        "locations",
        select="""SELECT CAST(location_id AS VARCHAR) AS location_id, city_name, country,
        CAST(location_latitude + CAST(0.03125 AS DOUBLE) AS VARCHAR) AS latitude,
        CAST(location_longitude - CAST(0.03125 AS DOUBLE) AS VARCHAR) AS longitude,
        COALESCE(CAST(population AS VARCHAR), 'unknown') AS population,
        CAST(CAST(elevation AS BIGINT) AS VARCHAR) AS elevation,
        visits AS average_tourism_visits_per_year FROM locations""",
    ),
    "observations_roundtrip": on_obs("SELECT * FROM obs"),
    "table_roundtrip": on_obs("SELECT * FROM obs"),
    "dataset_roundtrip": on_obs(MONTHLY),
    "json_export": on_obs(RAIN_PROFILE),
    "csv_export": on_obs(RAIN_PROFILE),
    "dataset_catalog": """SELECT name, category, CAST(files AS BIGINT) AS file_count
        FROM (VALUES ('monthly_analysis', 'descriptive_analytics', 2),
        ('temporal_patterns', 'ml_analytics', 3)) AS d(name, category, files)""",
    "raw_to_refined": over(*LANDED, select=MONTHLY, dated=DATED.replace("obs", "trusted")),
}


def on_trusted(sql: str) -> str:
    """A query over ``obs``, over the observations that the batch makes of the landed documents."""
    landed = ",\n".join(cte(name, NAMED[name]) for name in LANDED)
    start = f"WITH RECURSIVE obs AS ({NAMED['obs']})"
    assert sql.startswith(start)
    return f"WITH RECURSIVE {landed},\nobs AS (SELECT * FROM trusted)" + sql.removeprefix(start)


CLUSTERED = f"""SELECT city_name, country, avg_max_temp, total_precipitation, temp_variability,
    {{more}} CAST(LEAST(3, COUNT(*) OVER ()) AS INT) AS clusters FROM ({FEATURES})
    WHERE avg_max_temp IS NOT NULL AND total_precipitation IS NOT NULL
    AND temp_variability IS NOT NULL"""

ORACLE |= {
    "anomalies_from_rollup": ORACLE["anomalies"],
    "join_on_grid_salted": ORACLE["join_on_grid"],
    "dataset_head": ORACLE["head_monthly"],
    "clustering_results": on_obs(CLUSTERED.format(more="TRUE AS own_centre_is_nearest,")),
    "cluster_members": on_obs(CLUSTERED.format(more="")),
    "silhouette_sweep": "SELECT CAST(k AS INT) AS k, TRUE AS choice_is_right FROM RANGE(2, 8) r(k)",
} | {
    f"batch_{name}": on_trusted(ORACLE[name])
    for name in (
        "correlations",
        "seasonal_analysis",
        "extreme_cities",
        "precipitation_patterns",
        "tropical_analysis",
        "temporal_patterns",
        "regression_results",
        "anomalies",
    )
}
