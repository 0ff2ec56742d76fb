"""The registered queries as SQL over the same tables, for comparison."""

from __future__ import annotations

from ..operators.distribution import GRID_POINTS
from ..spec import LAGS, MEASURES, WINDOWS

YEAR = 1997

TX = """
tx AS (
  SELECT l_shipdate AS transaction_date,
         date_trunc('month', l_shipdate) AS reference_date,
         CAST(s_nationkey AS BIGINT) AS internal_store_id,
         CAST(substr(p_brand, 7) AS BIGINT) AS internal_product_id,
         sign * l_quantity AS quantity,
         sign * l_extendedprice AS gross_value,
         (sign * l_extendedprice) * (1 - l_discount) AS net_value,
         (sign * l_extendedprice) * (1 - l_discount)
           - (sign * l_quantity) * p_retailprice AS gross_profit,
         (sign * l_extendedprice) * l_discount AS discount,
         ((sign * l_extendedprice) * (1 - l_discount)) * l_tax AS taxes
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN CAST(-1 AS DOUBLE)
                       ELSE CAST(1 AS DOUBLE) END AS sign FROM lineitem) l
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

SPARSE = TX.replace("s_nationkey", "l_suppkey").replace("substr(p_brand, 7)", "l_partkey")

STORES = """
stores AS (
  SELECT CAST(n_nationkey AS BIGINT) AS pdv,
         CASE WHEN n_nationkey % 2 = 0 THEN 'On Premise' ELSE 'Off Premise' END AS premise_type,
         r_name AS categoria_pdv, CAST(n_nationkey * 1000 AS BIGINT) AS zipcode,
         CAST(CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_on_premise
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

PRODUCTS = """
products AS (
  SELECT id AS produto, 'cat' || (id % 6) AS categoria, 'tipo' || (id % 4) AS tipos,
         'label' || (id % 5) AS label, 'sub' || (id % 3) AS subcategoria, p_brand AS marca,
         'fab' || (id % 7) AS fabricante, p_brand AS descricao
  FROM (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS BIGINT) AS id FROM part) b
)"""

PAIR = "internal_store_id, internal_product_id"
GRAIN = f"{PAIR}, year, week"
PARTS = """CAST(year({d}) AS INTEGER) AS year, CAST(weekofyear({d}) AS INTEGER) AS week"""
WEEKEND = "CASE WHEN isodow({d}) IN (6, 7) THEN 1 ELSE 0 END"


def rollup(name: str, source: str, year: str = "year(transaction_date)") -> str:
    sums = ", ".join(f"round(coalesce(sum({m}), 0), 6) AS {m}" for m in MEASURES)
    weekend = WEEKEND.format(d="transaction_date")
    return f"""
{name} AS (
  SELECT {PAIR}, CAST({year} AS INTEGER) AS year,
         CAST(weekofyear(transaction_date) AS INTEGER) AS week,
         {sums}, avg({weekend}) AS is_weekend
  FROM {source}
  WHERE internal_store_id IS NOT NULL AND internal_product_id IS NOT NULL
    AND transaction_date IS NOT NULL
  GROUP BY 1, 2, 3, 4
)"""


def lag_columns() -> str:
    return ", ".join(f"lag(quantity, {k}) OVER s AS quantity_lag_{k}" for k in LAGS)


def roll_columns(before: bool = False, value: str = "quantity", keys: str = PAIR,
                 order: str = "year, week", windows=WINDOWS) -> str:
    parts = []
    for w in windows:
        frame = (f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING" if before
                 else f"ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW")
        over = f"OVER (PARTITION BY {keys} ORDER BY {order} {frame})"
        for name, function in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"),
                               ("max", "max")):
            found = f"coalesce({function}({value}) {over}, 0)"
            parts.append(f"round({found}, 6) AS {value}_roll_{name}_{w}")
    return ", ".join(parts)


SERIES = f"WINDOW s AS (PARTITION BY {PAIR} ORDER BY year, week)"
W = f"{TX}, {rollup('w', 'tx')}"
LAGGED = f"{W}, lagged AS (SELECT *, {lag_columns()} FROM w {SERIES})"
MEASURE_COLUMNS = ", ".join(f"round({m}, 6) AS {m}" for m in MEASURES)
ROLL_NAMES = [f"quantity_roll_{n}_{w}" for w in WINDOWS for n in ("mean", "std", "min", "max")]
LAG_NAMES = [f"quantity_lag_{k}" for k in LAGS]
DAY = "strftime({c}, '%Y-%m-%d') AS {c}"


def day(column: str) -> str:
    return DAY.format(c=column)


def guarded(a: str, b: str) -> str:
    return f"({a}) / nullif({b}, 0)"


RATIO_COLUMNS = f"""{guarded('gross_value', 'quantity')} AS unit_price,
  {guarded('gross_profit', 'gross_value')} AS profit_margin,
  {guarded('discount', 'gross_value')} AS discount_ratio"""


def profile(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM {source}"
        for c in columns)


CYCLE = {"month": ("month({d})", 12), "week": ("weekofyear({d})", 52), "day": ("day({d})", 31),
         "dayofweek": ("(isodow({d}) - 1)", 7)}


def cyclical(date: str) -> str:
    return ", ".join(
        f"round({f}(2 * pi() * {e.format(d=date)} / {n}), 9) + 0.0 AS {c}_{f}"
        for c, (e, n) in CYCLE.items() for f in ("sin", "cos"))


KEPT = f"""
kept AS (SELECT * FROM tx WHERE transaction_date >= TIMESTAMP '{YEAR}-01-01'
                            AND transaction_date < TIMESTAMP '{YEAR + 1}-01-01'),
bounds AS (SELECT quantile_cont(quantity, 0.001) AS lo, quantile_cont(quantity, 0.999) AS hi
           FROM kept),
trimmed AS (SELECT kept.* FROM kept, bounds WHERE quantity BETWEEN lo AND hi)"""


# The same without a year.
ALL_KEPT = """
bounds AS (SELECT quantile_cont(quantity, 0.001) AS lo, quantile_cont(quantity, 0.999) AS hi FROM tx),
trimmed AS (SELECT tx.* FROM tx, bounds WHERE quantity BETWEEN lo AND hi)"""


def middle(column: str) -> str:
    """The mean of the two middle values, which are one and the same for an odd count."""
    ordered = f"list({column} ORDER BY {column}) FILTER ({column} IS NOT NULL)"
    n = f"count({column})"
    return (f"(list_extract({ordered}, ({n} + 1) // 2) + list_extract({ordered}, {n} // 2 + 1))"
            " / 2")


def filled(source: str) -> str:
    return f"""
raw_ratios AS (SELECT *, {RATIO_COLUMNS} FROM {source}),
medians AS (SELECT {middle('unit_price')} AS up, {middle('profit_margin')} AS pm FROM raw_ratios),
filled AS (SELECT raw_ratios.* REPLACE (coalesce(unit_price, up) AS unit_price,
             coalesce(profit_margin, pm) AS profit_margin,
             coalesce(discount_ratio, 0) AS discount_ratio)
           FROM raw_ratios, medians)"""


RATIO_NAMES = ["unit_price", "profit_margin", "discount_ratio"]
RATIOS_FINAL = ", ".join(f"{r} + 0.0 AS {r}" for r in RATIO_NAMES)
STORE_ATTRIBUTES = "zipcode, premise_type, categoria_pdv"
PRODUCT_ATTRIBUTES = "categoria, tipos, label, subcategoria, marca, fabricante"
CODED = ["categoria", "tipos", "label", "subcategoria", "marca", "fabricante", "premise_type",
         "categoria_pdv"]
# Categories are never missing here; codes follow the order of the values seen.
CODE_COLUMNS = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_encoded" for c in CODED)

FEATURES = f"""{TX}, {ALL_KEPT}, {STORES}, {PRODUCTS}, {rollup('w', 'trimmed')}, {filled('w')},
lagged AS (SELECT *, {lag_columns()}, {roll_columns()} FROM filled {SERIES}),
features AS MATERIALIZED (
  SELECT {GRAIN}, {MEASURE_COLUMNS}, round(is_weekend, 6) AS is_weekend,
         {STORE_ATTRIBUTES}, {PRODUCT_ATTRIBUTES}, {RATIOS_FINAL},
         {', '.join(LAG_NAMES)}, {', '.join(ROLL_NAMES)}, {CODE_COLUMNS},
         round(sin(2 * pi() * week / 52), 6) + 0.0 AS week_sin,
         round(cos(2 * pi() * week / 52), 6) + 0.0 AS week_cos
  FROM lagged
  LEFT JOIN stores ON internal_store_id = pdv
  LEFT JOIN products ON internal_product_id = produto
)"""
UNUSED_BY_MODELS = ["quantity", "marca", "fabricante", *[f"{c}_encoded" for c in CODED]]

# The vector of a model in its order: numbers, filled gaps and their flags, codes of texts.
MODEL_INPUTS = {
    **{c: c for c in ("internal_store_id", "internal_product_id", "year", "week", *MEASURES[1:], "is_weekend",
                      "zipcode", *RATIO_NAMES, *ROLL_NAMES, "week_sin", "week_cos")},
    **{f"{c}_filled": f"coalesce({c}, -1)" for c in LAG_NAMES},
    **{f"{c}_missing": f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in LAG_NAMES},
    **{f"{c}_code": f"{c}_encoded" for c in (
        "premise_type", "categoria_pdv", "categoria", "tipos", "label", "subcategoria")},
}

# Sales with missing keys, dates and values, values that are no numbers, and orphans.
DIRTY = """
dirty AS (
  SELECT CASE WHEN abs(quantity) <> 7 THEN transaction_date END AS transaction_date, reference_date,
         CASE abs(quantity) WHEN 3 THEN NULL WHEN 4 THEN internal_store_id + 1000
              ELSE internal_store_id END AS internal_store_id,
         CASE WHEN abs(quantity) <> 9 THEN internal_product_id END AS internal_product_id,
         CASE WHEN abs(quantity) NOT IN (8, 12) THEN quantity END AS quantity,
         CASE abs(quantity) WHEN 11 THEN 0 WHEN 6 THEN NULL ELSE gross_value END AS gross_value, net_value,
         CASE WHEN abs(quantity) <> 13 THEN gross_profit END AS gross_profit,
         CASE WHEN abs(quantity) <> 10 THEN discount END AS discount,
         CASE WHEN abs(quantity) <> 5 THEN taxes END AS taxes
  FROM tx)"""

DIRTY_CLEAN = f"""WITH {TX}, {STORES}, {PRODUCTS}, {DIRTY},
bounds AS (SELECT quantile_cont(quantity, 0.001) AS lo, quantile_cont(quantity, 0.999) AS hi FROM dirty),
inside AS (SELECT dirty.* FROM dirty, bounds WHERE quantity BETWEEN lo AND hi),
{filled('inside')},
goods AS (SELECT produto, CASE WHEN produto % 4 <> 0 THEN categoria ELSE 'Unknown' END AS categoria,
                 CASE WHEN produto % 4 <> 0 THEN marca ELSE 'Unknown' END AS marca FROM products),
codes AS (SELECT marca, row_number() OVER (ORDER BY marca) - 1 AS code
          FROM (SELECT DISTINCT marca FROM goods WHERE produto <= 15) d)
SELECT {PAIR}, {day('transaction_date')}, CAST(year(transaction_date) AS INTEGER) AS year,
       CAST(weekofyear(transaction_date) AS INTEGER) AS week,
       CAST(CASE WHEN quantity < 0 THEN 1 ELSE 0 END AS INTEGER) AS is_return, quantity,
       round(gross_value, 6) + 0.0 AS gross_value, round(gross_profit, 6) + 0.0 AS gross_profit,
       round(discount, 6) + 0.0 AS discount, round(taxes, 6) + 0.0 AS taxes, {RATIOS_FINAL}, pdv,
       CASE WHEN pdv % 5 <> 0 THEN premise_type END AS premise_type,
       CASE WHEN pdv % 5 <> 0 THEN is_on_premise WHEN pdv IS NOT NULL THEN 0 END AS is_on_premise,
       categoria, coalesce(codes.marca, 'Unknown') AS marca,
       CAST(coalesce(code, (SELECT code FROM codes WHERE marca = 'Unknown'), -1) AS INTEGER) AS marca_encoded
FROM filled LEFT JOIN stores ON internal_store_id = pdv LEFT JOIN goods ON internal_product_id = produto
LEFT JOIN codes ON goods.marca = codes.marca"""

JOINED = f"""
SELECT {day('transaction_date')}, {PAIR}, quantity, round(gross_value, 6) AS gross_value, pdv,
       premise_type, categoria_pdv, zipcode, produto, categoria, marca, fabricante
FROM tx {{how}} JOIN stores ON internal_store_id = pdv
        {{how}} JOIN products ON internal_product_id = produto"""

ORDERED = f"""
ordered AS (SELECT *, row_number() OVER (ORDER BY year, week, {PAIR}) AS ordinal,
                   count(*) OVER () AS n FROM w)"""

FOLDS = f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY year, week, {PAIR}) AS ordinal,
                    count(*) OVER () AS n FROM {{source}}),
folds AS (
  SELECT numbered.*, CAST(j AS INTEGER) AS fold, n // 6 AS z, n - (5 - j) * (n // 6) AS train_end
  FROM numbered, range(5) t(j))"""


def error_measures(actual: str, predicted: str) -> str:
    e = f"({actual} - {predicted})"
    y = f"(CASE WHEN {predicted} IS NOT NULL THEN {actual} END)"
    return f"""count({e}) AS n, round(avg(abs({e})), 6) AS mae, round(avg({e} * {e}), 6) AS mse,
  round(sqrt(avg({e} * {e})), 6) AS rmse,
  round(1 - sum({e} * {e}) / (var_pop({y}) * count({y})), 6) AS r2,
  round(avg(abs({e}) / nullif(abs({y}), 0)), 6) AS mape"""


def horizon(columns: str) -> str:
    lags = ", ".join(
        "quantity AS quantity_lag_1" if k == 1 else
        f"CASE WHEN semana >= {k} THEN quantity ELSE quantity_lag_{k} END AS quantity_lag_{k}"
        for k in LAGS)
    return f"""
newest AS (SELECT year AS max_year, week AS max_week FROM lagged
           ORDER BY year DESC, week DESC LIMIT 1),
latest AS (SELECT * FROM lagged
           QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY year DESC, week DESC) = 1),
steps AS (
  SELECT {PAIR}, quantity, {lags}, quantity_roll_mean_4, quantity_roll_std_12,
         CAST(semana AS INTEGER) AS semana, max_year, max_week,
         CASE WHEN (max_week + semana) % 52 = 0 THEN 52 ELSE (max_week + semana) % 52 END AS wk
  FROM latest, newest, range(1, 6) t(semana)),
horizon AS (
  SELECT *, CAST(wk AS INTEGER) AS week,
         CAST(CASE WHEN wk > max_week THEN max_year ELSE max_year + 1 END AS INTEGER) AS year,
         round(sin(2 * pi() * wk / 52), 6) + 0.0 AS week_sin,
         round(cos(2 * pi() * wk / 52), 6) + 0.0 AS week_cos
  FROM steps)
{columns}"""


ROLLED = f"{W}, lagged AS (SELECT *, {lag_columns()}, {roll_columns()} FROM w {SERIES})"
UNITS = """SELECT semana, internal_store_id AS pdv, internal_product_id AS produto,
  CAST(greatest(round_even(quantity_roll_mean_4, 0), 0) AS BIGINT) AS quantidade FROM horizon"""

BUCKET = {
    "D": ("CAST({c} AS DATE)", "INTERVAL 1 DAY"),
    "W": ("CAST(date_trunc('week', {c}) AS DATE) + 6", "INTERVAL 7 DAY"),
    "M": ("last_day(CAST({c} AS DATE))", "INTERVAL 1 MONTH"),
}


def trend(source: str, date: str, value: str, freq: str, digits: int) -> str:
    label, step = BUCKET[freq]
    label = label.format(c=date)
    start = "min(p)" if freq != "M" else "date_trunc('month', min(p))"
    calendar = f"generate_series(CAST({start} AS TIMESTAMP), CAST(max(p) AS TIMESTAMP), {step})"
    period = "CAST(g AS DATE)" if freq != "M" else "last_day(CAST(g AS DATE))"
    return f"""
totals AS (SELECT {label} AS p, sum({value}) AS v FROM {source} WHERE {date} IS NOT NULL GROUP BY 1),
calendar AS (SELECT {period} AS p FROM (SELECT unnest({calendar}) AS g FROM totals) c)
SELECT strftime(calendar.p, '%Y-%m-%d') AS period, round(coalesce(v, 0), {digits}) AS total
FROM calendar LEFT JOIN totals ON totals.p = calendar.p"""


def seasonal(position: str, label: str) -> str:
    return f"""WITH {TX} SELECT CAST({position} AS INTEGER) AS position, {label} AS period,
  round(avg(quantity), 6) + 0.0 AS mean_value FROM tx GROUP BY 1, 2"""


def correlations(source: str, columns: list[str], threshold: float, digits: int) -> str:
    parts = []
    for j, b in enumerate(columns):
        for a in columns[j + 1:]:
            x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            r = f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r} AS raw FROM {source}")
    pairs = " UNION ALL ".join(parts)
    return f"""pairs AS ({pairs})
SELECT col_a, col_b, round(CASE WHEN abs(coalesce(raw, 0)) >= {threshold}
                                THEN greatest(-1, least(1, raw)) ELSE 0 END, {digits}) + 0.0 AS r
FROM pairs"""


ERRORS = f"{LAGGED}, errors AS (SELECT quantity - quantity_lag_1 AS error FROM lagged " \
         "WHERE quantity_lag_1 IS NOT NULL)"

HISTOGRAM = f"""WITH {ERRORS},
b AS (SELECT min(error) AS lo, max(error) AS hi, (max(error) - min(error)) / 30 AS width
      FROM errors),
edges AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * width AS left_edge,
                 CASE WHEN i = 29 THEN hi ELSE lo + (i + 1) * width END AS right_edge
          FROM b, range(30) t(i))
SELECT bin, round(left_edge, 6) + 0.0 AS left_edge, round(right_edge, 6) + 0.0 AS right_edge,
       count(error) AS count
FROM edges LEFT JOIN errors
  ON error >= left_edge AND (error < right_edge OR (bin = 29 AND error = right_edge))
GROUP BY ALL"""


def density(centre: str) -> str:
    return f"""WITH {ERRORS},
d AS (SELECT count(*) AS n, stddev_samp(error) * pow(count(*), -0.2) AS h,
             min(error) AS lo, max(error) AS hi FROM errors),
v AS (SELECT {centre} AS value, count(*) AS weight FROM errors, d GROUP BY 1),
grid AS (SELECT CAST(i AS INTEGER) AS point, lo + i * ((hi - lo) / {GRID_POINTS - 1}) AS x, n, h
         FROM d, range({GRID_POINTS}) t(i))
SELECT point, round(x, 9) + 0.0 AS x,
       round(sum(weight * exp(-0.5 * ((x - value) / h) * ((x - value) / h)))
             / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
FROM grid, v GROUP BY point, x"""


def decomposition(source: str, date: str, value: str, period: int, model: str,
                  key: str = "") -> str:
    by = f"{key}, " if key else ""
    part = f"PARTITION BY {key}" if key else ""
    half = period // 2
    frame = f"OVER ({part} ORDER BY i ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    total = f"sum(observed) {frame}"
    if period % 2 == 0:
        total += (f" - 0.5 * (lag(observed, {half}) OVER ({part} ORDER BY i)"
                  f" + lead(observed, {half}) OVER ({part} ORDER BY i))")
    detrended, level, resid = (
        ("observed - trend", "m - avg(m) OVER ({p})", "observed - trend - seasonal")
        if model == "additive" else
        ("observed / trend", "m / avg(m) OVER ({p})", "observed / (trend * seasonal)"))
    level = level.format(p=part)
    join = f"t.{key} = s.{key} AND " if key else ""
    key_column = f"t.{key}, " if key else ""
    reason = f", CASE WHEN n < {2 * period} THEN 'short' END AS reason" if key else ""
    enough = f"n >= {2 * period} AND " if key else ""
    return f"""
totals AS (SELECT {by}{date} AS d, sum({value}) AS observed FROM {source}
           WHERE {date} IS NOT NULL GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER ({part} ORDER BY d) - 1 AS i,
                    count(*) OVER ({part}) AS n FROM totals),
t AS (SELECT *, CASE WHEN {enough}i >= {half} AND i < n - {half} THEN ({total}) / {period} END AS trend
      FROM numbered),
phases AS (SELECT {by}i % {period} AS phase, avg({detrended}) AS m FROM t
           WHERE {enough}true GROUP BY ALL),
s AS (SELECT {by}phase, {level} AS seasonal FROM phases)
SELECT {key_column}strftime(d, '%Y-%m-%d') AS {date}, round(observed, 6) + 0.0 AS observed,
       round(trend, 6) + 0.0 AS trend, round(seasonal, 6) + 0.0 AS seasonal,
       round({resid}, 6) + 0.0 AS resid{reason}
FROM t LEFT JOIN s ON {join}i % {period} = phase"""


NUMBERS = ["internal_store_id", "internal_product_id", "year", "week", *MEASURES, "is_weekend", "zipcode",
           *RATIO_NAMES, *LAG_NAMES, *ROLL_NAMES, *[f"{c}_encoded" for c in CODED], "week_sin", "week_cos"]
TX_NAMES = ["transaction_date", "reference_date", "internal_store_id", "internal_product_id",
            *MEASURES]
ACTUAL = "round(coalesce(sum(quantity), 0), 6)"
PREDICTED = "round(coalesce(sum(quantity_lag_1), 0), 6)"

CLEANED = f"""WITH {TX}, {KEPT}, {filled('trimmed')}
        SELECT {day('transaction_date')}, {day('reference_date')}, {PAIR}, {MEASURE_COLUMNS},
        {PARTS.format(d='filled.transaction_date')},
        CAST(month(filled.transaction_date) AS INTEGER) AS month,
        CAST(day(filled.transaction_date) AS INTEGER) AS day,
        CAST(isodow(filled.transaction_date) - 1 AS INTEGER) AS dayofweek,
        CAST({WEEKEND.format(d='filled.transaction_date')} AS INTEGER) AS is_weekend,
        CAST(CASE WHEN filled.quantity < 0 THEN 1 ELSE 0 END AS INTEGER) AS is_return,
        {RATIOS_FINAL} FROM filled"""

ORACLE: dict[str, str] = {
    "scan_profile": f"WITH {TX} {profile('tx', TX_NAMES)}",
    "lag_null_profile": f"""WITH {LAGGED} {profile('lagged', [
        'internal_store_id', 'internal_product_id', 'year', 'week', *MEASURES, 'is_weekend',
        *LAG_NAMES])}""",
    "date_parse": """SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS year,
        CAST(month(l_shipdate) AS INTEGER) AS month, CAST(day(l_shipdate) AS INTEGER) AS day
        FROM lineitem""",
    "calendar": f"""SELECT l_orderkey, {day('l_shipdate')}, {PARTS.format(d='l_shipdate')},
        CAST(month(l_shipdate) AS INTEGER) AS month, CAST(day(l_shipdate) AS INTEGER) AS day,
        CAST(isodow(l_shipdate) - 1 AS INTEGER) AS dayofweek,
        CAST({WEEKEND.format(d='l_shipdate')} AS INTEGER) AS is_weekend,
        CAST(CASE WHEN day(l_shipdate) = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_month_start,
        CAST(CASE WHEN last_day(CAST(l_shipdate AS DATE)) = CAST(l_shipdate AS DATE)
             THEN 1 ELSE 0 END AS INTEGER) AS is_month_end,
        CAST(quarter(l_shipdate) AS INTEGER) AS quarter FROM lineitem""",
    "calendar_iso_year": f"""SELECT l_orderkey, {day('l_shipdate')},
        CAST(isoyear(l_shipdate) AS INTEGER) AS year,
        CAST(weekofyear(l_shipdate) AS INTEGER) AS week FROM lineitem""",
    "cyclical": f"""SELECT l_orderkey, {day('l_shipdate')}, {cyclical('l_shipdate')}
        FROM lineitem""",
    "year_filter": f"""WITH {TX}, {KEPT} SELECT {PAIR}, {day('transaction_date')}, quantity
        FROM kept""",
    "return_flag": f"""WITH {TX} SELECT {PAIR}, quantity,
        CAST(CASE WHEN quantity < 0 THEN 1 ELSE 0 END AS INTEGER) AS is_return FROM tx""",
    "quantiles": f"WITH {TX} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability, "
        f"round(quantile_cont({c}, {p}), 6) AS value FROM tx"
        for c, ps in (("quantity", (0.001, 0.5, 0.999)),
                      ("gross_value", (0.001, 0.25, 0.5, 0.999)),
                      ("gross_profit", (0.1, 0.5, 0.9))) for p in ps),
    "quantiles_by_sketch": f"WITH {TX}, y AS (SELECT *, year(transaction_date) AS y FROM tx) " + " UNION ALL ".join(
        f"SELECT '{years}' AS years, '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability, "
        f"round(quantile_cont({c}, {p}), 6) AS value FROM y WHERE {where}"
        for years, where in (("all", "y IS NOT NULL"), ("one", f"y = {YEAR}"), ("outer", f"abs(y - {YEAR}) > 1"))
        for c, ps in (("quantity", (0.001, 0.5, 0.999)), ("gross_profit", (0.1, 0.5, 0.9))) for p in ps),
    "trim_by_sketch": f"""WITH {TX}, y AS (SELECT * FROM tx WHERE year(transaction_date) = {YEAR}),
        b AS (SELECT quantile_cont(quantity, 0.05) AS lo, quantile_cont(quantity, 0.95) AS hi FROM y)
        SELECT {PAIR}, quantity, round(gross_value, 6) AS gross_value FROM y, b
        WHERE quantity BETWEEN lo AND hi""",
    "outlier_trim": f"""WITH {TX}, b AS (SELECT quantile_cont(quantity, 0.05) AS lo,
        quantile_cont(quantity, 0.95) AS hi FROM tx)
        SELECT {PAIR}, quantity, round(gross_value, 6) AS gross_value FROM tx, b
        WHERE quantity BETWEEN lo AND hi""",
    "outlier_trim_value": f"""WITH {TX}, b AS (SELECT quantile_cont(gross_value, 0.01) AS lo,
        quantile_cont(gross_value, 0.99) AS hi FROM tx)
        SELECT {PAIR}, quantity, round(gross_value, 6) AS gross_value FROM tx, b
        WHERE gross_value BETWEEN lo AND hi""",
    "ratios": f"""WITH {W}, r AS (SELECT *, {RATIO_COLUMNS} FROM w)
        SELECT {GRAIN}, {RATIOS_FINAL} FROM r""",
    "ratios_filled": f"WITH {W}, {filled('w')} SELECT {GRAIN}, {RATIOS_FINAL} FROM filled",
    "clean_transactions": CLEANED,
    "processed_tables": CLEANED,
    "store_clean": f"WITH {STORES} SELECT * FROM stores",
    "product_clean": f"WITH {PRODUCTS} SELECT * FROM products",
    "dirty_clean": DIRTY_CLEAN,
    "dirty_weekly": f"""WITH {TX}, {DIRTY}, {rollup('w', 'dirty')} SELECT {GRAIN}, {MEASURE_COLUMNS},
        round(is_weekend, 6) AS is_weekend FROM w""",
    "loaded_tables": f"""WITH {W}, {STORES}, {PRODUCTS} SELECT {GRAIN}, {MEASURE_COLUMNS}, premise_type,
        categoria FROM w LEFT JOIN stores ON internal_store_id = pdv
        LEFT JOIN products ON internal_product_id = produto""",
    "star_join": f"WITH {TX}, {STORES}, {PRODUCTS} {JOINED.format(how='LEFT')}",
    "star_join_inner": f"WITH {TX}, {STORES}, {PRODUCTS} {JOINED.format(how='INNER')}",
    "weekly_rollup": f"""WITH {W} SELECT {GRAIN}, {MEASURE_COLUMNS},
        round(is_weekend, 6) AS is_weekend FROM w""",
    "weekly_lags_and_ratios": f"""WITH {W},
        r AS (SELECT *, {RATIO_COLUMNS} FROM w)
        SELECT {GRAIN}, {MEASURE_COLUMNS}, round(is_weekend, 6) AS is_weekend, {RATIOS_FINAL},
        lag(quantity, 1) OVER s AS quantity_lag_1, lag(quantity, 12) OVER s AS quantity_lag_12
        FROM r {SERIES}""",
    "weekly_rollup_iso_year": f"""WITH {TX}, {rollup('w', 'tx', 'isoyear(transaction_date)')}
        SELECT {GRAIN}, {MEASURE_COLUMNS}, round(is_weekend, 6) AS is_weekend FROM w""",
    "weekly_attributes": f"""WITH {W}, {STORES}, {PRODUCTS}
        SELECT {GRAIN}, {STORE_ATTRIBUTES}, {PRODUCT_ATTRIBUTES} FROM w
        LEFT JOIN stores ON internal_store_id = pdv
        LEFT JOIN products ON internal_product_id = produto""",
    "lags": f"WITH {LAGGED} SELECT {GRAIN}, quantity, {', '.join(LAG_NAMES)} FROM lagged",
    "rolling": f"WITH {W} SELECT {GRAIN}, {roll_columns()} FROM w",
    "incremental_features": f"""WITH {LAGGED} SELECT {GRAIN}, quantity, {', '.join(LAG_NAMES)}, {roll_columns()}
        FROM lagged""",
    "stored_lags": f"""WITH {LAGGED} SELECT {GRAIN}, quantity, {', '.join(LAG_NAMES)}, {roll_columns()}
        FROM lagged""",
    "distinct_by_sketch": f"""WITH {SPARSE} SELECT CAST(year(transaction_date) AS INTEGER) AS year,
        count(DISTINCT internal_store_id) AS stores, count(DISTINCT internal_product_id) AS products, TRUE AS near
        FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1""",
    "rolling_before": f"WITH {W} SELECT {GRAIN}, {roll_columns(before=True)} FROM w",
    "weekly_rollup_sparse": f"""WITH {SPARSE}, {rollup('w', 'tx')} SELECT {GRAIN}, {MEASURE_COLUMNS},
        round(is_weekend, 6) AS is_weekend FROM w""",
    "rolling_sparse": f"""WITH {SPARSE}, {rollup('w', 'tx')} SELECT {GRAIN}, quantity,
        {', '.join(f'lag(quantity, {k}) OVER s AS quantity_lag_{k}' for k in (1, 2, 3, 4))},
        {roll_columns()} FROM w {SERIES}""",
    "lags_long_series": """SELECT event_id, event_type, value, lag(value, 1) OVER s AS value_lag_1,
        lag(value, 2) OVER s AS value_lag_2, lag(value, 3) OVER s AS value_lag_3,
        lag(value, 4) OVER s AS value_lag_4 FROM events
        WINDOW s AS (PARTITION BY event_type ORDER BY ts, event_id)""",
    "rolling_year": f"""SELECT event_id, event_type, value, {roll_columns(
        value='value', keys='event_type', order='ts, event_id', windows=(26, 52, 365))}
        FROM (SELECT event_id, event_type, ts, round(value * 100) AS value FROM events)""",
    "rolling_year_before": f"WITH {W} SELECT {GRAIN}, {roll_columns(True, windows=(12, 52))} FROM w",
    "rolling_long_series": f"""SELECT event_id, event_type, round(value, 6) AS value, {roll_columns(
        value='value', keys='event_type', order='ts, event_id')} FROM events""",
    "lags_text_ties": """SELECT o_orderkey, o_orderpriority, o_totalprice,
        lag(o_totalprice, 1) OVER s AS o_totalprice_lag_1, lag(o_totalprice, 2) OVER s AS o_totalprice_lag_2
        FROM orders WINDOW s AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR))""",
    "lags_by_date": """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
        l_extendedprice, lag(l_extendedprice, 1) OVER s AS l_extendedprice_lag_1,
        lag(l_extendedprice, 3) OVER s AS l_extendedprice_lag_3
        FROM lineitem WINDOW s AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber,
                                   l_partkey, l_suppkey, l_quantity, l_extendedprice)""",
    "weekly_features": f"WITH {FEATURES} SELECT * FROM features",
    "feature_table": f"WITH {FEATURES} SELECT * FROM features",
    "model_input": f"""WITH {FEATURES} SELECT * EXCLUDE ({', '.join(UNUSED_BY_MODELS)})
        FROM features WHERE quantity_lag_4 IS NOT NULL""",
    "last_observation": f"""WITH {W} SELECT {GRAIN}, quantity FROM w
        QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY year DESC, week DESC) = 1""",
    "distinct_series": f"WITH {TX} SELECT DISTINCT {PAIR} FROM tx",
    "category_codes": """SELECT p_partkey, p_brand, p_type, p_name,
        CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_encoded,
        CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type_encoded,
        CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name_encoded FROM part""",
    "category_apply": f"""WITH known AS (
          SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority AS priority FROM orders
          WHERE o_orderdate >= TIMESTAMP '{YEAR}-01-01'
            AND o_orderdate < TIMESTAMP '{YEAR + 1}-01-01'),
        c AS (SELECT customer AS v, row_number() OVER (ORDER BY customer) - 1 AS code
              FROM (SELECT DISTINCT customer FROM known) k),
        p AS (SELECT priority AS v, row_number() OVER (ORDER BY priority) - 1 AS code
              FROM (SELECT DISTINCT priority FROM known) k)
        SELECT o_orderkey, coalesce(c.v, 'Unknown') AS customer,
               coalesce(p.v, 'Unknown') AS priority,
               CAST(coalesce(c.code, -1) AS INTEGER) AS customer_encoded,
               CAST(coalesce(p.code, -1) AS INTEGER) AS priority_encoded
        FROM orders LEFT JOIN c ON CAST(o_custkey AS VARCHAR) = c.v
                    LEFT JOIN p ON o_orderpriority = p.v""",
    "time_split": f"""WITH {W}, {ORDERED} SELECT {GRAIN}, ordinal,
        CASE WHEN ordinal <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split
        FROM ordered""",
    "time_split_numbered": f"""WITH {W}, {ORDERED} SELECT {GRAIN}, ordinal,
        CASE WHEN ordinal <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split
        FROM ordered""",
    "time_split_ties": f"""SELECT {day('l_shipdate')}, l_returnflag, split, count(*) AS lines FROM (
          SELECT l_shipdate, l_returnflag,
                 CASE WHEN row_number() OVER (ORDER BY l_shipdate, l_returnflag) <= floor(count(*) OVER () * 0.63)
                      THEN 'train' ELSE 'test' END AS split
          FROM lineitem) GROUP BY ALL""",
    "split_union": f"WITH {W}, {ORDERED} SELECT {GRAIN}, ordinal, quantity FROM ordered",
    "time_folds": f"""WITH {W}, {FOLDS.format(source='w')} SELECT {GRAIN}, ordinal, fold,
        CASE WHEN ordinal <= train_end THEN 'train' ELSE 'test' END AS part
        FROM folds WHERE ordinal <= train_end + z""",
    "time_folds_numbered": f"""WITH {W}, {FOLDS.format(source='w')} SELECT {GRAIN}, ordinal, fold,
        CASE WHEN ordinal <= train_end THEN 'train' ELSE 'test' END AS part
        FROM folds WHERE ordinal <= train_end + z""",
    "regression_metrics": f"""WITH {LAGGED}
        SELECT {error_measures('quantity', 'quantity_lag_1')} FROM lagged""",
    "regression_metrics_by_store": f"""WITH {LAGGED} SELECT internal_store_id,
        {error_measures('quantity', 'quantity_lag_1')} FROM lagged GROUP BY 1""",
    "fold_summary": f"""WITH {LAGGED}, {FOLDS.format(source='lagged')},
        m AS (SELECT fold, avg(abs(quantity - quantity_lag_1)) AS mae,
                     sqrt(avg((quantity - quantity_lag_1) * (quantity - quantity_lag_1))) AS rmse
              FROM folds WHERE ordinal > train_end AND ordinal <= train_end + z GROUP BY 1)
        SELECT round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse,
               round(stddev_pop(mae), 6) AS mae_std, round(stddev_pop(rmse), 6) AS rmse_std
        FROM m""",
    "horizon_features": f"""WITH {ROLLED}, {horizon(f'''SELECT semana, {GRAIN}, quantity,
        week_sin, week_cos, {', '.join(LAG_NAMES)}, quantity_roll_mean_4, quantity_roll_std_12
        FROM horizon''')}""",
    "stored_horizon": f"""WITH {ROLLED}, {horizon(f'''SELECT semana, {GRAIN}, quantity,
        week_sin, week_cos, {', '.join(LAG_NAMES)}, quantity_roll_mean_4, quantity_roll_std_12
        FROM horizon''')}""",
    "forecast_units": f"WITH {ROLLED}, {horizon(UNITS)}",
    "forecast_csv": f"WITH {ROLLED}, {horizon(UNITS)}",
    "run_summary": f"""WITH {ROLLED}, {horizon(f'''SELECT CAST(sum(quantidade) AS BIGINT)
        AS total_units, count(DISTINCT pdv) AS stores, count(DISTINCT produto) AS products
        FROM ({UNITS}) u''')}""",
    "forecast_inputs": f"""WITH {ROLLED}, {horizon(f'''SELECT {GRAIN}, {', '.join(LAG_NAMES)},
        quantity_roll_mean_4, quantity_roll_std_12, week_sin, week_cos FROM horizon''')}""",
    "forecast_coverage": f"""WITH {TX}, {ALL_KEPT},
        p AS (SELECT count(*) AS pairs FROM (SELECT DISTINCT {PAIR} FROM trimmed) d)
        SELECT CAST(semana AS INTEGER) AS semana, pairs AS forecasts, pairs, CAST(0 AS BIGINT) AS negative
        FROM p, range(1, 6) t(semana)""",
    "model_roundtrip": f"""WITH {TX}, {ALL_KEPT}
        SELECT 5 * count(*) AS forecasts, CAST(0 AS BIGINT) AS differing
        FROM (SELECT DISTINCT {PAIR} FROM trimmed) d""",
    "fold_sizes": f"""WITH {TX}, {ALL_KEPT}, {rollup('w', 'trimmed')},
        n AS (SELECT count(*) AS n, CAST(floor(count(*) * (1 - 0.2)) AS BIGINT) AS train FROM w)
        SELECT 'fold ' || j AS part, train // 6 AS n FROM n, range(5) t(j)
        UNION ALL SELECT 'test', n - train FROM n""",
    "importance_shape": "SELECT unnest([" + ", ".join(f"'{c}'" for c in MODEL_INPUTS) + """]) AS feature,
        CAST(1 AS DOUBLE) AS total""",
    "model_exact": """SELECT unnest(['catboost', 'random_forest']) AS kind, * FROM (
        SELECT l_returnflag AS flag, l_linenumber % 2 AS odd, round(avg(l_quantity), 6) AS prediction
        FROM lineitem GROUP BY ALL) m""",
    "importance_exact": """WITH cells AS (
          SELECT l_linestatus AS status, l_linenumber % 2 AS odd, l_quantity AS quantity FROM lineitem),
        explained AS (
          SELECT (SELECT sum(s * s / n) FROM (SELECT sum(quantity) AS s, count(*) AS n FROM cells GROUP BY status)) - a
                   AS by_status,
                 (SELECT sum(s * s / n) FROM (SELECT sum(quantity) AS s, count(*) AS n FROM cells GROUP BY odd)) - a
                   AS by_odd,
                 (SELECT sum(s * s / n) FROM (SELECT sum(quantity) AS s, count(*) AS n FROM cells GROUP BY status, odd)) - a
                   AS by_both
          FROM (SELECT sum(quantity) * sum(quantity) / count(*) AS a FROM cells)),
        share AS (
          SELECT CASE WHEN by_status > by_odd THEN by_status ELSE by_both - by_odd END / by_both AS status FROM explained)
        SELECT unnest(['catboost', 'random_forest']) AS kind, feature, round(importance, 4) + 0.0 AS importance FROM (
          SELECT 'status_code' AS feature, status AS importance FROM share
          UNION ALL SELECT 'odd', 1 - status FROM share)""",
    "fold_metrics_exact": f"""WITH cells AS (
          SELECT l_returnflag AS flag, l_linenumber % 2 AS odd, l_quantity AS quantity,
                 row_number() OVER (ORDER BY l_quantity, l_returnflag, l_linenumber % 2) AS ordinal,
                 CAST(floor(count(*) OVER () * 0.8) AS BIGINT) AS known FROM lineitem),
        parts AS (
          SELECT 'fold ' || j AS part, known - (5 - j) * (known // 6) AS train_end,
                 known - (4 - j) * (known // 6) AS test_end FROM (SELECT DISTINCT known FROM cells), range(5) t(j)
          UNION ALL SELECT 'test', known, 9223372036854775807 FROM (SELECT DISTINCT known FROM cells)),
        means AS (
          SELECT part, flag, odd, avg(quantity) AS prediction FROM cells JOIN parts ON ordinal <= train_end
          GROUP BY ALL),
        scored AS (
          SELECT part, quantity, prediction FROM cells JOIN parts ON ordinal > train_end AND ordinal <= test_end
          JOIN means USING (part, flag, odd))
        SELECT part, {error_measures('quantity', 'prediction')} FROM scored GROUP BY part""",
    "model_matrix": f"""WITH {FEATURES} SELECT
        row_number() OVER (ORDER BY year, week, {PAIR}) AS ordinal, quantity AS label,
        {', '.join(f'CAST({source} AS DOUBLE) AS {name}' for name, source in MODEL_INPUTS.items())}
        FROM features""",
    "trend_daily": f"WITH {TX}, {trend('tx', 'transaction_date', 'quantity', 'D', 6)}",
    "trend_weekly": f"WITH {TX}, {trend('tx', 'transaction_date', 'quantity', 'W', 6)}",
    "trend_monthly": f"WITH {TX}, {trend('tx', 'transaction_date', 'net_value', 'M', 4)}",
    "trend_event_days": f"WITH {trend('events', 'ts', 'value', 'D', 4)}",
    "top_categories": f"""WITH {TX}, {PRODUCTS} SELECT marca, round(coalesce(sum(quantity), 0), 6)
        AS total FROM products LEFT JOIN tx ON internal_product_id = produto
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "top_store_categories": f"""WITH {TX}, {STORES} SELECT categoria_pdv,
        round(coalesce(sum(net_value), 0), 4) AS total
        FROM stores LEFT JOIN tx ON internal_store_id = pdv
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "seasonality_weekday": seasonal("isodow(transaction_date) - 1", "dayname(transaction_date)"),
    "seasonality_week": seasonal("weekofyear(transaction_date)",
                                 "CAST(weekofyear(transaction_date) AS INTEGER)"),
    "seasonality_month": seasonal("month(transaction_date)", "monthname(transaction_date)"),
    "forecast_vs_actual": f"""WITH {LAGGED} SELECT year, week, {ACTUAL} AS actual,
        {PREDICTED} AS forecast FROM lagged GROUP BY 1, 2""",
    "forecast_vs_actual_by_store": f"""WITH {LAGGED},
        s AS (SELECT week, internal_store_id, {ACTUAL} AS actual, {PREDICTED} AS forecast
              FROM lagged GROUP BY 1, 2)
        SELECT week, internal_store_id, 'actual' AS kind, actual AS value FROM s
        UNION ALL SELECT week, internal_store_id, 'forecast', forecast FROM s""",
    "correlation": "WITH " + correlations(
        "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 0.001, 8),
    "correlation_weekly": f"WITH {LAGGED}, " + correlations(
        "lagged", [*MEASURES, "is_weekend", *LAG_NAMES], 0.1, 7),
    "correlation_features": f"WITH {FEATURES}, " + correlations("features", NUMBERS, 0.1, 6),
    "error_histogram": HISTOGRAM,
    "error_summary": f"""WITH {ERRORS} SELECT count(*) AS n, round(avg(error), 6) + 0.0
        AS mean_error, round(median(error), 6) + 0.0 AS median_error FROM errors""",
    "density": density("error"),
    "density_binned": density(
        "lo + (least(floor((error - lo) / ((hi - lo) / 512)), 511) + 0.5) * ((hi - lo) / 512)"),
    "decompose_yearly": f"""WITH {TX}, {decomposition(
        'tx', 'transaction_date', 'quantity', 365, 'additive')}""",
    "decompose_additive": f"""WITH {TX}, {decomposition(
        'tx', 'transaction_date', 'quantity', 52, 'additive')}""",
    "decompose_multiplicative": "WITH " + decomposition(
        "lineitem", "l_shipdate", "l_quantity", 7, "multiplicative"),
    "decompose_sparse": f"""WITH {SPARSE}, {decomposition(
        'tx', 'transaction_date', 'quantity', 14, 'additive', 'internal_product_id')}""",
    "decompose_by_store": f"""WITH {TX}, {decomposition(
        'tx', 'transaction_date', 'quantity', 7, 'additive', 'internal_store_id')}""",
}
