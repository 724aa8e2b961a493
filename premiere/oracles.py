"""The registered queries in plain SQL, written the direct way: joins on dates, no rewrites."""

from __future__ import annotations

from premiere.config import NUMERIC_FEATURES, TARGETS
from premiere.functions import risk, text
from premiere.functions.dates import WEEKDAYS
from premiere.operators import champion
from premiere.operators.analogs import WEIGHTED_OUTCOMES
from premiere.operators.transactions import MODEL_INPUTS
from premiere.sources.adapters import RENEWED_ABOVE_SIZE, TYPE_NOUNS


def _clean(x: str) -> str:
    return rf"trim(lower(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g')))"


def _category(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower(coalesce({x}, '')), '{p}') THEN '{n}'" for n, p in text.CATEGORY_RULES)
    return f"CASE {whens} ELSE '{text.OTHER_CATEGORY}' END"


_ACCESSORY = dict(text.CATEGORY_RULES)["accessory"]


def _accessory(title: str, category: str) -> str:
    return f"CAST({category} = 'accessory' OR coalesce(regexp_matches(lower({title}), '{_ACCESSORY}'), false) AS INTEGER)"


def _refurbished(title: str) -> str:
    return f"CAST(coalesce(regexp_matches({title}, '{text.REFURBISHED_PATTERN}'), false) AS INTEGER)"


_DIGITS = {"unit_price": 9, "launch_price": 9, "analog_demand_dispersion": 4}


def _r(x: str, name: str, digits: int = 6) -> str:
    digits = _DIGITS.get(name, digits) if digits == 6 else digits
    return f"round(CAST({x} AS DOUBLE), {digits}) + 0.0::DOUBLE AS {name}"


_NOUN = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_NOUNS.items()) + " END"

_LINE_REST = "order_ts, order_date, product_name, brand, functional_category"

# Whole months between two dates; a part month counts days / 31, month ends match month ends.
_MONTHS = "((year(d) - year(l)) * 12 + month(d) - month(l))"
_MONTH_INDEX = f"""CAST(CASE WHEN day(d) = day(l) OR (d = last_day(d) AND l = last_day(l)) THEN {_MONTHS}
    ELSE floor(round({_MONTHS} + (day(d) - day(l)) / 31.0::DOUBLE, 8)) END AS INTEGER) + 1"""

_MERCHANTS = "CASE k % 9 " + " ".join(f"WHEN {c} THEN '{m}'" for m, c in risk.MERCHANT_CODES.items()) + " ELSE 'kiosk' END"
_CODES = "CASE merchant_type " + " ".join(f"WHEN '{m}' THEN {c}" for m, c in risk.MERCHANT_CODES.items())
_CODES += f" ELSE {risk.UNKNOWN_MERCHANT} END"


def _position(keys: str, seed: int, key: str) -> str:
    over = f"PARTITION BY {keys} " if keys else ""
    return f"row_number() OVER ({over}ORDER BY md5(concat('{seed}|', {key})))"


def _standing(query: str) -> str:
    """Earlier-launch figures as a left join of each query with every earlier launch."""
    return f"""
        SELECT q.product_id, any_value(q.launch_price) AS price,
          CAST(coalesce(count(*) FILTER (h.brand = q.brand), 0) AS BIGINT) AS brand_historical_launch_count,
          avg(h.qty_90d) FILTER (h.brand = q.brand) AS brand_avg_first_90d_qty,
          CAST(coalesce(count(*) FILTER (h.functional_category = q.functional_category), 0) AS BIGINT)
            AS category_historical_launch_count,
          avg(h.qty_90d) FILTER (h.functional_category = q.functional_category) AS category_avg_first_90d_qty,
          quantile_disc(h.launch_price, 0.5) FILTER (h.functional_category = q.functional_category) AS cm,
          quantile_disc(h.launch_price, 0.5) FILTER (h.brand = q.brand) AS bm,
          avg(CASE WHEN h.functional_category = q.functional_category AND h.launch_price <= q.launch_price
              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS category_price_percentile
        FROM {query} q LEFT JOIN history h ON h.launch_date < q.launch_date AND h.m3_qty IS NOT NULL
        GROUP BY q.product_id"""


def _demand(query: str) -> str:
    return f"""
        SELECT q.product_id,
          coalesce(sum(f.quantity) FILTER (f.order_date >= q.launch_date - 90), 0.0::DOUBLE) AS recent,
          coalesce(sum(f.quantity) FILTER (f.order_date < q.launch_date - 90), 0.0::DOUBLE) AS prev,
          coalesce(sum(f.quantity) FILTER (month(f.order_date) = month(q.launch_date)), 0.0::DOUBLE) AS same,
          sum(f.quantity) AS total
        FROM {query} q LEFT JOIN daily f ON f.functional_category = q.functional_category
          AND f.order_date < q.launch_date AND f.order_date >= q.launch_date - 365
        GROUP BY q.product_id"""


def _customers(query: str) -> str:
    return f"""
        SELECT q.product_id, CAST(count(DISTINCT c.customer_id) AS BIGINT) AS eligible_customer_count
        FROM {query} q LEFT JOIN (
          SELECT q.product_id, f.customer_id FROM {query} q
            JOIN fact f ON f.brand = q.brand AND f.order_date < q.launch_date
          UNION
          SELECT q.product_id, f.customer_id FROM {query} q
            JOIN fact f ON f.functional_category = q.functional_category AND f.order_date < q.launch_date
        ) c ON c.product_id = q.product_id
        GROUP BY q.product_id"""


def _ranked(query: str, available: str = "h.launch_date < q.launch_date") -> str:
    return f"""
        SELECT q.product_id, q.brand AS q_brand, q.functional_category AS q_category, h.*
          EXCLUDE (product_id), h.product_id AS aid, s.s AS similarity,
          CAST(row_number() OVER (PARTITION BY q.product_id ORDER BY s.s DESC, h.product_id) AS INTEGER) AS rank
        FROM {query} q JOIN history h ON {available} AND h.m3_qty IS NOT NULL
          JOIN product_vector qv ON qv.product_id = q.product_id
          JOIN product_vector hv ON hv.product_id = h.product_id
          JOIN vector_similarity s ON s.a = qv.vec_id AND s.b = hv.vec_id
        QUALIFY rank <= 5"""


def _analog(ranked: str) -> str:
    weighted = ", ".join(f"sum(w * {c}) / sum(w) AS {n}" for n, c in WEIGHTED_OUTCOMES.items())
    return f"""
        SELECT product_id, max(similarity) AS top1_similarity, avg(similarity) AS top5_mean_similarity,
          avg(CAST(q_brand = brand AS DOUBLE)) AS top5_same_brand_share,
          avg(CAST(q_category = functional_category AS DOUBLE)) AS top5_same_category_share,
          {weighted},
          sqrt(greatest(sum(w * qty_90d * qty_90d) / sum(w) - (sum(w * qty_90d) / sum(w)) ** 2, 0.0::DOUBLE))
            AS analog_demand_dispersion
        FROM (SELECT *, exp(10.0::DOUBLE * similarity) AS w FROM {ranked}) GROUP BY product_id"""


_STANDING_COLUMNS = {
    "price_to_category_median": "price / greatest(cm, 1.0::DOUBLE)",
    "price_to_brand_median": "price / greatest(bm, 1.0::DOUBLE)",
    "category_price_percentile": "category_price_percentile",
    "brand_historical_launch_count": "brand_historical_launch_count",
    "brand_avg_first_90d_qty": "brand_avg_first_90d_qty",
    "category_historical_launch_count": "category_historical_launch_count",
    "category_avg_first_90d_qty": "category_avg_first_90d_qty",
}
_DEMAND_COLUMNS = {
    "category_recent_demand": "recent",
    "category_demand_trend": "(recent + 1) / (prev + 1)",
    "category_launch_month_index": "same / greatest(total / 12, 1.0::DOUBLE)",
}
_COUNTS = ("brand_historical_launch_count", "category_historical_launch_count")
_ANALOG_COLUMNS = (
    "top1_similarity",
    "top5_mean_similarity",
    "top5_same_brand_share",
    "top5_same_category_share",
    *WEIGHTED_OUTCOMES,
    "analog_demand_dispersion",
)


def _shown(columns: dict[str, str]) -> str:
    return ", ".join(f"{x} AS {n}" if n in _COUNTS else _r(x, n) for n, x in columns.items())


def _numeric(q: str) -> dict[str, str]:
    """Where each numeric feature comes from once the parts are joined."""
    return {
        "log_launch_price": f"ln(1 + greatest({q}.launch_price, 0.0::DOUBLE))",
        "launch_month_sin": f"sin(2 * pi() * month({q}.launch_date) / 12)",
        "launch_month_cos": f"cos(2 * pi() * month({q}.launch_date) / 12)",
        "accessory_flag": f"{q}.accessory_flag",
        "refurbished_flag": f"{q}.refurbished_flag",
        "eligible_customer_count": "e.eligible_customer_count",
        **{n: f"a.{n}" for n in _ANALOG_COLUMNS},
        **_STANDING_COLUMNS,
        **_DEMAND_COLUMNS,
    }


_RAW_NUMERIC = _numeric("q")
_SHARED = {"category_price_percentile", *_COUNTS, "brand_avg_first_90d_qty", "category_avg_first_90d_qty"}
_JOINED_NUMERIC = {n: f"p.{x}" if n in _SHARED else x for n, x in _RAW_NUMERIC.items()}

# Named parts; each may use those before it.
CTES: dict[str, str] = {
    "products": f"""
        SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id, p_brand, p_retailprice AS list_price,
          concat_ws(' ', p_brand, p_name, {_NOUN},
            CASE WHEN p_size > {RENEWED_ABOVE_SIZE} THEN 'Renewed' END) AS title
        FROM part""",
    "flat": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
          CAST(o_orderdate AS TIMESTAMP) AS order_ts, CAST(o_orderdate AS DATE) AS order_date,
          product_id, title, p_brand, {_clean("title")} AS product_name,
          split_part({_clean("title")}, ' ', 1) AS brand, {_category("title")} AS functional_category,
          l_extendedprice / l_quantity AS unit_price, l_quantity AS quantity,
          CAST(l_discount > 0 AS INTEGER) AS promotion_flag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN products ON l_partkey = p_partkey""",
    "fact": f"""
        SELECT order_id, customer_id, {_LINE_REST}, product_id, unit_price, quantity,
          min(promotion_flag) AS promotion_flag
        FROM flat GROUP BY order_id, customer_id, {_LINE_REST}, product_id, unit_price, quantity""",
    "sales_hashed": f"""
        SELECT sha256(concat_ws('||', customer_id, strftime(order_date, '%Y-%m-%d'), product_id)) AS order_id,
          customer_id, CAST(order_date AS TIMESTAMP) AS order_ts, order_date, product_id, product_name,
          {_clean("p_brand")} AS brand, functional_category, unit_price, quantity
        FROM flat""",
    "sales_fact": """
        SELECT * FROM sales_hashed QUALIFY row_number() OVER (
          PARTITION BY order_id, product_id ORDER BY customer_id, order_ts, unit_price, quantity) = 1""",
    "launch": "SELECT product_id, min(order_date) AS launch_date FROM fact GROUP BY product_id",
    "early": f"""
        SELECT *, {_MONTH_INDEX} AS m
        FROM (SELECT f.*, launch_date, order_date AS d, launch_date AS l FROM fact f JOIN launch USING (product_id))""",
    "outcome": """
        SELECT product_id, launch_date, sum(CASE WHEN m = 1 THEN quantity ELSE 0.0::DOUBLE END) AS m1_qty,
          sum(CASE WHEN m = 2 THEN quantity ELSE 0.0::DOUBLE END) AS m2_qty,
          sum(CASE WHEN m = 3 THEN quantity ELSE 0.0::DOUBLE END) AS m3_qty,
          sum(quantity) AS qty_90d, count(DISTINCT customer_id) AS customers_90d,
          count(DISTINCT order_id) AS orders_90d,
          sum(quantity) / greatest(count(DISTINCT order_id), 1) AS avg_order_qty_90d
        FROM early WHERE m BETWEEN 1 AND 3 GROUP BY product_id, launch_date""",
    "profile": f"""
        SELECT *, {_refurbished("product_name")} AS refurbished_flag,
          {_accessory("product_name", "functional_category")} AS accessory_flag
        FROM (SELECT product_id, min(order_date) AS launch_date,
            arg_min(product_name, (order_ts, order_id)) AS product_name, arg_min(brand, (order_ts, order_id)) AS brand,
            arg_min(functional_category, (order_ts, order_id)) AS functional_category,
            quantile_disc(unit_price, 0.5) AS launch_price
          FROM fact GROUP BY product_id)""",
    "history": """
        SELECT p.*, o.* EXCLUDE (product_id, launch_date)
        FROM profile p LEFT JOIN outcome o ON o.product_id = p.product_id AND o.launch_date = p.launch_date""",
    "daily": """
        SELECT functional_category, order_date, sum(quantity) AS quantity
        FROM fact GROUP BY functional_category, order_date""",
    "product_vector": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_partkey % (SELECT count(*) FROM embeddings) AS vec_id
        FROM part""",
    "vector": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "vector_similarity": """
        SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v)
          / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 9) AS s
        FROM vector a, vector b""",
    "ranked": _ranked("history"),
    "analog": _analog("ranked"),
    "standing": _standing("history"),
    "demand": _demand("history"),
    "customers": _customers("history"),
    "features": f"""
        SELECT q.product_id, q.product_name, q.launch_date, q.launch_price, q.brand, q.functional_category,
          {", ".join(f"coalesce(CAST({_JOINED_NUMERIC[n]} AS DOUBLE), 0.0::DOUBLE) AS {n}" for n in NUMERIC_FEATURES)},
          q.m1_qty AS target_m1_qty, q.m2_qty AS target_m2_qty, q.m3_qty AS target_m3_qty
        FROM history q LEFT JOIN analog a USING (product_id) LEFT JOIN standing p USING (product_id)
          LEFT JOIN demand d USING (product_id) LEFT JOIN customers e USING (product_id)
        WHERE q.m3_qty IS NOT NULL""",
    "announced": f"""
        SELECT product_id, {_clean("title")} AS product_name, launch_date, list_price AS launch_price,
          CASE WHEN p_partkey % 2 = 0 THEN {_clean("p_brand")} ELSE split_part({_clean("title")}, ' ', 1) END AS brand,
          {_category(_clean("title"))} AS functional_category, {_refurbished(_clean("title"))} AS refurbished_flag,
          {_accessory(_clean("title"), _category(_clean("title")))} AS accessory_flag
        FROM products JOIN (SELECT l_partkey, CAST(min(o_orderdate) AS DATE) AS launch_date
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey) ON l_partkey = p_partkey""",
    "new_ranked": _ranked("announced"),
    "new_analog": _analog("new_ranked"),
    "new_standing": _standing("announced"),
    "new_demand": _demand("announced"),
    "new_customers": _customers("announced"),
    "day_split": """
        SELECT launch_date, CASE WHEN r < 0.70::DOUBLE THEN 'train' WHEN r < 0.70::DOUBLE + 0.15::DOUBLE
          THEN 'validation' ELSE 'test' END AS dataset_split
        FROM (SELECT launch_date, percent_rank() OVER (ORDER BY launch_date) AS r
          FROM (SELECT DISTINCT launch_date FROM history))""",
    "split_features": "SELECT * FROM features JOIN day_split USING (launch_date)",
    "stats": " UNION ALL ".join(
        f"SELECT '{n}' AS feature, coalesce(avg({n}), 0.0::DOUBLE) AS mean, "
        f"greatest(stddev_pop({n}), 1e-6::DOUBLE) AS std FROM split_features WHERE dataset_split = 'train'"
        for n in NUMERIC_FEATURES
    ),
    "event_rows": """
        SELECT *, CAST(round(value * 100) AS BIGINT) AS cents, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "running": """
        SELECT *, count(*) OVER before AS previous, CAST(sum(cents) OVER before AS BIGINT) AS spent FROM event_rows
        WINDOW before AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "unlabelled": f"""
        SELECT concat('TXN', CASE WHEN event_id >= 100000 THEN CAST(event_id AS VARCHAR)
            ELSE lpad(CAST(event_id AS VARCHAR), 5, '0') END) AS transaction_id,
          value AS amount, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
          {_MERCHANTS} AS merchant_type, CAST(18 + user_id % 63 AS INTEGER) AS customer_age,
          CAST(previous AS INTEGER) AS num_prev_txns, coalesce((spent // nullif(previous, 0)) / 100.0::DOUBLE, 0.0::DOUBLE) AS avg_txn_amount,
          event_type
        FROM running""",
    "txn": """
        SELECT * EXCLUDE (event_type), CAST(amount > 3 * avg_txn_amount
          OR (event_type = 'error' AND (hour >= 22 OR hour <= 5)) AS INTEGER) AS is_fraud FROM unlabelled""",
    "encoded": f"""
        SELECT * REPLACE ({_CODES} AS merchant_type), merchant_type AS merchant_name,
          CAST(hour >= 22 OR hour <= 5 AS INTEGER) AS is_night, CAST(day_of_week >= 5 AS INTEGER) AS is_weekend,
          round(amount / (avg_txn_amount + 1), 2) AS amount_vs_avg, round(ln(1 + amount), 4) AS amount_log
        FROM txn""",
    "scored": """
        SELECT *, CAST(p >= 0.5 AS INTEGER) AS predicted
        FROM (SELECT *, (1000 * a // (a + m + 100)) / 1000.0::DOUBLE AS p
          FROM (SELECT *, CAST(round(amount * 100) AS BIGINT) AS a,
            CAST(round(avg_txn_amount * 100) AS BIGINT) AS m FROM txn))""",
    "confusion": """
        SELECT CAST(count(*) FILTER (is_fraud = 1 AND predicted = 1) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (is_fraud = 0 AND predicted = 1) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (is_fraud = 1 AND predicted = 0) AS DOUBLE) AS fn,
          CAST(count(*) FILTER (is_fraud = 0 AND predicted = 0) AS DOUBLE) AS tn FROM scored""",
    "forecast": """
        SELECT product_id, strftime(launch_date, '%Y-%m') AS run_id, unnest([
          {'horizon': 'm1', 'e': qty_90d / 3 - m1_qty, 'y': m1_qty},
          {'horizon': 'm2', 'e': m1_qty - m2_qty, 'y': m2_qty},
          {'horizon': 'm3', 'e': m2_qty - m3_qty, 'y': m3_qty},
          {'horizon': 'three_month', 'e': qty_90d / 3 + m1_qty + m2_qty - (m1_qty + m2_qty + m3_qty),
           'y': m1_qty + m2_qty + m3_qty}], recursive := true)
        FROM history WHERE m3_qty IS NOT NULL""",
    "runs": """
        SELECT run_id, CAST(concat(run_id, '-01') AS TIMESTAMP) AS evaluated_at,
          'test_three_month_wape' AS selection_metric,
          sum(abs(e)) / greatest(sum(abs(y)), 1e-9::DOUBLE) AS selection_metric_value
        FROM forecast WHERE horizon = 'three_month' GROUP BY run_id""",
}


def _with(final: str, *needed: str) -> str:
    """Only the parts the query needs, in order."""
    names = list(CTES)
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name in wanted:
            return
        for other in names[: names.index(name)]:
            if f" {other} " in f" {' '.join(CTES[name].replace('(', ' ').replace(')', ' ').replace(',', ' ').split())} ":
                add(other)
        wanted.add(name)

    for n in needed:
        add(n)
    # Written once, read often: keep DuckDB from computing a part again per use.
    parts = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in names if n in wanted)
    return f"WITH {parts}\n{final}"


def _lines(source: str, flag: str, label: str) -> str:
    return f"""
        SELECT order_id, customer_id, order_ts, order_date, product_id, product_name, brand, functional_category,
          {_r("unit_price", "unit_price")}, {_r("quantity", "quantity")}, 'USD' AS currency, 'ea' AS unit,
          {flag} AS promotion_flag, 0.0::DOUBLE AS promotion_discount, '{label}' AS source
        FROM {source}"""


_ROUNDED_HISTORY = f"""
    SELECT product_id, launch_date, product_name, brand, functional_category, {_r("launch_price", "launch_price")},
      refurbished_flag, accessory_flag, m1_qty, m2_qty, m3_qty, qty_90d, customers_90d, orders_90d,
      {_r("avg_order_qty_90d", "avg_order_qty_90d")}
    FROM history"""

_RANKED_OUT = f"""
    SELECT product_id, rank, aid, product_name AS aname, {_r("similarity", "similarity")}, launch_date AS ad,
      m1_qty, m2_qty, m3_qty
    FROM ranked"""

_PIT = f"""
    SELECT product_id, {_shown(_STANDING_COLUMNS)}, {_shown(_DEMAND_COLUMNS)}, eligible_customer_count
    FROM standing JOIN demand USING (product_id) JOIN customers USING (product_id)"""

_NEW_FEATURES = f"""
    SELECT q.product_id, q.product_name, q.launch_date, {_r("q.launch_price", "launch_price")}, q.brand,
      q.functional_category, {", ".join(_r(_JOINED_NUMERIC[n], n) for n in NUMERIC_FEATURES)}
    FROM announced q LEFT JOIN new_analog a USING (product_id) LEFT JOIN new_standing p USING (product_id)
      LEFT JOIN new_demand d USING (product_id) LEFT JOIN new_customers e USING (product_id)"""

_FEATURES_OUT = f"""
    SELECT product_id, product_name, launch_date, {_r("launch_price", "launch_price")}, brand, functional_category,
      {", ".join(_r(n, n) for n in (*NUMERIC_FEATURES, *TARGETS))}
    FROM features"""

_SCALED = ", ".join(
    _r(
        f"(f.{n} - (SELECT mean FROM stats WHERE feature = '{n}')) / (SELECT std FROM stats WHERE feature = '{n}')",
        n,
        4,
    )
    for n in NUMERIC_FEATURES
)
_LOGGED = ", ".join(_r(f"ln(1 + greatest(f.{t}, 0.0::DOUBLE))", f"log_{t}", 4) for t in TARGETS)

_TEXTS = """
    SELECT concat('d', doc_id) AS id, text AS title FROM documents
    UNION ALL SELECT concat('p', page_id), url FROM pages
    UNION ALL SELECT concat('t', product_id), title FROM products"""

_LIMIT_CHECKS = ", ".join(
    f"CASE WHEN coalesce({c} BETWEEN {low} AND {high}, false) THEN NULL ELSE '{c}' END"
    for c, (low, high) in risk.LIMITS.items()
)
_KNOWN = ", ".join(f"'{m}'" for m in risk.MERCHANT_CODES)
_FAILED = f"concat_ws(',', {_LIMIT_CHECKS}, CASE WHEN merchant_type IN ({_KNOWN}) THEN NULL ELSE 'merchant_type' END)"

_RISKY = ", ".join(f"'{m}'" for m in risk.RISKY_MERCHANTS)
_REASONS = f"""concat_ws('; ',
    CASE WHEN is_night = 1 THEN '{risk.NIGHT_REASON}' END, CASE WHEN is_weekend = 1 THEN '{risk.WEEKEND_REASON}' END,
    CASE WHEN amount_vs_avg > 5
      THEN replace('{risk.AMOUNT_REASON}', '%s', CAST(amount_vs_avg AS VARCHAR)) END,
    CASE WHEN num_prev_txns < 5 THEN '{risk.NEWCOMER_REASON}' END,
    CASE WHEN merchant_name IN ({_RISKY}) THEN replace('{risk.MERCHANT_REASON}', '%s',
      concat(upper(merchant_name[1]), merchant_name[2:])) END)"""
_DAY_NAMES = "[" + ", ".join(f"'{d}'" for d in WEEKDAYS) + "]"


def _ratio(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif({b}, 0), 0.0::DOUBLE)"


def _class_measures(hit: str, wrong: str, missed: str) -> dict[str, str]:
    return {
        "precision": _ratio(hit, f"{hit} + {wrong}"),
        "recall": _ratio(hit, f"{hit} + {missed}"),
        "f1": _ratio(f"2 * {hit}", f"2 * {hit} + {wrong} + {missed}"),
    }


def _report() -> str:
    legit, fraud = _class_measures("tn", "fn", "fp"), _class_measures("tp", "fp", "fn")
    total = "(tp + fp + fn + tn)"
    accuracy = _ratio("tp + tn", total)
    rows = [
        ("Legitimate", legit, "tn + fp"),
        ("Fraud", fraud, "tp + fn"),
        ("accuracy", dict.fromkeys(legit, accuracy), total),
        ("macro avg", {m: f"({legit[m]} + {fraud[m]}) / 2" for m in legit}, total),
        (
            "weighted avg",
            {m: _ratio(f"{legit[m]} * (tn + fp) + {fraud[m]} * (tp + fn)", total) for m in legit},
            total,
        ),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS class, {', '.join(_r(x, m) for m, x in values.items())}, "
        f"CAST({support} AS BIGINT) AS support FROM confusion"
        for name, values, support in rows
    )


_TEST_ROW = "row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat('42|', transaction_id)))"
_CLASS_SIZE = "count(*) OVER (PARTITION BY is_fraud)"

def _champions(lower: bool) -> str:
    better, best, gain = ("<", "min", "old - value") if lower else (">", "max", "value - old")
    return f"""
    SELECT run_id, evaluated_at, selection_metric, {_r("value", "selection_metric_value")},
      {_r("old", "champion_metric")}, coalesce(value {better} old, old IS NULL) AS promoted, {_r("gain", "improvement_pct")},
      CASE WHEN met = 0 THEN '{champion.FIRST_REASON}' WHEN old IS NULL THEN '{champion.UNMEASURED_REASON}'
        WHEN abs(gain) < {champion.EQUAL_BAND_PCT}
          THEN printf('{champion.EQUAL_REASON.replace("%s", "%+.2f")}', gain)
        WHEN value {better} old THEN printf('{champion.BETTER_REASON.replace("%s", "%.2f")}', abs(gain))
        ELSE printf('{champion.WORSE_REASON.replace("%s", "%.2f")}', abs(gain)) END AS reason, {lower} AS lower_is_better
    FROM (SELECT *, ({gain}) / nullif(old, 0) * 100 AS gain FROM (
      SELECT *, selection_metric_value AS value, {best}(selection_metric_value) OVER earlier AS old,
        count(*) OVER earlier AS met
      FROM (SELECT * FROM runs
        UNION ALL SELECT * REPLACE ('negated' AS selection_metric, -selection_metric_value AS selection_metric_value) FROM runs)
      WINDOW earlier AS (PARTITION BY selection_metric ORDER BY evaluated_at, run_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""


_VOCABULARIES = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS id
    FROM (SELECT DISTINCT {c} AS value FROM history JOIN day_split USING (launch_date)
      WHERE dataset_split = 'train' AND {c} IS NOT NULL)"""
    for c in ("brand", "functional_category")
)


_SCORE_FACTS = "true AS is_verdict, true AS is_confidence, true AS level_agrees"


def oracle_sql() -> dict[str, str]:
    return {
        "launch_month_demand": _with(
            f"SELECT product_id, launch_date, m1_qty, m2_qty, m3_qty, qty_90d, customers_90d, orders_90d, "
            f"{_r('avg_order_qty_90d', 'avg_order_qty_90d')} FROM outcome",
            "outcome",
        ),
        "order_lines_from_orders": _with(_lines("fact", "promotion_flag", "sales_order"), "fact"),
        "order_lines_from_sales": _with(_lines("sales_fact", "0", "sales"), "sales_fact"),
        "order_lines_union": _with(
            _lines("fact", "promotion_flag", "sales_order") + " UNION ALL " + _lines("sales_fact", "0", "sales"),
            "fact",
            "sales_fact",
        ),
        "transactions_csv": _with("SELECT * FROM txn", "txn"),
        "split_tables": _with(
            """SELECT dataset_split, count(*) AS products, min(launch_date) AS first_launch,
              max(launch_date) AS last_launch, sum(qty_90d) AS units
            FROM history JOIN day_split USING (launch_date) GROUP BY dataset_split""",
            "history",
            "day_split",
        ),
        "appended_evaluations": _with(
            f"""SELECT run_id, CASE WHEN run_id >= '1996' THEN selection_metric END AS selection_metric,
              {_r("selection_metric_value", "selection_metric_value")} FROM runs""",
            "runs",
        ),
        "title_features": _with(
            f"""SELECT id, md5(c) AS clean_md5, split_part(c, ' ', 1) AS brand,
              CASE WHEN length(title) % 2 = 0 THEN 'own brand' ELSE split_part(c, ' ', 1) END AS known_brand,
              category AS functional_category, {_accessory("c", "category")} AS accessory_flag,
              {_refurbished("c")} AS refurbished_flag
            FROM (SELECT id, title, {_clean("title")} AS c, {_category("title")} AS category FROM ({_TEXTS}))""",
            "products",
        ),
        "vector_expressions": _with(
            f"""SELECT vec_id, {_r("sqrt(list_dot_product(v, v))", "length")}, 1.0::DOUBLE AS unit_length,
              {_r("list_dot_product(v, list_reverse(v)) / list_dot_product(v, v)", "mirror_cosine")},
              0.0::DOUBLE AS zero_cosine, CAST(NULL AS DOUBLE) AS missing_cosine FROM vector""",
            "vector",
        ),
        "target_transform": _with(
            f"""SELECT product_id, {_r("ln(1 + greatest(qty_90d - 40, 0.0::DOUBLE))", "log_target")},
              {_r("greatest(qty_90d, 0.0::DOUBLE)", "restored")}, 0.0::DOUBLE AS floored FROM history""",
            "history",
        ),
        "product_history": _with(_ROUNDED_HISTORY, "history"),
        "similar_products_topk": _with(_RANKED_OUT, "ranked"),
        "matured_similar_products": _with(
            f"""SELECT product_id, rank, aid AS analog_id, {_r("similarity", "similarity")}
            FROM ({_ranked("history", "h.launch_date + INTERVAL 3 MONTH <= q.launch_date")})""",
            "history",
            "product_vector",
            "vector_similarity",
        ),
        "analog_features": _with(
            f"SELECT product_id, {', '.join(_r(n, n) for n in _ANALOG_COLUMNS)} FROM analog", "analog"
        ),
        "earlier_launch_stats": _with(f"SELECT product_id, {_shown(_STANDING_COLUMNS)} FROM standing", "standing"),
        "category_demand": _with(f"SELECT product_id, {_shown(_DEMAND_COLUMNS)} FROM demand", "demand"),
        "eligible_customers": _with("SELECT * FROM customers", "customers"),
        "point_in_time_features": _with(_PIT, "standing", "demand", "customers"),
        "feature_matrix": _with(_FEATURES_OUT, "features"),
        "new_product_features": _with(
            _NEW_FEATURES, "announced", "new_analog", "new_standing", "new_demand", "new_customers"
        ),
        "chronological_split": _with(
            "SELECT product_id, launch_date, dataset_split FROM history JOIN day_split USING (launch_date)",
            "history",
            "day_split",
        ),
        "scaler_stats": _with(f"SELECT feature, {_r('mean', 'mean')}, {_r('std', 'std')} FROM stats", "stats"),
        "standardised_features": _with(
            f"SELECT f.product_id, {_SCALED}, {_LOGGED} FROM split_features f", "split_features", "stats"
        ),
        "category_vocabulary": _with(_VOCABULARIES, "history", "day_split"),
        "encoded_categories": _with(
            f"""SELECT product_id, brand, functional_category, coalesce(b.id, 0) AS brand_id,
              coalesce(c.id, 0) AS functional_category_id
            FROM history h LEFT JOIN ({_VOCABULARIES}) b ON b.feature = 'brand' AND b.value = brand
              LEFT JOIN ({_VOCABULARIES}) c ON c.feature = 'functional_category' AND c.value = functional_category
            WHERE m3_qty IS NOT NULL""",
            "history",
            "day_split",
        ),
        "transaction_features": _with(
            f"""SELECT transaction_id, {", ".join(f"{c} + 0.0::DOUBLE AS {c}" if c in
                ("amount", "avg_txn_amount", "amount_vs_avg", "amount_log") else c for c in MODEL_INPUTS)}, is_fraud
            FROM encoded""",
            "encoded",
        ),
        "transaction_profile": _with(
            f"""SELECT count(*) AS row_count, 9 AS column_count, CAST(sum(is_fraud) AS BIGINT) AS positive_count,
              {_r("avg(is_fraud)", "positive_rate")} FROM txn""",
            "txn",
        ),
        "transaction_validation": _with(
            f"SELECT transaction_id, {_FAILED} = '' AS is_valid, {_FAILED} AS failed FROM txn", "txn"
        ),
        "transaction_reasons": _with(
            f"""SELECT transaction_id, CASE WHEN hour < 5 OR hour >= 22 THEN 'late night'
                WHEN hour >= 8 AND hour < 20 THEN 'daytime' ELSE 'evening' END AS part_of_day,
              {_DAY_NAMES}[day_of_week + 1] AS weekday,
              CASE WHEN amount_vs_avg > 5 THEN 'HIGH' ELSE 'NORMAL' END AS amount_level,
              coalesce(nullif({_REASONS}, ''), '{risk.NO_REASON}') AS reasons
            FROM encoded""",
            "encoded",
        ),
        "transaction_risk": _with(
            """SELECT transaction_id, CASE WHEN predicted = 1 THEN 'FRAUD' ELSE 'LEGITIMATE' END AS prediction,
              round(p * 100, 1) AS confidence,
              CASE WHEN p >= 0.70 THEN 'HIGH' WHEN p >= 0.40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
            FROM scored""",
            "scored",
        ),
        "stratified_split": _with(
            f"""SELECT transaction_id, is_fraud,
              CASE WHEN {_TEST_ROW} <= {_CLASS_SIZE} - round({_CLASS_SIZE} * 0.2::DOUBLE) THEN 'train'
                ELSE 'test' END AS dataset_split
            FROM txn""",
            "txn",
        ),
        "seeded_shuffle": _with(
            f"SELECT transaction_id, is_fraud, {_position('', 42, 'transaction_id')} AS position FROM txn", "txn"
        ),
        "sample_rows": _with(
            f"""SELECT product_id, product_name, {_position('', 42, 'product_id')} AS position
            FROM history JOIN day_split USING (launch_date) WHERE dataset_split = 'train'
            ORDER BY position LIMIT 5""",
            "history",
            "day_split",
        ),
        "forecast_metrics": _with(
            " UNION ALL ".join(
                f"SELECT concat('test_', horizon, '_{n}') AS metric, {_r(x, 'value')} FROM forecast GROUP BY horizon"
                for n, x in (
                    ("mae", "avg(abs(e))"),
                    ("rmse", "sqrt(avg(e * e))"),
                    ("wape", "sum(abs(e)) / greatest(sum(abs(y)), 1e-9::DOUBLE)"),
                )
            ),
            "forecast",
        ),
        "evaluation_log": _with(
            f"""SELECT half AS run_id, 'test_three_month_wape' AS selection_metric,
                {_r("max(wape) FILTER (horizon = 'three_month') OVER (PARTITION BY half)", "selection_metric_value")}, horizon,
                {_r("mae", "mae")}, {_r("rmse", "rmse")}, {_r("wape", "wape")}
            FROM (SELECT CASE WHEN run_id < '1996' THEN 'early' ELSE 'late' END AS half, horizon,
                    avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, sum(abs(e)) / greatest(sum(abs(y)), 1e-9::DOUBLE) AS wape
                  FROM forecast GROUP BY ALL)""",
            "forecast",
        ),
        "champion_history": _with(_champions(True) + " UNION ALL " + _champions(False), "runs"),
        "latest_evaluation": _with(
            f"""SELECT run_id, evaluated_at, selection_metric, {_r("selection_metric_value", "selection_metric_value")}
            FROM runs ORDER BY evaluated_at DESC, run_id DESC LIMIT 1""",
            "runs",
        ),
        "class_report": _with(_report(), "confusion"),
        "classifier_summary": _with(
            "SELECT {}, {} FROM confusion".format(
                _r(_ratio("tp + tn", "tp + fp + fn + tn"), "accuracy"),
                ", ".join(_r(x, m) for m, x in _class_measures("tp", "fp", "fn").items()),
            ),
            "confusion",
        ),
        "roc_auc": _with(
            f"""SELECT {_r("(sum(r) FILTER (is_fraud = 1) - np * (np + 1) / 2) / (np * nn)", "roc_auc")}
            FROM (SELECT is_fraud, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r,
                CAST(sum(is_fraud) OVER () AS DOUBLE) AS np, CAST(sum(1 - is_fraud) OVER () AS DOUBLE) AS nn
              FROM scored) GROUP BY np, nn""",
            "scored",
        ),
        "title_vectors": _with(
            r"""SELECT product_id, 64 AS dimensions, CASE WHEN regexp_matches(title, '\w') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
              AS length, true AS is_vector FROM products""",
            "products",
        ),
        "fraud_scores": _with(
            f"""SELECT transaction_id, is_fraud, coalesce(nullif({_REASONS}, ''), '{risk.NO_REASON}') AS reasons, {_SCORE_FACTS}
            FROM (SELECT *, {_TEST_ROW} > {_CLASS_SIZE} - round({_CLASS_SIZE} * 0.2::DOUBLE) AS is_test FROM encoded)
            WHERE is_test""",
            "encoded",
        ),
        "stream_transaction_scores": _with(
            f"""SELECT transaction_id, coalesce(nullif({_REASONS}, ''), '{risk.NO_REASON}') AS reasons, {_SCORE_FACTS}
            FROM encoded""",
            "encoded",
        ),
        "risk_model_quality": _with(
            f"""SELECT CAST(count(*) AS INTEGER) AS test_rows, true AS accuracy_reached, true AS auc_reached
            FROM (SELECT *, {_TEST_ROW} > {_CLASS_SIZE} - round({_CLASS_SIZE} * 0.2::DOUBLE) AS is_test FROM txn)
            WHERE is_test""",
            "txn",
        ),
        "demand_forecast": _with(
            """SELECT product_id, true AS is_forecast, true AS adds_up FROM history JOIN day_split USING (launch_date)
            WHERE dataset_split = 'test' AND m3_qty IS NOT NULL""",
            "history",
            "day_split",
        ),
        "training_history": """SELECT unnest(['m1', 'm2', 'm3']) AS horizon, true AS all_epochs, true AS all_losses,
            true AS best_is_kept, true AS patient, true AS loss_fell""",
        "demand_model_quality": _with(
            f"""SELECT forecast, {_r("sum(abs(y - guess)) / greatest(sum(abs(y)), 1e-9::DOUBLE)", "wape")}, true AS model_below_nothing
            FROM (SELECT m1_qty + m2_qty + m3_qty AS y FROM history JOIN day_split USING (launch_date)
                  WHERE dataset_split = 'test' AND m3_qty IS NOT NULL) t,
                 (SELECT 'nothing' AS forecast, 0::DOUBLE AS guess UNION ALL
                  SELECT 'train median', median(m1_qty) + median(m2_qty) + median(m3_qty)
                  FROM history JOIN day_split USING (launch_date) WHERE dataset_split = 'train' AND m3_qty IS NOT NULL) g
            GROUP BY forecast""",
            "history",
            "day_split",
        ),
        "published_run": _with(
            """SELECT 'second' AS run_id, dataset_split, count(*) AS products, count(*) AS said
            FROM history JOIN day_split USING (launch_date) WHERE m3_qty IS NOT NULL GROUP BY dataset_split""",
            "history",
            "day_split",
        ),
        "title_idf_weights": _with(
            f"""SELECT CAST(b AS INTEGER) AS bucket, count(h.bucket) AS titles,
                {_r("ln((1.0::DOUBLE + n) / (1.0::DOUBLE + count(h.bucket)))", "weight")}, true AS unit_length
            FROM range(64) r(b) CROSS JOIN (SELECT count(*) AS n FROM products) LEFT JOIN (
                SELECT DISTINCT product_id, CAST('0x' || md5(unnest(regexp_extract_all(lower(title), '[a-z0-9]+')))[1:8] AS BIGINT) % 64 AS bucket
                FROM products) h ON h.bucket = b
            GROUP BY b, n""",
            "products",
        ),
        "eligible_customers_sketched": _with("SELECT *, true AS is_close FROM customers", "customers"),
        "appended_predictions": _with(
            "SELECT product_id, true AS is_forecast, true AS adds_up FROM announced", "announced"
        ),
        "stream_product_scores": _with(
            "SELECT product_id, true AS is_forecast, true AS adds_up, true AS as_batch FROM announced", "announced"
        ),
        "latest_run": _with(
            "SELECT run_id, evaluated_at AS started_at FROM runs ORDER BY evaluated_at DESC, run_id DESC LIMIT 1", "runs"
        ),
    }
