"""DuckDB SQL that each query of `catalog_queries` must agree with, written from the definitions."""

from __future__ import annotations

from itertools import combinations

# Column names and labels of the catalog.
MEASURES = ["actual_price", "discounted_price", "discount_percentage", "rating", "rating_count"]
DERIVED = ["price_savings", "discount_depth", "price_ratio", "category_depth", "log_rating_count",
           "log_discounted_price", "log_actual_price", "review_count_parsed", "avg_review_length"]
FLAGS = ["has_high_rating", "is_heavily_discounted", "is_budget", "is_premium"]
LEVELS = ["main_category", "sub_category", "level_3", "level_4", "level_5"]
FEATURES = ["discounted_price", "discount_percentage", "rating", "rating_count", "log_rating_count",
            "log_discounted_price"]
PROFILE = ["discounted_price", "discount_percentage", "rating", "log_rating_count"]
BANDS = ["0-10%", "10-30%", "30-50%", "50-70%", "70-100%"]
RAW_COLUMNS = ["product_id", "product_name", "category", "discounted_price", "actual_price",
               "discount_percentage", "rating", "rating_count", "review_id", "review_content", "listing_ord"]

RAW = """
raw AS (
  SELECT concat('P', l_partkey) AS product_id, p_name AS product_name,
         CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN concat(p_type, '|', p_brand)
              ELSE concat(p_type, '|', p_brand, '|', p_name) END AS category,
         concat('₹', format('{:,.2f}', l_extendedprice * (100 - pct) / 100)) AS discounted_price,
         concat('₹', format('{:,.2f}', l_extendedprice)) AS actual_price,
         concat(CAST(pct AS VARCHAR), '%') AS discount_percentage,
         CASE WHEN l_orderkey % 400 = 7 THEN '|' ELSE CAST(round(5 - l_tax * 37, 1) AS VARCHAR) END AS rating,
         CASE WHEN l_orderkey % 500 = 0 THEN NULL
              ELSE format('{:,}', (l_orderkey * l_linenumber * 37) % 50021) END AS rating_count,
         concat('R', l_linenumber, CASE WHEN l_linenumber > 3 THEN concat(',R', l_orderkey) ELSE '' END) AS review_id,
         concat(p_name, ', ', l_returnflag, ',,', p_brand) AS review_content,
         l_orderkey * 10 + l_linenumber AS listing_ord
  FROM (SELECT *, least(CAST(round(l_discount * 1000) AS INT), 95) AS pct FROM lineitem) l
  JOIN part ON l_partkey = p_partkey)"""

PARSED = RAW + """,
parsed AS (
  SELECT * REPLACE (
    TRY_CAST(replace(replace(discounted_price, '₹', ''), ',', '') AS DOUBLE) AS discounted_price,
    TRY_CAST(replace(replace(actual_price, '₹', ''), ',', '') AS DOUBLE) AS actual_price,
    TRY_CAST(replace(discount_percentage, '%', '') AS DOUBLE) AS discount_percentage,
    CASE WHEN TRY_CAST(rating AS DOUBLE) BETWEEN 0 AND 5 THEN TRY_CAST(rating AS DOUBLE) END AS rating,
    TRY_CAST(replace(rating_count, ',', '') AS DOUBLE) AS rating_count) FROM raw)"""

UNIQUE = PARSED + """,
uniq AS (
  SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY listing_ord,
    actual_price NULLS LAST, discounted_price NULLS LAST, rating NULLS LAST, rating_count NULLS LAST,
    review_id, review_content) = 1)"""

LEVEL_COLUMNS = ", ".join(
    f"string_split(category, '|')[{i + 1}] AS {c}" for i, c in enumerate(LEVELS)
) + ", CAST(len(string_split(category, '|')) AS INT) AS category_depth"


def review_columns() -> str:
    parts = "list_filter(list_transform(string_split(review_content, ','), lambda x: trim(x)), lambda x: x <> '')"
    return f"""CAST(len(string_split(review_id, ',')) AS INT) AS review_count_parsed,
  CASE WHEN len({parts}) > 0 THEN list_sum(list_transform({parts}, lambda x: length(x))) * 1.0 / len({parts}) ELSE 0.0 END
  AS avg_review_length"""


PRODUCTS = UNIQUE + f""",
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in MEASURES)} FROM uniq),
imputed AS (SELECT uniq.* REPLACE ({', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in MEASURES)}) FROM uniq, med),
products AS (
  SELECT *, {LEVEL_COLUMNS}, actual_price - discounted_price AS price_savings,
    discount_percentage / 100.0 AS discount_depth, discounted_price / nullif(actual_price, 0) AS price_ratio,
    coalesce(rating >= 4.0, false) AS has_high_rating,
    coalesce(discount_percentage >= 50, false) AS is_heavily_discounted,
    coalesce(discounted_price <= 500, false) AS is_budget,
    coalesce(discounted_price >= 10000, false) AS is_premium,
    ln(1 + rating_count) AS log_rating_count, ln(1 + discounted_price) AS log_discounted_price,
    ln(1 + actual_price) AS log_actual_price, {review_columns()}
  FROM imputed),
cat AS (
  SELECT *, CASE WHEN discounted_price >= 30000 THEN 2 WHEN discount_percentage >= 50 THEN 1 ELSE 0 END AS cluster,
    CASE WHEN discount_percentage <= -1 THEN NULL WHEN discount_percentage <= 10 THEN '0-10%'
         WHEN discount_percentage <= 30 THEN '10-30%' WHEN discount_percentage <= 50 THEN '30-50%'
         WHEN discount_percentage <= 70 THEN '50-70%' WHEN discount_percentage <= 100 THEN '70-100%' END AS discount_band
  FROM products)"""


def q(select: str, base: str = PRODUCTS) -> str:
    """`select` after the base tables; it may start with further tables, led by a comma."""
    select = select.strip()
    return f"WITH {base.strip()}{'' if select.startswith(',') else chr(10)}{select}"


def long(columns: list[str], by: str = "", source: str = "cat") -> str:
    """CTE `long`: one row per non-null value of every column."""
    keys = f"{by}, " if by else ""
    parts = [f"SELECT {keys}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL"
             for c in columns]
    return "long AS (" + " UNION ALL ".join(parts) + ")"


def rounds(names: list[str], places: int = 6) -> str:
    return ", ".join(f"round({n}, {places}) AS {n}" for n in names)


MEAN_MEDIAN_MODE = """round(avg(value), 6) AS "Mean", round(quantile_cont(value, 0.5), 6) AS "Median",
  round((SELECT value FROM long m WHERE m."column" = long."column" GROUP BY value ORDER BY count(*) DESC, value LIMIT 1), 6) AS "Mode\""""
SPREAD = """round(min(value), 6) AS "Minimum", round(max(value), 6) AS "Maximum", round(max(value) - min(value), 6) AS "Range",
  printf('%.7e', var_samp(value)) AS "Variance", round(stddev_samp(value), 6) AS "Std_Deviation\""""
SHAPE = 'round(skewness(value), 6) AS "Skewness", round(kurtosis(value), 6) AS "Kurtosis"'
PERCENTILES = ", ".join(f'round(quantile_cont(value, {p / 100}), 6) AS "P{p}"' for p in (10, 25, 50, 75, 90, 95, 99))


def label(c: str, near: str, above: str, below: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'Undefined' WHEN abs({c}) < 0.5 THEN '{near}' WHEN {c} > 0 THEN '{above}' ELSE '{below}' END"


def missing(columns: list[str], source: str, only: bool = False) -> str:
    parts = [f"""SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS missing,
      round((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM {source}""" for c in columns]
    union = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({union})" + (" WHERE missing > 0" if only else "")


def pair_table(columns: list[str], measure: str, name: str = "value", source: str = "cat") -> str:
    """All ordered pairs of `measure(a, b)`."""
    return " UNION ALL ".join(
        f"SELECT '{a}' AS row, '{b}' AS col, {measure.format(a=a, b=b)} AS {name} FROM {source}"
        for a in columns for b in columns)


def spearman(columns: list[str], source: str) -> str:
    """Ordered pairs over rows where both are known; ranks are averaged over ties."""
    parts = []
    for a in columns:
        for b in columns:
            if a == b:
                parts.append(f"SELECT '{a}' AS row, '{a}' AS col, 1.0 AS value")
                continue
            parts.append(f"""SELECT '{a}' AS row, '{b}' AS col, round(corr(ra, rb), 6) AS value FROM (
              SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
                     rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
              FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""")
    return " UNION ALL ".join(parts)


def kendall(columns: list[str]) -> str:
    """Tau-b over every pair of distinct value combinations."""
    parts = [f"SELECT '{c}' AS row, '{c}' AS col, 1.0 AS value" for c in columns]
    for a, b in combinations(columns, 2):
        body = f"""(SELECT round(sum(s * w) / sqrt(sum(w) FILTER (dx) * sum(w) FILTER (dy)), 6) FROM (
          SELECT sign(p.x - q.x) * sign(p.y - q.y) AS s, p.x <> q.x AS dx, p.y <> q.y AS dy, CAST(p.n * q.n AS DOUBLE) AS w
          FROM (SELECT {a} AS x, {b} AS y, count(*) AS n FROM cat GROUP BY ALL) p,
               (SELECT {a} AS x, {b} AS y, count(*) AS n FROM cat GROUP BY ALL) q
          WHERE p.x <> q.x OR p.y <> q.y))"""
        parts.append(f"SELECT '{a}' AS row, '{b}' AS col, {body} AS value")
        parts.append(f"SELECT '{b}' AS row, '{a}' AS col, {body} AS value")
    return " UNION ALL ".join(parts)


def group_stats(key: str, columns: list[str], places: int = 6) -> str:
    cells = ", ".join(
        f"round(avg({c}), {places}) AS {c}_mean, round(quantile_cont({c}, 0.5), {places}) AS {c}_median, "
        f"round(stddev_samp({c}), {places}) AS {c}_std, count({c}) AS {c}_count, "
        f"round(CAST(min({c}) AS DOUBLE), {places}) AS {c}_min, round(CAST(max({c}) AS DOUBLE), {places}) AS {c}_max"
        for c in columns)
    return f"SELECT {key}, {cells} FROM cat WHERE {key} IS NOT NULL GROUP BY {key}"


def band_pivot(cell: str, where: str = "true", source: str = "cat", index: str = "main_category") -> str:
    cells = ", ".join(f"{cell.format(w=f'discount_band = {chr(39)}{b}{chr(39)}')} AS \"{b}\"" for b in BANDS)
    return f"SELECT {index}, {cells} FROM {source} WHERE {where} GROUP BY {index}"


FILTERED = """filtered AS (SELECT * FROM cat WHERE main_category IN ('ECONOMY', 'PROMO', 'SMALL')
  AND discounted_price BETWEEN 1000 AND 60000 AND discount_percentage BETWEEN 10 AND 80)"""


def histogram(columns: list[str], bins: int, by: str = "") -> str:
    key = f"{by}, " if by else ""
    join = f" AND c.{by} = g.{by}" if by else ""
    using = f"g.{by}, " if by else ""
    return q(f"""
      , {long(columns, by)},
      ends AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM long GROUP BY 1),
      c AS (SELECT {key}long."column", CAST(least(floor((value - lo) / (hi - lo) * {bins}), {bins - 1}) AS INT) AS bin,
                   count(*) AS n FROM long JOIN ends ON long."column" = ends."column" GROUP BY ALL),
      g AS (SELECT {key}"column", count(*) AS total FROM long GROUP BY ALL)
      SELECT {using}g."column", CAST(r.bin AS INT) AS bin, round(lo + r.bin * (hi - lo) / {bins}, 8) AS low,
             round(lo + (r.bin + 1) * (hi - lo) / {bins}, 8) AS high, coalesce(n, 0) AS count,
             round(coalesce(n, 0) / (total * (hi - lo) / {bins}), 8) AS density
      FROM g JOIN ends ON g."column" = ends."column" CROSS JOIN (SELECT unnest(range({bins})) AS bin) r
      LEFT JOIN c ON c."column" = g."column" AND c.bin = r.bin{join}""")


def kde(columns: list[str], points: int, by: str = "", cut: float = 0.0, places: int = 8) -> str:
    key = f"{by}, " if by else ""
    match = 'v."column" = g."column"' + (f" AND v.{by} = g.{by}" if by else "")
    own = f"g.{by}, " if by else ""
    return q(f"""
      , {long(columns, by)},
      v AS (SELECT {key}"column", value, count(*) AS n FROM long GROUP BY ALL),
      g AS (SELECT {key}"column", count(*) AS total, stddev_samp(value) * pow(count(*), -0.2) AS h,
                   min(value) AS lo, max(value) AS hi FROM long GROUP BY ALL),
      gx AS (SELECT g.*, p.point, lo - {cut} * h + p.point * ((hi - lo + 2 * {cut} * h) / {points - 1}) AS x
             FROM g CROSS JOIN (SELECT unnest(range({points})) AS point) p)
      SELECT {own}g."column", CAST(point AS INT) AS point, round(x, {places}) AS x,
             round(sum(n * exp(-0.5 * pow((x - value) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), {places}) AS density
      FROM gx g JOIN v ON {match} GROUP BY {own}g."column", point, x""")


def boxes(columns: list[str], by: str = "") -> str:
    key = f"{by}, " if by else ""
    match = 'long."column" = f."column"' + (f" AND long.{by} = f.{by}" if by else "")
    own = f"f.{by}, " if by else ""
    return f"""
      , {long(columns, by)},
      f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM (
        SELECT {key}"column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL)),
      boxes AS (SELECT {own}f."column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
          round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
          CAST(count(*) AS BIGINT) AS count, round(min(value), 6) AS min, round(max(value), 6) AS max,
          count(*) FILTER (value < lower_fence OR value > upper_fence) AS outliers,
          round(min(value) FILTER (value >= lower_fence AND value <= upper_fence), 6) AS lower_whisker,
          round(max(value) FILTER (value >= lower_fence AND value <= upper_fence), 6) AS upper_whisker
        FROM long JOIN f ON {match} GROUP BY ALL)"""


def box_query(columns: list[str], by: str = "") -> str:
    return q(boxes(columns, by) + "\n SELECT * FROM boxes")


def bins2d(pairs: list[tuple[str, str]], bins: int, by: str = "") -> str:
    key = f"{by}, " if by else ""

    def axis(c: str) -> str:
        return (f"CAST(least(floor(({c} - (SELECT min({c}) FROM cat)) / "
                f"((SELECT max({c}) FROM cat) - (SELECT min({c}) FROM cat)) * {bins}), {bins - 1}) AS INT)")
    return q(" UNION ALL ".join(
        f"SELECT {key}'{a}' AS x, '{b}' AS y, {axis(a)} AS x_bin, {axis(b)} AS y_bin, count(*) AS count FROM cat GROUP BY ALL"
        for a, b in pairs))


def ecdf(column: str) -> str:
    return q(f"""SELECT round(value, 6) AS value, n, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS cumulative_n,
      round(sum(n) OVER (ORDER BY value) * 100.0 / sum(n) OVER (), 6) AS cumulative_pct
      FROM (SELECT {column} AS value, count(*) AS n FROM cat GROUP BY 1)""")


ZSCORES = f"""z AS (SELECT product_id, cluster, {', '.join(
    f'({c} - (SELECT avg({c}) FROM cat)) / (SELECT stddev_pop({c}) FROM cat) AS {c}_z' for c in FEATURES)} FROM cat)"""


def silhouette(distance: str) -> str:
    return q(f""", {ZSCORES},
      d AS (SELECT a.product_id, a.cluster AS own, b.cluster AS other, sum({distance}) AS s, count(*) AS n
            FROM z a CROSS JOIN z b GROUP BY ALL),
      ab AS (SELECT product_id, max(CASE WHEN own = other THEN s / (n - 1) END) AS a,
                    min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY 1)
      SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab""")


SQUARES = " + ".join(f"pow(a.{c}_z - b.{c}_z, 2)" for c in FEATURES)

CLUSTER_MEANS = f"""cm AS (SELECT cluster, count(*) AS size, count(*) * 100.0 / (SELECT count(*) FROM cat) AS percentage,
  {', '.join(f'avg({f}) AS mean_{f}, (SELECT avg({f}) FROM cat) AS all_{f}' for f in FEATURES)} FROM cat GROUP BY 1)"""


def relative(f: str) -> str:
    return f"((mean_{f} - all_{f}) / all_{f})"


def level(gap: str, t: float, above: str, below: str) -> str:
    return f"CASE WHEN {gap} > {t} THEN '{above}' WHEN {gap} < -{t} THEN '{below}' END"


_LABEL_PARTS = ", ".join([
    level(relative("log_discounted_price"), 0.3, "High-Price", "Low-Price"),
    level(relative("discount_percentage"), 0.3, "High-Discount", "Low-Discount"),
    level("(mean_rating - all_rating)", 0.15, "High-Rating", "Low-Rating"),
    level(relative("log_rating_count"), 0.3, "Popular", "Niche")])
LABEL = f"coalesce(nullif(concat_ws(' / ', {_LABEL_PARTS}), ''), 'Average')"
_NOTES = ", ".join(
    f"CASE WHEN abs({relative(f)} * 100) > 20 THEN concat('{f}: ', CASE WHEN {relative(f)} > 0 THEN 'higher' ELSE 'lower' END, "
    f"' than average (', printf('%+.1f', {relative(f)} * 100), '%)') END" for f in FEATURES)


def composition(by: str) -> str:
    return f"""comp_{by} AS (SELECT g.cluster, g.{by}, coalesce(n, 0) AS count,
        round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY g.cluster), 4) * 100.0 AS pct_in_cluster,
        round(coalesce(n, 0) / nullif(sum(coalesce(n, 0)) OVER (PARTITION BY g.{by}), 0), 4) * 100.0 AS pct_in_{by}
      FROM (SELECT DISTINCT a.cluster, b.{by} FROM cat a CROSS JOIN (SELECT DISTINCT {by} FROM cat) b) g
      LEFT JOIN (SELECT cluster, {by}, count(*) AS n FROM cat GROUP BY ALL) c
        ON g.cluster = c.cluster AND g.{by} = c.{by})"""


def composition_query(by: str) -> str:
    return f"""WITH {PRODUCTS.strip()}, {composition(by)}
      SELECT cluster, {by}, count, round(pct_in_cluster, 6) AS pct_in_cluster, round(pct_in_{by}, 6) AS pct_in_{by} FROM comp_{by}"""


def listed(by: str) -> str:
    return f"""(SELECT string_agg(concat({by}, '=', format('{{:.2f}}', pct_in_cluster)), '; ' ORDER BY pct_in_cluster DESC, {by})
      FROM comp_{by} x WHERE x.cluster = cm.cluster AND pct_in_cluster > 5)"""


def tier(label_sql: str) -> str:
    return f"""CASE WHEN {label_sql} LIKE '%Average%' OR {label_sql} LIKE '%Mid%' THEN 'mainstream'
      WHEN {label_sql} LIKE '%Low-Rating%' OR {label_sql} LIKE '%Low-Price%' THEN 'budget'
      WHEN {label_sql} LIKE '%High-Price%' OR {label_sql} LIKE '%Low-Discount%' THEN 'premium' END"""


# Recommendation rules by brute force: join condition and order of the candidates.
RULES = {
    "cluster_based": ("t.cluster = c.cluster", "c.rating DESC, c.rating_count DESC"),
    "category_better_rated": (
        "t.main_category = c.main_category AND c.rating >= t.rating + CAST(0.2 AS DOUBLE) AND c.discounted_price BETWEEN "
        "t.discounted_price * CAST(0.5 AS DOUBLE) AND t.discounted_price * CAST(1.5 AS DOUBLE)",
        "c.rating DESC, c.rating_count DESC"),
    "budget_alternative": (
        "t.main_category = c.main_category AND c.rating >= 3.5 AND c.discounted_price <= t.discounted_price * CAST(0.7 AS DOUBLE)",
        "c.rating / (c.discounted_price + 1) DESC"),
    "premium_upgrade": (
        "t.main_category = c.main_category AND c.rating >= 4.0 AND c.discounted_price >= t.discounted_price * CAST(1.5 AS DOUBLE)",
        "c.rating DESC, c.discounted_price"),
    "price_range": (
        "c.discounted_price BETWEEN t.discounted_price * (CAST(1 AS DOUBLE) - CAST(0.3 AS DOUBLE)) "
        "AND t.discounted_price * (CAST(1 AS DOUBLE) + CAST(0.3 AS DOUBLE))", "c.rating DESC"),
    "category": ("t.main_category = c.main_category", "c.rating DESC, c.rating_count DESC"),
}


def rule(name: str, n: int = 3, tag: bool = False, where: str = "true") -> str:
    on, order = RULES[name]
    strategy = f"'{name}' AS strategy, " if tag else ""
    return f"""SELECT t.product_id, c.product_id AS recommended_product_id, {strategy}
        CAST(row_number() OVER (PARTITION BY t.product_id ORDER BY {order}, c.product_id) AS INT) AS rank,
        round(c.discounted_price, 2) AS recommended_price, round(c.rating, 2) AS recommended_rating,
        c.main_category AS recommended_category
      FROM cat t JOIN cat c ON {on} AND t.product_id <> c.product_id WHERE {where} QUALIFY rank <= {n}"""


STRATEGIES = ["cluster_based", "category_better_rated", "budget_alternative", "premium_upgrade", "price_range"]


def all_rules(n: int = 3, where: str = "true") -> str:
    return " UNION ALL ".join(f"({rule(s, n, True, where)})" for s in STRATEGIES)


def preferences(where: str, boost: bool) -> str:
    def mm(e: str) -> str:
        return f"(({e}) - min({e}) OVER ()) / (max({e}) OVER () - min({e}) OVER () + 1e-6)"
    add = "CASE cluster WHEN 0 THEN 0.1 WHEN 1 THEN 0.05 ELSE 0.0 END" if boost else "0.0"
    return q(f"""SELECT product_id, product_name, main_category, {rounds(['actual_price', 'discounted_price',
        'discount_percentage', 'rating', 'rating_count'])}, cluster, round(score, 6) AS composite_score,
        CAST(row_number() OVER (ORDER BY score DESC, product_id) AS INT) AS rank FROM (
        SELECT *, 0.4 * {mm('rating')} + 0.3 * {mm('ln(1 + rating_count)')} + 0.2 * {mm('discount_percentage')} + 0.1 * ({add}) AS score
        FROM cat WHERE {where}) QUALIFY rank <= 10""")


PARSED_KEYS = f"product_id, listing_ord, {', '.join(MEASURES)}"

ORACLES: dict[str, str] = {
    "listings_text": q("SELECT * FROM raw", RAW),
    "parse_listings": q(f"SELECT product_id, listing_ord, {rounds(MEASURES)} FROM parsed", PARSED),
    "parse_clean": q(f"SELECT product_id, product_name, listing_ord, {rounds(MEASURES)} FROM uniq", UNIQUE),
    "duplicate_removal": q("""SELECT (SELECT count(*) FROM raw) AS original_rows,
        (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS removed_exact,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) - count(DISTINCT product_id) AS removed_repeated_ids,
        count(DISTINCT product_id) AS final_rows FROM raw""", RAW),
    "impute_median": q(f"SELECT product_id, {rounds(MEASURES)} FROM imputed"),
    "clean_catalog": q(f"SELECT product_id, product_name, {rounds(MEASURES)}, {', '.join(LEVELS)}, category_depth, "
                       "round(price_savings, 6) AS price_savings, is_premium, listing_ord FROM products"),
    "category_levels": q(f"SELECT product_id, listing_ord, {LEVEL_COLUMNS} FROM raw", RAW),
    "features": q(f"""SELECT product_id, {rounds(MEASURES)}, {rounds([c for c in DERIVED if c not in ('category_depth', 'review_count_parsed')])},
        category_depth, review_count_parsed, {', '.join(FLAGS)} FROM products"""),
    "review_lists": q(f"""SELECT * REPLACE (round(avg_review_length, 6) AS avg_review_length) FROM (
        SELECT product_id, listing_ord, {review_columns()}, round(discounted_price / nullif(actual_price, 0), 6) AS price_ratio
        FROM parsed)""", PARSED),
    "discount_bands": q(f"""SELECT product_id, round(discount_percentage, 6) AS discount_percentage, discount_band,
        CAST(list_position({BANDS!r}, discount_band) - 1 AS INT) AS discount_band_ord FROM cat"""),
    "inspect_shape": q(f"SELECT count(*) AS rows, {len(RAW_COLUMNS)} AS columns FROM raw", RAW),
    "inspect_head": q("SELECT * FROM raw ORDER BY listing_ord, product_id, actual_price LIMIT 3", RAW),
    "inspect_tail": q("SELECT * FROM raw ORDER BY listing_ord DESC, product_id DESC, actual_price DESC LIMIT 2", RAW),
    "missing_profile": q(missing(RAW_COLUMNS, "raw"), RAW),
    "missing_after_parse": q(missing(MEASURES, "parsed", True), PARSED),
    "total_missing": q(f"SELECT CAST(sum(missing) AS BIGINT) AS total_missing FROM ({missing(RAW_COLUMNS, 'parsed')})", PARSED),
    "duplicate_profile": q("""
  , copies AS (SELECT *, count(*) AS n FROM raw GROUP BY ALL),
  ids AS (SELECT product_id, count(*) AS n FROM raw GROUP BY 1)
  SELECT CAST((SELECT coalesce(sum(n), 0) FROM copies WHERE n > 1) AS BIGINT) AS exact_duplicate_rows,
    (SELECT count(*) FROM copies WHERE n > 1) AS exact_duplicate_groups,
    count(*) FILTER (n > 1) AS repeated_product_ids,
    CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_with_repeated_ids, count(*) AS unique_product_ids,
    CAST(sum(n) AS BIGINT) AS total_rows, max(n) AS max_rows_per_product_id FROM ids""", RAW),
    "id_count_distribution": q("SELECT rows_per_id, count(*) AS ids FROM (SELECT count(*) AS rows_per_id FROM raw GROUP BY product_id) GROUP BY 1", RAW),
    "quality_summary": q(f"""SELECT count(*) AS rows, {len(RAW_COLUMNS)} AS columns,
        CAST({' + '.join(f'count(*) - count({c})' for c in MEASURES)} AS BIGINT) AS residual_missing,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM parsed)) AS exact_duplicates,
        count(*) - count(DISTINCT product_id) AS id_duplicates FROM parsed""", PARSED),
    "category_distinct": q("SELECT count(DISTINCT main_category) AS main_categories FROM cat"),
    "category_depths": q("SELECT category_depth, count(*) AS count FROM cat GROUP BY 1"),
    "category_top": q("SELECT main_category, count(*) AS count FROM cat GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "feature_profile": q(" UNION ALL ".join(
        [f"""SELECT '{c}' AS "column", count(*) FILTER ({c}) AS true_count, count(*) FILTER (NOT {c}) AS false_count,
             CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std FROM cat""" for c in FLAGS]
        + [f"""SELECT '{c}', NULL, NULL, round(avg({c}), 6), round(stddev_samp({c}), 6) FROM cat""" for c in DERIVED])),
    "distinct_values": q("SELECT DISTINCT sub_category FROM cat WHERE sub_category IS NOT NULL"),
    "central_tendency": q(f', {long(MEASURES)} SELECT "column", {MEAN_MEDIAN_MODE} FROM long GROUP BY 1'),
    "dispersion": q(f', {long(MEASURES)} SELECT "column", {SPREAD} FROM long GROUP BY 1'),
    "distribution_labels": q(f""", {long(MEASURES)} SELECT *, {label('"Skewness"', 'Approximately symmetric',
        'Right-skewed (positive skew)', 'Left-skewed (negative skew)')} AS skewness_label, {label('"Kurtosis"',
        'Mesokurtic (normal-like)', 'Leptokurtic (heavy-tailed, peaked)', 'Platykurtic (light-tailed, flat)')} AS kurtosis_label
        FROM (SELECT "column", {SHAPE} FROM long GROUP BY 1)"""),
    "percentiles": q(f', {long(MEASURES)} SELECT "column", {PERCENTILES} FROM long GROUP BY 1'),
    "summary_statistics": q(f', {long(MEASURES)} SELECT "column", {MEAN_MEDIAN_MODE}, {SPREAD}, {SHAPE}, {PERCENTILES} FROM long GROUP BY 1'),
    "corr_pearson": q(pair_table(MEASURES, "round(corr({a}, {b}), 6)")),
    "corr_spearman": q(spearman(MEASURES, "cat")),
    "corr_kendall": q(kendall(MEASURES)),
    "corr_matrix": q(" UNION ALL ".join(
        f"SELECT '{a}' AS \"column\", " + ", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in MEASURES) + " FROM cat"
        for a in MEASURES)),
    "corr_spearman_nulls": q(spearman(["rating", "rating_count", "actual_price"], "uniq"), UNIQUE),
    "cov_matrix": q(pair_table(MEASURES, "round(covar_samp({a}, {b}), 0) AS value, round(covar_samp({a}, {b}) / stddev_samp({a}) / stddev_samp({b}), 6)", "scaled")),
    "corr_target": q(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr(rating, {c}), 6) AS value FROM cat" for c in MEASURES)),
    "corr_target_signed": q(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr(rating, {c}), 6) AS value FROM cat" for c in MEASURES if c != "rating")),
    "heatmap_lower": q(f"SELECT * FROM ({spearman(MEASURES, 'cat')}) WHERE list_position({MEASURES!r}, row) > list_position({MEASURES!r}, col)"),
    "group_by_category": q(group_stats("main_category", MEASURES)),
    "group_by_band": q(group_stats("discount_band", MEASURES)),
    "pivot_count": q(band_pivot("nullif(count(product_id) FILTER ({w}), 0)", "level_3 IS NOT NULL", index="level_3")),
    "pivot_count_filled": q(band_pivot("count(product_id) FILTER ({w})", "level_3 IS NOT NULL", index="level_3")),
    "pivot_sum": q(band_pivot("round(sum(rating_count) FILTER ({w}), 6)")),
    "pivot_min": q(band_pivot("round(min(discounted_price) FILTER ({w}), 6)")),
    "pivot_max": q(band_pivot("round(max(discounted_price) FILTER ({w}), 6)")),
    "pivot_mean": q(band_pivot("round(avg(rating) FILTER ({w}), 6)")),
    "pivot_median": q(band_pivot("round(quantile_cont(discounted_price, 0.5) FILTER ({w}), 6)")),
    "pivot_cells_std": q("SELECT main_category, discount_band, round(stddev_samp(rating), 6) AS cell FROM cat GROUP BY ALL"),
    "kpis": q("SELECT count(*) AS products, " + ", ".join(
        f"round(avg({c}), 6) AS mean_{c}, round(quantile_cont({c}, 0.5), 6) AS median_{c}"
        for c in ("discounted_price", "discount_percentage", "rating"))
        + ", count(DISTINCT main_category) AS categories, count(DISTINCT cluster) AS clusters FROM cat"),
    "category_overview": q("SELECT main_category, count(*) AS count, round(avg(discounted_price), 6) AS avg_price, round(avg(rating), 6) AS avg_rating FROM cat GROUP BY 1"),
    "category_metric": q("SELECT main_category, round(avg(discount_percentage), 6) AS mean_discount_percentage FROM cat GROUP BY 1"),
    "category_means": q(f', {long(MEASURES, "main_category")} SELECT main_category, "column", round(avg(value), 6) AS mean FROM long GROUP BY ALL'),
    "category_counts": q("SELECT main_category, count(*) AS count FROM cat GROUP BY 1"),
    "category_rollup": q(f"""SELECT {', '.join(LEVELS)}, CAST(GROUPING_ID({', '.join(LEVELS)}) AS BIGINT) AS grouping_bits, count(*) AS count,
        round(avg(discounted_price), 6) AS avg_discounted_price FROM cat GROUP BY ROLLUP ({', '.join(LEVELS)})"""),
    "compare_products": q(f', {long(MEASURES, "product_id")} SELECT product_id, "column", round(value, 6) AS value FROM long WHERE product_id IN (\'P1\', \'P20\', \'P300\')'),
    "rating_price_bands": q("""SELECT CAST(floor(rating) AS INT) AS rating_band, CASE WHEN discounted_price <= 1000 THEN 'low'
        WHEN discounted_price <= 10000 THEN 'middle' ELSE 'high' END AS discount_band, count(*) AS cell FROM cat GROUP BY ALL"""),
    "filter_catalog": q(f", {FILTERED} SELECT product_id, main_category, round(discounted_price, 6) AS discounted_price, round(discount_percentage, 6) AS discount_percentage FROM filtered"),
    "filtered_pivot": q(f", {FILTERED} " + band_pivot("round(avg(discounted_price) FILTER ({w}), 6)", source="filtered")),
    "filter_bounds": q(f', {long(MEASURES)} SELECT "column", round(min(value), 6) AS low, round(max(value), 6) AS high FROM long GROUP BY 1'),
    "product_search": q("SELECT product_id, product_name, main_category FROM cat WHERE main_category = 'ECONOMY' AND regexp_matches(product_name, '^(red|blue) .*(ring|bolt)', 'i')"),
    "product_search_literal": q("SELECT product_id, product_name, main_category FROM cat WHERE main_category = 'ECONOMY' AND contains(lower(product_name), 'ring')"),
    "filter_preferences": q("SELECT product_id, round(discounted_price, 6) AS discounted_price, round(rating, 6) AS rating FROM cat WHERE main_category = 'SMALL' AND discounted_price <= 40000 AND rating >= 3.5 AND discount_percentage >= 20"),
    "product_details": q(f"""SELECT product_id, CASE WHEN length(product_name) > 8 THEN concat(substring(product_name, 1, 8), '...') ELSE product_name END AS product_name,
        main_category, {rounds(MEASURES)}, cluster FROM cat WHERE product_id = 'P20'"""),
    "cluster_lookup": q("""SELECT concat('P', p_partkey) AS product_id, cluster FROM part LEFT JOIN cat ON product_id = concat('P', p_partkey)
        UNION ALL SELECT concat('S', s_suppkey), NULL FROM supplier"""),
    "product_search_accents": q("""SELECT product_id, name AS product_name FROM (SELECT product_id, concat(product_name, CASE WHEN is_heavily_discounted
        THEN ' GRÖSSE ÉTÉ' ELSE ' größe etc' END) AS name FROM cat) WHERE regexp_matches(name, 'ing größe|RED.*été$', 'i')"""),
    "histogram": histogram(MEASURES, 50),
    "distribution_markers": q(f', {long(MEASURES)} SELECT "column", round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median FROM long GROUP BY 1'),
    "kde": kde(["discounted_price", "rating"], 300),
    "box_stats": box_query(MEASURES),
    "box_by_category": box_query(MEASURES, "main_category"),
    "outlier_values": q(boxes(["discounted_price", "price_savings"], "main_category") + """
        SELECT main_category, long."column", round(value, 6) AS value, count(*) AS n FROM long JOIN f USING (main_category, "column")
        WHERE value < lower_fence OR value > upper_fence GROUP BY ALL"""),
    "violin_density": kde(["rating"], 100, "main_category", 2.0, 6),
    "violin_box": box_query(["rating"], "main_category"),
    "ecdf": ecdf("discount_percentage"),
    "ecdf_price": ecdf("discounted_price"),
    "ecdf_markers": " UNION ALL ".join(
        f"(SELECT * FROM ({q(f'SELECT {p}.0 AS percent, min(v) AS value FROM (SELECT discount_percentage AS v, row_number() OVER (ORDER BY discount_percentage) * 100.0 / count(*) OVER () AS pct FROM cat) WHERE pct >= {p}')}))"
        for p in (25, 50, 75)),
    "scatter_points": q(f"SELECT {rounds(['discounted_price', 'rating', 'discount_percentage'])} FROM cat"),
    "scatter_bins": bins2d([("discounted_price", "rating"), ("discount_percentage", "rating")], 50),
    "scatter_corr": q("""SELECT round(r, 6) AS r, n, round(r * sqrt(n - 2) / sqrt(1 - r * r), 6) AS t FROM (
        SELECT corr(discount_percentage, discounted_price) AS r, count(*) AS n FROM cat)"""),
    "pair_histograms": histogram(MEASURES, 20, "cluster"),
    "pair_bins": bins2d(list(combinations(MEASURES, 2)), 20, "cluster"),
    "zscore_features": q(f", {ZSCORES} SELECT product_id, cluster, {rounds([c + '_z' for c in FEATURES], 6)} FROM z"),
    "cluster_sizes": q("SELECT cluster, count(*) AS size, round(count(*) * 100.0 / (SELECT count(*) FROM cat), 6) AS percentage FROM cat GROUP BY 1"),
    "cluster_stats": q(group_stats("cluster", MEASURES + ["price_savings"])),
    "cluster_labels": q(f""", {CLUSTER_MEANS} SELECT cluster, {LABEL} AS label, size, round(percentage, 6) AS percentage,
        {rounds(['mean_' + f for f in FEATURES])}, concat_ws('; ', {_NOTES}) AS characteristics FROM cm"""),
    "cluster_profile": q("SELECT cluster, " + ", ".join(
        f"round(avg(({f} - (SELECT min({f}) FROM cat)) / ((SELECT max({f}) FROM cat) - (SELECT min({f}) FROM cat))), 6) AS {f}_norm"
        for f in PROFILE) + " FROM cat GROUP BY 1"),
    "cluster_composition": composition_query("main_category"),
    "cluster_bands": composition_query("discount_band"),
    "cluster_band_matrix": q("SELECT cluster, " + ", ".join(f"count(*) FILTER (discount_band = '{b}') AS \"{b}\"" for b in BANDS) + " FROM cat GROUP BY 1"),
    "cluster_summary": q("""SELECT cluster, CASE cluster WHEN 0 THEN 'Mainstream' WHEN 1 THEN 'Budget/Deep-Discount' ELSE 'Premium' END AS name,
        count(*) AS count, round(avg(discounted_price), 6) AS avg_price, round(quantile_cont(discounted_price, 0.5), 6) AS median_price,
        round(avg(discount_percentage), 6) AS avg_discount, round(avg(rating), 6) AS avg_rating, round(avg(rating_count), 6) AS avg_reviews,
        round(count(*) * 100.0 / (SELECT count(*) FROM cat), 6) AS percentage FROM cat GROUP BY 1"""),
    "cluster_facts": q(f""", {CLUSTER_MEANS}, {composition('main_category')}, {composition('discount_band')}
        SELECT cluster, {LABEL} AS label, {tier(LABEL)} AS tier, size, round(percentage, 6) AS percentage,
        {rounds(['mean_' + f for f in FEATURES[:4]])}, {listed('main_category')} AS categories, {listed('discount_band')} AS bands FROM cm"""),
    "canonical_clusters": q("""SELECT product_id, c.canonical AS cluster FROM cat JOIN (SELECT cluster, CAST(row_number() OVER (
        ORDER BY count(*) DESC, avg(discounted_price)) - 1 AS INT) AS canonical FROM cat GROUP BY 1) c USING (cluster)"""),
    "silhouette_squared": silhouette(SQUARES),
    "silhouette_euclidean": silhouette(f"sqrt({SQUARES})"),
    "rec_cluster": q(rule("cluster_based")),
    "rec_category": q(rule("category")),
    "rec_price_range": q(rule("price_range")),
    "rec_better_rated": q(rule("category_better_rated")),
    "rec_budget": q(rule("budget_alternative")),
    "rec_premium": q(rule("premium_upgrade")),
    "rec_all": q(all_rules()),
    "rec_combined": q(f"""SELECT * FROM ({all_rules()}) QUALIFY row_number() OVER (PARTITION BY product_id, recommended_product_id
        ORDER BY list_position({STRATEGIES!r}, strategy)) = 1"""),
    "rec_one_product": q(all_rules(5, "t.product_id = 'P20'")),
    "rec_preferences": preferences("discounted_price <= 50000 AND rating >= 3.0 AND discount_percentage >= 20", True),
    "rec_preferences_open": preferences("true", False),
}

# Sources, sinks and bundles return what the tables written to them hold.
for _name, _same in {"csv_source": "listings_text", "catalog_round_trip": "clean_catalog", "report_round_trip": "group_by_band",
                     "recommendations_round_trip": "rec_all", "segment_report_round_trip": "cluster_labels",
                     "silhouette_pipeline": "silhouette_squared"}.items():
    ORACLES[_name] = ORACLES[_same]


def digests(tables: dict[str, tuple[str, str]]) -> str:
    """Of each named table, given as SQL and its columns that hold no numbers: rows, known numbers, sum of signed logarithms."""
    return " UNION ALL ".join(f"""SELECT '{name}' AS name, (SELECT count(*) FROM ({sql})) AS rows, count(v) AS cells,
        round(coalesce(sum(sign(v) * ln(1 + abs(v))), 0), 3) AS total
      FROM (UNPIVOT (SELECT round(CAST(COLUMNS(*{f" EXCLUDE ({text})" if text else ""}) AS DOUBLE), 6) FROM ({sql}))
            ON COLUMNS(*) INTO NAME c VALUE v)""" for name, (sql, text) in tables.items())


def lloyd(k: int, starts: int = 12, steps: int = 60) -> str:
    """The least inertia a product of K-Means from several sets of products chosen by a hash, as a scalar query."""
    gap = " + ".join(f"pow({f}_z - c{i}, 2)" for i, f in enumerate(FEATURES))
    return q(f""", {ZSCORES},
      dealt AS (SELECT z.*, start, row_number() OVER (PARTITION BY start ORDER BY md5(concat(product_id, '-', start)), product_id) AS place
                FROM z CROSS JOIN (SELECT unnest(range({starts})) AS start)),
      lloyd AS (SELECT start, 0 AS step, place AS k, {', '.join(f'{f}_z AS c{i}' for i, f in enumerate(FEATURES))} FROM dealt WHERE place <= {k}
        UNION ALL SELECT start, step + 1, k, {', '.join(f'avg({f}_z)' for f in FEATURES)} FROM (
          SELECT l.start, l.step, l.k, z.*, row_number() OVER (PARTITION BY l.start, z.product_id ORDER BY {gap}, l.k) AS near
          FROM lloyd l CROSS JOIN z WHERE step < {steps}) WHERE near = 1 GROUP BY start, step, k),
      gaps AS (SELECT l.start, z.product_id, min({gap}) AS gap FROM lloyd l CROSS JOIN z WHERE step = {steps} GROUP BY ALL)
      SELECT round(min(cost), 2) FROM (SELECT avg(gap) AS cost FROM gaps GROUP BY start)""").replace("WITH ", "WITH RECURSIVE ", 1)


def p_value(x: str, y: str) -> str:
    """Student's t for whole degrees of freedom as a finite series in cos(atan(t / sqrt(n - 2)))."""
    return q(f"""SELECT round(r, 6) AS r, n, round(t, 6) AS t, round(1 - CASE WHEN v % 2 = 0
          THEN sin(a) * list_sum(list_transform(range(0, CAST(v / 2 AS BIGINT)), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow(cos(a), 2 * k)))
          ELSE 2 / pi() * (a + sin(a) * cos(a) * coalesce(list_sum(list_transform(range(0, CAST((v - 1) / 2 AS BIGINT)),
               lambda k: exp(lgamma(k + 1) - lgamma(k + 1.5)) * sqrt(pi()) / 2 * pow(cos(a), 2 * k))), 0)) END, 6) AS p
        FROM (SELECT *, n - 2 AS v, atan(abs(t) / sqrt(n - 2)) AS a FROM (SELECT r, n, r * sqrt(n - 2) / sqrt(1 - r * r) AS t
          FROM (SELECT corr({x}, {y}) AS r, count(*) AS n FROM cat)))""")


_CHARTED = [*MEASURES, "price_savings"]
_LOWER = f"list_position({MEASURES!r}, row) > list_position({MEASURES!r}, col)"

ORACLES |= {
    "segments_round_trip": q("SELECT product_id, cluster FROM cat"),
    "model_round_trip": q("SELECT count(*) AS rows, 0 AS moved FROM cat"),
    "report_presented": q(" UNION ALL ".join(
        f"SELECT main_category, '{c}' AS \"column\", round_even(avg({c}), 2) AS mean FROM cat GROUP BY 1" for c in MEASURES)),
    "report_bundle": digests({
        "summary": (f"SELECT * REPLACE (CAST(\"Variance\" AS DOUBLE) AS \"Variance\") FROM ({ORACLES['summary_statistics']})", '"column"'),
        "correlation": (ORACLES["corr_matrix"], '"column"'),
        "covariance": (q(" UNION ALL ".join(f"SELECT '{a}' AS \"column\", " + ", ".join(
            f"covar_samp({a}, {b}) AS {b}" for b in MEASURES) + " FROM cat" for a in MEASURES)), '"column"'),
        "group_by_category": (ORACLES["group_by_category"], "main_category"),
        "group_by_discount_band": (ORACLES["group_by_band"], "discount_band"),
        "pivot_category_discount": (q(band_pivot("nullif(count(product_id) FILTER ({w}), 0)")), "main_category"),
        "pivot_category_rating": (ORACLES["pivot_mean"], "main_category")}),
    "chart_bundle": digests({
        "histograms": (histogram(_CHARTED, 50), '"column"'), "densities": (kde(_CHARTED, 300), '"column"'),
        "markers": (q(f', {long(_CHARTED)} SELECT "column", avg(value) AS mean, quantile_cont(value, 0.5) AS median FROM long GROUP BY 1'), '"column"'),
        "boxes": (ORACLES["box_stats"], '"column"'), "boxes_by_category": (ORACLES["box_by_category"], 'main_category, "column"'),
        "correlation_heatmap_pearson": (f"SELECT * FROM ({ORACLES['corr_pearson']}) WHERE {_LOWER}", "row, col"),
        "correlation_heatmap_spearman": (ORACLES["heatmap_lower"], "row, col"),
        "correlation_with_rating": (ORACLES["corr_target"], "feature"),
        "correlation_with_discounted_price": (q(" UNION ALL ".join(
            f"SELECT '{c}' AS feature, corr(discounted_price, {c}) AS value FROM cat" for c in MEASURES)), "feature"),
        "category_counts": (ORACLES["category_counts"], "main_category"),
        "category_means": (ORACLES["category_means"], 'main_category, "column"'),
        "pivot_counts": (q(band_pivot("count(product_id) FILTER ({w})")), "main_category"),
        "pair_histograms": (histogram(MEASURES, 50), '"column"'), "pair_bins": (bins2d(list(combinations(MEASURES, 2)), 50), "x, y"),
        "violin_density": (ORACLES["violin_density"], 'main_category, "column"'), "violin_box": (ORACLES["violin_box"], 'main_category, "column"'),
        "cumulative_discount": (ORACLES["ecdf"], ""), "cumulative_discount_markers": (ORACLES["ecdf_markers"], ""),
        **{f"pivot_mean_{c}": (q(band_pivot(f"avg({c}) FILTER ({{w}})")), "main_category")
           for c in ("rating", "discounted_price", "discount_percentage")},
        **{f"scatter_{y}_vs_{x}": (q(f"SELECT {', '.join([x, y, *hue])} FROM cat"), "") for x, y, hue in (
            ("discounted_price", "rating", ["discount_percentage"]), ("discounted_price", "rating_count", []), ("discount_percentage", "rating", []))},
        **{f"scatter_{y}_vs_{x}_correlation": (p_value(x, y), "") for x, y in (
            ("discounted_price", "rating"), ("discounted_price", "rating_count"), ("discount_percentage", "rating"))}}),
    "segment_bundle": digests({
        "cluster_statistics": (ORACLES["cluster_stats"], ""), "cluster_interpretations": (ORACLES["cluster_labels"], "label, characteristics"),
        "cluster_category": (ORACLES["cluster_composition"], "main_category"), "cluster_discount_band": (ORACLES["cluster_bands"], "discount_band"),
        "cluster_summary": (ORACLES["cluster_summary"], "name"), "cluster_dashboard_profile": (ORACLES["cluster_profile"], ""),
        "cluster_facts": (ORACLES["cluster_facts"], "label, tier, categories, bands")}),
    "kmeans_segments": q(f"""SELECT count(*) AS rows, 0 AS misplaced, ({lloyd(3)}) AS inertia, true AS cost_agrees, true AS centres_are_means,
        true AS ids_by_size FROM cat"""),
    "k_sweep": f"""SELECT k, 'squared_euclidean' AS metric, CASE k WHEN 2 THEN ({lloyd(2)}) WHEN 3 THEN ({lloyd(3)}) WHEN 4 THEN ({lloyd(4)}) END AS inertia,
        true AS falls, true AS in_range, true AS bend_inside FROM range(2, 11) t(k)""",
    "segment_catalog": q(f"SELECT count(*) AS products, 3 AS clusters, 12 AS tables, ({lloyd(3)}) AS inertia FROM cat"),
    "sample_per_cluster": q("""SELECT product_id, cluster FROM cat
        QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY md5(concat(product_id, '42')), product_id) = 1"""),
    "segment_features_filled": q(f""", f AS (SELECT product_id, discounted_price, discount_percentage, rating, rating_count,
        ln(1 + rating_count) AS log_rating_count, ln(1 + discounted_price) AS log_discounted_price FROM uniq)
        SELECT product_id, {', '.join(f'round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM f)), 6) AS {c}' for c in FEATURES)} FROM f""", UNIQUE),
    "cluster_representatives": q(f""", {ZSCORES},
      c AS (SELECT cluster, {', '.join(f'avg({f}_z) AS {f}_c' for f in FEATURES)} FROM z GROUP BY 1),
      d AS (SELECT product_id, cluster, sqrt({' + '.join(f'pow({f}_z - {f}_c, 2)' for f in FEATURES)}) AS distance FROM z JOIN c USING (cluster)),
      r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY distance, product_id) AS rank FROM d)
      SELECT product_id, cluster, round(distance, 6) AS distance, rank FROM r WHERE rank <= 3"""),
    "scatter_p_value": p_value("actual_price", "rating"),
}


def principal(select: str) -> str:
    """Two principal components of the scaled features: a matrix squared until one direction is left, then deflated."""
    d = range(len(FEATURES))
    cells = [(i, j) for i in d for j in d]
    squared = ", ".join(f"{' + '.join(f'm{i}{k} * m{k}{j}' for k in d)} AS m{i}{j}" for i, j in cells)
    scaled = ", ".join(f"m{i}{j} / ({' + '.join(f'm{k}{k}' for k in d)}) AS m{i}{j}" for i, j in cells)
    start = [1.0, 0.7, 0.3, -0.2, 0.5, 0.4]

    def component(n: int, matrix: str) -> str:
        raw = ", ".join(f"{' + '.join(f'm{i}{j} * {start[j]}' for j in d)} AS y{i}" for i in d)
        norm = "sqrt(" + " + ".join(f"y{i} * y{i}" for i in d) + ")"
        value = " + ".join(f"x{i} * x{j} * m{i}{j}" for i, j in cells)
        return f"""power{n} AS (SELECT 0 AS step, {scaled} FROM {matrix} UNION ALL SELECT step + 1, {scaled}
              FROM (SELECT step, {squared} FROM power{n} WHERE step < 16)),
            unsigned{n} AS (SELECT [{', '.join(f'y{i} / {norm}' for i in d)}] AS x FROM (SELECT {raw} FROM power{n} WHERE step = 16)),
            vector{n} AS (SELECT {', '.join(f'x[{i + 1}] * s AS x{i}' for i in d)} FROM (SELECT x, sign(x[list_position(
              list_transform(x, lambda a: abs(a)), list_max(list_transform(x, lambda a: abs(a))))]) AS s FROM unsigned{n})),
            value{n} AS (SELECT {value} AS l FROM vector{n}, {matrix})"""

    covariances = ", ".join(f"covar_samp({FEATURES[i]}_z, {FEATURES[j]}_z) AS m{i}{j}" for i, j in cells)
    deflated = ", ".join(f"m{i}{j} - l * x{i} * x{j} AS m{i}{j}" for i, j in cells)
    return q(f""", {ZSCORES}, spread AS (SELECT {covariances} FROM z), {component(1, 'spread')},
        rest AS (SELECT {deflated} FROM spread, vector1, value1), {component(2, 'rest')} {select}""").replace("WITH ", "WITH RECURSIVE ", 1)


_TRACE = "(SELECT " + " + ".join(f"m{i}{i}" for i in range(len(FEATURES))) + " FROM spread)"
ORACLES |= {
    "pca_variance": principal(" UNION ALL ".join(f"SELECT 'PC{n}' AS component, round(l / {_TRACE}, 6) AS explained FROM value{n}" for n in (1, 2))),
    "pca_loadings": principal(" UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(a.x{i}, 6) AS PC1, round(b.x{i}, 6) AS PC2 FROM vector1 a, vector2 b" for i, f in enumerate(FEATURES))),
    "pca_projection": principal("SELECT product_id, cluster, " + ", ".join(
        f"round({' + '.join(f'{f}_z * v{n}.x{i}' for i, f in enumerate(FEATURES))}, 6) AS PC{n}" for n in (1, 2)) + " FROM z, vector1 v1, vector2 v2"),
}
