"""Queries of sampled, stored and laid-out forms of the catalog operators, each with the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import combinations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_oracles import FEATURES, MEASURES, PARSED, PRODUCTS, SQUARES, UNIQUE, ZSCORES, long, q, rounds
from catalog_queries import _on, _scaled_example, banded, clustered, listings, products, rounded, unique_products
from shelfline.operators import (association, charts, cleaning, cluster_quality, encoding, features, quality, quantile_summaries,
                                 recommend, sampling, search_index, segments, validation)
from shelfline.plans import segment_pipeline
from shelfline.schema import ALL_MEASURES, SEGMENT_FEATURES
from shelfline.session import shared_folder
from shelfline.sources import layout

CELLS = ["main_category", "discount_band"]
SOME = "main_category IN ('ECONOMY', 'PROMO', 'SMALL') AND discount_band IN ('10-30%', '50-70%')"
RULES = [
    validation.not_null("rating"), validation.not_null("rating_count"), validation.within("discount_percentage", 0, 60),
    validation.within("rating", 3, 5), validation.at_most("discounted_price", "actual_price"), validation.matches("product_id", "^P[0-9]+$"),
]


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _sampled_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    z = _scaled_example(spark, folder).select("product_id", "cluster", F.array(*[c + "_z" for c in SEGMENT_FEATURES]).alias("features"))
    return rounded(segments.silhouette_sampled(z, rows=400, groups=10, key="product_id"))


def _agreement(spark: SparkSession, folder: str) -> DataFrame:
    labels = clustered(spark, folder).withColumn("stars", F.floor("rating").cast("int"))
    return rounded(cluster_quality.labeling_agreement(features.add_discount_band(labels), ["cluster", "stars", "discount_band"]))


def _summaries(spark: SparkSession, folder: str) -> DataFrame:
    return quantile_summaries.quantile_summaries(banded(spark, folder), MEASURES, CELLS, 20)


def _merged_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Stored, read back, filtered and merged."""
    path = _fresh(spark, "summaries")
    _summaries(spark, folder).write.parquet(path)
    found = quantile_summaries.summary_quantiles(spark.read.parquet(path).where(SOME), [0.1, 0.5, 0.9])
    return rounded(found.select("column", "n", "error", *[F.col("q")[i].alias(f"q{p}") for i, p in enumerate((10, 50, 90))]))


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    """Codes and vectors of all products by a dictionary of those outside one category, so some values are unseen."""
    catalog = products(spark, folder)
    path = _fresh(spark, "dictionary")
    encoding.write_dictionary(encoding.fit_dictionary(catalog.where("main_category <> 'PROMO'"), "category"), path)
    coded = encoding.encode_all(catalog.select("product_id", "category"), ["category"], {"category": encoding.read_dictionary(spark, path)})
    dense = vector_to_array("category_code_vector")
    return coded.select("product_id", "category_code", F.size(dense).alias("places"), (F.array_position(dense, F.lit(1.0)) - 1).alias("place"))


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    parsed = cleaning.parse_measures(listings(spark, folder)).select("product_id", *MEASURES)
    found = validation.validated_write(parsed, _fresh(spark, "validated"), RULES)
    return found.withColumn("witnesses", F.array_join("witnesses", ","))


def _pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """What the saved and loaded pipeline has learnt, and how many products it places otherwise than the fitted one."""
    catalog = features.add_features(unique_products(spark, folder))
    path = _fresh(spark, "segment-pipeline")
    model = segment_pipeline.fit_segments(catalog, 3, restarts=2)
    segment_pipeline.save_segments(model, path)
    loaded = segment_pipeline.load_segments(path)
    fill, scale = loaded.stages[0], loaded.stages[1]
    learnt = spark.createDataFrame(list(zip(SEGMENT_FEATURES, fill.getOrDefault("medians"), scale.getOrDefault("means"), scale.getOrDefault("deviations"))),
                                   "feature string, median double, mean double, deviation double")
    both = segment_pipeline.place_products(loaded, segment_pipeline.place_products(model, catalog).withColumnRenamed("cluster", "before"))
    moved = both.agg(F.struct(F.count("*").alias("rows"), F.count_if(F.col("before") != F.col("cluster")).alias("moved")))
    return rounded(learnt.withColumn("m", moved.scalar()).select("feature", "median", "mean", "deviation", "m.rows", "m.moved"))


def _indexed(term: str, literal: bool) -> Callable:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path, catalog = _fresh(spark, "index"), products(spark, folder)
        search_index.write_index(catalog, path)
        return search_index.search_indexed(catalog, path, term, literal=literal).select("product_id", "product_name")
    return query


def _laid_out(spark: SparkSession, folder: str) -> DataFrame:
    path = _fresh(spark, "layout")
    layout.write_clustered(products(spark, folder).select("product_id", *MEASURES), path)
    found = spark.read.parquet(path).where("discounted_price between 5000 and 20000 and discount_percentage between 20 and 60")
    return rounded(found.select("product_id", "discounted_price", "discount_percentage"))


def _chosen_k(spark: SparkSession, folder: str) -> DataFrame:
    """The choice of K over stand-in clusterings: discounts cut into k parts of one width."""
    cut = [F.struct(F.lit(k).alias("k"), F.least(F.floor(F.col("discount_percentage") * k / 100.0), F.lit(k - 1)).alias("part")) for k in range(2, 9)]
    parts = products(spark, folder).select("discount_percentage", F.inline(F.array(*cut)))
    inertia = parts.groupBy("k", "part").agg((F.var_pop("discount_percentage") * F.count("*")).alias("v")).groupBy("k").agg(F.sum("v").alias("inertia"))
    bent = segments.elbow_table(inertia)
    chosen = segments.choose_k([(r["k"], r["inertia"], None) for r in inertia.collect()])
    return rounded(bent.withColumn("chosen", F.col("k") == chosen), 3)


def _numeric(spark: SparkSession, folder: str) -> DataFrame:
    wanted = [*ALL_MEASURES, "product_name", "is_premium", "absent"]
    return spark.createDataFrame([(c,) for c in quality.numeric_columns(products(spark, folder), wanted)], "name string")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silhouette_sampled": _sampled_silhouette,
    "labeling_agreement": _agreement,
    "quantile_summaries": lambda s, d: rounded(_summaries(s, d).select(*CELLS, "column", "n", "error", F.inline("points"))),
    "merged_quantiles": _merged_quantiles,
    "kde_binned": _on(products, lambda df: charts.kde_binned(df, ["discounted_price", "rating"]), 8),
    "scatter_panels": _on(clustered, lambda df: sampling.scatter_panels(df, 300, hue="cluster")),
    "weighted_sample": _on(products, lambda df: sampling.priority_sample(df, 200, weight="rating_count").select("product_id", "estimate")),
    "corr_kendall_sampled": _on(products, lambda df: association.kendall_sampled(df, MEASURES, rows=1000, block=100)),
    "category_encoding": _encoded,
    "validation_report": _validated,
    "segment_pipeline": _pipeline,
    "product_search_indexed": _indexed("RING", True),
    "product_search_indexed_pattern": _indexed("^bl.*e.* bolt", False),
    "clustered_layout": _laid_out,
    "value_picks": _on(products, recommend.value_picks),
    "bullet_counts": _on(listings, lambda df: features.add_bullet_count(df, "review_content", ",").select("product_id", "listing_ord", "bullet_count")),
    "rec_better_rated_nearby": _on(products, lambda df: recommend.better_rated_nearby(df, 3), 2),
    "chosen_k": _chosen_k,
    "numeric_columns": _numeric,
}

ORACLES: dict[str, str] = {}

ORACLES["silhouette_sampled"] = q(f""", {ZSCORES},
  s AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY md5(concat(product_id, '42')), product_id) - 1 AS place,
               count(*) OVER (PARTITION BY cluster) AS size, count(*) OVER () AS total FROM z),
  k AS (SELECT *, place % 10 AS part FROM s WHERE place < greatest(least(size, 50), ceil(CAST(400 AS DOUBLE) * size / total))),
  d AS (SELECT a.product_id, a.cluster AS own, a.part AS own_part, b.cluster AS other, b.part, sum(sqrt({SQUARES})) AS d, count(*) AS m
        FROM k a CROSS JOIN k b GROUP BY ALL),
  e AS (SELECT out, product_id, own, other, sum(d) AS d, sum(m) AS m FROM d CROSS JOIN (SELECT unnest(range(-1, 10)) AS out)
        WHERE own_part <> out AND part <> out GROUP BY ALL),
  ab AS (SELECT out, product_id, own, max(CASE WHEN own = other THEN d / nullif(m - 1, 0) END) AS a, max(CASE WHEN own = other THEN m END) AS n,
                min(CASE WHEN own <> other THEN d / m END) AS b FROM e GROUP BY ALL),
  c AS (SELECT out, own, avg(CASE WHEN n > 1 THEN coalesce((b - a) / greatest(a, b), 0) ELSE 0 END) AS s FROM ab GROUP BY ALL),
  sizes AS (SELECT cluster, any_value(size) AS size, any_value(total) AS total, count(*) AS n FROM k GROUP BY 1),
  t AS (SELECT out, sum(s * size) / sum(size) AS s FROM c JOIN sizes ON own = cluster GROUP BY 1),
  r AS (SELECT max(s) FILTER (out < 0) AS silhouette, sqrt(var_pop(s) FILTER (out >= 0) * (count(*) FILTER (out >= 0) - 1)
               * (1 - (SELECT sum(n) FROM sizes) / (SELECT CAST(max(total) AS DOUBLE) FROM sizes))) AS e FROM t)
  SELECT round(silhouette, 6) AS silhouette, round(e, 6) AS std_error, round(silhouette - 1.959963984540054 * e, 6) AS low,
         round(silhouette + 1.959963984540054 * e, 6) AS high, (SELECT CAST(sum(n) AS BIGINT) FROM sizes) AS sampled,
         (SELECT max(total) FROM sizes) AS rows FROM r""")


def _pairs_of(count: str) -> str:
    return f"({count} * ({count} - 1) / 2.0)"


def _agreement_sql(a: str, b: str, names: tuple[str, str]) -> str:
    return f"""SELECT '{names[0]}' AS first, '{names[1]}' AS second, rows, round((every + 2 * alike - pa - pb) / every, 6) AS rand,
      round((alike - pa * pb / every) / ((pa + pb) / 2 - pa * pb / every), 6) AS adjusted_rand, round(vi, 6) AS variation_of_information FROM (
      SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum({_pairs_of('n')}) AS DOUBLE) AS alike, CAST({_pairs_of('sum(n)')} AS DOUBLE) AS every,
        (SELECT CAST(sum({_pairs_of('m')}) AS DOUBLE) FROM (SELECT count(*) AS m FROM l GROUP BY {a})) AS pa,
        (SELECT CAST(sum({_pairs_of('m')}) AS DOUBLE) FROM (SELECT count(*) AS m FROM l GROUP BY {b})) AS pb,
        -sum(n / t * (ln(n / na) + ln(n / nb))) AS vi FROM (
          SELECT CAST(count(*) AS DOUBLE) AS n, CAST((SELECT count(*) FROM l) AS DOUBLE) AS t, any_value(na) AS na, any_value(nb) AS nb
          FROM (SELECT *, count(*) OVER (PARTITION BY {a}) AS na, count(*) OVER (PARTITION BY {b}) AS nb FROM l) GROUP BY {a}, {b}))"""


_LABELS = {"cluster": "cluster", "stars": "CAST(floor(rating) AS INT)", "discount_band": "discount_band"}
ORACLES["labeling_agreement"] = " UNION ALL ".join(
    "SELECT * FROM (" + q(f""", l AS (SELECT {_LABELS[x]} AS a, {_LABELS[y]} AS b FROM cat WHERE discount_band IS NOT NULL)
    {_agreement_sql('a', 'b', (x, y))}""") + ")" for x, y in combinations(_LABELS, 2))

_POINTS = f"""{long(MEASURES, 'main_category, discount_band')},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY main_category, discount_band, "column" ORDER BY value) - 1 AS i,
                    count(*) OVER (PARTITION BY main_category, discount_band, "column") AS n
             FROM long WHERE main_category IS NOT NULL AND discount_band IS NOT NULL),
  chosen AS (SELECT DISTINCT main_category, discount_band, "column", n, i, value FROM ranked
             JOIN (SELECT unnest(range(0, 21)) AS j) ON i = (j * (n - 1)) // 20),
  weighed AS (SELECT *, i - lag(i, 1, -1) OVER (PARTITION BY main_category, discount_band, "column" ORDER BY i) AS weight FROM chosen),
  points AS (SELECT *, max(weight) OVER (PARTITION BY main_category, discount_band, "column") - 1 AS error FROM weighed)"""
ORACLES["quantile_summaries"] = q(f""", {_POINTS}
  SELECT main_category, discount_band, "column", n, error, round(value, 6) AS value, weight FROM points""")
ORACLES["merged_quantiles"] = q(f""", {_POINTS},
  m AS (SELECT "column", value, sum(weight) AS w FROM points WHERE {SOME} GROUP BY ALL),
  c AS (SELECT *, sum(w) OVER (PARTITION BY "column" ORDER BY value) AS upto, sum(w) OVER (PARTITION BY "column") AS total FROM m),
  e AS (SELECT "column", CAST(sum(error) AS BIGINT) AS error FROM (
          SELECT DISTINCT main_category, discount_band, "column", error FROM points WHERE {SOME}) GROUP BY 1)
  SELECT "column", CAST(any_value(total) AS BIGINT) AS n, any_value(error) AS error, {', '.join(
    f'round(min(value) FILTER (upto > floor((total - 1) * CAST(0.{p} AS DOUBLE))), 6) AS q{p}0' for p in (1, 5, 9))}
  FROM c JOIN e USING ("column") GROUP BY 1""")

ORACLES["kde_binned"] = q(f""", {long(['discounted_price', 'rating'])},
  s AS (SELECT "column", count(*) AS total, stddev_samp(value) * pow(count(*), -0.2) AS h, min(value) AS lo, (max(value) - min(value)) / 299 AS step
        FROM long GROUP BY 1),
  g AS (SELECT *, step / refine AS fine FROM (SELECT *, greatest(1, least(64, CAST(ceil(10.0 * step / h) AS INT))) AS refine FROM s)),
  placed AS (SELECT g.*, (value - lo) / fine AS spot, least(greatest(floor((value - lo) / fine), 0), 299 * refine - 1) AS l
             FROM long JOIN g ON long."column" = g."column"),
  bins AS (SELECT "column", bin, sum(w) AS w FROM (SELECT "column", l AS bin, 1 - (spot - l) AS w FROM placed
           UNION ALL SELECT "column", l + 1, spot - l FROM placed) GROUP BY ALL HAVING sum(w) > 0)
  SELECT g."column", CAST(point AS INT) AS point, round(any_value(lo) + point * any_value(step), 8) AS x,
         round(sum(w * exp(-0.5 * pow((point * refine - bin) * fine / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 8) AS density
  FROM g JOIN bins b ON g."column" = b."column" CROSS JOIN (SELECT unnest(range(300)) AS point) GROUP BY g."column", point""")

_UNIT = "((CAST('0x' || substr(md5(concat(product_id, '42')), 1, 13) AS BIGINT) + CAST(1 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))"
ORACLES["scatter_panels"] = q(f""", s AS (SELECT * FROM cat ORDER BY 1 / {_UNIT} DESC, product_id LIMIT 300)
  """ + " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round({a}, 6) AS x_value, round({b}, 6) AS y_value, product_id, cluster AS hue FROM s"
                           for a, b in combinations(MEASURES, 2)))
ORACLES["weighted_sample"] = q(f""", p AS (SELECT product_id, rating_count AS w, rating_count / {_UNIT} AS priority FROM cat WHERE rating_count > 0),
  r AS (SELECT *, row_number() OVER (ORDER BY priority DESC, product_id) AS place FROM p)
  SELECT product_id, round(greatest(w, coalesce((SELECT priority FROM r WHERE place = 201), 0)), 6) AS estimate FROM r WHERE place <= 200""")


def _tau(s: str, x: str, y: str) -> str:
    return f"{s} / nullif(sqrt({x}) * sqrt({y}), 0)"


ORACLES["corr_kendall_sampled"] = q(f""", s AS (SELECT *, row_number() OVER (ORDER BY 1 / {_UNIT} DESC, product_id) - 1 AS place FROM cat),
  b AS (SELECT *, place // 100 AS block FROM s WHERE place < 1000),
  j AS ({' UNION ALL '.join(f'''SELECT a.block, '{x}' AS row, '{y}' AS col, sum(sign(a.{x} - b.{x}) * sign(a.{y} - b.{y})) AS s,
      sum(abs(sign(a.{x} - b.{x}))) AS ux, sum(abs(sign(a.{y} - b.{y}))) AS uy FROM b a JOIN b ON a.block = b.block AND a.place < b.place GROUP BY 1'''
      for x, y in combinations(MEASURES, 2))}),
  w AS (SELECT *, sum(s) OVER p AS ts, sum(ux) OVER p AS tx, sum(uy) OVER p AS ty FROM j WINDOW p AS (PARTITION BY row, col)),
  o AS (SELECT row, col, {_tau('ts', 'tx', 'ty')} AS v, {_tau('(ts - s)', '(tx - ux)', '(ty - uy)')} AS out FROM w),
  r AS (SELECT row, col, any_value(v) AS v, coalesce(sqrt(var_pop(out) * (count(*) - 1)), 0) AS e FROM o GROUP BY ALL)
  SELECT row, col, round(v, 6) AS value, round(e, 6) AS std_error, round(v - 1.959963984540054 * e, 6) AS low,
         round(v + 1.959963984540054 * e, 6) AS high, (SELECT count(*) FROM b) AS sampled FROM r""")

ORACLES["category_encoding"] = q(""", d AS (SELECT category, row_number() OVER (ORDER BY n DESC, category) - 1 AS code FROM (
      SELECT category, count(*) AS n FROM cat WHERE main_category <> 'PROMO' GROUP BY 1)),
  c AS (SELECT product_id, coalesce(code, (SELECT count(*) FROM d)) AS code FROM cat LEFT JOIN d USING (category))
  SELECT product_id, code AS category_code, CAST((SELECT count(*) + 1 FROM d) AS INTEGER) AS places, code AS place FROM c""")


def _rule_sql(name: str, fails: str) -> str:
    keys = f"""SELECT min(product_id) AS k FROM parsed WHERE {fails} GROUP BY CAST('0x' || substr(md5(product_id), 1, 7) AS BIGINT) % 3"""
    return f"""SELECT '{name}' AS "constraint", count(*) AS rows, count(*) FILTER ({fails}) AS failed, count(*) FILTER ({fails}) = 0 AS passed,
      coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM ({keys})), '') AS witnesses FROM parsed"""


ORACLES["validation_report"] = q(" UNION ALL ".join(_rule_sql(rule.name, fails) for rule, fails in zip(RULES, [
    "rating IS NULL", "rating_count IS NULL", "NOT discount_percentage BETWEEN 0 AND 60", "NOT rating BETWEEN 3 AND 5",
    "discounted_price > actual_price", "NOT regexp_matches(product_id, '^P[0-9]+$')"])), PARSED)

ORACLES["segment_pipeline"] = q(f""", f AS (SELECT product_id, discounted_price, discount_percentage, rating, rating_count,
      ln(1 + rating_count) AS log_rating_count, ln(1 + discounted_price) AS log_discounted_price FROM uniq),
  m AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in FEATURES)} FROM f)
  """ + " UNION ALL ".join(f"""SELECT '{c}' AS feature, round(any_value(m.{c}), 6) AS median, round(avg(coalesce(f.{c}, m.{c})), 6) AS mean,
      round(stddev_pop(coalesce(f.{c}, m.{c})), 6) AS deviation, count(*) AS rows, 0 AS moved FROM f, m""" for c in FEATURES), UNIQUE)
ORACLES["product_search_indexed"] = q("SELECT product_id, product_name FROM cat WHERE contains(lower(product_name), 'ring')")
ORACLES["product_search_indexed_pattern"] = q("SELECT product_id, product_name FROM cat WHERE regexp_matches(product_name, '^bl.*e.* bolt', 'i')")
ORACLES["clustered_layout"] = q(f"""SELECT product_id, {rounds(['discounted_price', 'discount_percentage'])} FROM cat
  WHERE discounted_price BETWEEN 5000 AND 20000 AND discount_percentage BETWEEN 20 AND 60""")
ORACLES["value_picks"] = q(f"""SELECT main_category, CAST(row_number() OVER (PARTITION BY main_category
    ORDER BY discount_percentage DESC, rating DESC, rating_count DESC, product_id) AS INT) AS rank, product_id,
    {rounds(['discounted_price', 'discount_percentage', 'rating', 'rating_count'])}
  FROM cat WHERE discount_percentage >= 50 AND rating >= 4 QUALIFY rank <= 5""")
ORACLES["bullet_counts"] = q("""SELECT product_id, listing_ord,
    CAST(len(list_filter(string_split(review_content, ','), lambda x: trim(x) <> '')) AS INT) AS bullet_count FROM raw""", PARSED)
ORACLES["rec_better_rated_nearby"] = q("""SELECT t.product_id, c.product_id AS recommended_product_id,
    CAST(row_number() OVER (PARTITION BY t.product_id ORDER BY c.rating DESC, c.rating_count DESC, c.product_id) AS INT) AS rank,
    round(c.discounted_price, 2) AS recommended_price, round(c.rating, 2) AS recommended_rating, c.main_category AS recommended_category
  FROM cat t JOIN cat c ON t.main_category = c.main_category AND c.rating > t.rating AND c.discounted_price BETWEEN
    t.discounted_price * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE)) AND t.discounted_price * (CAST(1 AS DOUBLE) + CAST(0.2 AS DOUBLE))
  QUALIFY rank <= 3""")
ORACLES["chosen_k"] = q(""", p AS (SELECT k, least(floor(discount_percentage * k / CAST(100 AS DOUBLE)), k - 1) AS part, discount_percentage AS v
        FROM cat CROSS JOIN (SELECT CAST(unnest(range(2, 9)) AS INT) AS k)),
  i AS (SELECT k, sum(s) AS inertia FROM (SELECT k, part, var_pop(v) * count(*) AS s FROM p GROUP BY ALL) GROUP BY 1),
  b AS (SELECT *, lead(inertia) OVER (ORDER BY k) - 2 * inertia + lag(inertia) OVER (ORDER BY k) AS bend FROM i)
  SELECT k, round(inertia, 3) AS inertia, round(bend, 3) AS bend, coalesce(bend = (SELECT max(bend) FROM b), false) AS chosen FROM b""")
ORACLES["numeric_columns"] = q(" UNION ALL ".join(
    f"SELECT '{c}' AS name FROM (SELECT typeof({c}) AS t FROM cat LIMIT 1) WHERE t IN ('DOUBLE', 'INTEGER', 'BIGINT', 'BOOLEAN')"
    for c in [*ALL_MEASURES, "product_name", "is_premium"]), PRODUCTS)
