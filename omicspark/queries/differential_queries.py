"""Differential models: features = parts by 40, samples = nation x return flag, donors = nations, types = return flags."""

from pyspark.sql import functions as F

from ..operators import differential as df_
from ..operators import quasi as qs
from .base import query, r6

_JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
_COUNTS = f"(SELECT l_partkey % 40 AS feature, concat(c_nationkey, '_', l_returnflag) AS sample, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM {_JOINED} GROUP BY 1, 2)"
_SAMPLES = f"(SELECT DISTINCT concat(c_nationkey, '_', l_returnflag) AS sample, c_nationkey AS donor, l_returnflag AS type, CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS grp, c_nationkey % 7 AS age FROM {_JOINED})"
_EXPRESSED = f"(WITH s AS (SELECT sample, sum(count) AS size FROM {_COUNTS} GROUP BY 1), k AS (SELECT feature FROM {_COUNTS} JOIN s USING (sample) WHERE count * 1e6 / size >= 10000 GROUP BY 1 HAVING count(*) >= 20) SELECT k.feature, s.sample, log2((coalesce(count, 0) + 0.5) / (size + 1) * 1e6) AS value, coalesce(count, 0) AS count, CAST(size AS BIGINT) AS size FROM k CROSS JOIN s LEFT JOIN {_COUNTS} c ON c.feature = k.feature AND c.sample = s.sample)"


def joined(t):
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.withColumns({"sample": F.concat_ws("_", "c_nationkey", "l_returnflag"), "feature": F.col("l_partkey") % 40})


def feature_counts(t):
    return joined(t).groupBy("feature", "sample").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))


def samples(t):
    return joined(t).select("sample", F.col("c_nationkey").alias("donor"), F.col("l_returnflag").alias("type"), F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise("odd").alias("grp"), (F.col("c_nationkey") % 7).alias("age")).distinct()


def design(t):
    return df_.design_columns(samples(t), ["grp", "type"], ["age"], [("grp", "type")])


def values(t):
    return df_.expressed(feature_counts(t), samples(t), 10_000, 20)


@query("differential_design", f"SELECT sample, donor, type, grp, age, CAST(1 AS DOUBLE) AS intercept, CAST(grp = 'odd' AS DOUBLE) AS grp_odd, CAST(type = 'N' AS DOUBLE) AS type_N, CAST(type = 'R' AS DOUBLE) AS type_R, CAST(age AS DOUBLE) AS age_value, CAST(grp = 'odd' AND type = 'N' AS DOUBLE) AS grp_odd_x_type_N, CAST(grp = 'odd' AND type = 'R' AS DOUBLE) AS grp_odd_x_type_R FROM {_SAMPLES}")
def differential_design(t):
    df_.check_blocked(samples(t), "type", "donor", None)
    return design(t)[0]


@query("differential_expressed", f"SELECT feature, sample, round(value, 6) AS value, count, size FROM {_EXPRESSED}")
def differential_expressed(t):
    return values(t).withColumns(r6("value"))


@query("differential_slopes", f"SELECT feature, 'age' AS contrast, round(regr_slope(value, age), 6) AS estimate, round(sqrt(1 / regr_sxx(value, age)), 6) AS unscaled, round((regr_syy(value, age) - regr_slope(value, age) * regr_sxy(value, age)) / (count(*) - 2), 6) AS s2, CAST(count(*) - 2 AS INTEGER) AS df FROM {_EXPRESSED} JOIN {_SAMPLES} USING (sample) GROUP BY 1")
def differential_slopes(t):
    own, names = df_.design_columns(samples(t), numeric=["age"])
    return df_.fit_contrasts(values(t), own, names, {"age": [0, 1]}).withColumns(r6("estimate", "unscaled", "s2"))


def fits(t):
    own, names = design(t)
    v = df_.mean_variance_weights(values(t), own, names)
    rho = df_.consensus_correlation(v, own, names, "donor")
    return df_.fit_contrasts(v, own, names, {"odd": [0, 1, 0, 0, 0, 0, 0], "N_minus_R": [0, 0, 1, -1, 0, 0, 0], "odd_in_N": [0, 1, 0, 0, 0, 1, 0]}, "donor", rho)


@query("differential_contrasts")
def differential_contrasts(t):
    """Precision weights, block correlation of donors, contrasts with exact errors."""
    return fits(t)


@query("differential_table")
def differential_table(t):
    return df_.differential_table(fits(t))


@query("differential_weights")
def differential_weights(t):
    own, names = design(t)
    return df_.mean_variance_weights(values(t), own, names).select("feature", "sample", "weight")


@query("differential_gram", f"""WITH e AS (SELECT feature, sample, value - avg(value) OVER (PARTITION BY feature) AS e FROM {_EXPRESSED}) SELECT a.sample AS a, b.sample AS b, round(sum(a.e * b.e), 5) AS value FROM e a JOIN e b USING (feature) GROUP BY 1, 2""")
def differential_gram(t):
    own, names = df_.design_columns(samples(t))
    return df_.gram(values(t), own, names).withColumn("value", F.round("value", 5))


@query("differential_unwanted_factors")
def differential_unwanted_factors(t):
    own, names = design(t)
    return df_.unwanted_factors(values(t), own, names, ["grp_odd"], 2)


@query("differential_support", f"""WITH d AS (SELECT donor, count(*) FILTER (type = 'N') AS u, count(*) FILTER (type <> 'N') AS d FROM {_SAMPLES} GROUP BY 1) SELECT CAST(sum(u) AS BIGINT) AS n_up, CAST(sum(d) AS BIGINT) AS n_down, count(*) FILTER (u > 0) AS donors_up, count(*) FILTER (d > 0) AS donors_down, count(*) FILTER (u > 0 AND d > 0) AS donors_paired FROM d""")
def differential_support(t):
    own, names = df_.design_columns(samples(t), ["type"])
    return df_.contrast_support(own, names, [0, 1, 0], "donor")


@query("differential_combined", f"""WITH v AS (SELECT type, feature, donor, value, 1 + count % 5 AS w FROM {_EXPRESSED} JOIN {_SAMPLES} USING (sample)) SELECT feature, donor, round(sum(CASE type WHEN 'A' THEN value ELSE -value END), 6) AS value, round(1 / sum(1.0 / w), 6) AS weight FROM v WHERE type IN ('A', 'R') GROUP BY 1, 2 HAVING count(DISTINCT type) = 2""")
def differential_combined(t):
    v = values(t).join(samples(t), "sample").select("type", "feature", "donor", "value", (1 + F.col("count") % 5).alias("weight"))
    return df_.combined_response(v, {"A": 1, "R": -1}).withColumns(r6("value", "weight"))


@query("differential_paired")
def differential_paired(t):
    """The combined response of two types fitted once over donors, with its contrasts."""
    v = values(t).join(samples(t), "sample").select("type", "feature", "donor", "value", F.lit(1.0).alias("weight"))
    combined = df_.combined_response(v, {"A": 1, "R": -1}).withColumnRenamed("donor", "sample")
    donors, names = df_.design_columns(samples(t).select(F.col("donor").alias("sample"), "grp").distinct(), ["grp"])
    return df_.differential_table(df_.fit_contrasts(combined, donors, names, {"A_minus_R": [1, 0], "A_minus_R_odd": [0, 1]}))


@query("differential_statistics")
def differential_statistics(t):
    rows = df_.differential_table(fits(t))
    return rows.select("feature", "contrast", df_.contrast_statistic(F.when(F.col("feature") % 2 == 0, F.col("moderated_t")), F.col("p"), F.col("estimate")).alias("statistic"))


@query("differential_by_type", f"SELECT type, feature, 'age' AS contrast, round(regr_slope(value, age), 6) AS estimate, CAST(count(*) - 2 AS INTEGER) AS df FROM {_EXPRESSED} JOIN {_SAMPLES} USING (sample) GROUP BY 1, 2")
def differential_by_type(t):
    own, names = df_.design_columns(samples(t), numeric=["age"])
    v = values(t).join(samples(t).select("sample", "type"), "sample").select("type", "feature", "sample", "value")
    return df_.fit_by_type(v, own, names, {"age": [0, 1]}).select("type", "feature", "contrast", F.round("estimate", 6).alias("estimate"), "df")


@query("differential_type_support", f"WITH d AS (SELECT donor, count(*) AS n, count(DISTINCT type) AS k FROM {_SAMPLES} WHERE type IN ('A', 'R') GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n_samples, count(*) AS n_donors, count(*) FILTER (k = 2) AS n_paired FROM d")
def differential_type_support(t):
    return df_.type_support(samples(t), ["A", "R"])


def _quasi(t):
    own, names = df_.design_columns(samples(t), ["grp"])
    return qs.quasi_fits(values(t), own, names, {"odd": [0, 1]})


@query("differential_quasi")
def differential_quasi(t):
    """Dispersions shrunken to a trend, quasi F tests of odd against even donors."""
    return qs.quasi_table(_quasi(t), ["odd"])


def _by_kind(t, rows, factors, contrast, block=None):
    own, names = df_.design_columns(samples(t), factors)
    return qs.fit_by_kind(rows, own, names, {"c": contrast}, block, 10_000, 20)


@query("differential_kind_quasi")
def differential_kind_quasi(t):
    return _by_kind(t, feature_counts(t).withColumnRenamed("count", "value"), ["grp", "type"], [0, 1, 0, 0])


@query("differential_kind_weighted")
def differential_kind_weighted(t):
    """Counts with an intercept alone."""
    return _by_kind(t, feature_counts(t).withColumnRenamed("count", "value"), [], [1])


@query("differential_kind_blocked")
def differential_kind_blocked(t):
    return _by_kind(t, feature_counts(t).withColumnRenamed("count", "value"), ["type"], [0, 1, -1], "donor")


@query("differential_kind_linear", f"SELECT feature, 'c' AS contrast, round(avg(value) FILTER (grp = 'odd') - avg(value) FILTER (grp = 'even'), 6) AS estimate, CAST(count(*) - 2 AS INTEGER) AS df, 'linear' AS method FROM {_EXPRESSED} JOIN {_SAMPLES} USING (sample) GROUP BY 1")
def differential_kind_linear(t):
    return _by_kind(t, values(t), ["grp"], [0, 1]).select("feature", "contrast", F.round("estimate", 6).alias("estimate"), "df", "method")
