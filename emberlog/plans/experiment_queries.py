"""Experiment assignment and analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.functions import special
from emberlog.operators import experiment as ex
from emberlog.operators import stats as st
from emberlog.operators.ordered import exact_percentiles
from emberlog.plans.registry import query
from emberlog.sources.tables import EXPERIMENT_NAME, VARIANT_WEIGHTS, experiment_rows, table

METRICS = ("f1_score", "accuracy", "latency_ms")


def _u(user: str, experiment: str = EXPERIMENT_NAME) -> str:
    return (
        f"CAST('0x' || substr(md5(concat(CAST({user} AS VARCHAR), '{experiment}')), 1, 13) AS BIGINT) / 4503599627370496.0"
    )


_FIVE_WAY = """CASE WHEN u < 0.3 THEN 'control' WHEN u < 0.55 THEN 'catboost' WHEN u < 0.75 THEN 'xgb_v1'
  WHEN u < 0.9 THEN 'xgb_v2' ELSE 'xgb_v3' END"""

EXPERIMENT = f"""exp AS (SELECT *, {_FIVE_WAY} AS variant_id FROM (
  SELECT o_orderkey AS row_id, o_custkey AS user_id, o_orderdate AS ts, round(o_totalprice / 10000.0, 6) AS latency_ms,
    round((o_orderkey % 1000) / 1000.0, 3) AS f1_score,
    round(((o_orderkey * 37 + o_custkey) % 1009) / 1009.0, 6) AS accuracy,
    CAST(o_orderstatus = 'F' AS INTEGER) AS success, o_orderpriority AS segment, o_orderstatus AS status,
    {_u('o_custkey')} AS u FROM orders)),
long AS (SELECT variant_id, row_id, 'f1_score' AS metric, f1_score AS value FROM exp
  UNION ALL SELECT variant_id, row_id, 'accuracy', accuracy FROM exp
  UNION ALL SELECT variant_id, row_id, 'latency_ms', latency_ms FROM exp),
mom AS (SELECT metric, variant_id, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std FROM long GROUP BY 1, 2),
pairs AS (SELECT a.metric, a.variant_id AS variant_a, b.variant_id AS variant_b, a.n AS n_a, b.n AS n_b,
    a.mean AS mean_a, b.mean AS mean_b, a.std AS std_a, b.std AS std_b, a.mean - b.mean AS difference,
    sqrt(((a.n - 1) * a.std ** 2 + (b.n - 1) * b.std ** 2) / (a.n + b.n - 2)) AS pooled
  FROM mom a JOIN mom b ON a.metric = b.metric AND a.variant_id < b.variant_id)"""




def _over_angles(term: str) -> str:
    """DuckDB sum of ``term`` of s, the squared sine of an angle, over a double exponential rule."""
    u, turn = "(-3.3e0 + 3e-2 * k)", "(pi() / 2 * sinh(-3.3e0 + 3e-2 * k))"
    weight = f"pi() / 8 * cosh({u}) / cosh({turn}) ** 2 * 3e-2"
    s = f"sin(pi() / 2 / (1 + exp(-2 * {turn}))) ** 2"
    return f"list_sum(list_transform(range(0, 221), lambda k: {weight} * {term.replace('{s}', s)}))"


def _t_p(t: str, df: str) -> str:
    return f"least(1, 2 * {_over_angles(f'exp(-({df}) / 2 * ln(1 + ({t}) ** 2 / (({df}) * {{s}})))')})"


def _phi(x: str) -> str:
    tail = _over_angles(f"exp(0 - ({x}) ** 2 / (2 * {{s}}))")
    return f"CASE WHEN {x} < 0 THEN {tail} ELSE 1 - {tail} END"


def _t_limit(z: float, df: str) -> str:
    """Quantile of t by its expansion in 1 / df."""
    a, b, c = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    return f"({z!r}::DOUBLE + {a!r}::DOUBLE / ({df}) + {b!r}::DOUBLE / ({df}) ** 2 + {c!r}::DOUBLE / ({df}) ** 3)"


def rows(spark, sf_dir):
    return experiment_rows(spark, sf_dir)


def long_rows(spark, sf_dir, metrics=METRICS):
    return st.metrics_long(rows(spark, sf_dir), ["variant_id", "row_id"], metrics)


@query("variant_assignment", f"WITH {EXPERIMENT} SELECT row_id, variant_id FROM exp")
def variant_assignment(spark, sf_dir):
    return rows(spark, sf_dir).select("row_id", "variant_id")


@query(
    "two_way_traffic_split",
    f"""SELECT CASE WHEN u < 0.7 THEN 'a' ELSE 'b' END AS arm, CASE WHEN v < 0.7 THEN 'a' WHEN v < 0.9 THEN 'b' ELSE 'c' END AS arm3,
  count(*) AS n FROM (SELECT {_u('l_orderkey', 'requests')} AS u, {_u('l_orderkey', 'three')} AS v FROM lineitem) GROUP BY 1, 2""",
)
def two_way_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    two = ex.assign_variant(lines, "l_orderkey", "requests", {"a": 0.7, "b": 0.3}, "arm")
    three = ex.assign_variant(two, "l_orderkey", "three", {"a": 0.7, "b": 0.2, "c": 0.1}, "arm3")
    return three.groupBy("arm", "arm3").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sticky_assignment",
    f"""WITH {EXPERIMENT}, stored AS (SELECT user_id, max(ts) AS assigned_at, any_value(variant_id) AS stored
  FROM exp WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT e.row_id, CASE WHEN e.ts >= assigned_at AND e.ts < assigned_at + INTERVAL 7 DAY THEN stored
    WHEN {_u('e.user_id', 'second')} < 0.7 THEN 'new_a' ELSE 'new_b' END AS variant_id,
  coalesce(e.ts >= assigned_at AND e.ts < assigned_at + INTERVAL 7 DAY, false) AS was_sticky
FROM exp e LEFT JOIN stored s USING (user_id)""",
)
def sticky_assignment(spark, sf_dir):
    requests = rows(spark, sf_dir)
    stored = (
        requests.where(F.col("timestamp") < F.lit("1998-01-01").cast("timestamp"))
        .groupBy("user_id")
        .agg(F.max("timestamp").alias("assigned_at"), F.max_by("variant_id", "timestamp").alias("variant_id"))
    )
    out = ex.assign_sticky(
        requests.drop("variant_id"), stored, "user_id", "timestamp", "second", {"new_a": 0.7, "new_b": 0.3}
    )
    return out.select("row_id", "variant_id", "was_sticky")


@query(
    "unassigned_users",
    "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')",
)
def unassigned_users(spark, sf_dir):
    requests = rows(spark, sf_dir)
    known = requests.where(F.col("timestamp") < F.lit("1996-01-01").cast("timestamp")).select("user_id").distinct()
    return ex.unassigned_users(requests, known, "user_id")


@query(
    "canary_ramp",
    f"""SELECT canary_share, CASE WHEN u < canary_share THEN 'challenger' ELSE 'control' END AS variant_id, count(*) AS n FROM (
  SELECT {_u('user_id', 'canary')} AS u, CASE CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0) AS INTEGER)
    WHEN 0 THEN 0.1::DOUBLE WHEN 1 THEN 0.3 WHEN 2 THEN 0.5 ELSE 1.0 END AS canary_share FROM events) GROUP BY 1, 2""",
)
def canary_ramp(spark, sf_dir):
    out = ex.canary_ramp(table(spark, sf_dir, "events"), "user_id", "ts", "canary", "2024-01-01", 7)
    return out.groupBy("canary_share", "variant_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_check",
    f"""WITH {EXPERIMENT}, w(variant_id, w) AS (VALUES ('control', 0.3::DOUBLE), ('catboost', 0.25), ('xgb_v1', 0.2), ('xgb_v2', 0.15), ('xgb_v3', 0.1)),
c AS (SELECT variant_id, count(*) AS n, sum(count(*)) OVER () AS total FROM exp GROUP BY 1)
SELECT variant_id, n, round(n / total::DOUBLE, 6) AS share, w AS expected_share,
  round((n - w * total) ** 2 / (w * total), 5) AS chi_term FROM c JOIN w USING (variant_id)""",
)
def split_check(spark, sf_dir):
    out = ex.split_check(rows(spark, sf_dir), VARIANT_WEIGHTS)
    return out.select(
        "variant_id", "n", F.round("share", 6).alias("share"), F.round("expected_share", 6).alias("expected_share"),
        F.round("chi_term", 5).alias("chi_term"),
    )


@query(
    "split_fit",
    f"""WITH {EXPERIMENT}, w(variant_id, w) AS (VALUES ('control', 0.3::DOUBLE), ('catboost', 0.25), ('xgb_v1', 0.2), ('xgb_v2', 0.15), ('xgb_v3', 0.1)),
c AS (SELECT variant_id, w, (SELECT count(*) FROM exp WHERE exp.variant_id = w.variant_id)::DOUBLE AS n, (SELECT count(*) FROM exp)::DOUBLE AS total FROM w),
x AS (SELECT sum((n - w * total) ** 2 / (w * total)) AS chi FROM c)
SELECT round(chi, 5) AS chi_square, 4 AS degrees_of_freedom, round(exp(0 - chi / 2) * (1 + chi / 2), 6) AS p_value,
  exp(0 - chi / 2) * (1 + chi / 2) >= 0.05 AS fits FROM x""",
)
def split_fit(spark, sf_dir):
    out = ex.split_fit(ex.split_check(rows(spark, sf_dir), VARIANT_WEIGHTS), VARIANT_WEIGHTS)
    return out.withColumns({"chi_square": F.round("chi_square", 5), "p_value": F.round("p_value", 6)})


@query(
    "variant_summary",
    f"""WITH {EXPERIMENT} SELECT metric, variant_id, count(value) AS n, round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS std,
  round(median(value), 5) AS median, round(quantile_cont(value, 0.95), 5) AS p95, round(quantile_cont(value, 0.99), 5) AS p99
FROM long GROUP BY 1, 2""",
)
def variant_summary(spark, sf_dir):
    out = ex.variant_summary(rows(spark, sf_dir), METRICS)
    return out.select("metric", "variant_id", "n", *[F.round(c, 5).alias(c) for c in ("mean", "std", "median", "p95", "p99")])


@query(
    "traffic_share",
    f"""WITH {EXPERIMENT} SELECT variant_id, CAST(sum(success) AS BIGINT) AS successes,
  round(avg(CASE WHEN success = 1 THEN latency_ms END), 5) AS mean_latency,
  round(100.0 * sum(success) / sum(sum(success)) OVER (), 5) AS share_percent FROM exp GROUP BY 1""",
)
def traffic_share(spark, sf_dir):
    out = st.traffic_share(rows(spark, sf_dir), "variant_id", F.col("success") == 1, "latency_ms")
    return out.select("variant_id", "successes", F.round("mean_latency", 5).alias("mean_latency"),
                      F.round("share_percent", 5).alias("share_percent"))


@query(
    "faster_variant",
    f"""WITH {EXPERIMENT} SELECT variant_a, variant_b, CASE WHEN mean_a < mean_b THEN variant_a ELSE variant_b END AS faster,
  round(abs(difference), 5) AS difference, round(100 * abs(difference) / greatest(mean_a, mean_b), 5) AS percent
FROM pairs WHERE metric = 'latency_ms'""",
)
def faster_variant(spark, sf_dir):
    out = st.faster_variant(rows(spark, sf_dir), "variant_id", "latency_ms")
    return out.withColumns({c: F.round(c, 5) for c in ("difference", "percent")})


@query(
    "daily_prediction_counters",
    f"""WITH {EXPERIMENT} SELECT variant_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS total_predictions,
  count(*) FILTER (success = 0) AS prediction_0, count(*) FILTER (success = 1) AS prediction_1,
  round(sum(latency_ms), 6) AS total_latency FROM exp GROUP BY 1, 2""",
)
def daily_counters(spark, sf_dir):
    out = st.daily_counters(rows(spark, sf_dir), "timestamp", "variant_id", "success", "latency_ms")
    return out.withColumns({"day": F.date_format("day", "yyyy-MM-dd"), "total_latency": F.round("total_latency", 6)})


@query(
    "weekly_counter_rollup",
    f"""WITH {EXPERIMENT} SELECT variant_id, count(*) AS total_predictions, count(*) FILTER (success = 0) AS prediction_0,
  count(*) FILTER (success = 1) AS prediction_1, round(avg(latency_ms), 5) AS avg_latency_ms
FROM exp WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM exp) - 7 GROUP BY 1""",
)
def weekly_rollup(spark, sf_dir):
    daily = st.daily_counters(rows(spark, sf_dir), "timestamp", "variant_id", "success", "latency_ms")
    return st.counters_rollup(daily, "variant_id").withColumn("avg_latency_ms", F.round("avg_latency_ms", 5))


@query("minimum_sample_gate", f"WITH {EXPERIMENT} SELECT variant_id, count(*) AS n, count(*) >= 1000 AS enough FROM exp GROUP BY 1")
def minimum_sample(spark, sf_dir):
    return st.minimum_sample_gate(rows(spark, sf_dir), ["variant_id"])


@query(
    "t_test_pooled",
    f"""WITH {EXPERIMENT} SELECT metric, variant_a, variant_b, n_a, n_b, round(difference, 6) AS difference,
  (n_a + n_b - 2)::DOUBLE AS df, round(pooled * sqrt(1.0 / n_a + 1.0 / n_b), 6) AS se,
  round(difference / (pooled * sqrt(1.0 / n_a + 1.0 / n_b)), 5) AS t, round(difference / pooled, 6) AS effect_size FROM pairs""",
)
def t_test_pooled(spark, sf_dir):
    out = ex.mean_differences(ex.moments(long_rows(spark, sf_dir)))
    return out.select(
        "metric", "variant_a", "variant_b", "n_a", "n_b", F.round("difference", 6).alias("difference"), "df",
        F.round("se", 6).alias("se"), F.round("t", 5).alias("t"), F.round("effect_size", 6).alias("effect_size"),
    )


@query(
    "t_test_welch",
    f"""WITH {EXPERIMENT}, e AS (SELECT *, std_a ** 2 / n_a AS ea, std_b ** 2 / n_b AS eb FROM pairs)
SELECT metric, variant_a, variant_b, round((ea + eb) ** 2 / (ea ** 2 / (n_a - 1) + eb ** 2 / (n_b - 1)), 3) AS df,
  round(difference / sqrt(ea + eb), 5) AS t, round(difference / sqrt((std_a ** 2 + std_b ** 2) / 2), 6) AS effect_size FROM e""",
)
def t_test_welch(spark, sf_dir):
    out = ex.mean_differences(ex.moments(long_rows(spark, sf_dir)), equal_var=False)
    return out.select(
        "metric", "variant_a", "variant_b", F.round("df", 3).alias("df"), F.round("t", 5).alias("t"),
        F.round("effect_size", 6).alias("effect_size"),
    )


_Z975 = special.normal_ppf(0.975)


def _nct(limit: str) -> str:
    """DuckDB noncentral t: the normal tail averaged over the scale's density."""
    s = "(low + (high - low) * (j + 5e-1) / 400)"
    density = f"exp((df - 1) * ln({s}) - df * ({s} ** 2 - 1) / 2)"
    scales = "range(0, 400)"
    inside = f"list_sum(list_transform({scales}, lambda j: {density} * ({_phi(f'({limit} * {s} - nc)')})))"
    return f"{inside} / list_sum(list_transform({scales}, lambda j: {density}))"


@query(
    "t_test_report",
    f"""WITH {EXPERIMENT},
e AS (SELECT *, (n_a + n_b - 2)::DOUBLE AS df, pooled * sqrt(1.0 / n_a + 1.0 / n_b) AS se, difference / pooled AS effect FROM pairs),
x AS (SELECT *, difference / se AS t, effect * sqrt(n_a::DOUBLE * n_b / (n_a + n_b)) AS nc, {_t_limit(_Z975, 'df')} AS critical,
  greatest(1e-9, 1 - 12 / sqrt(2 * df)) AS low, 1 + 12 / sqrt(2 * df) AS high FROM e),
r AS (SELECT *, {_t_p('t', 'df')} AS p, 1 - {_nct('critical')} AS power, {_nct('(-critical)')} AS lower FROM x)
SELECT metric, variant_a, variant_b, n_a, n_b, df, round(t, 5) AS t, round(p, 6) AS p_value, round(critical, 6) AS critical,
  round(power, 5) AS power, round(power + lower, 5) AS power_two_sided, round(effect, 6) AS effect_size,
  round(difference - critical * se, 6) AS ci_low, round(difference + critical * se, 6) AS ci_high, p < 0.05 AS is_significant,
  CASE WHEN p >= 0.05 AND power < 0.8 THEN printf('{ex.INCONCLUSIVE}', power * 100, CAST(floor(n_a * 1.5) AS BIGINT))
    WHEN p >= 0.05 THEN '{ex.NO_DIFFERENCE}'
    WHEN abs(effect) < 0.02 THEN printf('{ex.SMALL_EFFECT.replace("{min_effect}", "0.02")}', effect)
    ELSE printf('{ex.IMPROVEMENT}', CASE WHEN difference > 0 THEN 'A' ELSE 'B' END, abs(effect), CASE WHEN difference > 0 THEN 'A' ELSE 'B' END)
  END AS recommendation FROM r""",
)
def t_test_report(spark, sf_dir):
    out = ex.t_tests(long_rows(spark, sf_dir))
    return out.select(
        "metric", "variant_a", "variant_b", "n_a", "n_b", "df", F.round("t", 5).alias("t"),
        *[F.round(c, 6).alias(c) for c in ("p_value", "critical", "effect_size", "ci_low", "ci_high")],
        F.round("power", 5).alias("power"), F.round("power_two_sided", 5).alias("power_two_sided"), "is_significant", "recommendation",
    )


@query(
    "chi_square_status",
    f"""WITH {EXPERIMENT}, c AS (SELECT variant_id, status, count(*)::DOUBLE AS c FROM exp GROUP BY 1, 2),
n AS (SELECT variant_id, sum(c) AS n FROM c GROUP BY 1), k AS (SELECT DISTINCT status FROM c),
cells AS (SELECT a.variant_id AS va, b.variant_id AS vb, a.n AS na, b.n AS nb, k.status,
    coalesce(ca.c, 0) AS ca, coalesce(cb.c, 0) AS cb
  FROM n a JOIN n b ON a.variant_id < b.variant_id CROSS JOIN k
  LEFT JOIN c ca ON ca.variant_id = a.variant_id AND ca.status = k.status
  LEFT JOIN c cb ON cb.variant_id = b.variant_id AND cb.status = k.status)
SELECT va AS variant_a, vb AS variant_b, count(*) - 1 AS degrees_of_freedom,
  round(sum((ca - na * (ca + cb) / (na + nb)) ** 2 / (na * (ca + cb) / (na + nb)) + (cb - nb * (ca + cb) / (na + nb)) ** 2 / (nb * (ca + cb) / (na + nb))), 5) AS chi_square,
  round(sqrt(sum((ca - na * (ca + cb) / (na + nb)) ** 2 / (na * (ca + cb) / (na + nb)) + (cb - nb * (ca + cb) / (na + nb)) ** 2 / (nb * (ca + cb) / (na + nb))) / any_value(na + nb)), 6) AS cramers_v
FROM cells WHERE ca + cb > 0 GROUP BY 1, 2""",
)
def chi_square_status(spark, sf_dir):
    out = ex.chi_square_pairs(rows(spark, sf_dir), "variant_id", "status")
    return out.select(
        "variant_a", "variant_b", "degrees_of_freedom", F.round("chi_square", 5).alias("chi_square"),
        F.round("cramers_v", 6).alias("cramers_v"),
    )


@query(
    "chi_square_success",
    f"""WITH {EXPERIMENT}, n AS (SELECT variant_id, count(*)::DOUBLE AS n, sum(success)::DOUBLE AS s FROM exp GROUP BY 1),
p AS (SELECT a.variant_id AS variant_a, b.variant_id AS variant_b, a.n AS na, b.n AS nb, a.s AS sa, b.s AS sb,
    a.n * (a.s + b.s) / (a.n + b.n) AS e, a.n + b.n AS t, a.s + b.s AS s FROM n a JOIN n b ON a.variant_id < b.variant_id)
SELECT variant_a, variant_b, round((abs(sa - e) - least(0.5, abs(sa - e))) ** 2
  * (1 / e + 1 / (na - e) + 1 / (s - e) + 1 / (nb - s + e)), 5) AS chi_square FROM p""",
)
def chi_square_success(spark, sf_dir):
    out = ex.chi_square_pairs(rows(spark, sf_dir), "variant_id", "success")
    return out.select("variant_a", "variant_b", F.round("chi_square", 5).alias("chi_square"))


_CELLS = f"""WITH {EXPERIMENT}, c AS (SELECT variant_id, status, count(*)::DOUBLE AS c FROM exp GROUP BY 1, 2),
n AS (SELECT variant_id, sum(c) AS n FROM c GROUP BY 1), k AS (SELECT DISTINCT status FROM c),
cells AS (SELECT a.variant_id AS va, b.variant_id AS vb, a.n AS na, b.n AS nb, k.status,
    coalesce(ca.c, 0) AS ca, coalesce(cb.c, 0) AS cb
  FROM n a JOIN n b ON a.variant_id < b.variant_id CROSS JOIN k
  LEFT JOIN c ca ON ca.variant_id = a.variant_id AND ca.status = k.status
  LEFT JOIN c cb ON cb.variant_id = b.variant_id AND cb.status = k.status)"""
_TERM = """(ca - na * (ca + cb) / (na + nb)) ** 2 / (na * (ca + cb) / (na + nb)) + (cb - nb * (ca + cb) / (na + nb)) ** 2 / (nb * (ca + cb) / (na + nb))"""


@query(
    "contingency_status",
    f"""{_CELLS} SELECT va AS variant_a, vb AS variant_b, status, CAST(ca AS BIGINT) AS observed_a, CAST(cb AS BIGINT) AS observed_b,
  round(na * (ca + cb) / (na + nb), 5) AS expected_a, round(nb * (ca + cb) / (na + nb), 5) AS expected_b FROM cells WHERE ca + cb > 0""",
)
def contingency_status(spark, sf_dir):
    out = ex.contingency(rows(spark, sf_dir), "variant_id", "status")
    return out.withColumns({c: F.round(c, 5) for c in ("expected_a", "expected_b")})


@query(
    "chi_square_report",
    f"""{_CELLS},
x AS (SELECT va, vb, count(*) - 1 AS k, sum({_TERM}) AS chi, any_value(na + nb) AS n FROM cells WHERE ca + cb > 0 GROUP BY 1, 2),
p AS (SELECT *, CASE WHEN k = 2 THEN exp(-chi / 2) WHEN k = 1 THEN 2 * (1 - ({_phi('sqrt(chi)')})) END AS p FROM x)
SELECT va AS variant_a, vb AS variant_b, k AS degrees_of_freedom, round(chi, 5) AS chi_square, round(sqrt(chi / n), 6) AS cramers_v,
  round(p, 6) AS p_value, p < 0.05 AS is_significant FROM p""",
)
def chi_square_report(spark, sf_dir):
    out = ex.chi_square_tests(rows(spark, sf_dir), "variant_id", "status")
    return out.select(
        "variant_a", "variant_b", "degrees_of_freedom", F.round("chi_square", 5).alias("chi_square"),
        F.round("cramers_v", 6).alias("cramers_v"), F.round("p_value", 6).alias("p_value"), "is_significant",
    )


@query(
    "rank_sum_u",
    f"""WITH {EXPERIMENT}, v AS (SELECT metric, value, variant_id, count(*)::DOUBLE AS c FROM long GROUP BY 1, 2, 3),
p AS (SELECT DISTINCT a.variant_id AS va, b.variant_id AS vb FROM mom a, mom b WHERE a.variant_id < b.variant_id),
m AS (SELECT metric, va, vb, value, sum(CASE WHEN variant_id = va THEN c ELSE 0 END) AS na, sum(CASE WHEN variant_id = vb THEN c ELSE 0 END) AS nb
  FROM v JOIN p ON variant_id IN (va, vb) GROUP BY 1, 2, 3, 4),
r AS (SELECT *, sum(nb) OVER (PARTITION BY metric, va, vb ORDER BY value) AS cb FROM m)
SELECT metric, va AS variant_a, vb AS variant_b, CAST(sum(na) AS BIGINT) AS n_a, CAST(sum(nb) AS BIGINT) AS n_b,
  round(sum(na * (cb - nb / 2)), 1) AS u, sum((na + nb) ** 3 - (na + nb)) AS ties FROM r GROUP BY 1, 2, 3""",
)
def rank_sum_u(spark, sf_dir):
    out = ex.rank_sums(long_rows(spark, sf_dir), sorted(VARIANT_WEIGHTS))
    return out.select("metric", "variant_a", "variant_b", "n_a", "n_b", F.round("u", 1).alias("u"), "ties")


@query("rank_test_report")
def rank_test_report(spark, sf_dir):
    return ex.rank_tests(long_rows(spark, sf_dir), variants=sorted(VARIANT_WEIGHTS))


@query(
    "posterior_means",
    f"""WITH {EXPERIMENT} SELECT variant_id, (1 + sum(success))::DOUBLE AS alpha, (1 + count(*) - sum(success))::DOUBLE AS beta,
  round((1 + sum(success)) / (2 + count(*))::DOUBLE, 6) AS posterior_mean FROM exp GROUP BY 1""",
)
def posterior_means(spark, sf_dir):
    return ex.posteriors(rows(spark, sf_dir), "success").withColumn("posterior_mean", F.round("posterior_mean", 6))


@query("bayesian_report")
def bayesian_report(spark, sf_dir):
    return ex.bayesian_tests(rows(spark, sf_dir), "success")


@query(
    "sequential_prefix_t",
    f"""WITH {EXPERIMENT}, run AS (SELECT metric, variant_id, row_number() OVER w AS i, sum(value) OVER w AS s,
    sum(value * value) OVER w AS ss, count(*) OVER (PARTITION BY metric, variant_id) AS n
  FROM long WINDOW w AS (PARTITION BY metric, variant_id ORDER BY row_id)),
st AS (SELECT metric, variant_id, i, n, s / i AS m, (ss - s * s / i) / (i - 1) AS v FROM run WHERE i >= 100 AND i < n)
SELECT a.metric, a.variant_id AS variant_a, b.variant_id AS variant_b, count(*) AS prefixes,
  round(sum((a.m - b.m) / sqrt((a.v + b.v) / a.i)), 3) AS t_sum, round(max(abs((a.m - b.m) / sqrt((a.v + b.v) / a.i))), 4) AS t_max
FROM st a JOIN st b ON a.metric = b.metric AND a.i = b.i AND a.variant_id < b.variant_id AND a.i < least(a.n, b.n) GROUP BY 1, 2, 3""",
)
def sequential_prefix_t(spark, sf_dir):
    tests = ex.prefix_tests(long_rows(spark, sf_dir), "row_id")
    return tests.groupBy("metric", "variant_a", "variant_b").agg(
        F.count(F.lit(1)).alias("prefixes"), F.round(F.sum("t"), 3).alias("t_sum"),
        F.round(F.max(F.abs("t")), 4).alias("t_max"),
    )


@query(
    "sequential_report",
    f"""WITH {EXPERIMENT}, run AS (SELECT metric, variant_id, row_number() OVER w AS i, sum(value) OVER w AS s,
    sum(value * value) OVER w AS ss, count(*) OVER (PARTITION BY metric, variant_id) AS n
  FROM long WINDOW w AS (PARTITION BY metric, variant_id ORDER BY row_id)),
st AS (SELECT metric, variant_id, i, n, s / i AS m, (ss - s * s / i) / (i - 1) AS v FROM run WHERE i >= 100 AND i < n),
t AS (SELECT a.metric, a.variant_id AS variant_a, b.variant_id AS variant_b, a.i, least(a.n, b.n) AS n, (a.m - b.m) / sqrt((a.v + b.v) / a.i) AS t
  FROM st a JOIN st b ON a.metric = b.metric AND a.i = b.i AND a.variant_id < b.variant_id AND a.i < least(a.n, b.n)),
d AS (SELECT metric, variant_a, variant_b, min(i) FILTER (abs(t) >= {_t_limit(special.normal_ppf(1 - 0.025 / 2), '2e0 * i - 2')}) AS stop_at, any_value(n) AS n
  FROM t GROUP BY 1, 2, 3),
p AS (SELECT d.*, {_t_p('t.t', '2e0 * t.i - 2')} AS p FROM d JOIN t USING (metric, variant_a, variant_b) WHERE t.i = coalesce(d.stop_at, d.n - 1))
SELECT pairs.metric, pairs.variant_a, pairs.variant_b, coalesce(stop_at, least(n_a, n_b)) AS sample_size, round(p, 6) AS p_value,
  stop_at IS NOT NULL AS stop, CASE WHEN stop_at IS NOT NULL THEN 'Significant difference detected' ELSE 'Need more data' END AS reason
FROM pairs LEFT JOIN p USING (metric, variant_a, variant_b)""",
)
def sequential_report(spark, sf_dir):
    out = ex.sequential_tests(long_rows(spark, sf_dir), "row_id")
    return out.withColumn("p_value", F.round("p_value", 6))


_Z80 = repr(special.normal_ppf(0.975) + special.normal_ppf(0.8))


@query(
    "sample_size_by_segment",
    f"""WITH {EXPERIMENT}, r AS (SELECT segment, count(*) AS n, avg(success) AS p FROM exp GROUP BY 1)
SELECT segment, n, round(p, 6) AS baseline_rate,
  CAST(ceil({_Z80}::DOUBLE ** 2 * 2 * ((p + p * 1.1::DOUBLE) / 2) * (1 - (p + p * 1.1::DOUBLE) / 2) / (p * 1.1::DOUBLE - p) ** 2) AS BIGINT) AS required,
  n >= ceil({_Z80}::DOUBLE ** 2 * 2 * ((p + p * 1.1::DOUBLE) / 2) * (1 - (p + p * 1.1::DOUBLE) / 2) / (p * 1.1::DOUBLE - p) ** 2) AS adequate FROM r""",
)
def sample_size_by_segment(spark, sf_dir):
    out = ex.sample_size_by_segment(rows(spark, sf_dir), "segment", "success")
    return out.withColumn("baseline_rate", F.round("baseline_rate", 6))


_Z = {p: repr(special.normal_ppf(0.975) + special.normal_ppf(p)) for p in ex.PLAN_POWER}


@query(
    "power_grid",
    f"""WITH {EXPERIMENT}, r AS (SELECT segment, avg(success) AS p FROM exp GROUP BY 1),
m(mde_pct, m) AS (VALUES {', '.join(f'({round(m * 100)}, {m}::DOUBLE)' for m in ex.PLAN_MDE)}),
w(power_pct, z) AS (VALUES {', '.join(f'({round(p * 100)}, {z}::DOUBLE)' for p, z in _Z.items())}),
g AS (SELECT segment, mde_pct, power_pct, CAST(ceil(z * z * 2 * ((p + p * (1 + m)) / 2) * (1 - (p + p * (1 + m)) / 2) / (p * (1 + m) - p) ** 2) AS BIGINT) AS n FROM r, m, w)
SELECT segment, mde_pct, power_pct, n AS n_per_variant, 2 * n AS n_total FROM g""",
)
def power_grid(spark, sf_dir):
    rates = rows(spark, sf_dir).groupBy("segment").agg(F.avg("success").alias("p"))
    return ex.power_grid(rates, "p").drop("p")


@query(
    "achieved_power",
    f"""WITH {EXPERIMENT}, r AS (SELECT segment, count(*) AS n, avg(success) AS rate FROM exp GROUP BY 1),
z AS (SELECT *, {_Z975!r}::DOUBLE - abs(rate * 1.1::DOUBLE - rate) / sqrt(2 * ((rate + rate * 1.1::DOUBLE) / 2) * (1 - (rate + rate * 1.1::DOUBLE) / 2) / n) AS x FROM r)
SELECT segment, n, round(rate, 6) AS rate, round(1 - ({_phi('x')}), 6) AS power FROM z""",
)
def achieved_power(spark, sf_dir):
    rates = rows(spark, sf_dir).groupBy("segment").agg(F.count("success").alias("n"), F.avg("success").alias("rate"))
    out = ex.achieved_power(rates, "n", "rate", 0.1)
    return out.select("segment", "n", F.round("rate", 6).alias("rate"), F.round("power", 6).alias("power"))


@query(
    "best_variant",
    f"""WITH {EXPERIMENT}, s AS (SELECT variant_id, avg(f1_score) AS q, avg(latency_ms) AS l, quantile_cont(latency_ms, 0.95) AS p95 FROM exp GROUP BY 1)
SELECT variant_id, round(q, 5) AS quality, round(l, 5) AS latency, round(q * 100 - l * 0.1, 5) AS score, round(p95, 5) AS p95,
  printf('{ex.RATIONALE}', variant_id, q, l, p95) AS rationale
FROM s ORDER BY q * 100 - l * 0.1 DESC, variant_id LIMIT 1""",
)
def best_variant(spark, sf_dir):
    out = ex.best_variant(rows(spark, sf_dir))
    return out.withColumns({c: F.round(c, 5) for c in ("quality", "latency", "score", "p95")})


@query(
    "experiment_report",
    f"""WITH {EXPERIMENT}, s AS (SELECT variant_id, avg(f1_score) * 100 - avg(latency_ms) * 0.1 AS score FROM exp GROUP BY 1)
SELECT 'variant_summary' AS part, variant_id, NULL::VARCHAR AS other, metric, n, round(mean, 5) AS value FROM mom
UNION ALL SELECT 'pairwise_tests', variant_a, variant_b, metric, n_a + n_b, round(difference, 5) FROM pairs
UNION ALL SELECT 'recommendation', variant_id, NULL, NULL, NULL, round(score, 5) FROM (SELECT * FROM s ORDER BY score DESC, variant_id LIMIT 1)""",
)
def experiment_report(spark, sf_dir):
    """The three tables of the full report, one below the other."""
    report = ex.experiment_report(rows(spark, sf_dir))
    none = lambda kind: F.lit(None).cast(kind)
    row = lambda part, variant, other, metric, n, value: (
        F.lit(part).alias("part"), variant.alias("variant_id"), other.alias("other"), metric.alias("metric"),
        n.alias("n"), F.round(value, 5).alias("value"),
    )
    c = F.col
    summary = report["variant_summary"].select(*row("variant_summary", c("variant_id"), none("string"), c("metric"), c("n"), c("mean")))
    tests = report["pairwise_tests"].select(
        *row("pairwise_tests", c("variant_a"), c("variant_b"), c("metric"), c("n_a") + c("n_b"), c("difference"))
    )
    best = report["recommendation"].select(*row("recommendation", c("variant_id"), none("string"), none("string"), none("long"), c("score")))
    return summary.unionAll(tests).unionAll(best)


@query(
    "gauge_winner",
    f"""WITH {EXPERIMENT}, g AS (SELECT variant_id, avg(success) AS g FROM exp GROUP BY 1)
SELECT a.variant_id AS variant_a, b.variant_id AS variant_b, round(abs(a.g - b.g), 6) AS difference, abs(a.g - b.g) > 0.02 AS significant,
  CASE WHEN a.g >= b.g THEN a.variant_id ELSE b.variant_id END AS leader FROM g a JOIN g b ON a.variant_id < b.variant_id""",
)
def gauge_winner(spark, sf_dir):
    gauges = rows(spark, sf_dir).groupBy("variant_id").agg(F.avg("success").alias("rate"))
    return ex.gauge_winner(gauges, "variant_id", "rate").withColumn("difference", F.round("difference", 6))


@query(
    "variant_thresholds",
    f"""WITH {EXPERIMENT}, v AS (SELECT variant_id, quantile_cont(latency_ms, 0.99) AS p99, avg(accuracy) AS a, avg(f1_score) AS f FROM exp GROUP BY 1)
SELECT variant_id, metric, round(value, 5) AS value, required, CASE WHEN value >= required THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT variant_id, 'accuracy' AS metric, a AS value, 0.5::DOUBLE AS required FROM v UNION ALL SELECT variant_id, 'f1_score', f, 0.9 FROM v
  UNION ALL SELECT variant_id, 'headroom_p99', 100 - p99, 0.0 FROM v)""",
)
def variant_thresholds(spark, sf_dir):
    data = rows(spark, sf_dir)
    p99 = exact_percentiles(data, ["variant_id"], "latency_ms", {"p99": 0.99})
    means = data.groupBy("variant_id").agg(F.avg("accuracy").alias("accuracy"), F.avg("f1_score").alias("f1_score"))
    wide = means.join(p99, "variant_id").withColumn("headroom_p99", 100 - F.col("p99"))
    need = {"accuracy": 0.5, "f1_score": 0.9, "headroom_p99": 0.0}
    out = st.threshold_check(st.metrics_long(wide, ["variant_id"], list(need)), need)
    return out.select("variant_id", "metric", F.round("value", 5).alias("value"), "required", "status")
