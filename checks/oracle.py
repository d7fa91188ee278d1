"""The registered queries in DuckDB SQL, written from the definitions and not from the plans."""

from __future__ import annotations

from checks.queries import DIGITS, REPLICATES, SEEDS

# Shared table expressions ----------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
         user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
         epoch_us(ts) AS event_at_us,
         epoch_us(ts) + CAST(props->>'$.k' AS BIGINT) * 60000000 AS available_at_us,
         event_type AS page_category
  FROM events),
cust AS (
  SELECT c_custkey, n_name AS country, c_mktsegment AS source
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
st AS (
  SELECT user_id, session_id, min(event_at_us) AS session_start_at_us FROM ev GROUP BY ALL),
sess AS (
  SELECT session_id, CAST(user_id AS VARCHAR) AS user_id, session_start_at_us, country,
         13 + user_id % 88 AS age, user_id % 2 AS new_user, source
  FROM st JOIN cust ON c_custkey = user_id),
req AS (
  SELECT session_id || '#' || h AS score_id, session_id, h,
         session_start_at_us + h * 3600000000 AS score_at_us
  FROM st, (VALUES (0), (1), (6), (12)) t(h))
"""

PIT = (
    EVENTS
    + """,
agg AS (
  SELECT r.score_id, count(*) AS pages, count(DISTINCT page_category) AS categories,
         max(event_at_us) AS seen
  FROM req r JOIN ev e ON e.session_id = r.session_id
  WHERE e.event_at_us < r.score_at_us AND e.available_at_us <= r.score_at_us
  GROUP BY r.score_id),
feat AS (
  SELECT r.score_id, s.session_id, s.user_id, r.score_at_us, s.country, s.age, s.new_user,
         s.source,
         (r.score_at_us - s.session_start_at_us) // 1000000 AS seconds_since_session_start,
         coalesce(pages, 0) AS pages_observed_at_score_time,
         coalesce(categories, 0) AS unique_page_categories_observed,
         seen AS feature_max_event_at_us,
         (r.score_at_us - seen) // 1000000 AS seconds_since_last_page_view
  FROM req r JOIN sess s ON s.session_id = r.session_id LEFT JOIN agg a ON a.score_id = r.score_id)
"""
)

CONVERSIONS = """
conv AS (
  SELECT o_orderkey AS row_id, n_name AS country, CAST(13 + o_custkey % 88 AS INT) AS age,
         CAST(o_custkey % 2 AS INT) AS new_user, c_mktsegment AS source,
         CAST(1 + floor(o_totalprice / 25000) AS INT) AS total_pages_visited,
         CAST(o_totalprice > 400000 AND o_orderkey % 5 <> 0 AS INT) AS converted
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
"""

SCORES = """
sc AS (
  SELECT 'fine' AS scores, CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS row_id,
         CAST(o_orderpriority = '1-URGENT' AS INT) AS label, o_totalprice / 500000 AS score
  FROM orders
  UNION ALL
  SELECT 'tied', CAST(o_orderkey AS VARCHAR), o_orderkey,
         CAST(o_orderpriority = '1-URGENT' AS INT), floor(o_totalprice / 10000) / 50
  FROM orders)
"""


def sweep(source: str, keys: str, name: str = "sw") -> str:
    """Histogram and descending running totals of ``source`` per ``keys``."""
    return f"""
{name}_h AS (
  SELECT {keys}, score, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n
  FROM {source} GROUP BY ALL),
{name} AS (
  SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(n) OVER w AS BIGINT) AS cum_n,
         CAST(sum(pos) OVER k AS BIGINT) AS all_pos, CAST(sum(n) OVER k AS BIGINT) AS all_n
  FROM {name}_h
  WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         k AS (PARTITION BY {keys}))
"""


def uniform(key: str, salt: str, seed: str) -> str:
    return (
        f"(('0x' || substr(md5(concat_ws(':', CAST({key} AS VARCHAR), '{salt}',"
        f" CAST({seed} AS VARCHAR))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"
    )


def normal(key: str, salt: str, seed: str) -> str:
    return (
        f"(sqrt(-2 * ln(1 - {uniform(key, salt + '/r', seed)}))"
        f" * cos(2 * pi() * {uniform(key, salt + '/a', seed)}))"
    )


def seeds_values(seeds) -> str:
    return "(VALUES " + ", ".join(f"({s})" for s in seeds) + ") sd(seed)"


def r(expression: str, name: str, digits: int | None = DIGITS) -> str:
    return f"{expression} AS {name}" if digits is None else f"round({expression}, {digits}) AS {name}"


# Metrics over the sweep ------------------------------------------------------------------

AUC = (
    "CASE WHEN max(all_pos) > 0 AND max(all_n - all_pos) > 0 THEN"
    " sum(pos::DOUBLE * ((all_n - all_pos) - (cum_n - cum_pos) + (n - pos) / 2.0::DOUBLE))"
    " / (max(all_pos)::DOUBLE * max(all_n - all_pos)) END"
)
AP = (
    "CASE WHEN max(all_pos) > 0 THEN sum(pos::DOUBLE * cum_pos / cum_n) / max(all_pos)"
    " ELSE 0 END"
)
BRIER = "sum(pos * (score - 1) * (score - 1) + (n - pos) * score * score) / sum(n)"
BIAS = "sum(score * n) / sum(n) - sum(pos) / sum(n)"


def safe(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN 0.0 ELSE ({top})::DOUBLE / ({bottom}) END"


def confusion(fp: str = "1.0", fn: str = "10.0", digits: int | None = DIGITS) -> str:
    """Columns from tp, sel, all_pos, all_n."""
    return ",\n".join(
        [
            r(safe("tp", "sel"), "precision", digits),
            r(safe("tp", "all_pos"), "recall", digits),
            r(safe("2 * tp", "sel + all_pos"), "f1", digits),
            r(
                f"((sel - tp)::DOUBLE * {fp} + (all_pos - tp)::DOUBLE * {fn}) / all_n * 1000",
                "expected_cost_per_1000", digits,
            ),
            "all_n - sel - (all_pos - tp) AS true_negatives",
            "sel - tp AS false_positives",
            "all_pos - tp AS false_negatives",
            "tp AS true_positives",
            "sel AS selected_rows",
            r("sel::DOUBLE / all_n", "selection_rate", digits),
        ]
    )


def ece(source: str, keys: str, name: str = "ece") -> str:
    return f"""
{name} AS (
  SELECT {keys}, sum(abs(p - m)) / sum(c) AS ece FROM (
    SELECT {keys}, least(floor(score * 10), 9) AS bin, sum(label) AS p, sum(score) AS m,
           count(*) AS c
    FROM {source} GROUP BY ALL) GROUP BY ALL)
"""


def budget(source: str, keys: str, fraction: float = 0.05, name: str = "bud") -> str:
    """The first k rows by descending score, then by row_id."""
    return f"""
{name}_r AS (
  SELECT {keys}, label, score,
         row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, row_id) AS rn,
         greatest(1, ceil(count(*) OVER (PARTITION BY {keys}) * {fraction}::DOUBLE)) AS k,
         sum(label) OVER (PARTITION BY {keys}) AS ap, count(*) OVER (PARTITION BY {keys}) AS an
  FROM {source}),
{name}_s AS (
  SELECT {keys}, CAST(max(k) AS BIGINT) AS k, CAST(sum(label) AS BIGINT) AS hits,
         min(score) AS edge, max(ap) AS ap, max(an) AS an
  FROM {name}_r WHERE rn <= k GROUP BY ALL),
{name} AS (
  SELECT s.*, count(*) AS ties, count(*) FILTER (rn <= s.k) AS taken
  FROM {name}_s s JOIN {name}_r USING ({keys}) WHERE score = edge GROUP BY ALL)
"""


def budget_columns(digits: int = DIGITS, fraction: float = 0.05) -> str:
    precision = "hits::DOUBLE / k"
    return ",\n".join(
        [
            "k AS budget_selected_rows",
            "hits AS budget_selected_positives",
            f"{fraction}::DOUBLE AS budget_fraction",
            "'stable_input_order' AS budget_tie_break_policy",
            r("edge", "budget_boundary_score", digits),
            "ties AS budget_boundary_tie_rows",
            "taken AS budget_selected_from_boundary_tie",
            r(precision, "precision_at_budget", digits),
            r(safe("hits", "ap"), "recall_at_budget", digits),
            r(
                f"CASE WHEN ap = 0 THEN 0.0 ELSE ({precision}) / (ap::DOUBLE / an) END",
                "lift_at_budget", digits,
            ),
        ]
    )


# Splits ----------------------------------------------------------------------------------


def stratified(source: str, label: str, seeds) -> str:
    """Exact 60/20/20 with equal shares of positives, by hashed rank inside each label."""
    u = uniform("row_id", "stratified", "seed")
    return f"""
tot AS (
  SELECT count(*) AS n, CAST(sum({label}) AS BIGINT) AS p FROM {source}),
q0 AS (SELECT n, p, (n + 4) // 5 AS nt, (n - (n + 4) // 5 + 3) // 4 AS nv FROM tot),
q1 AS (SELECT *, (2 * nt * p + n) // (2 * n) AS tp FROM q0),
q AS (SELECT *, (2 * nv * (p - tp) + (n - nt)) // (2 * (n - nt)) AS vp FROM q1),
ranked AS (
  SELECT seed, s.*, row_number() OVER (
           PARTITION BY seed, {label} ORDER BY {u}, CAST(row_id AS VARCHAR)) AS rk
  FROM {source} s, {seeds_values(seeds)}),
split AS (
  SELECT ranked.* EXCLUDE (rk),
         CASE WHEN rk <= CASE WHEN {label} = 1 THEN tp ELSE nt - tp END THEN 'test'
              WHEN rk <= CASE WHEN {label} = 1 THEN tp + vp ELSE nt - tp + nv - vp END
                THEN 'validation'
              ELSE 'train' END AS split
  FROM ranked, q)
"""


def _escaped(column: str) -> str:
    return f"replace(replace(CAST({column} AS VARCHAR), '~', '~0'), '|', '~1')"


PROFILE_KEY = "concat_ws('|', " + ", ".join(
    _escaped(c) for c in ("country", "age", "new_user", "source")
) + ")"

PROFILE_SPLIT = (
    CONVERSIONS
    + f""",
prof AS (SELECT DISTINCT {PROFILE_KEY} AS pk FROM conv),
pr AS (
  SELECT seed, pk, row_number() OVER (
           PARTITION BY seed ORDER BY {uniform('pk', 'profile', 'seed')}, pk) AS rk,
         count(*) OVER (PARTITION BY seed) AS g
  FROM prof, {seeds_values(SEEDS)}),
ps AS (
  SELECT seed, pk,
         CASE WHEN rk <= ceil(g / 5) THEN 'test'
              WHEN rk <= ceil(g / 5) + ceil((g - ceil(g / 5)) / 4) THEN 'validation'
              ELSE 'train' END AS split
  FROM pr),
split_p AS (
  SELECT seed, conv.*, split FROM conv JOIN ps ON pk = {PROFILE_KEY})
"""
)

GROUPED_SPLIT = (
    CONVERSIONS
    + f""",
prof AS (
  SELECT {PROFILE_KEY} AS pk, count(*) AS w, avg(converted::DOUBLE) AS rate FROM conv GROUP BY 1),
strat AS (
  SELECT seed, pk, w, CAST(floor(log2(w) / 2) AS INT) AS size_class,
         CAST(ceil(rate * 4) AS INT) AS rate_class, {uniform('pk', 'grouped', 'seed')} AS u
  FROM prof, {seeds_values(SEEDS)}),
turned AS (
  SELECT *, 0.0::DOUBLE - st - floor(0.0::DOUBLE - st) AS t0,
         0.2::DOUBLE - st - floor(0.2::DOUBLE - st) AS t1,
         0.4::DOUBLE - st - floor(0.4::DOUBLE - st) AS t2
  FROM (SELECT *, {uniform("concat_ws(':', size_class, rate_class)", 'start', 'seed')} AS st
        FROM strat)),
run AS (
  SELECT *, sum(w) OVER (PARTITION BY seed, size_class, rate_class ORDER BY u, pk
                         ROWS UNBOUNDED PRECEDING) - w / 2 AS mid,
         sum(w) OVER (PARTITION BY seed, size_class, rate_class) AS total
  FROM turned),
left_of AS (
  SELECT *, mid <= total * t0 AS l0, mid <= total * t1 AS l1, mid <= total * t2 AS l2 FROM run),
gs AS (
  SELECT seed, pk,
         CASE WHEN CASE WHEN t0 < t1 THEN NOT l0 AND l1 ELSE NOT l0 OR l1 END THEN 'test'
              WHEN CASE WHEN t1 < t2 THEN NOT l1 AND l2 ELSE NOT l1 OR l2 END THEN 'validation'
              ELSE 'train' END AS split
  FROM left_of),
split_g AS (
  SELECT seed, conv.*, split FROM conv JOIN gs ON pk = {PROFILE_KEY})
"""
)

# Policies --------------------------------------------------------------------------------

_FINE = """
fine AS (
  SELECT o_orderkey AS row_id, CAST(o_orderpriority = '1-URGENT' AS INT) AS label,
         o_totalprice / 500000 AS score
  FROM orders)
"""

_POLICY = ", ".join(
    f"({i}, {'NULL' if c is None else c}::DOUBLE, {f}::DOUBLE)"
    for i, (c, f) in enumerate(
        (c, f) for c in (None, 0.05, 0.10) for f in (1.0, 2.0, 4.0, 10.0, 20.0)
    )
)


def choices(keys: str, source: str, policies: str) -> str:
    """One threshold per keys and policy: least cost, ties to the higher threshold."""
    return f"""
{sweep(source, keys, 'vs')},
pol AS (SELECT * FROM (VALUES {policies}) p(policy_id, ceiling, fn_cost)),
cand AS (
  SELECT {keys}, score AS threshold, n AS ties, cum_n AS sel, cum_pos AS tp, all_pos, all_n FROM vs
  UNION ALL
  SELECT {keys}, nextafter(max(score), 'inf'::DOUBLE), 0, 0, 0, max(all_pos), max(all_n)
  FROM vs GROUP BY ALL),
costed AS (
  SELECT cand.*, pol.*,
         ((sel - tp)::DOUBLE * 1.0 + (all_pos - tp)::DOUBLE * fn_cost) / all_n * 1000 AS cost,
         CAST(floor(all_n * ceiling) AS BIGINT) AS max_rows
  FROM cand, pol),
free AS (
  SELECT {keys}, policy_id, sel AS free_sel FROM costed
  QUALIFY row_number() OVER (
    PARTITION BY {keys}, policy_id ORDER BY cost, threshold DESC) = 1),
frontier AS (
  SELECT {keys}, policy_id, max(sel) FILTER (sel <= max_rows) AS front,
         arg_min(ties, sel) FILTER (sel > max_rows) AS next_ties
  FROM costed GROUP BY ALL),
best AS (
  SELECT * FROM costed WHERE max_rows IS NULL OR sel <= max_rows
  QUALIFY row_number() OVER (
    PARTITION BY {keys}, policy_id ORDER BY cost, threshold DESC) = 1),
choice AS (
  SELECT * FROM best JOIN free USING ({keys}, policy_id) JOIN frontier USING ({keys}, policy_id))
"""


CHOICE_COLUMNS = ",\n".join(
    [
        r("threshold", "threshold"),
        r("cost", "expected_cost_per_1000"),
        "1.0::DOUBLE AS false_positive_cost",
        "fn_cost AS false_negative_cost",
        "sel AS selected_rows",
        r("sel::DOUBLE / all_n", "selection_rate"),
        "'minimize_expected_misclassification_cost' AS objective",
        "ceiling AS max_selection_fraction",
        "max_rows AS max_selected_rows",
        "max_rows - sel AS policy_unused_capacity_rows",
        "coalesce(free_sel > max_rows, false) AS capacity_binding",
        "CASE WHEN max_rows IS NOT NULL THEN front END AS max_feasible_selected_rows",
        "max_rows - front AS frontier_unused_capacity_rows",
        "ties AS cutoff_tie_rows",
        "CASE WHEN max_rows IS NOT NULL THEN next_ties END AS next_infeasible_tie_rows",
    ]
)

POLICY_RUNS = (
    _FINE + "," + stratified("fine", "label", SEEDS)
    + ", val AS (SELECT * FROM split WHERE split = 'validation'),"
    + " tst AS (SELECT * FROM split WHERE split = 'test'),"
    + choices("seed", "val", _POLICY)
    + "," + sweep("tst", "seed", "ts")
    + "," + ece("tst", "seed")
    + f""",
flat AS (
  SELECT seed, {AUC} AS auc, {AP} AS ap, {BRIER} AS brier, {BIAS} AS bias
  FROM ts GROUP BY ALL),
role AS (
  SELECT seed, policy_id, ceiling, fn_cost, sel::DOUBLE / all_n AS vrate,
         unnest([threshold, 0.5::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + fn_cost)]) AS threshold,
         unnest(['validation_selected', 'fixed_0_50', 'theoretical_cost_threshold']) AS role
  FROM choice),
cnt AS (
  SELECT r.seed, policy_id, role, ceiling, fn_cost, vrate, threshold,
         count(*) FILTER (score >= threshold) AS sel,
         CAST(coalesce(sum(label) FILTER (score >= threshold), 0) AS BIGINT) AS tp,
         CAST(sum(label) AS BIGINT) AS all_pos, count(*) AS all_n
  FROM role r JOIN tst ON tst.seed = r.seed GROUP BY ALL),
judged AS (
  SELECT seed, policy_id,
         CASE WHEN ceiling IS NULL THEN 'unconstrained'
              ELSE printf('validation_selection_ceiling_%.3f', ceiling) END AS policy,
         fn_cost AS false_negative_cost, ceiling, role, threshold,
         vrate AS validation_selection_rate,
         {confusion('1.0', 'fn_cost', None)},
         auc AS roc_auc, ap AS average_precision, brier AS brier_score,
         bias AS calibration_bias, ece AS expected_calibration_error,
         coalesce(sel::DOUBLE / all_n > ceiling, false) AS ceiling_exceeded
  FROM cnt JOIN flat USING (seed) JOIN ece USING (seed))
"""
)

_ROLES = (("s", "validation_selected"), ("f", "fixed_0_50"), ("t", "theoretical_cost_threshold"))


def _compare() -> str:
    columns = [
        "s.seed", "s.policy_id", "s.policy", "s.false_negative_cost", "s.ceiling",
        "s.threshold AS threshold",
        "s.validation_selection_rate AS validation_selection_rate",
        "s.selection_rate AS test_selection_rate",
        "s.precision AS test_precision",
        "s.recall AS test_recall",
        "s.f1 AS test_f1",
        "s.brier_score AS test_brier_score",
        "s.expected_calibration_error AS test_calibration_error",
        "t.threshold AS theoretical_threshold",
        "s.expected_cost_per_1000 AS selected_cost_per_1000",
        "s.ceiling_exceeded AS validation_selected_exceeded",
    ]
    for a, name in (("f", "fixed_0_50"), ("t", "theoretical")):
        cost = f"{a}.expected_cost_per_1000"
        saved = f"({cost} - s.expected_cost_per_1000)"
        columns += [
            f"{a}.precision AS {name}_precision",
            f"{a}.recall AS {name}_recall",
            f"{a}.f1 AS {name}_f1",
            f"{a}.selection_rate AS {name}_selection_rate",
            f"{cost} AS {name}_cost_per_1000",
            f"CASE WHEN {cost} = 0 THEN 0 ELSE {saved} / {cost} END AS cost_reduction_vs_{name}",
            f"{saved} AS absolute_reduction_vs_{name}",
            f"{a}.false_negatives - s.false_negatives AS false_negatives_avoided_vs_{name}",
            f"s.false_positives - {a}.false_positives AS additional_false_positives_vs_{name}",
            f"{a}.ceiling_exceeded AS {name}_exceeded",
            f"NOT (s.ceiling_exceeded OR {a}.ceiling_exceeded) AS vs_{name}_feasible",
        ]
    joins = " JOIN ".join(
        f"(SELECT * FROM judged WHERE role = '{name}') {a}"
        + ("" if a == "s" else f" ON {a}.seed = s.seed AND {a}.policy_id = s.policy_id")
        for a, name in _ROLES
    )
    return f"cmp AS (SELECT {', '.join(columns)} FROM {joins})"


POLICY_COMPARE = POLICY_RUNS + "," + _compare()


def _select(source: str, plain: list[str], doubles: list[str]) -> str:
    return (
        "SELECT " + ", ".join(plain + [r(d, d) for d in doubles]) + f" FROM {source}"
    )


_JUDGED = _select(
    "judged",
    ["seed", "policy_id", "policy", "false_negative_cost", "ceiling", "role", "true_negatives",
     "false_positives", "false_negatives", "true_positives", "selected_rows", "ceiling_exceeded"],
    ["threshold", "validation_selection_rate", "precision", "recall", "f1",
     "expected_cost_per_1000", "selection_rate", "roc_auc", "average_precision", "brier_score",
     "calibration_bias", "expected_calibration_error"],
)
_PAIR = ("fixed_0_50", "theoretical")
_COMPARED = _select(
    "cmp",
    ["seed", "policy_id", "policy", "false_negative_cost", "ceiling",
     "validation_selected_exceeded"]
    + [f"{n}_exceeded" for n in _PAIR] + [f"vs_{n}_feasible" for n in _PAIR]
    + [f"false_negatives_avoided_vs_{n}" for n in _PAIR]
    + [f"additional_false_positives_vs_{n}" for n in _PAIR],
    ["threshold", "validation_selection_rate", "test_selection_rate", "test_precision",
     "test_recall", "test_f1", "test_brier_score", "test_calibration_error",
     "theoretical_threshold", "selected_cost_per_1000"]
    + [f"{n}_{f}" for n in _PAIR
       for f in ("precision", "recall", "f1", "selection_rate", "cost_per_1000")]
    + [f"{f}_vs_{n}" for n in _PAIR for f in ("cost_reduction", "absolute_reduction")],
)
_FIELDS = (
    ["threshold", "validation_selection_rate", "test_selection_rate", "test_precision",
     "test_recall", "test_f1", "test_brier_score", "test_calibration_error",
     "theoretical_threshold", "selected_cost_per_1000"]
    + [f"{n}_{f}" for n in _PAIR for f in ("precision", "recall", "selection_rate",
                                           "cost_per_1000")]
    + [f"{f}_vs_{n}" for n in _PAIR
       for f in ("cost_reduction", "absolute_reduction", "false_negatives_avoided",
                 "additional_false_positives")]
)
_SUMMARY = " UNION ALL ".join(
    f"SELECT policy, false_negative_cost, ceiling, '{f}' AS field, {r(f'avg({f}::DOUBLE)', 'mean')},"
    f" {r(f'min({f}::DOUBLE)', 'minimum')}, {r(f'max({f}::DOUBLE)', 'maximum')}"
    " FROM cmp GROUP BY ALL"
    for f in _FIELDS
)


def _benchmark() -> str:
    free = (
        ("validation_selected_threshold", "threshold"),
        ("validation_selected_precision", "test_precision"),
        ("validation_selected_recall", "test_recall"),
        ("validation_selected_selection_rate", "test_selection_rate"),
        ("fixed_0_50_modeled_loss_per_1000", "fixed_0_50_cost_per_1000"),
        ("theoretical_threshold_modeled_loss_per_1000", "theoretical_cost_per_1000"),
        ("validation_selected_modeled_loss_per_1000", "selected_cost_per_1000"),
        ("relative_modeled_loss_reduction_vs_fixed_0_50", "cost_reduction_vs_fixed_0_50"),
        ("relative_modeled_loss_reduction_vs_theoretical_threshold",
         "cost_reduction_vs_theoretical"),
    )
    bound = (
        ("validation_selected_threshold", "threshold", "true"),
        ("validation_selection_rate", "validation_selection_rate", "true"),
        ("test_selection_rate", "test_selection_rate", "true"),
        ("relative_modeled_loss_reduction_vs_fixed_0_50", "cost_reduction_vs_fixed_0_50",
         "bool_and(vs_fixed_0_50_feasible)"),
        ("relative_modeled_loss_reduction_vs_theoretical_threshold",
         "cost_reduction_vs_theoretical", "bool_and(vs_theoretical_feasible)"),
        ("raw_descriptive_relative_change_vs_fixed_0_50", "cost_reduction_vs_fixed_0_50", "true"),
        ("raw_descriptive_relative_change_vs_theoretical_threshold",
         "cost_reduction_vs_theoretical", "true"),
    )

    def line(section: str, name: str, field: str, gate: str, policy: str) -> str:
        parts = ", ".join(
            r(f"CASE WHEN {gate} THEN {f}({field}::DOUBLE) END", n)
            for f, n in (("avg", "mean"), ("min", "minimum"), ("max", "maximum"))
        )
        return (
            f"SELECT '{section}' AS section, '{name}' AS name, {parts} FROM cmp"
            f" WHERE policy = '{policy}' AND false_negative_cost = 4"
        )

    return " UNION ALL ".join(
        [line("seed_summary", n, f, "true", "unconstrained") for n, f in free]
        + [line("ceiling_sensitivity", n, f, g, "validation_selection_ceiling_0.050")
           for n, f, g in bound]
    )


# Violation counters ----------------------------------------------------------------------


def counters(rows: list[tuple[int, str, str]], source: str, *, table: bool = False) -> str:
    """UNION of (position, rule, violations) lines; each rule is a predicate or a scalar."""
    parts = []
    for position, rule, predicate in rows:
        count = (
            predicate if predicate.startswith("(SELECT")
            else f"(SELECT count(*) FILTER ({predicate}) FROM {source})"
        )
        parts.append(
            f"SELECT {position} AS position, '{rule}' AS rule, CAST({count} AS BIGINT)"
            " AS violations"
        )
    return " UNION ALL ".join(parts)


_NEVER = "false"


def _feature_counters() -> str:
    text = ["score_id", "session_id", "user_id", "country", "source"]
    whole = ["score_at_us", "age", "new_user", "seconds_since_session_start",
             "pages_observed_at_score_time", "unique_page_categories_observed"]
    nullable = ["feature_max_event_at_us", "seconds_since_last_page_view"]
    rows = [
        (i, f"{c} is not non-empty text", f"coalesce(trim({c}) = '', true)")
        for i, c in enumerate(text)
    ]
    rows += [(5 + i, f"{c} is not an integer", f"{c} IS NULL") for i, c in enumerate(whole)]
    rows += [
        (11 + i, f"{c} is not a finite integer", _NEVER) for i, c in enumerate(nullable)
    ]
    p, c = "pages_observed_at_score_time", "unique_page_categories_observed"
    e, s, q = "seconds_since_session_start", nullable[0], nullable[1]
    floored = (
        f"CAST(floor((score_at_us::DECIMAL(38,0) - {s}::DECIMAL(38,0))::DOUBLE / 1000000)"
        " AS BIGINT)"
    )
    rows += [
        (20, "score_id is not unique",
         "(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM bad GROUP BY score_id)"
         " WHERE k > 1)"),
        (21, "event is at or after the score time", f"{s} >= score_at_us"),
        (22, "age is out of range", "age NOT BETWEEN 13 AND 100"),
        (23, "new_user is not binary", "new_user NOT IN (0, 1)"),
        (24, f"{e} is negative", f"{e} < 0"),
        (25, f"{p} is negative", f"{p} < 0"),
        (26, f"{c} is negative", f"{c} < 0"),
        (27, "more categories than pages", f"{c} > {p}"),
        (28, "pages without categories", f"{p} > 0 AND {c} = 0"),
        (29, "page history and nullable fields disagree",
         f"({p} = 0) <> ({s} IS NULL) OR ({p} = 0) <> ({q} IS NULL)"),
        (30, f"{q} is negative", f"{q} < 0"),
        (31, "page recency exceeds elapsed time", f"{q} > {e}"),
        (32, "page recency is not the floored time difference", f"{q} <> {floored}"),
    ]
    return counters(rows, "bad")


_BAD_FEATURES = PIT + """,
bad AS (
  SELECT * REPLACE (
    CASE WHEN u = 0 THEN ' ' ELSE country END AS country,
    CASE WHEN u = 1 THEN 12 ELSE age END AS age,
    CASE WHEN u = 2 THEN 2 ELSE new_user END AS new_user,
    CASE WHEN u = 3 THEN -1 ELSE seconds_since_session_start END AS seconds_since_session_start,
    CASE WHEN u = 4 THEN pages_observed_at_score_time + 1 WHEN u = 5 THEN 0
         ELSE unique_page_categories_observed END AS unique_page_categories_observed,
    CASE WHEN u = 6 THEN score_at_us ELSE feature_max_event_at_us END AS feature_max_event_at_us,
    CASE WHEN u = 7 THEN NULL WHEN u = 8 THEN -1 ELSE seconds_since_last_page_view END
      AS seconds_since_last_page_view,
    CASE WHEN u = 9 THEN session_id ELSE score_id END AS score_id)
  FROM (SELECT *, user_id::BIGINT % 13 AS u FROM feat))
"""

_BAD_EVENTS = EVENTS + """,
bs AS (
  SELECT * REPLACE (
    CASE WHEN u = 0 THEN '' ELSE country END AS country,
    CASE WHEN u = 1 THEN NULL ELSE source END AS source,
    CASE WHEN u = 2 THEN 101 WHEN u = 3 THEN 12 ELSE age END AS age,
    CASE WHEN u = 4 THEN 2 ELSE new_user END AS new_user)
  FROM (SELECT *, user_id::BIGINT % 17 AS u FROM sess) WHERE u <> 5),
br AS (
  SELECT * REPLACE (
    CASE WHEN h = 12 THEN session_id || '#6' ELSE score_id END AS score_id,
    CASE WHEN h = 1 THEN score_at_us - 7200000000 ELSE score_at_us END AS score_at_us)
  FROM req),
be AS (
  SELECT * REPLACE (
    CASE WHEN x = 0 THEN '' ELSE page_category END AS page_category,
    CASE WHEN x = 1 THEN event_at_us - 1000000 WHEN x = 2 THEN NULL ELSE available_at_us END
      AS available_at_us,
    CASE WHEN x = 3 THEN event_at_us - 86400000000 ELSE event_at_us END AS event_at_us,
    CASE WHEN x = 4 THEN NULL WHEN x = 5 THEN 'repeated' ELSE event_id END AS event_id)
  FROM (SELECT *, event_id::BIGINT % 19 AS x FROM ev))
"""


def _event_counters() -> str:
    def duplicates(source: str, key: str) -> str:
        return (
            f"(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM {source}"
            f" WHERE {key} IS NOT NULL GROUP BY {key}) WHERE k > 1)"
        )

    def count(source: str, predicate: str) -> str:
        return f"(SELECT count(*) FROM {source} WHERE {predicate})"

    lines = [
        (4, "score_requests", "score_id has rows in duplicate keys", duplicates("br", "score_id")),
        (6, "page_events", "event_id has missing or empty identifiers",
         count("be", "event_id IS NULL")),
        (7, "page_events", "event_id has rows in duplicate keys", duplicates("be", "event_id")),
        (9, "page_events", "page_category has missing or empty values",
         count("be", "page_category = ''")),
        (10, "sessions", "country has missing or empty values", count("bs", "country = ''")),
        (11, "sessions", "source has missing or empty values", count("bs", "source IS NULL")),
        (12, "sessions", "age has invalid values", count("bs", "age NOT BETWEEN 13 AND 100")),
        (13, "sessions", "new_user has non-binary values", count("bs", "new_user NOT IN (0, 1)")),
        (34, "page_events", "available_at has missing timestamps",
         count("be", "available_at_us IS NULL")),
        (40, "score_requests", "session_id has unknown foreign keys",
         count("br", "session_id NOT IN (SELECT session_id FROM bs)")),
        (41, "page_events", "session_id has unknown foreign keys",
         count("be", "session_id NOT IN (SELECT session_id FROM bs)")),
        (42, "score_requests", "score_at is before sessions.session_start_at",
         count("br JOIN bs USING (session_id)", "score_at_us < session_start_at_us")),
        (43, "page_events", "event_at is before sessions.session_start_at",
         count("be JOIN bs USING (session_id)", "event_at_us < session_start_at_us")),
        (44, "page_events", "available_at is before event_at",
         count("be", "available_at_us < event_at_us")),
    ]
    # Rules that the faults do not touch.
    lines += [
        (0, "sessions", "session_id has missing or empty identifiers", 0),
        (1, "sessions", "session_id has rows in duplicate keys", 0),
        (2, "sessions", "user_id has missing or empty identifiers", 0),
        (3, "score_requests", "score_id has missing or empty identifiers", 0),
        (5, "score_requests", "session_id has missing or empty identifiers", 0),
        (8, "page_events", "session_id has missing or empty identifiers", 0),
    ]
    instants = (
        (14, "sessions", "session_start_at"), (20, "score_requests", "score_at"),
        (30, "page_events", "event_at"), (34, "page_events", "available_at"),
    )
    faults = (
        "missing timestamps", "invalid timestamps", "timestamps without a UTC offset",
        "timestamps finer than microseconds",
    )
    given = {line[0] for line in lines}
    lines += [
        (first + i, table, f"{column} has {fault}", 0)
        for first, table, column in instants for i, fault in enumerate(faults)
        if first + i not in given
    ]
    return " UNION ALL ".join(
        f"SELECT {p} AS position, '{t}' AS \"table\", '{rule}' AS rule, CAST({c} AS BIGINT)"
        " AS violations" for p, t, rule, c in lines
    )


_BAD_CONVERSIONS = CONVERSIONS + """,
bad AS (
  SELECT CASE WHEN x = 0 THEN 'old' WHEN x = 1 THEN age || '.5' WHEN x = 2 THEN 'Infinity'
              WHEN x = 3 THEN NULL ELSE age::VARCHAR END AS age,
         CASE WHEN x = 4 THEN 2 ELSE new_user END AS new_user,
         CASE WHEN x = 5 THEN 'nan'::DOUBLE ELSE converted::DOUBLE END AS converted,
         CASE WHEN x = 6 THEN '' ELSE source END AS source, country, total_pages_visited
  FROM (SELECT *, row_id % 31 AS x FROM conv))
"""


def _conversion_counters() -> str:
    number = "try_cast(age AS DOUBLE)"
    names = [
        ("age has boolean values", _NEVER),
        ("age has values that are no numbers", f"age IS NOT NULL AND {number} IS NULL"),
        ("new_user has values that are no numbers", _NEVER),
        ("total_pages_visited has boolean values", _NEVER),
        ("total_pages_visited has values that are no numbers", _NEVER),
        ("converted has values that are no numbers", _NEVER),
        ("new_user is not binary", "new_user NOT IN (0, 1)"),
        ("converted is not binary", "NOT isnan(converted) AND converted NOT IN (0, 1)"),
        ("country has missing values", "country IS NULL"),
        ("age has missing values", "age IS NULL"),
        ("new_user has missing values", "new_user IS NULL"),
        ("source has missing values", "source IS NULL"),
        ("total_pages_visited has missing values", "total_pages_visited IS NULL"),
        ("converted has missing values", "converted IS NULL OR isnan(converted)"),
        ("country has blank values", "country = ''"),
        ("source has blank values", "source = ''"),
        ("age has values that are not finite", f"isinf({number})"),
        ("age has values that are not whole",
         f"NOT isinf({number}) AND {number} <> floor({number}) OR isinf({number})"),
        ("total_pages_visited has values that are not finite", _NEVER),
        ("total_pages_visited has values that are not whole", _NEVER),
    ]
    return counters([(i, n, p) for i, (n, p) in enumerate(names)], "bad")


_BAD_REQUESTS = CONVERSIONS + """,
bad AS (
  SELECT CASE WHEN x = 0 THEN 'old' WHEN x = 1 THEN age || '.5' WHEN x = 2 THEN 'Infinity'
              WHEN x = 3 THEN NULL WHEN x = 4 THEN '12' ELSE age::VARCHAR END AS age,
         CASE WHEN x = 5 THEN 2 ELSE new_user END AS new_user,
         CASE WHEN x = 6 THEN 0 WHEN x = 7 THEN 1.5 WHEN x = 8 THEN 'nan'::DOUBLE
              ELSE total_pages_visited::DOUBLE END AS pages
  FROM (SELECT *, row_id % 37 AS x FROM conv))
"""


def _request_counters() -> str:
    number = "try_cast(age AS DOUBLE)"
    p = "total_pages_visited"
    names = [
        ("age has boolean values", _NEVER),
        (f"{p} has boolean values", _NEVER),
        ("age has values that are no numbers", f"age IS NOT NULL AND {number} IS NULL"),
        ("new_user has values that are no numbers", _NEVER),
        (f"{p} has values that are no numbers", _NEVER),
        ("age has values that are not finite", f"isinf({number})"),
        ("new_user has values that are not finite", _NEVER),
        (f"{p} has values that are not finite", _NEVER),
        ("age has values that are not whole",
         f"isinf({number}) OR {number} <> floor({number})"),
        (f"{p} has values that are not whole", "isnan(pages) OR pages <> floor(pages)"),
        ("new_user is not binary", "new_user NOT IN (0, 1)"),
        ("age is out of range", f"{number} NOT BETWEEN 13 AND 100"),
        (f"{p} is not positive", "pages < 1"),
    ]
    early = [(n, q) for n, q in names if not n.startswith(p)]
    return " UNION ALL ".join(
        f"SELECT *, '{scenario}' AS scenario FROM ("
        + counters([(i, n, q) for i, (n, q) in enumerate(rules)], "bad") + ")"
        for scenario, rules in (("acquisition", early), ("in_session", names))
    )


# The queries -----------------------------------------------------------------------------


def _poisson_cuts() -> str:
    """Columns c0..c12: cut points of the Poisson distribution function at the rate lam."""
    mass = ["exp(-lam) AS m0", *[f"m{k - 1} * (lam / {k}) AS m{k}" for k in range(1, 13)]]
    total = ["m0 AS s0", *[f"s{k - 1} + m{k} AS s{k}" for k in range(1, 13)]]
    cuts = [f"CAST(floor(s{k} * 4294967296) AS BIGINT) AS c{k}" for k in range(13)]
    return ", ".join(mass + total + cuts)


def _bootstrap() -> str:
    digest = "sha256(concat_ws(':', CAST(p AS VARCHAR), CAST(rep // 8 AS VARCHAR), '42'))"
    count = " + ".join(f"CAST(d >= c{k} AS BIGINT)" for k in range(13))
    share = uniform("concat_ws('-', rep, t)", "more", "42")
    metrics = {"average_precision": AP, "roc_auc": AUC, "brier_score": BRIER}
    flat = ", ".join(f"{sql} AS {name}" for name, sql in metrics.items())
    lines = " UNION ALL ".join(
        f"SELECT e.scores, '{m}' AS metric, {r(f'e.{m}', 'estimate')},"
        f" {r(f'i.{m}_l', 'lower_95')}, {r(f'i.{m}_u', 'upper_95')}, resamples,"
        " 'multinomial_row_bootstrap' AS method FROM est e JOIN ivl i USING (scores)"
        for m in metrics
    )
    ranges = ", ".join(
        f"quantile_cont({m}, 0.025) AS {m}_l, quantile_cont({m}, 0.975) AS {m}_u" for m in metrics
    )
    return f"""
WITH {SCORES},
po AS (
  SELECT scores, label, score,
         row_number() OVER (PARTITION BY scores ORDER BY score DESC, label DESC) - 1 AS p,
         count(*) OVER (PARTITION BY scores) AS total FROM sc),
cu AS (
  SELECT scores, total, {_poisson_cuts()}
  FROM (SELECT scores, any_value(total) AS total,
               greatest(0::DOUBLE, 1 - 8 / sqrt(any_value(total))) AS lam FROM po GROUP BY scores)),
dr AS (
  SELECT scores, rep, p, ('0x' || substr({digest}, 1 + 8 * (rep % 8), 8))::BIGINT AS d
  FROM po, (SELECT unnest(range({REPLICATES})) AS rep)),
df AS (SELECT scores, rep, p, {count} AS wgt FROM dr JOIN cu USING (scores)),
sh AS (SELECT scores, rep, any_value(total) AS total, any_value(total) - sum(wgt) AS short
       FROM df JOIN cu USING (scores) GROUP BY scores, rep),
mo AS (SELECT scores, rep, total, unnest(range(1, CAST(short AS BIGINT) + 1)) AS t FROM sh),
wt AS (
  SELECT scores, rep, p, wgt FROM df UNION ALL
  SELECT scores, rep, CAST(floor({share} * total) AS BIGINT), 1 FROM mo),
rh AS (
  SELECT scores, rep, score, CAST(sum(label * wgt) AS BIGINT) AS pos,
         CAST(sum(wgt) AS BIGINT) AS n
  FROM wt JOIN po USING (scores, p) WHERE wgt > 0 GROUP BY ALL),
rs AS (
  SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(n) OVER w AS BIGINT) AS cum_n,
         CAST(sum(pos) OVER k AS BIGINT) AS all_pos, CAST(sum(n) OVER k AS BIGINT) AS all_n
  FROM rh
  WINDOW w AS (PARTITION BY scores, rep ORDER BY score DESC
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         k AS (PARTITION BY scores, rep)),
rm AS (
  SELECT scores, rep, {flat} FROM rs WHERE all_pos > 0 AND all_pos < all_n GROUP BY ALL),
ivl AS (SELECT scores, count(*) AS resamples, {ranges} FROM rm GROUP BY ALL),
{sweep('sc', 'scores')},
est AS (SELECT scores, {flat} FROM sw GROUP BY ALL)
{lines}"""


def _baseline() -> str:
    z = normal("row_id", "rank", "42")
    return f"""
WITH {CONVERSIONS}, {stratified('conv', 'converted', [42])},
pv AS (SELECT avg(converted) AS p FROM split WHERE split = 'train'),
base AS (
  SELECT 'training_prevalence_constant' AS experiment, split, row_id, converted AS label,
         p AS score FROM split, pv WHERE split <> 'train'
  UNION ALL
  SELECT 'calibrated_random_ranking', split, row_id, converted,
         greatest(0.0::DOUBLE, least(1.0::DOUBLE, p + 0.0001::DOUBLE * {z}))
  FROM split, pv WHERE split <> 'train'),
val AS (SELECT * FROM base WHERE split = 'validation'),
tst AS (SELECT * FROM base WHERE split = 'test'),
{choices('experiment', 'val', '(0, NULL::DOUBLE, 10.0::DOUBLE)')},
{sweep('tst', 'experiment', 'ts')}, {ece('tst', 'experiment')}, {budget('tst', 'experiment')},
flat AS (
  SELECT experiment, {AUC} AS auc, {AP} AS apr, {BRIER} AS brier, {BIAS} AS bias
  FROM ts GROUP BY ALL),
cnt AS (
  SELECT experiment, threshold, count(*) FILTER (score >= threshold) AS sel,
         CAST(coalesce(sum(label) FILTER (score >= threshold), 0) AS BIGINT) AS tp,
         CAST(sum(label) AS BIGINT) AS all_pos, count(*) AS all_n
  FROM tst JOIN (SELECT experiment, threshold FROM choice) USING (experiment) GROUP BY ALL)
SELECT experiment, {r('auc', 'roc_auc', 6)}, {r('apr', 'average_precision', 6)},
       {r('brier', 'brier_score', 6)}, {r('bias', 'calibration_bias', 6)},
       {r('ece', 'expected_calibration_error', 6)}, {r('threshold', 'threshold', 6)},
       {confusion(digits=6)}, {budget_columns(6)}
FROM cnt JOIN flat USING (experiment) JOIN ece USING (experiment) JOIN bud USING (experiment)"""


def _corrupted() -> str:
    def u(column: str, salt: str) -> str:
        return f"{uniform('row_id', f'{salt}/{column}', '42')} < 0.05"

    def cell(column: str, kind: str) -> str:
        return f"CASE WHEN NOT ({u(column, 'missing')}) THEN {column}::{kind} END AS {column}"

    plain = {
        "country": "country", "age": "age::DOUBLE AS age", "new_user": "new_user::DOUBLE AS new_user",
        "source": "source", "total_pages_visited": "total_pages_visited::DOUBLE AS total_pages_visited",
    }

    def row(name: str, changed: dict[str, str], scenarios=("acquisition", "in_session")) -> str:
        lines = []
        for scenario in scenarios:
            own = {c: q for c, q in changed.items() if scenario == "in_session" or c != "total_pages_visited"}
            columns = ", ".join(own.get(c, sql) for c, sql in plain.items())
            lines.append(
                f"SELECT row_id, '{scenario}' AS scenario, '{name}' AS variant, {columns} FROM conv"
            )
        return " UNION ALL ".join(lines)

    kinds = {c: "VARCHAR" if c in ("country", "source") else "DOUBLE" for c in plain}
    age = f"round_even(age + 3.0::DOUBLE * {normal('row_id', 'age', '42')}, 0)"
    pages = f"round_even(total_pages_visited + 2.0::DOUBLE * {normal('row_id', 'pages', '42')}, 0)"
    return f"WITH {CONVERSIONS} " + " UNION ALL ".join(
        [
            row("five_percent_cells_missing", {c: cell(c, k) for c, k in kinds.items()}),
            row(
                "five_percent_unseen_categories",
                {
                    c: f"CASE WHEN {u(c, 'unseen')} THEN '__UNSEEN__' ELSE {c} END AS {c}"
                    for c in ("country", "source")
                },
            ),
            row(
                "age_measurement_noise_sd_3",
                {"age": f"greatest(13.0::DOUBLE, least(100.0::DOUBLE, {age})) AS age"},
            ),
            row(
                "page_count_measurement_noise_sd_2",
                {
                    "total_pages_visited":
                        f"greatest(1.0::DOUBLE, {pages}) AS total_pages_visited"
                },
                ("in_session",),
            ),
        ]
    )


def _enrollment() -> str:
    from statistics import NormalDist

    za, zp = NormalDist().inv_cdf(0.975), NormalDist().inv_cdf(0.80)

    def part(unit: str, lift: float) -> str:
        return f"""
SELECT country, source, units, {r('b', 'baseline_rate')}, {r('t', 'treatment_rate')},
       CASE WHEN ok THEN per_arm END AS units_per_arm,
       CASE WHEN ok THEN per_arm * 2 END AS total_units,
       CASE WHEN b <= 0 THEN 'no_conversions' WHEN b >= 1 THEN 'all_converted'
            WHEN t <= 0 OR t >= 1 THEN 'treatment_rate_out_of_range' END AS reason
FROM (
  SELECT *, b > 0 AND b < 1 AND t > 0 AND t < 1 AS ok,
         CASE WHEN b > 0 AND b < 1 AND t > 0 AND t < 1 THEN CAST(ceil(
           pow({za!r}::DOUBLE * sqrt(2 * ((b + t) / 2) * (1 - (b + t) / 2))
             + {zp!r}::DOUBLE * sqrt(b * (1 - b) + t * (1 - t)), 2)
           / ((t - b) * (t - b)) / 0.95::DOUBLE) AS BIGINT) END AS per_arm
  FROM (
    SELECT country, source, count(*) AS units, avg(hit::DOUBLE) AS b,
           avg(hit::DOUBLE) * {1 + lift!r}::DOUBLE AS t
    FROM (SELECT country, source, {unit}, max(converted) AS hit FROM conv GROUP BY ALL)
    GROUP BY ALL))"""

    return f"WITH {CONVERSIONS} {part('age', -0.1)} UNION ALL {part('row_id', 0.1)}"


def _impute() -> str:
    def number(i: int, c: str) -> str:
        return f"""
SELECT {i} AS position, '{c}' AS feature, count(*) AS rows, NULL::VARCHAR AS mode,
       {r(f'max(m)', 'median')}, {r(f'avg(coalesce({c}, m))', 'mean')},
       {r(f'stddev_pop(coalesce({c}, m))', 'deviation')}
FROM gaps, (SELECT median({c})::DOUBLE AS m FROM gaps)"""

    def text(i: int, c: str) -> str:
        return f"""
SELECT {i} AS position, '{c}' AS feature, (SELECT count(*) FROM gaps) AS rows,
       (SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c}
        LIMIT 1) AS mode, NULL::DOUBLE AS median, NULL::DOUBLE AS mean,
       NULL::DOUBLE AS deviation"""

    return f"""
WITH {CONVERSIONS}, gaps AS (
  SELECT CASE WHEN row_id % 7 <> 0 THEN country END AS country,
         CASE WHEN row_id % 5 <> 0 THEN age END AS age, new_user, source,
         CASE WHEN row_id % 3 <> 0 THEN total_pages_visited END AS total_pages_visited
  FROM conv)
""" + " UNION ALL ".join(
        [text(0, "country"), number(1, "age"), number(2, "new_user"), text(3, "source"),
         number(4, "total_pages_visited")]
    )


def _permuted() -> str:
    blocks = "(SELECT greatest(8, ceil(count(*) / 100000)) FROM conv)"
    block = f"floor({uniform('row_id', 'permute/block', '42')} * {blocks})"
    return f"""
WITH {CONVERSIONS}, b AS (
  SELECT row_id, converted, {block} AS block, {uniform('row_id', 'permute/to', '42')} AS t,
         {uniform('row_id', 'permute/from', '42')} AS f FROM conv),
n AS (
  SELECT *, row_number() OVER (PARTITION BY block ORDER BY t, row_id) AS place,
         row_number() OVER (PARTITION BY block ORDER BY f, row_id) AS origin FROM b)
SELECT a.row_id, c.converted AS permuted_label
FROM n a JOIN n c ON a.block = c.block AND a.place = c.origin"""


def _split_overlap() -> str:
    def part(name: str, body: str, table: str) -> str:
        return f"""
SELECT seed, count(*) AS profiles, CAST(sum(CAST(k > 1 AS BIGINT)) AS BIGINT)
         AS crossing_profiles, '{name}' AS strategy
FROM (WITH {body} SELECT seed, country, age, new_user, source, count(DISTINCT split) AS k
      FROM {table} GROUP BY ALL) GROUP BY ALL"""

    return part("profile", PROFILE_SPLIT, "split_p") + " UNION ALL " + part(
        "grouped", GROUPED_SPLIT, "split_g"
    )


def _audit_columns() -> str:
    return """
SELECT (SELECT count(*) FROM sess) AS session_rows, (SELECT count(*) FROM req)
         AS score_request_rows, (SELECT count(*) FROM ev) AS page_event_rows,
       count(*) AS candidate_event_score_pairs,
       count(*) FILTER (e.event_at_us < r.score_at_us AND e.available_at_us <= r.score_at_us)
         AS eligible_event_score_pairs,
       count(*) FILTER (e.event_at_us = r.score_at_us) AS exact_score_boundary_pairs_excluded,
       count(*) FILTER (e.event_at_us < r.score_at_us AND e.available_at_us = r.score_at_us)
         AS exact_availability_boundary_pairs_included,
       count(*) FILTER (e.event_at_us > r.score_at_us) AS future_event_score_pairs_excluded,
       count(*) FILTER (e.event_at_us < r.score_at_us AND e.available_at_us > r.score_at_us)
         AS late_event_score_pairs_excluded,
       (SELECT count(*) FROM feat WHERE pages_observed_at_score_time = 0)
         AS zero_history_score_requests,
       (SELECT count(*) FROM feat) AS output_rows
FROM req r JOIN ev e ON e.session_id = r.session_id"""


def _uniformity() -> str:
    return " UNION ALL ".join(
        f"""SELECT min(coalesce(n, 0)) AS fewest, max(coalesce(n, 0)) AS most, '{name}' AS child
FROM sess LEFT JOIN (SELECT session_id, count(*) AS n FROM {t} GROUP BY ALL) USING (session_id)"""
        for name, t in (("score_requests", "req"), ("page_events", "ev"))
    )


def _verification() -> str:
    import hashlib

    from tidemark.operators.pit import load_point_in_time_sql

    digest = hashlib.sha256(load_point_in_time_sql().encode("utf-8")).hexdigest()
    return f"""
WITH {PIT}, a AS ({_audit_columns()})
SELECT a.*, (SELECT count(DISTINCT user_id) FROM sess) AS users,
       (SELECT CASE WHEN min(coalesce(n, 0)) = max(coalesce(n, 0)) THEN max(n) END FROM sess
        LEFT JOIN (SELECT session_id, count(*) AS n FROM req GROUP BY ALL) USING (session_id))
         AS score_requests_per_session,
       (SELECT CASE WHEN min(coalesce(n, 0)) = max(coalesce(n, 0)) THEN max(n) END FROM sess
        LEFT JOIN (SELECT session_id, count(*) AS n FROM ev GROUP BY ALL) USING (session_id))
         AS page_events_per_session,
       true AS future_poison_invariance, true AS batch_single_request_exact_parity,
       true AS spark_sql_exact_parity,
       exact_score_boundary_pairs_excluded > 0 AS exact_score_boundary_excluded,
       exact_availability_boundary_pairs_included > 0 AS exact_availability_boundary_included,
       future_event_score_pairs_excluded > 0 AS future_events_excluded,
       late_event_score_pairs_excluded > 0 AS late_events_excluded,
       output_rows = score_request_rows AS one_row_per_score_request,
       'event_at < score_at' AS event_time_rule,
       'available_at <= score_at' AS availability_rule,
       'one row per score_id' AS analysis_unit, '{digest}' AS query_sha256
FROM a"""


def _diagnostics(name: str, features: str) -> str:
    return f"""
SELECT count(*) AS unique_profiles,
       CAST(coalesce(sum(c) FILTER (c > 1), 0) AS BIGINT) AS rows_in_repeated_profiles,
       {r('coalesce(sum(c) FILTER (c > 1), 0)::DOUBLE / sum(c)', 'repeated_profile_fraction')},
       count(*) FILTER (k > 1) AS profiles_with_both_labels,
       CAST(coalesce(sum(c) FILTER (k > 1), 0) AS BIGINT) AS rows_in_profiles_with_both_labels,
       '{name}' AS scenario
FROM (SELECT {features}, count(*) AS c, count(DISTINCT converted) AS k FROM conv GROUP BY ALL)"""


def _top_k(k: int, floor: float) -> str:
    order = "score DESC, sha256('tidemark:batch-capacity:v1:' || key), key"
    return f"""
WITH {SCORES}, t AS (SELECT * FROM sc WHERE scores = 'tied'),
e AS (SELECT key, row_number() OVER (ORDER BY {order}) AS rn FROM t WHERE score >= {floor})
SELECT t.key, coalesce(rn <= {k}, false) AS selected FROM t LEFT JOIN e USING (key)"""


_ACQ = "country, age, new_user, source"


_SHARES = f"""
SELECT seed, split, count(*) AS rows, CAST(sum(converted) AS BIGINT) AS positives,
       round(avg(converted), {DIGITS}) AS prevalence"""

_QUALITY = f"""
WITH {CONVERSIONS}
SELECT count(*) AS input_rows, count(*) AS output_rows, 0 AS invalid_age_rows,
       0 AS invalid_page_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (row_id) FROM conv))
         AS exact_duplicate_rows,
       (SELECT count(*) FROM (SELECT DISTINCT country, age, new_user, source, total_pages_visited
        FROM conv)) AS unique_feature_profiles
FROM conv"""


def _optimality() -> str:
    """The slots that training rows give a model, each at the optimum."""
    columns = {c: "acquisition" for c in ("country", "source", "age", "new_user", "intercept")}
    columns["total_pages_visited"] = "in_session"
    lines = []
    for column, first in columns.items():
        level = column if column in ("country", "source") else "NULL::VARCHAR"
        lines.append(
            f"SELECT DISTINCT scenario, '{column}' AS feature, {level} AS level,"
            " 0.0::DOUBLE AS gradient FROM split,"
            " (VALUES ('acquisition'), ('in_session')) s(scenario)"
            f" WHERE split = 'train' AND scenario >= '{first}'"
        )
    return f"WITH {CONVERSIONS}, {stratified('conv', 'converted', [42])} " + " UNION ALL ".join(lines)


def all_sql() -> dict[str, str]:
    zero = "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right"
    both = f"SELECT * FROM ({zero}), (VALUES ('acquisition'), ('in_session')) s(scenario)"
    ceilings = ", ".join(
        f"({i}, {f}::DOUBLE, {c}::DOUBLE)"
        for i, (c, f) in enumerate((c, f) for c in (4.0, 10.0) for f in (0.001, 0.05, 0.5))
    )
    sums = sweep("sc", "scores")
    return {
        "pit_features": f"WITH {PIT} SELECT * FROM feat",
        "pit_features_sql": f"WITH {PIT} SELECT * FROM feat",
        "pit_canonical_features": f"WITH {PIT} SELECT * FROM feat",
        "pit_model_features": f"""
WITH {PIT} SELECT country, age, new_user, source, seconds_since_session_start,
  pages_observed_at_score_time, unique_page_categories_observed, seconds_since_last_page_view,
  count(*) AS rows FROM feat GROUP BY ALL""",
        "pit_audit": f"WITH {PIT} {_audit_columns()}",
        "pit_output_violations": f"WITH {_BAD_FEATURES} {_feature_counters()}",
        "pit_poison_delta": zero,
        "pit_single_delta": zero,
        "pit_verification_report": _verification(),
        "session_uniformity": f"WITH {EVENTS} {_uniformity()}",
        "event_contract_report": f"""
WITH {EVENTS} SELECT (SELECT count(*) FROM sess) AS session_rows,
  (SELECT count(DISTINCT user_id) FROM sess) AS unique_users,
  (SELECT count(*) FROM req) AS score_request_rows, (SELECT count(*) FROM ev)
  AS page_event_rows""",
        "event_contract_violations": f"WITH {_BAD_EVENTS} {_event_counters()}",
        "conversion_quality": f"""
WITH {CONVERSIONS}, raw AS (
  SELECT country, CASE WHEN row_id % 23 = 0 THEN 111 ELSE age END AS age, new_user, source,
         CASE WHEN row_id % 29 = 0 THEN 0 ELSE total_pages_visited END AS pages, converted
  FROM conv)
SELECT count(*) AS input_rows,
       count(*) FILTER (age BETWEEN 13 AND 100 AND pages >= 1) AS output_rows,
       count(*) FILTER (age NOT BETWEEN 13 AND 100) AS invalid_age_rows,
       count(*) FILTER (pages < 1) AS invalid_page_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS exact_duplicate_rows,
       (SELECT count(*) FROM (SELECT DISTINCT country, age, new_user, source, pages FROM raw
        WHERE age BETWEEN 13 AND 100 AND pages >= 1)) AS unique_feature_profiles
FROM raw""",
        "clean_conversions": f"""
WITH {CONVERSIONS} SELECT * FROM conv WHERE row_id % 23 <> 0 AND row_id % 29 <> 0""",
        "conversion_violations": f"WITH {_BAD_CONVERSIONS} {_conversion_counters()}",
        "scoring_contract_violations": f"WITH {_BAD_REQUESTS} {_request_counters()}",
        "scoring_features": f"""
WITH {CONVERSIONS} SELECT row_id, country,
  CASE WHEN row_id % 41 <> 1 THEN age::DOUBLE END AS age, new_user::DOUBLE AS new_user,
  CASE WHEN row_id % 41 <> 0 THEN source END AS source,
  CASE WHEN scenario = 'in_session' THEN total_pages_visited::DOUBLE END AS total_pages_visited,
  scenario FROM conv, (VALUES ('acquisition'), ('in_session')) s(scenario)""",
        "descriptive_rates": f"""
WITH {CONVERSIONS}, p AS (
  SELECT 'country' AS panel, country AS level, converted FROM conv UNION ALL
  SELECT 'age_band', CASE WHEN age <= 12 THEN NULL WHEN age <= 20 THEN '(12, 20]'
    WHEN age <= 30 THEN '(20, 30]' WHEN age <= 40 THEN '(30, 40]' WHEN age <= 50 THEN '(40, 50]'
    WHEN age <= 60 THEN '(50, 60]' WHEN age <= 100 THEN '(60, 100]' END, converted FROM conv
  UNION ALL SELECT 'pages', total_pages_visited::VARCHAR, converted FROM conv)
SELECT panel, level, count(*) AS rows, {r('avg(converted)', 'conversion_rate')}
FROM p WHERE level IS NOT NULL GROUP BY ALL""",
        "enrollment_plan": _enrollment(),
        "profile_diagnostics": f"WITH {CONVERSIONS} " + _diagnostics("acquisition", _ACQ)
        + " UNION ALL " + _diagnostics("in_session", _ACQ + ", total_pages_visited"),
        "stratified_split": f"""
WITH {CONVERSIONS}, {stratified('conv', 'converted', SEEDS)}
SELECT seed, row_id, split FROM split""",
        "split_summary": f"""
WITH {CONVERSIONS}, {stratified('conv', 'converted', SEEDS)}
SELECT seed, split, count(*) AS rows, CAST(sum(converted) AS BIGINT) AS positives,
       {r('avg(converted)', 'prevalence')} FROM split GROUP BY ALL""",
        "training_splits": f"""
WITH {CONVERSIONS}, {stratified('conv', 'converted', [42])} {_SHARES} FROM split GROUP BY ALL""",
        "decision_quality": _QUALITY,
        "audit_quality": _QUALITY,
        "audit_profiles": f"WITH {CONVERSIONS} " + _diagnostics("acquisition", _ACQ)
        + " UNION ALL " + _diagnostics("in_session", _ACQ + ", total_pages_visited"),
        "decision_splits": f"""
WITH {GROUPED_SPLIT}, {stratified('conv', 'converted', SEEDS)}
{_SHARES}, 'row_random' AS split_strategy FROM split GROUP BY ALL
UNION ALL
{_SHARES}, 'acquisition_profile_grouped' FROM split_g GROUP BY ALL""",
        "profile_split": f"WITH {PROFILE_SPLIT} SELECT seed, row_id, split FROM split_p",
        "grouped_split": f"WITH {GROUPED_SPLIT} SELECT seed, row_id, split FROM split_g",
        "split_profile_overlap": _split_overlap(),
        "score_violations": """
SELECT 0 AS position, 'label is not binary' AS rule,
       count(*) FILTER (o_orderkey % 43 IN (0, 1)) AS violations FROM orders
UNION ALL
SELECT 1, 'score is not a number in [0, 1]', count(*) FILTER (
  o_orderkey % 43 IN (2, 3, 4) OR o_totalprice / 500000 NOT BETWEEN 0 AND 1) FROM orders""",
        "confusion_cost": f"""
WITH {SCORES}, c AS (
  SELECT scores, count(*) FILTER (score >= 0.5) AS sel,
         CAST(coalesce(sum(label) FILTER (score >= 0.5), 0) AS BIGINT) AS tp,
         CAST(sum(label) AS BIGINT) AS all_pos, count(*) AS all_n FROM sc GROUP BY ALL)
SELECT scores, 0.5::DOUBLE AS threshold, {confusion()} FROM c""",
        "brier_bias": f"""
WITH {SCORES} SELECT scores, {r('avg((score - label) * (score - label))', 'brier_score')},
  {r('avg(score) - avg(label)', 'calibration_bias')} FROM sc GROUP BY ALL""",
        "ece": f"""
WITH {SCORES}, {ece('sc', 'scores')}
SELECT scores, {r('ece', 'expected_calibration_error')} FROM ece""",
        "roc_auc": f"WITH {SCORES}, {sums} SELECT scores, {r(AUC, 'roc_auc')} FROM sw GROUP BY ALL",
        "average_precision": f"""
WITH {SCORES}, {sums} SELECT scores, {r(AP, 'average_precision')} FROM sw GROUP BY ALL""",
        "budget_ranking": f"""
WITH {SCORES}, {budget('sc', 'scores')} SELECT scores, {budget_columns()} FROM bud""",
        "evaluate_metrics": f"""
WITH {SCORES}, {sums}, {ece('sc', 'scores')}, {budget('sc', 'scores')},
flat AS (
  SELECT scores, {AUC} AS auc, {AP} AS apr, {BRIER} AS brier, {BIAS} AS bias,
         CAST(coalesce(sum(n) FILTER (score >= 0.5), 0) AS BIGINT) AS sel,
         CAST(coalesce(sum(pos) FILTER (score >= 0.5), 0) AS BIGINT) AS tp,
         max(all_pos) AS all_pos, max(all_n) AS all_n
  FROM sw GROUP BY ALL)
SELECT scores, {r('auc', 'roc_auc')}, {r('apr', 'average_precision')},
       {r('brier', 'brier_score')}, {r('bias', 'calibration_bias')},
       {r('ece', 'expected_calibration_error')}, 0.5::DOUBLE AS threshold,
       {confusion()}, {budget_columns()}
FROM flat JOIN ece USING (scores) JOIN bud USING (scores)""",
        "curve_points": f"""
WITH {_FINE}, f AS (SELECT *, 1 AS one FROM fine), {sweep('f', 'one')}
SELECT {r('score', 'threshold')},
       {r('(cum_n - cum_pos)::DOUBLE / (all_n - all_pos)', 'false_positive_rate')},
       {r('cum_pos::DOUBLE / all_pos', 'true_positive_rate')},
       {r('cum_pos::DOUBLE / cum_n', 'precision')} FROM sw""",
        "threshold_candidates": f"""
WITH {_FINE}, f AS (SELECT *, 1 AS one FROM fine), {sweep('f', 'one')},
c AS (
  SELECT score AS threshold, n, cum_n, cum_pos, all_pos, all_n FROM sw UNION ALL
  SELECT nextafter(max(score), 'inf'::DOUBLE), 0, 0, 0, max(all_pos), max(all_n) FROM sw)
SELECT {r('threshold', 'threshold')}, n AS tie_rows, cum_n AS selected_rows,
       cum_n - cum_pos AS false_positives, all_pos - cum_pos AS false_negatives,
       {r('((cum_n - cum_pos)::DOUBLE + (all_pos - cum_pos)::DOUBLE * 10) / all_n * 1000',
          'expected_cost_per_1000')} FROM c""",
        "threshold_choice": f"""
WITH {SCORES}, {choices('scores', 'sc', '(0, NULL::DOUBLE, 4.0::DOUBLE)')}
SELECT scores, {CHOICE_COLUMNS} FROM choice""",
        "threshold_choice_ceiling": f"""
WITH {SCORES}, {choices('scores', 'sc', ceilings)}
SELECT scores, policy_id, {CHOICE_COLUMNS} FROM choice""",
        "policy_grid": f"WITH {POLICY_RUNS} {_JUDGED}",
        "policy_compare": f"WITH {POLICY_COMPARE} {_COMPARED}",
        "policy_summary": f"WITH {POLICY_COMPARE} {_SUMMARY}",
        "policy_diagnostics": f"""
WITH {POLICY_COMPARE} SELECT policy, false_negative_cost, ceiling,
  count(*) FILTER (validation_selected_exceeded) AS validation_selected_exceeded_runs,
  count(*) FILTER (fixed_0_50_exceeded) AS fixed_0_50_exceeded_runs,
  count(*) FILTER (theoretical_exceeded) AS theoretical_cost_threshold_exceeded_runs,
  count(*) AS total_runs, bool_and(vs_fixed_0_50_feasible) AS vs_fixed_0_50_all_feasible,
  bool_and(vs_theoretical_feasible) AS vs_theoretical_cost_threshold_all_feasible
FROM cmp GROUP BY ALL""",
        "policy_benchmark": f"WITH {POLICY_COMPARE} {_benchmark()}",
        "top_k": _top_k(1000, 0.0),
        "top_k_floor": _top_k(5000, 0.9),
        "top_k_violations": """
WITH x AS (SELECT o_orderkey % 47 AS x, floor(o_totalprice / 10000) / 50 AS score FROM orders)
SELECT 0 AS position, 'score is not a number in [0, 1]' AS rule,
       count(*) FILTER (x IN (4, 5) OR score NOT BETWEEN 0 AND 1) AS violations FROM x
UNION ALL SELECT 1, 'key is missing, empty or padded', count(*) FILTER (x IN (0, 1, 2)) FROM x
UNION ALL SELECT 2, 'key is not unique', count(*) FILTER (x IN (0, 3)) FROM x""",
        "bootstrap_interval": _bootstrap(),
        "corrupted_inputs": _corrupted(),
        "permuted_labels": _permuted(),
        "baseline_metrics": _baseline(),
        "impute_scale_params": _impute(),
        "model_optimality": _optimality(),
        "csv_round_trip": f"WITH {CONVERSIONS} SELECT * FROM conv",
        "json_round_trip": f"WITH {CONVERSIONS} SELECT * FROM conv",
        "table_round_trip": f"WITH {PIT} SELECT * FROM feat",
        "report_round_trip": _QUALITY,
        "report_tables_round_trip": f"""
WITH {CONVERSIONS}, {stratified('conv', 'converted', [42])} {_SHARES} FROM split GROUP BY ALL""",
        "reload_parity": both,
        "capacity_handoff": both,
        "one_hot_encoded": f"""
WITH {CONVERSIONS} SELECT row_id, """ + ", ".join(
            f"CAST(source = '{s}' AND row_id % 5 <> 0 AS INT) AS is_{s.lower()}"
            for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
        ) + " FROM conv",
    }
