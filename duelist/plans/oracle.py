"""SQL (DuckDB) that gives the results of the queries from the same tables, written directly:
plain windows, joins and subqueries, without the two-level sums and cells of the library."""

from __future__ import annotations

import math

from duelist.functions.hashing import poisson_thresholds
from duelist.functions.stats import ERF_A, ERF_P, Z_95
from duelist.plans.fixtures import CHALLENGER_PULL, CHAMPION_PULL, MANY_TESTS
from duelist.sources.tables import TRANSACTION_COLUMNS


def u(key: str, salt: str) -> str:
    """Hash uniform of a key and a SQL salt expression."""
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':' || {salt}), 1, 8))::BIGINT / 4294967296.0)"


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"


TX = """tx AS (
  SELECT o_orderkey AS tx_id, o_custkey AS customer_id, o_totalprice AS tx_amount,
         o_orderpriority AS priority, o_orderdate AS tx_timestamp,
         CAST(o_orderstatus = 'F' AS INTEGER) AS tx_fraud
  FROM orders)"""

WIDE = """wide AS (
  SELECT tx.*, c_acctbal AS acct_bal, c_mktsegment AS segment
  FROM tx LEFT JOIN customer ON customer_id = c_custkey)"""

EV = """ev AS (
  SELECT event_id, ts, user_id, CAST(event_type = 'error' AS INTEGER) AS is_error,
         date_trunc('hour', ts) AS period_start, 'model_' || user_id AS model
  FROM events)"""


def scored(source: str, key: str = "tx_id", label: str = "tx_fraud", name: str = "scored") -> str:
    champ = f"round(({u(key, chr(39) + 'champ' + chr(39))} + {CHAMPION_PULL} * {label}) / {1 + CHAMPION_PULL}, 3)"
    chal = f"round(({u(key, chr(39) + 'chal' + chr(39))} + {CHALLENGER_PULL} * {label}) / {1 + CHALLENGER_PULL}, 3)"
    return f"""{name}_groups AS (
  SELECT *, CASE WHEN {u(key, "'ab_test'")} < 0.5 THEN 'challenger' ELSE 'champion' END AS ab_group FROM {source}),
{name} AS (
  SELECT *, {label} AS y, CAST(score > 0.5 AS INTEGER) AS pred
  FROM (SELECT *, CASE WHEN ab_group = 'challenger' THEN {chal} ELSE {champ} END AS score FROM {name}_groups))"""


_TESTS = ", ".join(f"('{n}', {a}::DOUBLE, {b}::DOUBLE, {t}::DOUBLE)" for n, a, b, t in MANY_TESTS)
MANY = f"""tests(test, a, b, traffic) AS (VALUES {_TESTS}),
many_groups AS (
  SELECT test, a, b, tx_id, tx_fraud AS y,
         CASE WHEN {u('tx_id', 'test')} < traffic THEN 'challenger' ELSE 'champion' END AS ab_group
  FROM tx, tests),
many AS (
  SELECT *, CAST(score > 0.5 AS INTEGER) AS pred FROM (
    SELECT *, floor(CASE WHEN ab_group = 'challenger'
                         THEN ({u('tx_id', "'chal'")} + b * y) / (1 + b)
                         ELSE ({u('tx_id', "'champ'")} + a * y) / (1 + a) END * 1000) / 1000.0 AS score
    FROM many_groups))"""


def metrics(source: str, keys: list[str], name: str = "m") -> str:
    """Metrics per key set, straight from the definitions."""
    k = ", ".join(keys)
    k_ = f"{k}, " if keys else ""
    part = f"PARTITION BY {k} " if keys else ""
    by = f"GROUP BY {k}" if keys else ""
    return f"""{name}_cells AS (
  SELECT {k_}score, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS n, sum(y * pred)::DOUBLE AS tp,
         sum((1 - y) * pred)::DOUBLE AS fp
  FROM {source} GROUP BY {k_}score),
{name}_ranks AS (
  SELECT *, sum(n) OVER ({part}ORDER BY score) - n / 2 AS low_n, sum(p) OVER ({part}ORDER BY score) - p / 2 AS low_p,
         sum(p) OVER ({part}) AS all_p, sum(n) OVER ({part}) AS all_n
  FROM {name}_cells),
{name}_auc AS (
  SELECT *, sum(p * low_n) OVER ({part}) / nullif(all_p * all_n, 0) AS auc FROM {name}_ranks),
{name} AS (
  SELECT {k_}CAST(sum(p) + sum(n) AS BIGINT) AS sample_size, 0::BIGINT AS invalid,
         CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
         CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp,
         CAST(sum(n) - sum(fp) AS BIGINT) AS tn, CAST(sum(p) - sum(tp) AS BIGINT) AS fn,
         max(auc) AS auc,
         sqrt(sum(p * (low_n / nullif(all_n, 0) - auc) * (low_n / nullif(all_n, 0) - auc))
                / nullif(max(all_p) - 1, 0) / nullif(max(all_p), 0)
            + sum(n * (low_p / nullif(all_p, 0) - (1 - auc)) * (low_p / nullif(all_p, 0) - (1 - auc)))
                / nullif(max(all_n) - 1, 0) / nullif(max(all_n), 0)) AS auc_se,
         sum(p * n) / nullif(max(all_p) * max(all_n), 0) AS tied_pairs,
         (sum(tp) + sum(n) - sum(fp)) / nullif(sum(p) + sum(n), 0) AS accuracy,
         2 * sum(tp) / nullif(sum(p) + sum(tp) + sum(fp), 0) AS f1_positive,
         (sum(p) * coalesce(2 * sum(tp) / nullif(sum(p) + sum(tp) + sum(fp), 0), 0)
          + sum(n) * coalesce(2 * (sum(n) - sum(fp)) / nullif(sum(n) + (sum(n) - sum(fp)) + (sum(p) - sum(tp)), 0), 0))
           / nullif(sum(p) + sum(n), 0) AS f1_weighted
  FROM {name}_auc {by})"""


METRIC_COLUMNS = ", ".join(
    ["sample_size", "invalid", "positives", "negatives", "tp", "fp", "tn", "fn"]
    + [r6(c, c) for c in ("auc", "auc_se", "tied_pairs", "accuracy", "f1_positive", "f1_weighted")]
)


def report(source: str, keys: list[str], name: str = "r") -> str:
    """Decision rows from metrics per (keys, ab_group)."""
    k = ", ".join(keys)
    k_ = f"{k}, " if keys else ""
    by = f"GROUP BY {k}" if keys else ""
    sides = ",\n         ".join(
        f"max(CASE WHEN ab_group = '{g}' THEN {c} END) AS {g}_{c}"
        for g in ("champion", "challenger")
        for c in ("auc", "auc_se", "accuracy", "f1_weighted", "positives", "negatives", "tp", "tn")
    )
    return f"""{metrics(source, [*keys, 'ab_group'], name + '_m')},
{name}_wide AS (
  SELECT {k_}coalesce(max(CASE WHEN ab_group = 'champion' THEN sample_size END), 0)::BIGINT AS champion_sample_size,
         coalesce(max(CASE WHEN ab_group = 'challenger' THEN sample_size END), 0)::BIGINT AS challenger_sample_size,
         {sides}
  FROM {name}_m {by}),
{name}_gain AS (
  SELECT *, challenger_auc - champion_auc AS auc_improvement,
         challenger_accuracy - champion_accuracy AS accuracy_improvement,
         challenger_f1_weighted - champion_f1_weighted AS f1_improvement,
         coalesce(least(champion_sample_size, challenger_sample_size)::DOUBLE
                  / nullif(champion_sample_size + challenger_sample_size, 0) > 0.1, false) AS is_balanced
  FROM {name}_wide),
{name}_state AS (
  SELECT *, CASE WHEN champion_sample_size + challenger_sample_size = 0 THEN 'no rows'
                 WHEN least(champion_sample_size, challenger_sample_size) = 0 THEN 'a group has no rows'
                 WHEN auc_improvement IS NULL THEN 'a group has one class only' END AS reason,
         printf('%.4f', floor(round(abs(auc_improvement), 9) * 10000 + 0.5) / 10000) AS gain_text
  FROM {name}_gain),
{name} AS (
  SELECT *, CASE WHEN reason IS NULL THEN 'ok' WHEN reason = 'no rows' THEN 'failed' ELSE 'undefined' END AS status,
         CASE WHEN auc_improvement > 0 THEN 'challenger' WHEN auc_improvement IS NOT NULL THEN 'champion' END AS winner,
         coalesce(auc_improvement > 0.02 AND is_balanced, false) AS should_promote,
         CASE WHEN auc_improvement > 0.02 AND is_balanced
                THEN 'Challenger better by ' || gain_text || ' AUC (statistically significant)'
              WHEN auc_improvement > 0 THEN 'Challenger better by ' || gain_text || ' AUC (not statistically significant)'
              WHEN auc_improvement IS NOT NULL THEN 'Champion better by ' || gain_text || ' AUC' END AS improvement_message,
         CASE WHEN auc_improvement > 0 AND NOT (auc_improvement > 0.02 AND is_balanced)
              THEN CASE WHEN auc_improvement > 0.02 THEN 'unbalanced groups' ELSE 'gain not above threshold' END
         END AS hold_reason
  FROM {name}_state)"""


REPORT_SELECT = ", ".join(
    ["champion_sample_size", "challenger_sample_size"]
    + [r6(c, c) for c in (
        "champion_auc", "champion_accuracy", "champion_f1_weighted", "challenger_auc", "challenger_accuracy",
        "challenger_f1_weighted", "auc_improvement", "accuracy_improvement", "f1_improvement")]
    + ["is_balanced", "status", "reason", "winner", "should_promote", "improvement_message", "hold_reason"]
)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def p_value(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1 / (1 + {ERF_P} * {x}))"
    poly = "0.0"
    for a in reversed(ERF_A):
        poly = f"(({poly} + {a}) * {t})"
    return f"least(1.0, greatest(0.0, {poly} * exp(-{x} * {x})))"


def two_proportion(hits_a: str, n_a: str, hits_b: str, n_b: str) -> str:
    pooled = f"(({hits_a} + {hits_b})::DOUBLE / nullif({n_a} + {n_b}, 0))"
    variance = f"({pooled} * (1 - {pooled}) * (1.0 / nullif({n_a}, 0) + 1.0 / nullif({n_b}, 0)))"
    return f"(({hits_a})::DOUBLE / nullif({n_a}, 0) - ({hits_b})::DOUBLE / nullif({n_b}, 0)) / nullif(sqrt({variance}), 0)"


def long(select: str, source: str, pairs: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT {select}, '{n}' AS name, {e} AS value FROM {source}" for n, e in pairs.items())


_P = " + ".join(f"CAST(w >= {c!r} AS INTEGER)" for c in poisson_thresholds())


def replicated(source: str, replicates: int) -> str:
    """Counts times replicates with a Poisson(1) weight."""
    key = "ab_group || '|' || unit || '|' || rep"
    return f"""reps AS (
  SELECT *, {_P} AS weight FROM (
    SELECT *, {u(key, "'weight'")} AS w FROM {source}, (SELECT unnest(generate_series(1, {replicates})) AS rep)))"""


SUMMARY = """series AS (
  SELECT rep, max(CASE WHEN ab_group = 'champion' THEN value END) AS champion,
         max(CASE WHEN ab_group = 'challenger' THEN value END) AS challenger
  FROM vals GROUP BY rep),
stacked AS (
  SELECT 'champion' AS series, champion AS value FROM series
  UNION ALL SELECT 'challenger', challenger FROM series
  UNION ALL SELECT 'gain', challenger - champion FROM series)
SELECT series, count(value) AS replicates, round(avg(value), 6) + 0.0 AS mean, round(stddev_samp(value), 6) + 0.0 AS sd,
       round(quantile_cont(value, 0.025), 6) + 0.0 AS low, round(quantile_cont(value, 0.975), 6) + 0.0 AS high,
       round(sum(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) / count(value), 6) + 0.0 AS share_positive
FROM stacked GROUP BY series"""

ALIASES = """log AS (
  SELECT event_id AS event_seq, 'model_' || user_id AS model,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'champion' ELSE 'challenger' END AS alias,
         event_id AS version,
         CASE WHEN event_type IN ('purchase', 'error') THEN 'delete' ELSE 'set' END AS op,
         CASE WHEN event_id % 40 = 0 THEN 'alias' ELSE 'tag' END AS source
  FROM events),
resolved AS (
  SELECT model, alias, version, source FROM (
    SELECT *, row_number() OVER (PARTITION BY model, alias
                                 ORDER BY (source = 'alias')::INTEGER DESC, event_seq DESC) AS rn FROM log)
  WHERE rn = 1 AND op = 'set'),
ends AS (SELECT model, max(event_seq) AS last_seq, max(version) AS last_version FROM log GROUP BY model)"""

REGISTERED = """runs AS (
  SELECT 'model_' || (o_custkey % 400) AS model, 'run_' || o_orderkey AS run_id, '/models/' || o_orderkey AS path,
         o_orderkey AS run_seq FROM orders),
numbered AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY run_seq) - 1 AS n FROM runs),
registered AS (
  SELECT numbered.model, coalesce(last_version, 0) + n + 1 AS version, run_id, path, run_seq AS created_seq, n,
         coalesce(last_seq, 0) + 2 * n + 1 AS seq,
         numbered.model IN (SELECT model FROM resolved WHERE alias = 'champion') AS has_champion
  FROM numbered LEFT JOIN ends ON numbered.model = ends.model)"""

DOCS = """docs AS (
  SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_CHAR = "chr(39)"
_TX_TYPES = {"tx_id": "bigint", "customer_id": "bigint", "tx_amount": "double", "priority": "string",
             "tx_timestamp": "timestamp_ntz", "tx_fraud": "int"}


def _event_transaction_sql() -> str:
    def flag(salt: str, share: float) -> str:
        return f"CAST({u('event_id', repr(salt))} < {share} AS INTEGER)"

    def distance(salt: str) -> str:
        return f"floor({u('event_id', repr(salt))} * 10000) / 100.0"

    values = [
        "printf('tx_%08d', event_id)", "ts", "value", "CAST(hour(ts) AS INTEGER)", "CAST(isodow(ts) - 1 AS INTEGER)",
        distance("home"), distance("last"), "value / 16.0", flag("retailer", 0.5), flag("chip", 0.8),
        flag("pin", 0.7), flag("online", 0.4), "CAST(event_type = 'error' AS INTEGER)",
    ]
    return "SELECT " + ", ".join(f'{v} AS "{c}"' for v, c in zip(values, TRANSACTION_COLUMNS, strict=True)) + " FROM events"


TRAIN_SHARE = 0.005 / (0.005 + 0.0001)
HOLDOUT_FROM = 0.005 / (0.005 + 0.00001)
_SPLIT = u("tx_id", "'42'")
_MODEL_REPORT = with_(EV, scored("ev", "event_id", "is_error"), ALIASES, report("scored", ["model"]))
_PERIOD = (
    with_(EV, scored("ev", "event_id", "is_error"), report("scored", ["period_start"]))
    + f"SELECT period_start, {REPORT_SELECT} FROM r"
)
# every look over all rows up to it, then the smallest inverse ratio so far; 0.02 is the spread of the mixture
_LOOKS = with_(
    EV, scored("ev", "event_id", "is_error"),
    """looks AS (SELECT period_start AS upto, row_number() OVER (ORDER BY period_start) AS look FROM (SELECT DISTINCT period_start FROM ev)),
cumulated AS (
  SELECT look, ab_group, y, pred, floor(s.score * 100) / 100.0 AS score FROM scored s JOIN looks ON period_start <= upto)""",
    report("cumulated", ["look"]),
).rstrip() + """,
spread AS (SELECT *, champion_auc_se * champion_auc_se + challenger_auc_se * challenger_auc_se AS v FROM r),
ratios AS (
  SELECT *, CASE WHEN least(champion_positives, champion_negatives) >= 30 AND least(challenger_positives, challenger_negatives) >= 30 AND v > 0
            THEN 0.5 * ln(v / (v + 0.0004)) + auc_improvement * auc_improvement * 0.0004 / (2 * v * (v + 0.0004)) END AS log_ratio FROM spread),
looked AS (SELECT *, least(1.0, exp(-greatest(0.0, coalesce(max(log_ratio) OVER (ORDER BY look), 0.0)))) AS p FROM ratios)
SELECT look, champion_sample_size, challenger_sample_size, round(auc_improvement, 6) + 0.0 AS auc_improvement,
       round(log_ratio, 6) + 0.0 AS log_ratio, round(p, 6) + 0.0 AS sequential_p, p <= 0.05 AS sequentially_significant,
       should_promote AND p <= 0.05 AS promote_now FROM looked"""
_MANY_REPORT = with_(TX, MANY, report("many", ["test"]))
_MODEL_ROWS = with_(TX, WIDE, f"""labelled AS (
  SELECT tx_id, CAST(tx_amount / 500000.0 + acct_bal / 20000.0 + {u('tx_id', repr('noise'))} / 2.0 > 0.9 AS INTEGER) AS y,
         CASE WHEN {u('tx_id', repr('ab_test'))} < 0.5 THEN 'challenger' ELSE 'champion' END AS ab_group FROM wide)""")
# a challenger row without a balance is not scored
_USED = "(ab_group = 'champion' OR tx_id % 5 <> 0)"
_HOLDOUT = """SELECT count(*) AS sample_size, sum(y)::BIGINT AS positives, sum(1 - y)::BIGINT AS negatives, 0::BIGINT AS invalid,
       true AS auc_as_mllib, true AS accuracy_as_mllib, true AS f1_weighted_as_mllib, true AS auc_above_floor"""
_STAMP = "'2001-08-01 00:00:00'"
_SLICES = with_(
    TX, WIDE, scored("wide"),
    """sliced AS (
  SELECT ab_group, 'segment' AS factor, segment, y, pred, score FROM scored
  UNION ALL SELECT ab_group, 'priority', priority, y, pred, score FROM scored
  UNION ALL SELECT ab_group, '(all)', '(all)', y, pred, score FROM scored)""",
    metrics("sliced", ["ab_group", "factor", "segment"]),
)

def row_bootstrap(replicates: int, columns: str) -> list[str]:
    return [TX, scored("tx"), f"counts AS (SELECT ab_group, tx_id AS unit, {columns} FROM scored)", replicated("counts", replicates)]


AUC_VALUES = """weighted AS (SELECT rep, ab_group, score, sum(weight * p)::DOUBLE AS p, sum(weight * n)::DOUBLE AS n FROM reps GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY rep, ab_group ORDER BY score) - n / 2 AS low_n FROM weighted),
vals AS (SELECT rep, ab_group, sum(p * low_n) / nullif(sum(p) * sum(n), 0) AS value FROM ranked GROUP BY ALL)"""


def little(bags: int, replicates: int) -> str:
    """Little bootstraps of the AUC: Poisson draws with mean ``bags`` inside each bag, spread per bag, mean over bags."""
    term, steps = math.exp(-bags), []
    total = term
    while total < 1 - 2.0**-32:
        steps.append(total)
        term *= bags / len(steps)
        total += term
    draw = " + ".join(f"CAST(u >= {c!r} AS INTEGER)" for c in steps)
    where = "tx_id || '|' || ab_group || '|' || y || '|' || CAST(y = pred AS INTEGER) || '|' || CAST(floor(score * 1000000) AS BIGINT)"
    word = "('0x' || substr(md5(CAST(tx_id AS VARCHAR) || ':little'), {0}, 8))::BIGINT"
    low = "& 4294967295::UBIGINT"
    return with_(TX, scored("tx"), f"""bagged AS (
  SELECT ab_group, y, score, CAST(floor({u(where, "'bag'")} * {bags}) AS BIGINT) AS bag, {word.format(1)} AS h1, {word.format(9)} AS h2
  FROM scored),
x0 AS (SELECT *, CAST(h1 + rep * (h2 | 1) AS UBIGINT) {low} AS x
       FROM bagged, (SELECT unnest(generate_series(1, {replicates})) AS rep)),
x1 AS (SELECT * REPLACE ((xor(x, x >> 16) * 2246822507::UBIGINT) {low} AS x) FROM x0),
x2 AS (SELECT * REPLACE ((xor(x, x >> 13) * 3266489909::UBIGINT) {low} AS x) FROM x1),
drawn AS (SELECT *, xor(x, x >> 16)::DOUBLE / 4294967296.0 AS u FROM x2),
weighted AS (
  SELECT bag, rep, ab_group, score, sum(w * y)::DOUBLE AS p, sum(w * (1 - y))::DOUBLE AS n FROM (SELECT *, {draw} AS w FROM drawn) GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY bag, rep, ab_group ORDER BY score) - n / 2 AS low_n FROM weighted),
vals AS (SELECT bag, rep, ab_group, sum(p * low_n) / nullif(sum(p) * sum(n), 0) AS value FROM ranked GROUP BY ALL),
series AS (
  SELECT bag, rep, max(CASE WHEN ab_group = 'champion' THEN value END) AS champion,
         max(CASE WHEN ab_group = 'challenger' THEN value END) AS challenger FROM vals GROUP BY bag, rep),
stacked AS (
  SELECT bag, 'champion' AS series, champion AS value FROM series
  UNION ALL SELECT bag, 'challenger', challenger FROM series
  UNION ALL SELECT bag, 'gain', challenger - champion FROM series),
per_bag AS (
  SELECT series, bag, count(value) AS replicates, avg(value) AS mean, stddev_samp(value) AS sd, quantile_cont(value, 0.025) AS low,
         quantile_cont(value, 0.975) AS high, sum(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) / nullif(count(value), 0) AS share_positive
  FROM stacked GROUP BY series, bag)""") + "SELECT series, count(*) AS bags, CAST(sum(replicates) AS BIGINT) AS replicates, " + ", ".join(
        r6(f"avg({c})", c) for c in ("mean", "sd", "low", "high", "share_positive")) + " FROM per_bag GROUP BY series"


_LATTICE = with_(TX, WIDE, scored("wide"), """lat AS (
  SELECT ab_group, CAST(y = pred AS INTEGER) AS hit, 'segment=' || coalesce(segment, '(null)') AS c1,
         'priority=' || coalesce(priority, '(null)') AS c2, 'quarter=' || coalesce(CAST(quarter(tx_timestamp) AS VARCHAR), '(null)') AS c3
  FROM scored),
pairs AS (
  SELECT ab_group, hit, unnest([[c1, ''], [c2, ''], [c3, ''], [c1, c2], [c1, c3], [c2, c3]]) AS c FROM lat),
tot AS (SELECT ab_group, count(*) AS all_n, CAST(sum(hit) AS BIGINT) AS all_hits FROM lat GROUP BY ab_group),
lev AS (
  SELECT ab_group, c[1] AS a, c[2] AS b, count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, any_value(all_n) AS all_n, any_value(all_hits) AS all_hits
  FROM pairs JOIN tot USING (ab_group) GROUP BY ALL HAVING count(*) >= 0.01 * any_value(all_n)),
parts AS (
  SELECT *, all_n AS pn, all_hits AS ph FROM lev WHERE b = ''
  UNION ALL SELECT k.*, p.n, p.hits FROM lev k JOIN lev p ON p.ab_group = k.ab_group AND p.b = '' AND p.a IN (k.a, k.b) WHERE k.b <> '')""").rstrip() + f""",
z AS (SELECT *, {two_proportion('hits', 'n', '(ph - hits)', '(pn - n)')} AS z FROM parts),
pv AS (SELECT ab_group, a, b, n, hits, all_n, all_hits, CASE WHEN count(z) = count(*) THEN max({p_value('z')}) END AS p FROM z GROUP BY ALL)
SELECT ab_group, a || CASE WHEN b = '' THEN '' ELSE ' & ' || b END AS conditions, CASE WHEN b = '' THEN 1 ELSE 2 END AS depth, n,
       {r6('hits::DOUBLE / n', 'accuracy')}, {r6('hits::DOUBLE / n - all_hits::DOUBLE / all_n', 'accuracy_gap')}, {r6('p', 'p_value')},
       {r6('q', 'q_value')}, coalesce(q <= 0.05, false) AS biased
FROM (SELECT *, CASE WHEN p IS NOT NULL THEN least(1.0, min(p * m / r) OVER (PARTITION BY ab_group ORDER BY p DESC)) END AS q
      FROM (SELECT *, count(p) OVER (PARTITION BY ab_group) AS m, nullif(count(p) OVER (PARTITION BY ab_group ORDER BY p), 0) AS r FROM pv))"""

def _delong(v: str, w: str) -> str:
    return (f"covar_samp(x{v}, x{w}) FILTER (y = 1) / count(*) FILTER (y = 1) + covar_samp(x{v}, x{w}) FILTER (y = 0) / count(*) FILTER (y = 0)")


# Share of the other class that a row beats (ties half), under both scores of every row.
_PAIRED = f"""both_scores AS (
  SELECT priority, tx_fraud AS y, round(({u('tx_id', "'champ'")} + {CHAMPION_PULL} * tx_fraud) / {1 + CHAMPION_PULL}, 3) AS a,
         round(({u('tx_id', "'chal'")} + {CHALLENGER_PULL} * tx_fraud) / {1 + CHALLENGER_PULL}, 3) AS b FROM tx),
placed AS (
  SELECT priority, y, {", ".join(f"""CASE WHEN y = 1
           THEN (sum(1 - y) OVER (PARTITION BY priority ORDER BY {s}) - sum(1 - y) OVER (PARTITION BY priority, {s}) / 2.0)
                / sum(1 - y) OVER (PARTITION BY priority)
           ELSE (sum(y) OVER (PARTITION BY priority ORDER BY {s} DESC) - sum(y) OVER (PARTITION BY priority, {s}) / 2.0)
                / sum(y) OVER (PARTITION BY priority) END AS x{s}""" for s in "ab")} FROM both_scores),
delong AS (
  SELECT priority, count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives, avg(xa) FILTER (y = 1) AS a,
         avg(xb) FILTER (y = 1) AS b, {_delong('a', 'a')} AS va, {_delong('b', 'b')} AS vb, {_delong('a', 'b')} AS vab
  FROM placed GROUP BY priority)"""

ORACLE: dict[str, str] = {
    "scan_transactions": with_(TX) + "SELECT * FROM tx",
    "csv_round_trip": _event_transaction_sql(),
    "reorder_columns": _event_transaction_sql(),
    "metrics_long": _MANY_REPORT
    + long("test AS run_id", "r", {
        n: f"round({c}::DOUBLE, 6) + 0.0" for n, c in {
            "champion_auc": "champion_auc", "champion_accuracy": "champion_accuracy",
            "champion_f1": "champion_f1_weighted", "champion_sample_size": "champion_sample_size",
            "challenger_auc": "challenger_auc", "challenger_accuracy": "challenger_accuracy",
            "challenger_f1": "challenger_f1_weighted", "challenger_sample_size": "challenger_sample_size",
            "auc_improvement": "auc_improvement", "accuracy_improvement": "accuracy_improvement",
            "f1_improvement": "f1_improvement"}.items()}),
    "params_long": _MANY_REPORT
    + long("test AS run_id", "r", {
        "ab_traffic_split": "'0.5'", "ab_test_timestamp": _STAMP, "ab_test_name": "'ab_test'",
        "confidence_threshold": "'0.02'", "winner": "winner", "should_promote": "CAST(should_promote AS VARCHAR)",
        "statistical_significance": "CAST(is_balanced AS VARCHAR)", "improvement_message": "improvement_message"}),
    "ab_report_json": _MANY_REPORT
    + f"""SELECT test, {_STAMP} AS timestamp, 'ab_test' AS test_name, 0.5::DOUBLE AS traffic_split,
       {r6('champion_auc', 'champion_auc')}, champion_sample_size, {r6('challenger_auc', 'challenger_auc')},
       {r6('challenger_accuracy', 'challenger_accuracy')}, {r6('challenger_f1_weighted', 'challenger_f1')},
       {r6('auc_improvement', 'auc_improvement')}, {r6('f1_improvement', 'f1_improvement')},
       is_balanced AS statistical_significance, winner, should_promote, improvement_message,
       0.02::DOUBLE AS confidence_threshold, status FROM r""",
    "schema_rows": with_(TX) + "\nUNION ALL\n".join(
        f"SELECT count(*) AS rows, '{c}' AS name, '{t}' AS type, true AS nullable, "
        f"count(*) - count({c}) AS nulls, count(*) > count({c}) AS has_nulls FROM tx"
        for c, t in _TX_TYPES.items()),
    "null_profile": with_(DOCS) + "SELECT count(*) AS rows, " + ", ".join(
        f"count(*) - count({c}) AS {c}_nulls" for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")) + " FROM docs",
    "preview": with_(TX) + "SELECT * FROM tx ORDER BY tx_id LIMIT 5",
    "class_balance": with_(TX) + "SELECT count(*) AS rows, sum(tx_fraud)::BIGINT AS positives, round(avg(tx_fraud), 6) + 0.0 AS positive_rate FROM tx",
    "split_counts": with_(TX) + f"""SELECT CASE WHEN {_SPLIT} < {TRAIN_SHARE!r} THEN 'train' ELSE 'test' END AS split,
       count(*) AS rows FROM tx GROUP BY 1""",
    "select_features": with_(TX, WIDE) + "SELECT tx_id, tx_amount, acct_bal, tx_fraud FROM wide",
    "assign_ab": with_(TX, scored("tx")) + "SELECT tx_id, ab_group FROM scored_groups",
    "group_filter": with_(TX) + f"SELECT tx_id, tx_amount, 'challenger' AS ab_group FROM tx WHERE {u('tx_id', repr('ab_test'))} < 0.3",
    "format_tx_id": with_(TX) + f"""SELECT tx_id, printf('tx_%08d', row_number() OVER (ORDER BY {_SPLIT}, tx_id) - 1) AS transaction_id FROM tx""",
    "split_train_test": with_(TX) + f"""SELECT tx_id, tx_fraud,
       CASE WHEN {_SPLIT} < {TRAIN_SHARE!r} THEN 'train' ELSE 'test' END AS part FROM tx""",
    "ab_holdout": with_(TX) + f"SELECT tx_id, tx_fraud FROM tx WHERE {_SPLIT} >= {HOLDOUT_FROM!r}",
    "sample_fraction": with_(TX) + f"SELECT tx_id, tx_fraud FROM tx WHERE {_SPLIT} < 0.8",
    "sample_complement": with_(TX) + f"SELECT tx_id, tx_fraud FROM tx WHERE {_SPLIT} >= 0.8",
    "sample_exact": with_(TX) + f"""SELECT tx_id, tx_fraud, row_number() OVER (PARTITION BY tx_fraud ORDER BY {_SPLIT}, tx_id)
         <= floor(0.8 * count(*) OVER (PARTITION BY tx_fraud) + 0.5) AS sampled FROM tx""",
    "sample_exact_total": with_(TX) + f"""SELECT tx_id, tx_amount FROM tx
QUALIFY row_number() OVER (ORDER BY {_SPLIT}, tx_id) <= floor(count(*) OVER () / 3.0 + 0.5)""",
    "anti_complement": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "union_classes": "SELECT event_id, event_type, value, CAST(event_type = 'error' AS INTEGER) AS fraud FROM events",
    "shuffle_rows": with_(TX) + f"SELECT tx_id, tx_amount, row_number() OVER (ORDER BY {_SPLIT}, tx_id) - 1 AS position FROM tx",
    "group_counts": with_(TX, scored("tx")) + """SELECT count(*) FILTER (ab_group = 'champion') AS champion_count,
       count(*) FILTER (ab_group = 'challenger') AS challenger_count FROM scored_groups""",
    "auc_by_group": with_(TX, scored("tx"), metrics("scored", ["ab_group"]))
    + f"SELECT ab_group, positives, negatives, {r6('auc', 'auc')}, {r6('auc_se', 'auc_se')} FROM m",
    "auc_one_shuffle": with_(TX, scored("tx"), metrics("scored", ["ab_group"]))
    + f"SELECT ab_group, positives, negatives, {r6('auc', 'auc')}, {r6('auc_se', 'auc_se')}, {r6('tied_pairs', 'tied_pairs')}, "
    + f"{r6('accuracy', 'accuracy')} FROM m",
    "confusion_by_group": with_(DOCS) + """SELECT lang, count(*) FILTER (quality = 1) AS positives,
       count(*) FILTER (quality = 0) AS negatives, count(*) FILTER (quality = 1 AND n_chars > 1000) AS tp,
       count(*) FILTER (quality = 0 AND n_chars > 1000) AS fp, count(*) FILTER (quality IS NULL) AS invalid,
       count(*) AS sample_size, count(*) FILTER (quality = 1 AND n_chars <= 1000) AS fn,
       count(*) FILTER (quality = 0 AND n_chars <= 1000) AS tn FROM docs GROUP BY lang""",
    "accuracy_by_group": with_(TX, scored("tx"))
    + "SELECT ab_group, count(*) AS sample_size, round(avg(CAST(y = pred AS INTEGER)), 6) + 0.0 AS accuracy FROM scored GROUP BY ab_group",
    "f1_by_group": with_(TX, scored("tx"), metrics("scored", ["ab_group"]))
    + f"SELECT ab_group, {r6('f1_positive', 'f1_positive')}, {r6('f1_weighted', 'f1_weighted')} FROM m",
    "holdout_metrics": with_(
        TX, f"""scored AS (
  SELECT *, tx_fraud AS y, CAST(score > 0.5 AS INTEGER) AS pred FROM (
    SELECT *, round(({u('tx_id', repr('champ'))} + {CHAMPION_PULL} * tx_fraud) / {1 + CHAMPION_PULL}, 3) AS score FROM tx))""",
        metrics("scored", [])) + f"SELECT {METRIC_COLUMNS} FROM m",
    "standardise": with_(TX, WIDE) + "SELECT tx_id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}_scaled" for c in ("tx_amount", "acct_bal"))
    + " FROM wide",
    "ab_report": with_(TX, scored("tx"), report("scored", [])) + f"SELECT {REPORT_SELECT} FROM r",
    "metric_deltas": with_(TX, scored("tx"), report("scored", ["priority"]))
    + f"SELECT priority, {r6('auc_improvement', 'auc_improvement')}, {r6('accuracy_improvement', 'accuracy_improvement')}, "
    + f"{r6('f1_improvement', 'f1_improvement')} FROM r",
    "ab_decision": _MANY_REPORT + f"SELECT test, {REPORT_SELECT} FROM r",
    "ab_failures": with_(TX, scored("tx"), report("scored", ["customer_id"]))
    + "SELECT customer_id, 'ab_test' AS test_name, status, reason FROM r WHERE status <> 'ok'",
    "ab_report_by_period": _PERIOD,
    "period_report_incremental": _PERIOD,
    "period_report_stateful": _PERIOD,
    "sequential_report": _LOOKS,
    "resolve_alias": with_(ALIASES) + "SELECT model, alias, version, source FROM resolved",
    "alias_exists": with_(ALIASES) + "SELECT model FROM resolved GROUP BY model HAVING count(*) = 2",
    "register_version": with_(ALIASES, REGISTERED) + "SELECT model, version, run_id, path, created_seq FROM registered",
    "register_aliases": with_(ALIASES, REGISTERED) + """
SELECT seq AS event_seq, model, 'challenger' AS alias, version, 'set' AS op, 'alias' AS source FROM registered
UNION ALL
SELECT seq + 1, model, 'champion', version, 'set', 'alias' FROM registered WHERE n = 0 AND NOT has_champion""",
    "promotion_status": _MODEL_REPORT.rstrip() + """,
able AS (SELECT DISTINCT r.model FROM r JOIN ends ON r.model = ends.model
         JOIN resolved chal ON chal.model = r.model AND chal.alias = 'challenger' WHERE should_promote)
SELECT r.model, winner, should_promote,
       CASE WHEN NOT should_promote THEN 'not_promoted' WHEN able.model IS NULL THEN 'failed' ELSE 'success' END AS promotion_status
FROM r LEFT JOIN able ON r.model = able.model""",
    "promote": _MODEL_REPORT.rstrip() + """,
now AS (
  SELECT r.model, last_seq, champ.version AS champion, chal.version AS challenger
  FROM r JOIN ends ON r.model = ends.model
  JOIN resolved chal ON chal.model = r.model AND chal.alias = 'challenger'
  LEFT JOIN resolved champ ON champ.model = r.model AND champ.alias = 'champion'
  WHERE should_promote)
SELECT last_seq + 1 AS event_seq, model, 'champion' AS alias, champion AS version, 'delete' AS op, 'alias' AS source
FROM now WHERE champion IS NOT NULL
UNION ALL SELECT last_seq + 2, model, 'champion', challenger, 'set', 'alias' FROM now
UNION ALL SELECT last_seq + 3, model, 'challenger', challenger, 'delete', 'alias' FROM now""",
    "ztest_accuracy": _MANY_REPORT.rstrip() + f""",
z AS (SELECT test, {two_proportion(
        'challenger_tp + challenger_tn', '(challenger_positives + challenger_negatives)',
        'champion_tp + champion_tn', '(champion_positives + champion_negatives)')} AS z FROM r)
SELECT test, {r6('z', 'accuracy_z')}, {r6(p_value('z'), 'accuracy_p_value')}, abs(z) > {Z_95!r} AS accuracy_significant FROM z""",
    "ztest_auc": _MANY_REPORT.rstrip() + f""",
z AS (SELECT *, auc_improvement / sqrt(challenger_auc_se * challenger_auc_se + champion_auc_se * champion_auc_se) AS z FROM r)
SELECT test, {r6('champion_auc_se', 'champion_auc_se')}, {r6('challenger_auc_se', 'challenger_auc_se')}, {r6('z', 'auc_z')},
       {r6(p_value('z'), 'auc_p_value')}, abs(z) > {Z_95!r} AS auc_significant FROM z""",
    "paired_auc": with_(TX, _PAIRED) + f"""SELECT priority, positives, negatives, 0 AS invalid, {r6('a', 'first_auc')}, {r6('b', 'second_auc')},
       {r6('sqrt(va)', 'first_auc_se')}, {r6('sqrt(vb)', 'second_auc_se')}, round(vab, 9) + 0.0 AS auc_covariance, {r6('b - a', 'auc_gain')},
       {r6('z', 'paired_z')}, {r6(p_value('z'), 'paired_p_value')}, abs(z) > {Z_95!r} AS paired_significant
FROM (SELECT *, (b - a) / sqrt(va + vb - 2 * vab) AS z FROM delong)""",
    "bootstrap_accuracy": with_(
        TX, scored("tx"),
        f"""counts AS (
  SELECT ab_group, CAST(floor({u('tx_id', repr('unit'))} * 1000) AS BIGINT) AS unit, count(*) AS rows,
         sum(CAST(y = pred AS INTEGER)) AS hits FROM scored GROUP BY ALL)""",
        replicated("counts", 50),
        "vals AS (SELECT rep, ab_group, sum(weight * hits)::DOUBLE / sum(weight * rows) AS value FROM reps GROUP BY ALL)",
        SUMMARY),
    "bootstrap_auc": with_(
        TX, scored("tx"),
        f"""counts AS (
  SELECT ab_group, CAST(floor({u('tx_id', repr('unit'))} * 200) AS BIGINT) AS unit, score, sum(y) AS p, sum(1 - y) AS n
  FROM scored GROUP BY ALL)""",
        replicated("counts", 20),
        """weighted AS (SELECT rep, ab_group, score, sum(weight * p)::DOUBLE AS p, sum(weight * n)::DOUBLE AS n FROM reps GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY rep, ab_group ORDER BY score) - n / 2 AS low_n FROM weighted),
vals AS (SELECT rep, ab_group, sum(p * low_n) / nullif(sum(p) * sum(n), 0) AS value FROM ranked GROUP BY ALL)""",
        SUMMARY),
    "bootstrap_accuracy_rows": with_(
        *row_bootstrap(50, "1 AS rows, CAST(y = pred AS INTEGER) AS hits"),
        "vals AS (SELECT rep, ab_group, sum(weight * hits)::DOUBLE / nullif(sum(weight * rows), 0) AS value FROM reps GROUP BY ALL)", SUMMARY),
    "bootstrap_auc_rows": with_(*row_bootstrap(20, "score, y AS p, 1 - y AS n"), AUC_VALUES, SUMMARY),
    "bootstrap_auc_little": little(8, 40),
    "slice_lattice": _LATTICE,
    "slice_metrics": _SLICES + f"SELECT ab_group, factor, segment, {METRIC_COLUMNS} FROM m",
    "slice_bias": _SLICES.rstrip() + f""",
z AS (SELECT s.ab_group, s.factor, s.segment, s.accuracy, s.accuracy - t.accuracy AS gap, {two_proportion(
        '(s.tp + s.tn)', 's.sample_size', '(t.tp + t.tn - s.tp - s.tn)', '(t.sample_size - s.sample_size)')} AS z
      FROM m s JOIN m t ON s.ab_group = t.ab_group AND t.factor = '(all)' WHERE s.factor <> '(all)')
SELECT ab_group, factor, segment, {r6('accuracy', 'accuracy')}, {r6('gap', 'accuracy_gap')}, {r6('z', 'z')}, {r6('p', 'p_value')},
       {r6('q', 'q_value')}, coalesce(q <= 0.05, false) AS biased
FROM (SELECT *, CASE WHEN p IS NOT NULL THEN least(1.0, min(p * m / r) OVER (PARTITION BY ab_group ORDER BY p DESC)) END AS q
      FROM (SELECT *, count(p) OVER (PARTITION BY ab_group) AS m, nullif(count(p) OVER (PARTITION BY ab_group ORDER BY p), 0) AS r
            FROM (SELECT *, {p_value('z')} AS p FROM z)))""",
    **{name: _MODEL_ROWS + _HOLDOUT + extra + f" FROM labelled WHERE {u('tx_id', repr('42'))} >= 0.8" for name, extra in (
        ("train_rf", ", true AS metrics_stored"), ("train_lr", ""), ("train_cv", ""),
        ("train_halving", ", 10::BIGINT AS trials, true AS deeper_wins, true AS under_half_of_the_rows"))},
    "model_params": """SELECT * FROM (VALUES
  ('rf', 'model_type', 'RandomForestClassificationModel'), ('rf', 'best_numTrees', '10'), ('rf', 'best_maxDepth', '5'), ('rf', 'seed', '42'),
  ('rf', 'weight_tx_amount', 'used'), ('rf', 'weight_acct_bal', 'used'),
  ('lr', 'model_type', 'LogisticRegressionModel'), ('lr', 'best_regParam', '0.0'), ('lr', 'best_maxIter', '100'),
  ('lr', 'weight_tx_amount', 'used'), ('lr', 'weight_acct_bal', 'used')) AS p(run_id, name, value)""",
    "score_champion_challenger": _MODEL_ROWS + """SELECT tx_id, ab_group, ab_group = 'champion' OR tx_id % 5 <> 0 AS scored,
       true AS in_range, true AS prediction_follows FROM labelled""",
    "ab_report_rf": _MODEL_ROWS + "SELECT " + ", ".join(
        f"count(*) FILTER ({g} AND {c}) AS {name}_{n}" for name, g in (("champion", "ab_group = 'champion'"), ("challenger", "ab_group = 'challenger'"))
        for n, c in (("sample_size", "true"), ("invalid", f"NOT ({_USED})"), ("positives", f"{_USED} AND y = 1"), ("negatives", f"{_USED} AND y = 0"))
    ) + ", 'challenger' AS winner, 'ok' AS status FROM labelled",
    # no transaction can be in both parts, whatever the hash
    "holdout_leak_check": "SELECT count(*) - count(o_orderkey) AS common_rows FROM orders",
    "model_round_trip": "SELECT 1::BIGINT AS version, count(*) AS rows, 0::BIGINT AS changed FROM orders",
}
