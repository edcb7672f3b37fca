"""Model versions and aliases as append-only tables.

``alias_events`` is a log: the last event of a (model, alias) counts. ``event_seq`` orders
the events of a model. Every operator works on all models at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import quote
from duelist.operators.decision import CHALLENGER, CHAMPION
from duelist.operators.sampling import with_position

VERSIONS = "model string, version bigint, run_id string, path string, created_seq bigint"
ALIAS_EVENTS = "event_seq bigint, model string, alias string, version bigint, op string, source string"
EVENT_COLUMNS = ["event_seq", "model", "alias", "version", "op", "source"]


def model_name(experiment: str) -> str:
    # Fixed value: suffix of a registered model's name.
    return f"{experiment}_model"


def _in_force(condition: str = "true") -> str:
    """Aggregate (SQL text): version of the last event, NULL if that one deletes. Version tags
    count only where no alias event was ever written.

    The aggregates hold plain numbers, so Spark keeps to hash aggregation.
    """
    last = "max_by(if(op = 'set', version, NULL), event_seq) FILTER (WHERE {0} AND source = '{1}')"
    any_alias = f"count_if({condition} AND source = 'alias') > 0"
    return f"if({any_alias}, {last.format(condition, 'alias')}, {last.format(condition, 'tag')})"


def resolve(events: DataFrame) -> DataFrame:
    """(model, alias, version, source) in force: last write wins.

    An aggregate rather than a ranking window: a model with most of all events is
    reduced before the shuffle.
    """
    return (
        events.groupBy("model", "alias")
        .agg(
            F.expr(f"{_in_force()} AS version"),
            F.expr("if(count_if(source = 'alias') > 0, 'alias', 'tag') AS source"),
        )
        .filter("version IS NOT NULL")
    )


def model_state(events: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """Per model: last event, last version and the versions of both aliases, in one aggregation."""
    rows = events.selectExpr(*EVENT_COLUMNS, "cast(NULL AS bigint) AS _version")
    if versions is not None:
        empty = [f"cast(NULL AS {'bigint' if c in ('event_seq', 'version') else 'string'}) AS {c}"
                 for c in EVENT_COLUMNS if c != "model"]
        rows = rows.unionByName(versions.selectExpr("model", *empty, "version AS _version"))
    aliases = [f"{_in_force(f'alias = {quote(a)}')} AS _{a}" for a in (CHAMPION, CHALLENGER)]
    return rows.groupBy("model").agg(
        F.expr("max(event_seq) AS _last_seq"), F.expr("max(_version) AS _last_version"), *map(F.expr, aliases)
    )


def has_alias(models: DataFrame, aliases: DataFrame, *names: str) -> DataFrame:
    """Models for which every one of the given aliases is in force."""
    wanted = aliases.filter(F.col("alias").isin(*names)).groupBy("model").agg(F.expr("count(*) AS _n"))
    return models.join(wanted.filter(f"_n = {len(set(names))}"), "model", "left_semi")


def register(
    runs: DataFrame, versions: DataFrame, events: DataFrame, run_order_width: int = 1 << 20
) -> DataFrame:
    """New versions for runs (model, run_id, path, run_seq), with their alias events.

    Runs already registered are left out, so a repeated call changes nothing; of a run that occurs
    several times the row with the smallest ``run_seq`` counts. A NULL model, run_id or run_seq is an
    error. Versions go on from the model's last one in ``run_seq`` order, ties by run_id. Every new
    version becomes challenger; the first one also champion if the model has none.
    ``run_order_width`` is the range of ``run_seq`` numbered in one task.

    One row per version: version columns plus ``events``, an array of alias events.
    """
    checked = runs.select("run_id", "run_seq", "model", "path").selectExpr(
        *(f"coalesce({c}, raise_error('{c} of a run must not be NULL')) AS {c}" for c in ("run_id", "run_seq", "model")), "path")
    once = checked.groupBy("run_id").agg(F.min(F.struct("run_seq", "model", "path")).alias("_first")).select("run_id", "_first.*")
    fresh = once.join(versions.select("run_id"), "run_id", "left_anti")
    ordered = with_position(fresh, "run_seq, run_id", f"floor(run_seq / {run_order_width})", ("model",), "_n")
    def event(step: int, alias: str) -> str:
        return (
            f"struct(_seq + {step} AS event_seq, model, '{alias}' AS alias, version, "
            "'set' AS op, 'alias' AS source)"
        )

    # Two event numbers per version: challenger first, then champion.
    return (
        ordered.join(model_state(events, versions), "model", "left")
        .selectExpr(
            "*",
            "coalesce(_last_version, 0) + _n + 1 AS version",
            "coalesce(_last_seq, 0) + 2 * _n + 1 AS _seq",
            f"_n = 0 AND _{CHAMPION} IS NULL AS _first_champion",
        )
        .selectExpr(
            "model", "version", "run_id", "path", "run_seq AS created_seq",
            f"if(_first_champion, array({event(0, CHALLENGER)}, {event(1, CHAMPION)}), "
            f"array({event(0, CHALLENGER)})) AS events",
        )
    )


def version_rows(registered: DataFrame) -> DataFrame:
    return registered.drop("events")


def event_rows(registered: DataFrame) -> DataFrame:
    return registered.select(F.inline("events"))


def promotion_outcome(report: DataFrame, events: DataFrame, key: str = "model") -> DataFrame:
    """``report`` with the ``promotion_status`` that the alias events allow: ``success`` only where promotion
    has events to write, ``failed`` where a winner that should be promoted has none (its alias is gone or
    already moved)."""
    moved = promote(report, events).select(F.col("model").alias("_moved")).distinct()
    return report.join(moved, report[key] == moved["_moved"], "left").withColumn(
        "promotion_status",
        F.expr("CASE WHEN NOT coalesce(promote, false) THEN 'not_promoted' WHEN _moved IS NULL THEN 'failed' ELSE 'success' END"),
    ).drop("_moved")


def promote(decisions: DataFrame, events: DataFrame) -> DataFrame:
    """Alias events for every model whose decision says ``promote``: the champion alias is
    dropped and set to the challenger's version, and the challenger alias is dropped.

    A decision may name the ``challenger_version`` that was tested; a challenger registered
    since then keeps its alias and is not promoted. Promoting twice changes nothing.
    """
    tested = "challenger_version" if "challenger_version" in decisions.columns else "cast(NULL AS bigint)"
    winners = decisions.filter("promote").groupBy("model").agg(F.expr(f"max({tested}) AS _tested"))

    def event(step: int, alias: str, version: str, op: str) -> str:
        return f"_last_seq + {step}, '{alias}', {version}, '{op}'"

    steps = [
        event(1, CHAMPION, "_champion", "delete"),
        event(2, CHAMPION, "_winner", "set"),
        event(3, CHALLENGER, "if(_challenger = _winner, _challenger, NULL)", "delete"),
    ]
    return (
        winners.join(model_state(events), "model")
        .selectExpr("*", "coalesce(_tested, _challenger) AS _winner")
        .filter("_winner IS NOT NULL AND (_champion IS NULL OR _champion <> _winner OR _champion = _challenger)")
        .selectExpr("model", f"stack(3, {', '.join(steps)}) AS (event_seq, alias, version, op)")
        .filter("version IS NOT NULL")
        .selectExpr(*EVENT_COLUMNS[:-1], "'alias' AS source")
    )
